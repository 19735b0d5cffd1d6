"""Vectorised word shingles: from Arrow text batches to sorted token sets.

Words are the runs of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased
(all other code points are compared as they are). A shingle is ``width``
neighbouring words; a text of fewer words has its whole word sequence as its
only shingle, a text without words has none. A shingle's token is 48 bits
of a keyed 64-bit hash: two different shingles of one pair of documents share
a token with probability under ``(shingles of the pair)^2 / 2^49``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

TOKEN_BITS = 48
#: Bytes of text whose letters are hashed at once.
SPAN_BYTES = 1 << 17
_rng = np.random.default_rng(0x5EED)
_LETTER = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[65:91] = _LETTER[97:123]  # A-Z as a-z
_PLACE, _STEP, _SHORT = _rng.integers(1, 2**62, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (bijective), so that sums and products spread well."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and each row's [start, end); null counts as
    empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def _word_sums(raw: np.ndarray, inside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of each word's letters by their places; words begin at ``at``,
    the first with the first byte."""
    place = np.arange(len(raw), dtype=np.int32)
    place -= np.repeat(place[at], np.diff(np.append(at, len(raw))))
    place[~inside] = 0
    powers = np.cumprod(np.full(int(place.max()) + 1, _PLACE), dtype=np.uint64)
    terms = powers[place]
    terms *= _LETTER[raw]
    terms[~inside] = 0
    return np.add.reduceat(terms, at)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, the row of each word). Numbers are held
    for the letters of ``SPAN_BYTES`` at a time, or of one longer word."""
    raw, offsets = text_bytes(texts)
    inside = ~_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(raw)]
    begins[edges] = inside[edges]  # a row's first byte begins a word of its own
    at = np.flatnonzero(begins)
    del begins
    hashes = np.empty(len(at), np.uint64)
    ends = np.append(at[1:], len(raw))
    w = 0
    while w < len(at):
        first = int(at[w])
        stop = max(w + 1, int(np.searchsorted(ends, first + SPAN_BYTES, side="right")))
        span = slice(first, int(ends[stop - 1]))
        hashes[w:stop] = mix(_word_sums(raw[span], inside[span], at[w:stop] - first))
        w = stop
    return hashes, np.searchsorted(offsets, at, side="right") - 1


def _sequence(hashes: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Hash of the run of n words that begins at each of ``first``, order and
    number included."""
    out = np.full(len(first), n, np.uint64) * _SHORT
    for k in range(n):
        out = mix(out * _STEP + hashes[first + k])
    return out


def token_sets(texts: pa.Array, width: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, bounds): row i's distinct tokens, ascending, are
    ``tokens[bounds[i]:bounds[i + 1]]``. Under 65,536 rows at once."""
    rows = len(texts)
    assert rows < 1 << (64 - TOKEN_BITS)
    hashes, row = word_hashes(texts)
    counts = np.bincount(row, minlength=rows)
    first = np.cumsum(counts) - counts
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if len(hashes) >= width:
        full = np.flatnonzero(row[width - 1:] == row[:len(row) - width + 1])
        keys.append(_sequence(hashes, full, width))
        owners.append(row[full])
    for n in range(1, width):
        few = np.flatnonzero(counts == n)
        if len(few):
            keys.append(_sequence(hashes, first[few], n))
            owners.append(few)
    keyed = np.concatenate(keys) >> np.uint64(64 - TOKEN_BITS)
    keyed |= np.concatenate(owners).astype(np.uint64) << np.uint64(TOKEN_BITS)
    keyed.sort()
    if len(keyed):
        keyed = keyed[np.append(True, keyed[1:] != keyed[:-1])]
    bounds = np.searchsorted(keyed, np.arange(rows + 1, dtype=np.uint64) << np.uint64(TOKEN_BITS))
    return keyed & np.uint64((1 << TOKEN_BITS) - 1), bounds
