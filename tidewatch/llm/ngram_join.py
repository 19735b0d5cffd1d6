"""Operator 6: n-gram Jaccard join over size-banded tiles.

Documents with equal shingle sets are one node. Two nodes link when
``den * |x & y| >= num * |x | y|`` for a ratio (num, den). The join loses no
link:

* **Size bands.** Band edges grow by the ratio, so linked nodes lie in the
  same or in neighbouring bands; a tile covers two neighbouring bands.
* **Tiles.** Linked nodes of a tile differ in at most ``d`` tokens,
  ``d = (den - num) (|x| + |y|) / (den + num)`` at the band edges. Tokens are
  dealt into ``d + 1 + e`` parts by hash, so two linked nodes agree on
  ``e + 1`` whole parts at least: on one that is not empty, unless both have
  more than ``e`` empty parts, and then their empty parts count as well (e is
  set so that hardly any node has more). A tile's key is (band, part, sum of
  the part's tokens). Small sets, which differ from linked ones in one token
  at most, have as keys the set and, where that can link, the set without
  each one token.
* **Sketches.** Pairs of a tile are first bounded by bit counts: every token
  turns over one of 1,024 bits, so that tokens of both sets leave no trace, and
  ``|x & y| <= (|x| + |y| - |bx ^ by|) / 2``. Large sets, whose linked ones may
  differ in more tokens than those bits can show, have longer sketches by their
  size as well: in a large corpus most pairs of a tile are long documents that
  share one common shingle, and these pairs end there.
* **Exact.** What is left is decided by intersecting the sorted token arrays.

Groups are never paired off in full. Each chunk of an input partition links
the nodes of a tile to its first one, and an exchange of packed keys links
those firsts to each other, so a tile meets at most once per chunk. After
these stars are verified and joined up, only tiles that still hold more than
one component compare nodes across components, in blocks of bounded size:
each stray's likeliest pair first, then all pairs that are left. A pair of
nodes that share many tiles is given out in one of them, the least one, which
each of them knows from its own list.

Documents are staged once with their row numbers, in buckets of their chunks.
Later steps read them more than once and name them by the written numbers
alone, so it doesn't matter how each reading splits the files. Texts and token
sets of all documents are never exchanged: rows that a step wants are gathered
by chunk and dealt to the buckets (:meth:`_Join.picked`), and only the sets of
nodes in pairs that the bit counts allow meet each other. The tables of such a
round and the files of each exchange go as soon as the round has been written.

Defined cases: null and blank texts have an empty set, link with nothing and
are a component of their own; equal texts are one component; a repeated
``doc_id`` stands once per row, and of rows equal in ``doc_id`` the first
represents their component; an empty table gives no rows; extra columns pass
through :func:`representatives` under any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, exchanges_end, slices, staged, staged_by, with_row_id
from .components import components
from .shingles import TOKEN_BITS, mix, token_sets

BITMAP_BITS = 1024
#: The longest sketch; sets of more than about 150,000 tokens (at 0.8) are bounded less closely.
SKETCH_BITS = 1 << 16
CHUNK_BYTES = 2 << 20
CHUNK_ROWS = 4096
#: Low bits of a row number, which tell the rows of a chunk apart.
CHUNK_BITS = 13
#: Tokens whose tile keys are made at once.
RUN_TOKENS = 1 << 15
#: Nodes on a side of a block in the comparison across components.
BLOCK = 2048
#: Rows of a tile up to which it is gathered whole, to compare equal tiles once.
SMALL_TILE = 64
#: A node's least tiles, from which it is known which shared tile gives a pair out.
LEAST_TILES = 8
_NO_TILE = np.iinfo(np.int64).max
#: Packed tile keys that one task of the exchange takes, on average.
TASK_KEYS = 4 << 20
_TOKEN_BYTES = TOKEN_BITS // 8
ROW = "__row"
CHUNK = "__chunk"


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of num / den at least, over shingles of width words."""
    num: int
    den: int
    width: int

    def links(self, n_x, n_y, common):
        return self.den * common >= self.num * (n_x + n_y - common)

    def apart(self, n_x, n_y):
        """Most tokens in which linked sets of these sizes differ."""
        return (self.den - self.num) * (n_x + n_y) // (self.den + self.num)

    def partner(self, n):
        """Largest set that a set of n links with."""
        return n * self.den // self.num

    def sketch_bits(self, n: int) -> int:
        """A power of two, four times the tokens in which linked sets of this
        size differ or more: sets that differ in a quarter more are told apart."""
        return min(max(1 << (4 * self.apart(n, n) - 1).bit_length(), BITMAP_BITS), SKETCH_BITS)

    def small(self) -> int:
        """First size whose linked sets can differ in two tokens."""
        n = 1
        while self.apart(n, self.partner(n)) < 2:
            n += 1
        return n

    def edges(self, most: int) -> np.ndarray:
        """Ascending first sizes of the bands, past ``most`` by two."""
        out = [self.small()]
        while len(out) < 3 or out[-3] <= most:
            out.append(max(out[-1] + 1, self.partner(out[-1] - 1) + 1))
        return np.array(out, np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], width: int):
    """(tokens, bounds, set ids, rows, doc ids, chunk number) for runs of
    rows of bounded bytes; batches hold row, doc_id, text, bytes. A chunk is
    what shares the high bits of the row number; it may come in several runs."""
    for batch in batches:
        chunks = batch.column(0).to_numpy() >> CHUNK_BITS
        changes = np.append(np.flatnonzero(chunks[1:] != chunks[:-1]) + 1, len(batch))
        sizes = np.cumsum(np.append(0, batch.column(3).to_numpy(zero_copy_only=False)))
        at = 0
        while at < len(batch):
            end = int(np.searchsorted(sizes, sizes[at] + CHUNK_BYTES, side="right")) - 1
            end = min(max(end, at + 1), at + CHUNK_ROWS, int(changes[np.searchsorted(changes, at, side="right")]))
            part = batch.slice(at, end - at)
            tokens, bounds = token_sets(part.column(2), width)
            yield tokens, bounds, _set_ids(tokens, bounds), part.column(0), part.column(1), int(chunks[at])
            at = end


def _set_ids(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 63-bit id per set (0 for the empty set)."""
    data = tokens.astype("<u8").tobytes()
    out = np.zeros(len(bounds) - 1, np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if a < b:
            out[i] = (int.from_bytes(hashlib.blake2b(data[8 * a:8 * b], digest_size=8).digest(), "little") >> 1) or 1
    return out


def _sketch(tokens: np.ndarray, bits: int) -> np.ndarray:
    """How many tokens fall on each of so many places, modulo two, packed."""
    places = (mix(tokens) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(bool)).view(np.uint64)


def _folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch of the same set in so many words of 64 bits."""
    while len(sketch) > words:
        sketch = sketch[:len(sketch) // 2] ^ sketch[len(sketch) // 2:]
    return sketch


def _firsts(nodes: np.ndarray) -> np.ndarray:
    """Rows of a run on which a node appears first, without empty sets."""
    first = np.sort(np.unique(nodes, return_index=True)[1])
    return first[nodes[first] != 0]


def _members(t: Threshold):
    """A row per document: its node, number of tokens, and for a node's first
    row of the run its bits, and its sketch if that is longer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, bounds, nodes, rows, docs, _ in _chunks(batches, t.width):
            bits: list[bytes | None] = [None] * len(nodes)
            sketches: list[bytes | None] = [None] * len(nodes)
            for i in _firsts(nodes).tolist():
                sketch = _sketch(tokens[bounds[i]:bounds[i + 1]], t.sketch_bits(int(bounds[i + 1] - bounds[i])))
                bits[i] = _folded(sketch, BITMAP_BITS // 64).tobytes()
                if len(sketch) > BITMAP_BITS // 64:
                    sketches[i] = sketch.tobytes()
            yield pa.RecordBatch.from_arrays([rows, docs, pa.array(nodes), pa.array(np.diff(bounds).astype(np.int64)),
                                              pa.array(bits, pa.binary()), pa.array(sketches, pa.binary())],
                                             names=["row", "doc_id", "node", "n", "bits", "sketch"])
    return run


def _sets(width: int):
    """node and its sorted tokens, 6 bytes each; once per chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, bounds, nodes, _, _, _ in _chunks(batches, width):
            packed = tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_TOKEN_BYTES].tobytes()
            keep = _firsts(nodes).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array(nodes[keep]), pa.array([packed[_TOKEN_BYTES * bounds[i]:_TOKEN_BYTES * bounds[i + 1]] for i in keep],
                                                pa.binary())], names=["node", "tokens"])
    return run


def unpack(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // _TOKEN_BYTES, 8), np.uint8)
    wide[:, :_TOKEN_BYTES] = np.frombuffer(packed, np.uint8).reshape(-1, _TOKEN_BYTES)
    return wide.view("<u8").ravel()


def _part_keys(tokens: np.ndarray, owner: np.ndarray, tile: np.ndarray, parts: np.ndarray,
               spare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, set) of each part of each set; empty parts only of sets with
    more than ``spare`` of them. Each set has its own tile and parts."""
    base = np.cumsum(parts) - parts
    n = int(parts.sum())
    spread = mix(tokens)
    part = ((spread >> np.uint64(32)) * parts[owner].astype(np.uint64)) >> np.uint64(32)
    slot = base[owner] + part.astype(np.int64)
    filled = np.bincount(slot, minlength=n) > 0
    sums = np.zeros(n, np.uint64)
    if len(slot):
        order = np.argsort(slot, kind="stable")
        begin = np.flatnonzero(np.append(True, np.diff(slot[order]) > 0))
        sums[slot[order][begin]] = np.add.reduceat(mix(spread ^ _SALT)[order], begin)
    owners = np.repeat(np.arange(len(parts)), parts)
    empties = np.bincount(owners[~filled], minlength=len(parts))
    keep = filled | (empties > spare)[owners]
    number = np.arange(n) - base[owners]
    tag = (tile[owners].astype(np.uint64) << np.uint64(40)) | (number.astype(np.uint64) << np.uint64(1)) | filled
    return mix(sums + mix(tag))[keep], owners[keep]


_SALT = np.uint64(0x9E3779B97F4A7C15)


def tile_keys(tokens: np.ndarray, bounds: np.ndarray, t: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """(key, set number) of all tiles of all (non-empty) sets; each set's keys
    are its own, so sets are taken a run of ``RUN_TOKENS`` at a time."""
    keys, sets, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(bounds) - 1:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + RUN_TOKENS, side="right")) - 1)
        key, who = _run_keys(tokens[bounds[at]:bounds[end]], bounds[at:end + 1] - bounds[at], t)
        keys.append(key), sets.append(who + at)
        at = end
    return np.concatenate(keys), np.concatenate(sets)


def _run_keys(tokens: np.ndarray, bounds: np.ndarray, t: Threshold) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    small = t.small()
    spread = mix(mix(tokens) + np.uint64(1))
    total = np.add.reduceat(spread, bounds[:-1])
    few = sizes <= t.partner(small - 1)
    mine = (few & t.links(sizes, sizes - 1, sizes - 1))[owner]  # those that can link with a set of one token less
    keys = [mix(total[few]), mix(total[owner[mine]] - spread[mine])]
    sets = [np.flatnonzero(few), owner[mine]]
    large = np.flatnonzero(sizes >= small)
    if len(large):
        edges = t.edges(int(sizes.max()))
        band = np.searchsorted(edges, sizes[large], side="right") - 1
        renumber = np.full(len(sizes), -1)
        for below in (0, 1):
            ok = band >= below
            tile = band[ok] - below
            apart = t.apart(edges[tile + 1] - 1, np.minimum(edges[tile + 2] - 1, t.partner(edges[tile + 1] - 1)))
            low = edges[tile]
            spare = np.ones(len(tile), np.int64)
            for _ in range(3):
                parts = apart + 1 + spare
                empty = parts * np.exp(-low / parts)
                spare = np.ceil(empty + 4 * np.sqrt(empty) + 1).astype(np.int64)
            parts = apart + 1 + spare
            renumber[:] = -1
            renumber[large[ok]] = np.arange(int(ok.sum()))
            own = renumber[owner]
            k, s = _part_keys(tokens[own >= 0], own[own >= 0], tile + 1, parts, spare)
            keys.append(k), sets.append(large[ok][s])
    return np.concatenate(keys), np.concatenate(sets)


_SHARED = np.uint16(1 << 15)


def _tiles(t: Threshold, buckets: int):
    """Each chunk's tile keys, packed by bucket. A tile's first node of the
    chunk is its head. Heads are dealt out by the key, to meet the heads of
    other chunks; the rest only name their head, dealt by chunk, so that a hot
    tile isn't dealt to one place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, bounds, nodes, rows, _, chunk in _chunks(batches, t.width):
            first = _firsts(nodes)
            if not len(first):
                continue
            pieces = [tokens[bounds[i]:bounds[i + 1]] for i in first.tolist()]
            key, who = tile_keys(np.concatenate(pieces), np.append(0, np.cumsum([len(p) for p in pieces])), t)
            order = np.lexsort((who, key))
            key, who = key[order], who[order]
            fresh = np.append(True, (key[1:] != key[:-1]) | (who[1:] != who[:-1]))
            low = (rows.to_numpy()[first] & ((1 << CHUNK_BITS) - 1)).astype(np.uint16)
            key, who = key[fresh], low[who[fresh]]
            starts = np.append(True, key[1:] != key[:-1])
            begin = np.flatnonzero(starts)
            group = np.cumsum(starts) - 1
            several = np.diff(np.append(begin, len(key))) > 1
            heads, head = key[begin], who[begin] | np.where(several, _SHARED, np.uint16(0))
            bucket = (heads % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
            filled = np.flatnonzero(np.diff(cuts))
            rest = ~starts
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(filled, chunk % buckets).astype(np.int32)), pa.array([chunk] * (len(filled) + 1), pa.int64()),
                pa.array([*(heads[by[cuts[b]:cuts[b + 1]]].tobytes() for b in filled), key[rest].tobytes()], pa.binary()),
                pa.array([*(head[by[cuts[b]:cuts[b + 1]]].tobytes() for b in filled), who[rest].tobytes()], pa.binary()),
                pa.array([*(b"" for _ in filled), who[begin][group][rest].tobytes()], pa.binary())],
                names=["bucket", "chunk", "keys", "who", "heads"])
    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tile, place, to) of the tiles with two nodes or more, a place
    being a row that has the node: to is the
    head's place, or for a head the first head's. A tile's heads are all in
    one bucket, so the task's buckets are sorted one after the other."""
    dealt: dict[int, list[tuple[int, bytes, bytes]]] = {}

    def out(tile, place, to):
        for k in range(0, len(tile), 100_000):
            s = slice(k, k + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(x[s].view(np.int64)) for x in (tile, place, to)], names=["tile", "place", "to"])

    for b in batches:
        for bucket, chunk, k, w, h in zip(*(b.column(c).to_pylist() for c in ("bucket", "chunk", "keys", "who", "heads")), strict=True):
            if h:
                base = np.uint64(chunk << CHUNK_BITS)
                yield from out(np.frombuffer(k, np.uint64), base | np.frombuffer(w, np.uint16).astype(np.uint64),
                               base | np.frombuffer(h, np.uint16).astype(np.uint64))
            elif k:
                dealt.setdefault(bucket, []).append((chunk, k, w))
    while dealt:
        _, heads = dealt.popitem()
        yield from out(*_met(heads))


def _met(heads: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tile, place, to) of the heads of a bucket; empties the list."""
    key = np.frombuffer(b"".join(k for _, k, _ in heads), np.uint64)
    who = np.frombuffer(b"".join(w for _, _, w in heads), np.uint16)
    chunk = np.repeat(np.array([c for c, _, _ in heads], np.uint64), [len(w) // 2 for _, _, w in heads])
    heads.clear()
    place = (chunk << np.uint64(CHUNK_BITS) | (who & ~_SHARED)) << np.uint64(1) | (who >= _SHARED)
    order = np.lexsort((place, key))
    key, place = key[order], place[order]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(begin, len(key)))
    keep = np.repeat(size > 1, size) | (place & np.uint64(1) == 1)
    to = np.repeat(place[begin], size)
    return key[keep], place[keep] >> np.uint64(1), to[keep] >> np.uint64(1)


def _words(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), BITMAP_BITS // 64)


def _bound(t: Threshold, n_x, n_y, bits_x: np.ndarray, bits_y: np.ndarray):
    """May the sets link, by the upper bound that the bit counts give?"""
    apart = np.bitwise_count(bits_x ^ bits_y).sum(axis=-1, dtype=np.int64)
    return t.links(n_x, n_y, (n_x + n_y - apart) // 2)


_PAIR = "x long, y long"


def _by_bits(t: Threshold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                ok = _bound(t, b.column("nx").to_numpy(), b.column("ny").to_numpy(), _words(b.column("bx")), _words(b.column("by")))
                yield b.select(["x", "y"]).filter(pa.array(ok))
    return run


def _by_sketches(t: Threshold):
    """A pair passes if one of its sets has no sketch, as it has been bounded
    by its bits."""
    def allowed(n_x, n_y, x, y) -> bool:
        if x is None or y is None:
            return True
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        words = min(len(x), len(y))
        return bool(_bound(t, n_x, n_y, _folded(x, words), _folded(y, words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "sx"):
            ok = [allowed(*pair) for pair in zip(*(b.column(c).to_pylist() for c in ("nx", "ny", "sx", "sy")), strict=True)]
            yield b.select(["x", "y"]).filter(pa.array(ok, pa.bool_()))
    return run


def _exactly(t: Threshold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "tx"):
            ok = []
            for p, q in zip(b.column("tx").to_pylist(), b.column("ty").to_pylist(), strict=True):
                x, y = unpack(p), unpack(q)
                both = np.concatenate([x, y])
                both.sort(kind="stable")  # merges two ascending runs
                ok.append(bool(t.links(len(x), len(y), int((both[1:] == both[:-1]).sum()))))
            yield b.select(["x", "y"]).filter(pa.array(ok, pa.bool_()))
    return run


def _once(tile: int, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Is this the tile in which a node's pairs with others are given out?
    Rows hold a node's least tiles. If two nodes' least tiles have one in
    common, the least such one is the least of all that they share, in every
    tile alike; if they have none, each tile gives the pair out."""
    shared = np.where((theirs[:, :, None] == mine).any(axis=2), theirs, _NO_TILE).min(axis=1)
    return (shared == tile) | (shared == _NO_TILE)


def _across(t: Threshold, best: bool):
    """Blocks, one after the other: each stray against the block's nodes of
    other components; the pairs that the bit counts allow, each from one tile
    of those that its nodes share, or of each stray the pair that they bound
    highest."""
    def pairs(block: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n, comp, node, side, tile, stray, bits, least = block
        ys = np.flatnonzero(side == 1)
        for x in np.flatnonzero(side == 0):
            near = ys[(comp[ys] != comp[x]) & (t.den * np.minimum(n[ys], n[x]) >= t.num * np.maximum(n[ys], n[x]))]
            if not best:  # two strays meet twice
                near = near[~stray[near] | (node[near] > node[x])]
            if len(near):
                both = n[x] + n[near]
                most = (both - np.bitwise_count(bits[x] ^ bits[near]).sum(axis=-1, dtype=np.int64)) // 2
                allowed = t.links(n[x], n[near], most)
                if best:
                    hit = near[np.argmax(np.where(allowed, most / (both - most), -1))[None]] if allowed.any() else near[:0]
                else:
                    hit = near[allowed]
                    hit = hit[_once(tile[x], least[x], least[hit])]
                yield np.minimum(node[hit], node[x]), np.maximum(node[hit], node[x])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] = ()
        last = None
        for b in batches:
            if not len(b):
                continue
            key = b.column("block").to_numpy()
            rows = (*(b.column(c).to_numpy(zero_copy_only=False) for c in ("n", "comp", "node", "side", "tile", "stray")), _words(b.column("bits")), _least_tiles(b.column("least")))
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(b)]
            out: list[tuple[np.ndarray, np.ndarray]] = []
            for i, j in zip(cuts, cuts[1:], strict=False):
                part = tuple(c[i:j] for c in rows)
                if held and key[i] == last:
                    held = tuple(np.concatenate(c) for c in zip(held, part, strict=True))
                else:
                    out += pairs(held) if held else ()
                    held = part
                last = key[i]
            held = tuple(c.copy() for c in held)
            if out:
                yield _pair_batch(out)
        if held and (out := list(pairs(held))):
            yield _pair_batch(out)
    return run


def _least_tiles(lists: pa.Array) -> np.ndarray:
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.full((len(lists), LEAST_TILES), _NO_TILE)
    out[np.arange(LEAST_TILES) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _pair_batch(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    x, y = (np.concatenate(c) for c in zip(*found, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])


class _Join:
    """The steps of the join over one table of documents."""

    def __init__(self, docs: DataFrame, text: str, key: str, t: Threshold):
        self.t = t
        whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
        numbered = with_row_id(docs, ROW).withColumn(CHUNK, F.shiftright(ROW, CHUNK_BITS))
        buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
        self.docs = staged_by(numbered, "ngram-documents", CHUNK, ROW, buckets)
        self.columns = (F.col(ROW).alias("row"), F.col(key).cast("long").alias("doc_id"), whole.alias("text"),
                        F.octet_length(whole).cast("long").alias("bytes"))
        self.rows = self.docs.select(*self.columns)
        self.members = staged(self.rows.mapInArrow(_members(t), "row long, doc_id long, node long, n long, bits binary, sketch binary"),
                              "ngram-members")
        self.bits = self.members.where("bits is not null").select("node", "n", "bits").dropDuplicates(["node"])
        self.sketches = self.members.where("sketch is not null").select("node", "n", "sketch").dropDuplicates(["node"])

    def tiles(self) -> DataFrame:
        total = self.members.agg(F.sum("n")).first()[0] or 0
        spread = 4 * (self.t.den - self.t.num) / (self.t.den + self.t.num)  # keys per token: two tiles
        least = int(self.members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(least, int(total * spread // TASK_KEYS) + 1)
        keys = self.rows.mapInArrow(_tiles(self.t, 4 * tasks), "bucket int, chunk long, keys binary, who binary, heads binary")
        return staged(keys.repartition(tasks, "bucket").mapInArrow(_meet, "tile long, place long, to long"), "ngram-tiles")

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Pairs of nodes that the bit counts allow to link."""
        x, y = self.bits.toDF("x", "nx", "bx"), self.bits.toDF("y", "ny", "by")
        return (pairs.join(x, "x").join(y, "y").select("x", "y", "nx", "ny", "bx", "by").mapInArrow(_by_bits(self.t), _PAIR))

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Of pairs that the bit counts allow, those that the sketches do."""
        x, y = self.sketches.toDF("x", "nx", "sx"), self.sketches.toDF("y", "ny", "sy")
        return (pairs.join(x, "x", "left").join(y, "y", "left").select("x", "y", "nx", "ny", "sx", "sy").mapInArrow(_by_sketches(self.t), _PAIR))

    def picked(self, rows: DataFrame) -> DataFrame:
        """The documents with these row numbers. The numbers are gathered by
        chunk, a list of bounded length, and go to the documents' buckets."""
        low = (F.col(ROW) % (1 << CHUNK_BITS)).cast("short")
        wanted = (rows.toDF(ROW).select(F.shiftright(ROW, CHUNK_BITS).alias(CHUNK), low.alias("low"))
                  .groupBy(CHUNK).agg(F.collect_set("low").alias("wanted")))
        return self.docs.join(wanted.hint("shuffle_hash"), CHUNK).where(F.array_contains("wanted", low))

    def exact(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs of nodes that do link, staged, by their whole sets: those of
        the nodes of likely pairs alone, each from one of its rows."""
        own = Scratch()
        try:
            with own:
                pairs = staged(self.likely(pairs), "ngram-candidates")
                nodes = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
                rows = self.members.where("node != 0").groupBy("node").agg(F.min("row").alias("row")).join(nodes, "node", "left_semi")
                sets = staged(self.picked(rows.select("row")).select(*self.columns).mapInArrow(_sets(self.t.width), "node long, tokens binary"), "ngram-sets")
            return staged(pairs.join(sets.toDF("x", "tx"), "x").join(sets.toDF("y", "ty"), "y")
                          .select("x", "y", "tx", "ty").mapInArrow(_exactly(self.t), _PAIR), name)
        finally:
            own.clear()

    def stars(self, tiles: DataFrame) -> DataFrame:
        """Distinct pairs of different nodes, each node with its tile's head."""
        a, b = self.places.toDF("place", "a"), self.places.toDF("to", "b")
        pairs = tiles.where("place != to").select("place", "to").distinct().join(a, "place").join(b, "to").where("a != b")
        return pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()

    def mixed(self, tiles: DataFrame, labels: DataFrame) -> DataFrame:
        """(tile, node) of the tiles that hold several components. A tile of
        two nodes has been decided by its star. Small tiles with the same nodes
        (near sets that do not link share many) are one."""
        comp = (self.places.join(labels, "node", "left")
                .select("place", "node", F.coalesce("component", "node").alias("comp")))
        mixed = (tiles.join(comp, "place").groupBy("tile").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("rows"))
            .where("low != high and rows > 2").select("tile", "rows"))
        named = tiles.select("tile", "place").join(mixed, "tile").join(self.places, "place").select("tile", "rows", "node")
        small = (named.where(F.col("rows") <= SMALL_TILE).groupBy("tile").agg(F.sort_array(F.collect_set("node")).alias("g"))
                 .where(F.size("g") > 2).select("g").distinct())
        small = small.select(F.xxhash64("g").alias("tile"), F.explode("g").alias("node"))
        return staged(named.where(F.col("rows") > SMALL_TILE).select("tile", "node").distinct().union(small), "ngram-mixed")

    def across(self, mixed: DataFrame, labels: DataFrame, best: bool) -> DataFrame:
        """Pairs across components within the tiles that hold several: all
        that the bit counts allow, or the best of each stray."""
        named = mixed.join(labels, "node", "left").select("tile", "node", F.coalesce("component", "node").alias("comp"))
        sizes = named.groupBy("tile", "comp").agg(F.count("*").alias("m")).groupBy("tile").agg(
            F.sum("m").alias("size"), F.max(F.struct("m", "comp"))["comp"].alias("main"), F.count("*").alias("comps")).where("comps > 1")
        known = self.bits.withColumn("least", F.array().cast("array<long>"))
        if not best:  # a node's tiles are at most its keys
            least = F.slice(F.sort_array(F.collect_list("tile")), 1, LEAST_TILES)
            known = mixed.groupBy("node").agg(least.alias("least")).join(self.bits, "node")
        rest = named.join(sizes, "tile").withColumn("stray", F.col("comp") != F.col("main")).join(known, "node")
        down = F.ceil(F.col("size") / BLOCK).cast("long")
        mine, every = F.pmod(F.xxhash64("node", "tile"), down), F.explode(F.sequence(F.lit(0).cast("long"), down - 1))
        block = F.xxhash64("tile", "i", "j").alias("block")
        cols = ["tile", "node", "comp", "stray", "n", "bits", "least"]
        left = rest.where("stray").select("*", mine.alias("i"), every.alias("j"))
        right = rest.select("*", mine.alias("j"), every.alias("i"))
        blocks = left.select(block, F.lit(0).alias("side"), *cols).union(right.select(block, F.lit(1).alias("side"), *cols))
        return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(_across(self.t, best), _PAIR).distinct()

    def links(self) -> tuple[DataFrame, DataFrame]:
        """(verified pairs of nodes, components): the pairs connect all that
        links connect."""
        with exchanges_end(self.docs.sparkSession):
            tiles = self.tiles()
            places = self.members.select(F.col("row").alias("place"), "node")
            self.places = staged(places.join(tiles.select("place").distinct(), "place", "left_semi"), "ngram-places")
            found = self.exact(self.bounded(self.stars(tiles)), "ngram-links")
            labels = staged(components(found, "x", "y"), "ngram-labels")
            # First each stray's likeliest pair: that joins most of what links, and
            # pairs within a component need no comparing. Then all pairs left.
            mixed = self.mixed(tiles, labels)
            for best in (True, False):
                more = self.exact(self.across(mixed, labels, best), "ngram-across")
                if not more.isEmpty():
                    found = staged(found.union(more), "ngram-links")
                    labels = staged(components(found, "x", "y"), "ngram-labels")
        return found, labels


def jaccard_components(docs: DataFrame, ratio: tuple[int, int] = (8, 10), width: int = 5, text: str = "text",
                       key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_shingles, set_id
    (documents of equal sets share it), set_links (verified links of the set
    to others: enough to connect its component), component_id (the smallest
    doc_id reachable)."""
    plain = docs.select(F.col(text).alias("text"), F.col(key).alias("key"))
    join = _Join(plain, "text", "key", Threshold(*ratio, width))
    found, labels = join.links()
    degree = found.select(F.explode(F.array("x", "y")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    nodes = (join.members.where("node != 0").groupBy("node").agg(F.min("doc_id").alias("least"))
             .join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(least, "component").join(degree, "node", "left").select("node", "component_id", "links")
    return (join.members.join(nodes, "node", "left")
            .select("row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.col("node").alias("set_id"), F.coalesce("links", F.lit(0)).cast("long").alias("set_links")))


def representatives(docs: DataFrame, ratio: tuple[int, int] = (8, 10), width: int = 5, text: str = "text",
                    key: str = "doc_id") -> DataFrame:
    """The documents that stay, with all their columns: of each component the
    one with the smallest key (null last), and every document without a set."""
    plain = [f"c{i}" for i in range(len(docs.columns))]  # inner names, so that no column clashes
    name = dict(zip(docs.columns, plain, strict=True))
    inner = docs.toDF(*plain)
    join = _Join(inner, name[text], name[key], Threshold(*ratio, width))
    _, labels = join.links()
    best = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")).alias("b")
    nodes = join.members.where("node != 0").groupBy("node").agg(best).join(labels, "node", "left")
    stay = nodes.groupBy(F.coalesce("component", "node")).agg(F.min("b").alias("b")).select(F.col("b.row").alias(ROW))
    stay = stay.union(join.members.where("node = 0").select(F.col("row").alias(ROW)))
    return (join.picked(stay)
            .select(*[F.col(p).alias(c) for p, c in zip(plain, docs.columns, strict=True)]))
