"""Token ids of whole texts, by the public byte-level vocabulary."""

from __future__ import annotations

import re
import sys

import numpy as np

#: tiktoken's splitter without its look-ahead, which only matters where two white space characters meet.
_PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
_GAP = re.compile(r"\s\s")
#: The vocabulary's added token, which ``tokenizers`` cuts out of a text before all else.
ADDED, ADDED_ID = "<|endoftext|>", 50256


class Encoder:
    """Ids as ``tokenizers`` gives them for byte_bpe_50k.json; calls take
    strings that look like the added token as ordinary text, ``with_added``
    gives its id, as ``tokenizers`` does unless told otherwise."""

    def __init__(self, ranks_path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        make = lambda name, pattern: tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._plain = make("plain", _PLAIN)._core_bpe.encode_ordinary
        self._full = make("full", public_tokenizers.PATTERN)._core_bpe.encode_ordinary

    def __call__(self, text: str) -> np.ndarray:
        return np.array((self._full if _GAP.search(text) else self._plain)(text), dtype=np.uint32)

    def with_added(self, text: str) -> np.ndarray:
        if ADDED not in text:
            return self(text)
        out = [part for piece in text.split(ADDED) for part in (self(piece), np.array([ADDED_ID], np.uint32))]
        return np.concatenate(out[:-1])


def encoder(ranks_path: str) -> Encoder:
    """One per Python worker, kept for its later tasks."""
    kept = sys.__dict__.setdefault("_llm_encoders", {})
    if ranks_path not in kept:
        kept[ranks_path] = Encoder(ranks_path)
    return kept[ranks_path]
