"""Operator 5: hierarchical multi-length packing into windows of tokens.

Each input partition packs groups of documents of about ``group_tokens``
tokens, so nothing is exchanged and memory is bounded by a group and one
document. In a group:

* every whole window of a document is a sequence of its own;
* what is left of each document is routed to the smallest context tier that
  holds it (256, 512, 1,024 or 2,048 tokens);
* tiers are packed from the longest on: a window opens with the longest rest
  of its tier, its gap is filled by the longest rests that fit, of its own or
  shorter tiers, and at last by a cut, so windows are full;
* the tokens that are left at the end of a group become sequences whose
  lengths are powers of two, which need no padding either;
* sequences are dealt to step groups, longest first, each to the group with
  the fewest tokens, so steps have equal work.

Defined cases: a null or empty text is its end id alone; a text of any length
is tokenized whole; the vocabulary's added token in a text is one id with
``added``, as in the query and the pipeline, else ordinary text; equal lengths and repeated rows keep their input order;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoder

WINDOW = 2048
TIERS = (256, 512, 1024, 2048)
END_ID = 1
GROUP_TOKENS = 1 << 21
STEP_TOKENS = 1 << 16


def pack_group(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences of a group: (window, pieces), a piece being (document, start,
    length)."""
    window = tiers[-1]
    out: list[tuple[int, list[tuple[int, int, int]]]] = []
    rests: list[list[tuple[int, int, int]]] = [[] for _ in tiers]  # per tier, ascending (length, document, start)
    for d, n in enumerate(lengths):
        whole = n - n % window
        out += [(window, [(d, s, window)]) for s in range(0, whole, window)]
        if n > whole:
            rests[bisect.bisect_left(tiers, n - whole)].append((n - whole, d, whole))
    for r in rests:
        r.sort()

    def fill(gap: int, top: int) -> list[tuple[int, int, int]]:
        pieces = []
        while gap:
            for t in range(top, -1, -1):
                at = bisect.bisect_right(rests[t], (gap, len(lengths), 0)) - 1
                if at >= 0:
                    n, d, s = rests[t].pop(at)
                    break
            else:
                t = next((t for t in range(top + 1) if rests[t]), None)
                if t is None:
                    break
                n, d, s = rests[t].pop()
                bisect.insort(rests[bisect.bisect_left(tiers, n - gap)], (n - gap, d, s + gap))
                n = gap
            pieces.append((d, s, n))
            gap -= n
        return pieces

    left: list[tuple[int, int, int]] = []
    for top in range(len(tiers) - 1, -1, -1):
        while rests[top]:
            n, d, s = rests[top].pop()
            pieces = [(d, s, n), *fill(tiers[top] - n, top)]
            if sum(p[2] for p in pieces) == tiers[top]:
                out.append((tiers[top], pieces))
            else:  # nothing shorter is left
                left += pieces
    total = sum(p[2] for p in left)
    left.sort(key=lambda p: (-p[2], p[0], p[1]))
    while total:
        size = min(1 << (total.bit_length() - 1), window)
        pieces, room = [], size
        while room:
            d, s, n = left.pop(0)
            take = min(n, room)
            pieces.append((d, s, take))
            if take < n:
                left.insert(0, (d, s + take, n - take))
            room -= take
        out.append((size, pieces))
        total -= size
    return out


def step_groups(sizes: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step group per sequence, with token counts as even as longest-first
    dealing makes them."""
    n = max(1, -(-sum(sizes) // step_tokens))
    heap = [(0, g) for g in range(n)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        filled, g = heap[0]
        out[i] = g
        heapq.heapreplace(heap, (filled + sizes[i], g))
    return out


_OUT = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("window", pa.int32()),
        ("step_group", pa.int64())]
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "window int, step_group long")


def _packer(ranks_path: str, end_id: int, tiers: tuple[int, ...], group_tokens: int, step_tokens: int, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 36
        encode = encoder(ranks_path).with_added if added else encoder(ranks_path)
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        state = {"held": 0, "sequences": 0, "steps": 0}

        def close():
            sequences = pack_group([len(x) for x in ids], tiers)
            steps = step_groups([w for w, _ in sequences], step_tokens)
            rows: list[tuple] = []
            for (window, pieces), step in zip(sequences, steps, strict=True):
                offset = 0
                for d, s, n in pieces:
                    crc = zlib.crc32(ids[d][s:s + n].astype("<u4").tobytes())
                    rows.append((names[d], s, n, crc, len(ids[d]), base + state["sequences"], offset, window, base + state["steps"] + step))
                    offset += n
                state["sequences"] += 1
            state["steps"] += max(steps, default=-1) + 1
            state["held"] = 0
            ids.clear(), names.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _OUT, strict=True)],
                                                 schema=pa.schema(_OUT))

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(np.append(encode(text.as_py() or ""), np.uint32(end_id)))
                names.append(doc)
                state["held"] += len(ids[-1])
                if state["held"] >= group_tokens:
                    yield from close()
        yield from close()
    return run


def pack(docs: DataFrame, ranks_path: str, text: str = "text", key: str = "doc_id", end_id: int = END_ID,
         tiers: tuple[int, ...] = TIERS, group_tokens: int = GROUP_TOKENS, step_tokens: int = STEP_TOKENS,
         added: bool = False) -> DataFrame:
    """One row per piece; ``window`` is its sequence's length, ``step_group``
    the training step it belongs to. tiers: ascending powers of two."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_packer(ranks_path, end_id, tiers, group_tokens, step_tokens, added), SCHEMA)
