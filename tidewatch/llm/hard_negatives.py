"""Operator 13: hard negatives by inner products in a residue number system.

Scores are integer inner products, exact at any size of the components. The
integer matrices are reduced modulo small primes to balanced residues, and
each prime's product is one float32 matrix multiplication: with residues of at
most ``255`` and ``DEPTH`` columns at a time, all sums stay below 2**24, where
float32 is exact. As many primes are taken as the largest possible score asks
for (a bound from the measured vectors), and the signed scores are
reconstructed by Chinese remaindering (mixed radix).

The work: anchors against all rows, in blocks. Anchors are dealt into blocks
of ``ANCHORS``, rows into blocks of ``ROWS``; a task holds the anchors of a
pair of blocks and multiplies them with its rows. Two passes:

1. positives: a pair of blocks keeps each anchor's first ``positives`` rows
   of its label; of these, the first over all blocks stay;
2. negatives: a pair of blocks keeps, for each anchor and positive, the first
   ``negatives`` rows of other labels whose scores lie in the positive's
   window; of these, the first over all blocks are returned.

What leaves a task is bounded by its anchors, whatever labels, ties and copies
of vectors there are; no pair of rows leaves it otherwise.

Rows are staged once, as integers with a number each; later steps read them
only. Bytes that are exchanged: each row once per block of anchors and each
anchor once per block of rows.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; a null id is no anchor, is not relabelled, and comes
last among equal scores; repeated ids are rows of their own; a shorter vector
counts as one with zeros behind it; equal scores go by the smaller id, then by
the row's number; a score that fits no long raises ArithmeticError; an empty
table, or one without anchors, gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: The largest primes below 512, by trial division.
PRIMES = [p for p in range(511, 256, -1) if all(p % d for d in range(2, 23))]
#: Columns a product may sum with residues up to (511 - 1) / 2: 255**2 * DEPTH < 2**24.
DEPTH = 256
ANCHORS = 1 << 16
ROWS = 1 << 13
TILE = 1 << 11
_LEAST = np.iinfo(np.int64).min


def enough_primes(bound: int) -> list[int]:
    """Primes whose product exceeds the range -bound .. bound."""
    out, product = [], 1
    for p in PRIMES:
        if product > 2 * bound:
            break
        out.append(p)
        product *= p
    return out


def residues(m: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The integer matrix modulo each prime, balanced, as float32."""
    out = []
    for p in primes:
        r = m % p
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def product_residues(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo p, from 0, of balanced residues."""
    total = np.zeros((len(a), len(b)), np.int64)
    for k in range(0, a.shape[1], DEPTH):
        total += (a[:, k:k + DEPTH] @ b[:, k:k + DEPTH].T).astype(np.int64)
    return total % p


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int], bound: int) -> np.ndarray:
    """Exact int64 products of two matrices given by their residues: the
    products, moved up by ``bound`` so that none is negative, in mixed radix."""
    total = np.zeros((len(a[0]), len(b[0])), np.uint64)
    radix, digits = 1, []
    for k, p in enumerate(primes):
        digit = (product_residues(a[k], b[k], p) + bound % p) % p
        weight = 1
        for q, earlier in zip(primes[:k], digits, strict=True):
            digit -= earlier * weight % p
            weight = weight * q % p
        digit = digit % p * pow(weight, -1, p) % p
        digits.append(digit)
        total += digit.astype(np.uint64) * np.uint64(radix % (1 << 64))
        radix *= p
    return (total - np.uint64(bound)).view(np.int64)


def first_of_each(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's ``k`` greatest values, of equal ones the
    leftmost; ``_LEAST`` is no value."""
    if not values.size:
        return np.empty(0, int), np.empty(0, int)
    if values.shape[1] > k:
        least = np.partition(values, -k, axis=1)[:, -k][:, None]
        above = values > least
        room = k - above.sum(axis=1, keepdims=True)
        level = values == least
        values = np.where(above | (level & (np.cumsum(level, axis=1) <= room)), values, _LEAST)
    return np.nonzero(values != _LEAST)


def _prepared(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """number, id, label and integer vector of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    good = F.col(label).isNotNull() & F.col(vector).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    out = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.transform(v, lambda x: F.lit(256.0) * x).alias("v"),
                      F.monotonically_increasing_id().alias("number"), good.alias("good")).where(F.coalesce("good", F.lit(False)))
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # null stands for a component beyond 2**62, which ``mine`` refuses
    whole = F.transform("v", lambda x: F.when(F.abs(x) < 2.0 ** 62, F.floor(x).cast("long")))
    return out.select("number", "id", moved.alias("label"), whole.alias("v"))


def _paired(anchors: DataFrame, rows: DataFrame, n_anchor_blocks: int, n_row_blocks: int) -> DataFrame:
    """Anchors and rows of each pair of blocks, anchors first. Anchors carry
    the scores of their positives (none in the first pass)."""
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n: F.pmod(F.xxhash64("number"), F.lit(n)).cast("int")
    left = anchors.select(block(n_anchor_blocks).alias("a"), each(n_row_blocks).alias("b"), F.lit(0).alias("side"), "number", "id", "label", "v", "found")
    right = rows.select(each(n_anchor_blocks).alias("a"), block(n_row_blocks).alias("b"), F.lit(1).alias("side"), "number", "id", "label", "v",
                        F.lit(None).cast("array<struct<rank:int,score:long>>").alias("found"))
    both = left.unionByName(right)
    return both.repartition(n_anchor_blocks * n_row_blocks, "a", "b").sortWithinPartitions("a", "b", "side", F.asc_nulls_last("id"), "number")


class _Block:
    """Rows of a pair of blocks as arrays, in their order."""

    def __init__(self, batches: list[pa.RecordBatch], width: int, primes: list[int]):
        table = pa.Table.from_batches(batches)
        column = lambda n: table.column(n).combine_chunks()
        self.number = column("number").to_numpy(zero_copy_only=False)
        self.ids = column("id")
        self.label = column("label").to_numpy(zero_copy_only=False)
        lists = column("v")
        sizes = np.diff(lists.offsets.to_numpy())
        m = np.zeros((len(lists), width), np.int64)
        m[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        self.residues = residues(m, primes)
        self.found = column("found")

    def __len__(self) -> int:
        return len(self.number)


def _search(width: int, primes: list[int], bound: int, keep: int, window: tuple[int, int, int] | None):
    """Each anchor's first ``keep`` rows of its label, or with a window, for
    each of its positives its first rows of other labels in the window."""
    names = ["anchor", "anchor_id", "rank", "number", "id", "score"]

    def held(rows: _Block, anchors: _Block) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(anchors), TILE):
            cut = slice(at, min(at + TILE, len(anchors)))
            s = scores([r[cut] for r in anchors.residues], rows.residues, primes, bound)
            same = anchors.label[cut, None] == rows.label
            if window is None:
                tries = [(None, np.where(same & (anchors.number[cut, None] != rows.number), s, _LEAST))]
            else:
                low, high, of = window
                found = anchors.found.slice(at, cut.stop - at).to_pylist()
                tries = []
                for j in range(max(map(len, found), default=0)):
                    have = np.array([len(f) > j for f in found])
                    p = np.array([f[j]["score"] if len(f) > j else 0 for f in found], object)
                    # low * p <= of * s <= high * p, as bounds of s in whole numbers
                    least = np.array([-(-low * x // of) for x in p], object).clip(_LEAST + 1, -_LEAST - 1).astype(np.int64)
                    most = np.array([high * x // of for x in p], object).clip(_LEAST + 1, -_LEAST - 1).astype(np.int64)
                    tries.append((j, np.where(~same & have[:, None] & (s >= least[:, None]) & (s <= most[:, None]), s, _LEAST)))
            for j, values in tries:
                x, y = first_of_each(values, keep)
                if len(x):
                    rank = pa.nulls(len(x), pa.int32()) if j is None else pa.array([found[i][j]["rank"] for i in x.tolist()], pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(anchors.number[cut][x]), anchors.ids.take(pa.array(x + at)), rank,
                                                      pa.array(rows.number[y]), rows.ids.take(pa.array(y)), pa.array(s[x, y])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, sides = None, {0: [], 1: []}
        anchors: _Block | None = None

        def close():
            nonlocal anchors
            if sides[0] and anchors is None:
                anchors = _Block(sides[0], width, primes)
            if anchors is not None and sides[1]:
                yield from held(_Block(sides[1], width, primes), anchors)
            sides[1].clear()

        for batch in batches:
            code = np.stack([batch.column(c).to_numpy() for c in ("a", "b", "side")], axis=1)
            borders = [0, *(np.flatnonzero((code[1:] != code[:-1]).any(axis=1)) + 1).tolist(), len(code)]
            for start, end in zip(borders[:-1], borders[1:], strict=True):
                if start == end:
                    continue
                a, b, side = code[start].tolist()
                if (a, b) != pair:
                    yield from close()
                    pair, anchors = (a, b), None
                    sides[0].clear()
                sides[side].append(batch.slice(start, end - start))
                if side == 1 and sum(map(len, sides[1])) >= TILE:
                    yield from close()
        yield from close()
    return run


_HITS = "anchor long, anchor_id long, rank int, number long, id long, score long"


def _first(hits: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "number")
    return hits.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def mine(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", anchor: Column | None = None,
         positives: int = 5, negatives: int = 5, window: tuple[int, int, int] = (80, 100, 100),
         anchor_block: int = ANCHORS, row_block: int = ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score. ``anchor`` says by the id which rows are anchors (those
    divisible by 100); ``window`` (low, high, of): a negative's score s of a
    positive's score p has ``low * p <= of * s <= high * p``."""
    is_anchor = F.col("id") % 100 == 0 if anchor is None else anchor
    data = staged(_prepared(rows, key, vector, label), "integer-vectors")
    low, high = F.array_min("v"), F.array_max("v")
    n, n_anchors, width, least, most, refused = data.agg(
        F.count(F.lit(1)), F.count_if(is_anchor), F.max(F.size("v")), F.min(low), F.max(high), F.count_if(F.exists("v", lambda x: x.isNull()))).first()
    if refused:
        raise ArithmeticError(f"{refused} vectors have components beyond a long")
    largest = max(abs(least or 0), abs(most or 0))
    bound = largest * largest * (width or 0)
    if bound >= 1 << 62:
        raise ArithmeticError("scores may not fit a long")
    primes = enough_primes(max(bound, 1))
    blocks = lambda count, size: max(1, -(-count // size))
    shape = blocks(n_anchors, anchor_block), blocks(n, row_block)
    no_positives = F.lit(None).cast("array<struct<rank:int,score:long>>")
    anchors = data.where(is_anchor)
    search = lambda found, keep, at: _paired(found, data, *shape).mapInArrow(_search(max(width or 0, 1), primes, bound, keep, at), _HITS)
    near = staged(_first(search(anchors.withColumn("found", no_positives), positives, None), ["anchor"], positives, "place")
                  .select("anchor", F.col("place").cast("int").alias("place"), F.col("id").alias("positive_id"), "score"), "positives")
    listed = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(F.col("place").alias("rank"), "score"))).alias("found"))  # at most ``positives``
    hits = search(anchors.join(listed, anchors["number"] == listed["anchor"]).drop("anchor"), negatives, window)
    hits = _first(hits.withColumnRenamed("rank", "place"), ["anchor", "place"], negatives, "rank")
    out = hits.join(near.withColumnRenamed("score", "positive_score"), ["anchor", "place"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))
