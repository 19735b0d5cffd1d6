"""Connected components of an edge table by alternating stars: every node
points to the smallest node it knows of, first its larger neighbours, then
its smaller ones, until nothing changes. Rounds grow with the logarithm of
the nodes; each is written to the shared folder, and no component is ever
held in one task. A graph of at most ``FEW_EDGES`` edges is joined up in one
task instead, which holds that many at most: its rounds would be all start-up."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

FEW_EDGES = 1 << 14


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All edges at once: each node with the smallest one it is joined to."""
    above: dict[int, int] = {}

    def root(n: int) -> int:
        while above.setdefault(n, n) != n:
            above[n] = n = above[above[n]]
        return n
    for b in batches:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
            u, v = root(u), root(v)
            above[max(u, v)] = min(u, v)
    nodes = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(n) for n in nodes], pa.int64())], names=["node", "component"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """large: each node's larger neighbours go to its least neighbour; else
    the node and its smaller neighbours do."""
    if large:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        near = near.where("v > u")
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
    moved = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return moved.where("u != v")


def components(edges: DataFrame, x: str, y: str) -> DataFrame:
    """(node, component): component is the smallest node of its component;
    nodes without an edge do not appear."""
    now = staged(edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).where("u != v").distinct(), "cc")
    if now.count() <= FEW_EDGES:
        return now.repartition(1).mapInArrow(_joined_up, "node long, component long")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        now = staged(_star(_star(now, True), False).distinct(), "cc")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
