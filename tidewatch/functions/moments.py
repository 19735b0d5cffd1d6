"""Co-moments of two columns as mergeable states.

A state is ``struct(n, mean_x, mean_y, xx, yy, xy)``: the number of rows with
both values, their means, and the sums of products of deviations. States are
made by Spark's central-moment aggregates (partial on the map side, merged
without sums of squares), so a constant side has a deviation of exactly zero,
and stored states of parts (hours, batches) merge to that of the whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIELDS = ("mean_x", "mean_y", "xx", "yy", "xy")


def co_moments(x: str, y: str) -> Column:
    """Aggregate: the state of the rows in which neither is NULL."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = (F.when(both, F.col(c).cast("double")) for c in (x, y))
    n = F.count_if(both)
    scaled = lambda v: F.coalesce(v * n, F.lit(0.0))
    # a sum divided by its count can miss a value that never changes
    mean = lambda v: F.coalesce(F.when(F.min(v) == F.max(v), F.min(v)).otherwise(F.avg(v)), F.lit(0.0))
    return F.struct(n.alias("n"), mean(a).alias("mean_x"), mean(b).alias("mean_y"),
                    scaled(F.var_pop(a)).alias("xx"), scaled(F.var_pop(b)).alias("yy"), scaled(F.covar_pop(a, b)).alias("xy"))


def _merge(p: Column, q: Column) -> Column:
    """Two states as one; means that agree leave the deviations as they are."""
    n = p["n"] + q["n"]
    share = F.coalesce(F.try_divide(q["n"].cast("double"), n.cast("double")), F.lit(0.0))
    dx, dy = q["mean_x"] - p["mean_x"], q["mean_y"] - p["mean_y"]
    dx, dy = (F.when(p["n"] == 0, q[f"mean_{c}"]).otherwise(F.when(q["n"] == 0, 0.0).otherwise(d)) for c, d in (("x", dx), ("y", dy)))
    weight = p["n"] * share
    return F.struct(n.alias("n"), (p["mean_x"] + dx * share).alias("mean_x"), (p["mean_y"] + dy * share).alias("mean_y"),
                    (p["xx"] + q["xx"] + dx * dx * weight).alias("xx"), (p["yy"] + q["yy"] + dy * dy * weight).alias("yy"),
                    (p["xy"] + q["xy"] + dx * dy * weight).alias("xy"))


def merged(state: str) -> Column:
    """Aggregate: the state of the whole from states of its parts. A group
    gathers as many states as it has parts."""
    none = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(f) for f in _FIELDS])
    return F.reduce(F.collect_list(state), none, _merge)


def correlation(state: Column) -> Column:
    """Pearson's; NULL for fewer than two rows or a constant side."""
    spread = F.sqrt(state["xx"]) * F.sqrt(state["yy"])
    return F.when(state["n"] > 1, F.try_divide(state["xy"], spread))
