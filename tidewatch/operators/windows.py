"""LAG, latest-per-key and de-duplication.

``Window.partitionBy(app_id)`` puts every reading of a game into one task,
and a single game may hold a third of all rows. ``lag_by_key`` measures the
largest key first (one aggregate over the key column). If it fits a task, the
plain window runs. Otherwise each key's history is cut into time buckets
sized so that the largest key's buckets hold about ``rows_per_task`` rows,
the window runs per (key, bucket), and the last row of the previous non-empty
bucket is carried across the cut. Both give exactly
``LAG() OVER (PARTITION BY key ORDER BY ...)``.

Latest-per-key and DISTINCT ON use ``max(struct(order..., payload...))``,
which combines before the shuffle: one candidate per key and map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefns import minus


#: Rows of one key that a window task takes at most, on average per bucket.
ROWS_PER_TASK = 2_000_000


def _micros(ts_col: str) -> Column:
    return F.unix_micros(F.col(ts_col).cast("timestamp"))


def lag_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
               prefix: str = "prev_", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``prev_<v>`` = ``LAG(v) OVER (PARTITION BY keys ORDER BY order)``
    for each value column. ``order[0]`` must be a timestamp; it defines the
    buckets of hot keys. Ties in ``order`` should be broken by the caller
    (add an id)."""
    keys, order, values = list(keys), list(order), list(values)
    largest = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= rows_per_task:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({prefix + v: F.lag(v).over(w) for v in values})
    first, last = df.agg(F.min(_micros(order[0])), F.max(_micros(order[0]))).first()
    length = max(1, (last - first) * rows_per_task // largest)
    return _lag_by_bucket(df, keys, order, values, prefix, F.coalesce(F.floor((_micros(order[0]) - first) / length), F.lit(-1)))


def _lag_by_bucket(df: DataFrame, keys: list[str], order: list[str], values: list[str], prefix: str,
                   bucket: Column) -> DataFrame:
    b = "_lag_bucket"
    with_b = df.withColumn(b, bucket.cast("long"))
    # Last row of every (key, bucket): one partial row per map task per group.
    tails = (with_b.groupBy(*keys, b)
             .agg(F.max(F.struct(*[F.col(c) for c in order], *[F.col(v).alias(f"v_{v}") for v in values]))
                  .alias("_tail")))
    # Previous non-empty bucket's tail; this window runs over one row per
    # (key, bucket), i.e. the number of buckets per key, not the readings.
    wb = Window.partitionBy(*keys).orderBy(b)
    carry = tails.select(*[F.col(k).alias(f"_ck_{k}") for k in keys], F.col(b).alias("_ck_b"),
                         *[F.lag(F.col(f"_tail.v_{v}")).over(wb).alias(f"_carry_{v}") for v in values])
    cond = with_b[b] == carry["_ck_b"]
    for k in keys:
        cond = with_b[k].eqNullSafe(carry[f"_ck_{k}"]) & cond
    joined = with_b.join(carry, cond, "left").drop(*[f"_ck_{k}" for k in keys], "_ck_b")
    w = Window.partitionBy(*keys, b).orderBy(*order)
    first = F.row_number().over(w) == 1
    out = joined.withColumns({prefix + v: F.when(first, F.col(f"_carry_{v}")).otherwise(F.lag(v).over(w)) for v in values})
    return out.drop(b, *[f"_carry_{v}" for v in values])


def player_anomalies(players: DataFrame, as_of=None, hours: float = 4, min_prev: int = 100,
                     ratio: float = 0.5, k: int | None = 10) -> DataFrame:
    """readings in the last ``hours`` whose count moved more than
    ``ratio`` against the previous reading of the same game (previous above
    ``min_prev``, current not 0); the newest ``k``, or all for ``k=None``.
    ``change_pct`` is formatted like Python ``'%+.0f'`` (half-even)."""
    recent = players.filter(F.col("timestamp") > minus(as_of, hours=hours)).select(
        "id", "app_id", "game_name", "player_count", "timestamp")
    lagged = lag_by_key(recent, ["app_id"], ["timestamp", "id"], ["player_count"])
    prev, cur = F.col("prev_player_count"), F.col("player_count")
    hits = lagged.filter(prev.isNotNull() & (prev > min_prev)
                         & (F.abs(cur - prev).cast("double") / prev > ratio) & (cur != 0))
    change = (cur - prev) / prev * 100
    if k is not None:
        hits = hits.orderBy(F.col("timestamp").desc(), F.col("id").desc()).limit(k)
    return hits.select("app_id", "game_name", "player_count", prev.alias("prev_count"), "timestamp",
                       F.format_string("%+d", F.bround(change, 0).cast("long")).alias("change_pct"))


def significant_changes(players: DataFrame, threshold_pct: float = 20) -> DataFrame:
    """readings whose count changed by more than ``threshold_pct`` % against
    the previous stored reading of the game (previous > 0)."""
    lagged = lag_by_key(players.select("id", "app_id", "game_name", "player_count", "timestamp"),
                        ["app_id"], ["timestamp", "id"], ["player_count"])
    return changes_of(lagged, threshold_pct)


def changes_of(lagged: DataFrame, threshold_pct: float = 20) -> DataFrame:
    """F2 on readings that carry ``prev_player_count``."""
    prev, cur = F.col("prev_player_count"), F.col("player_count")
    change = (cur - prev) / prev * 100
    return (lagged.filter(prev.isNotNull() & (prev > 0)).withColumn("change_percent", change)
            .filter(F.abs(F.col("change_percent")) > threshold_pct)
            .select("app_id", "game_name", prev.alias("previous_count"), cur.alias("current_count"),
                    "change_percent",
                    F.when(F.col("change_percent") > 0, "UP").otherwise("DOWN").alias("direction"),
                    "timestamp"))


def price_changes(prices: DataFrame, order: Sequence[str] = ("timestamp",), eps: float = 0.01,
                  exact: bool = False) -> DataFrame:
    """flag a price whose difference to the previous stored price of the
    game exceeds ``eps``. The reference compares floats (9.99 -> 10.00 is not
    flagged); ``exact=True`` compares decimals. First row: FALSE; a NULL or
    zero previous price counts as 0.0."""
    # ``prev`` is NULL both for the first row and for a NULL stored price;
    # only the first row is unflagged, so a never-NULL marker is lagged too.
    marked = prices.withColumn("_row", F.lit(True))
    return flags_of(lag_by_key(marked, ["app_id"], list(order), ["price_current", "_row"]), eps, exact)


def flags_of(out: DataFrame, eps: float = 0.01, exact: bool = False) -> DataFrame:
    """F3 on prices that carry ``prev_price_current`` and ``prev__row``."""
    first = F.col("prev__row").isNull()
    prev = F.col("prev_price_current")
    if exact:
        diff = F.abs(F.coalesce(prev, F.lit(0).cast("decimal(10,2)")) - F.col("price_current"))
        flag = diff > F.lit(eps).cast("decimal(10,2)")
    else:
        diff = F.abs(F.coalesce(prev.cast("double"), F.lit(0.0)) - F.col("price_current").cast("double"))
        flag = diff > eps
    return (out.withColumn("price_change_detected", F.when(first, F.lit(False)).otherwise(flag))
            .drop("prev_price_current", "prev__row", "_row"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key by ``order`` (descending; last column breaks ties).
    ``max_by`` per column would give mixed rows on ties, so the whole row
    travels as one struct; ``order`` must tell the rows of a key apart."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = (df.groupBy(*keys)
            .agg(F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("_best")))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order + rest])


def latest_price(prices: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """latest stored price per game."""
    return latest_per_key(prices, ["app_id"], order)


def dedup_reviews(reviews: DataFrame) -> DataFrame:
    """labelled rows keep one row per review_id (newest processed, then
    highest id; NULL ids form one group); unlabelled rows are all kept."""
    lab = reviews.filter(F.col("sentiment_label").isNotNull())
    keep = latest_per_key(lab, ["review_id"], ["processed_timestamp", "id"]).select(*reviews.columns)
    return keep.unionByName(reviews.filter(F.col("sentiment_label").isNull()))


def keep_last_n(df: DataFrame, n: int = 168, created: str = "created_at", id_col: str = "id") -> DataFrame:
    """retain the ``n`` newest rows (``TakeOrderedAndProject``: each task
    keeps its own top n, the merge sees at most tasks x n rows)."""
    return df.orderBy(F.col(created).desc(), F.col(id_col).desc()).limit(n)
