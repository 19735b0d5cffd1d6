"""Keyed table mutations (B4-B8, D5-D7) as DataFrame rewrites.

Plain Parquet tables have no MERGE, so every upsert computes the *new table
state* as a DataFrame and a sink writes it (see ``sinks.stored``, which gives
it the rows of the touched folders only).
The shape is always one full outer join, so each side is read once:

    stored table  FULL OUTER JOIN  the batch, summarised per key

Within one change batch the reference applies rows in arrival order
(``executemany``): for DO UPDATE the last row wins, for DO NOTHING the first.
Arrival order is a column (``seq``). The winners per key are
``min/max(struct(seq, ...))`` aggregates, which combine map-side, so a hot
key never gathers in one task. NULL keys never conflict (SQL UNIQUE
semantics): each such row is a group of its own and joins nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import anchor


def _winner(df: DataFrame, key: str, seq: str, last: bool) -> DataFrame:
    """One row per non-NULL key: the last (or first) by ``seq``."""
    rest = [c for c in df.columns if c not in (key, seq)]
    pick = F.max if last else F.min
    best = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        pick(F.struct(F.col(seq), *[F.col(c) for c in rest])).alias("_w"))
    return best.select(key, *[F.col(f"_w.{c}").alias(c) for c in [seq] + rest])


def _summary(df: DataFrame, key: str, seq: str, *which: str) -> DataFrame:
    """Per key the batch's first (``_first``) and last (``_last``) row as
    structs; a row with a NULL key is a group of its own."""
    row = F.struct(F.col(seq).alias("_order"), *[F.col(c) for c in df.columns])
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    pick = {"first": F.min(row).alias("_first"), "last": F.max(row).alias("_last")}
    return df.withColumn("_own", own).groupBy(F.col(key).alias("_key"), "_own").agg(*[pick[w] for w in which])


def _outer(current: DataFrame, summary: DataFrame, key: str) -> DataFrame:
    stored = current.select(F.struct(*[F.col(c) for c in current.columns]).alias("_old"), F.col(key).alias("_stored"))
    return stored.join(summary, F.col("_stored") == F.col("_key"), "full_outer")


def insert_ignore(current: DataFrame, incoming: DataFrame, key: str, seq: str) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING``. The first
    incoming row per key wins, stored keys win over all of them; rows with a
    NULL key are all inserted. Returns the new table state."""
    cols = current.columns
    first = _summary(incoming.select(*cols, *([seq] if seq not in cols else [])), key, seq, "first")
    j = _outer(current, first, key)
    old = F.col("_old").isNotNull()
    return j.select(*[F.when(old, F.col(f"_old.{c}")).otherwise(F.col(f"_first.{c}")).alias(c) for c in cols])


def upsert(current: DataFrame, incoming: DataFrame, key: str, update_cols: Sequence[str], seq: str,
           set_exprs: dict[str, Column] | None = None, insert_exprs: dict[str, Column] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE SET update_cols = EXCLUDED.*``
    with batch rows applied in ``seq`` order.

    * stored key: stored row, ``update_cols`` from the last incoming row;
    * new key: first incoming row inserted, then ``update_cols`` from the last;
    * NULL key: every incoming row inserted.
    ``set_exprs`` overrides columns on the update path only (e.g.
    ``last_updated = now``); ``insert_exprs`` on the insert path only."""
    cols, update_cols = current.columns, list(update_cols)
    set_exprs, insert_exprs = set_exprs or {}, insert_exprs or {}
    inc = incoming.select(*[c for c in cols if c in incoming.columns], *([seq] if seq not in cols else []))
    j = _outer(current, _summary(inc, key, seq, "first", "last"), key)
    old, new = F.col("_old").isNotNull(), F.col("_last").isNotNull()
    out = []
    for c in cols:
        kind = current.schema[c].dataType
        got = lambda side, c=c, kind=kind: F.col(f"{side}.{c}").cast(kind) if c in inc.columns else F.lit(None).cast(kind)
        update = set_exprs[c] if c in set_exprs else got("_last") if c in update_cols and c in inc.columns else F.col(f"_old.{c}")
        insert = insert_exprs[c] if c in insert_exprs else got("_last" if c in update_cols else "_first")
        out.append(F.when(old & new, update).when(old, F.col(f"_old.{c}")).otherwise(insert).alias(c))
    return j.select(*out)


def update_by_key(current: DataFrame, updates: DataFrame, key: str, update_cols: Sequence[str],
                  seq: str) -> DataFrame:
    """``UPDATE ... SET update_cols WHERE key = ?`` for each batch row in
    order (the last row per key wins); unmatched updates change nothing."""
    cols = current.columns
    update_cols = [c for c in update_cols if c in cols and c in updates.columns and c != seq]
    last = _winner(updates.select(key, seq, *update_cols), key, seq, last=True)
    j = current.alias("c").join(last.alias("u"), F.col(f"c.{key}") == F.col(f"u.{key}"), "left")
    hit = F.col(f"u.{key}").isNotNull()
    return j.select(*[(F.when(hit, F.col(f"u.{c}")).otherwise(F.col(f"c.{c}")) if c in update_cols
                       else F.col(f"c.{c}")).alias(c) for c in cols])


# -- the reference's concrete mutations ------------------------------------

SCORE_COLS = ("sentiment_score", "sentiment_label", "sentiment_confidence", "processed_timestamp",
              "processing_time_ms", "llm_backend")
SCORE_COLS_BY_ID = ("sentiment_score", "sentiment_label", "sentiment_confidence", "processing_time_ms",
                    "processed_timestamp", "llm_backend", "processing_method")
CONFIG_UPDATE = ("tracking_enabled", "track_players", "track_prices", "track_reviews",
                 "update_interval_minutes")


def insert_reviews_ignore(current: DataFrame, incoming: DataFrame, seq: str = "id") -> DataFrame:
    """B4."""
    return insert_ignore(current, incoming, "review_id", seq)


def upsert_review_scores(current: DataFrame, incoming: DataFrame, seq: str = "id") -> DataFrame:
    """Conflict updates only the six score columns; the whole text is
    stored; missing label/score default to neutral / 0.0."""
    inc = incoming
    # ``dict.get(k, default)``: the default applies to an absent field only.
    for c, v in (("sentiment_label", "neutral"), ("sentiment_score", 0.0),
                 ("sentiment_confidence", 0.0), ("processing_time_ms", 0.0)):
        if c not in inc.columns and c in current.columns:
            inc = inc.withColumn(c, F.lit(v))
    return upsert(current, inc, "review_id", SCORE_COLS, seq)


def update_scores_by_id(current: DataFrame, updates: DataFrame, seq: str = "_seq") -> DataFrame:
    """B6."""
    if seq not in updates.columns:
        updates = updates.withColumn(seq, F.monotonically_increasing_id())
    return update_by_key(current, updates, "id", SCORE_COLS_BY_ID, seq)


def resolve_game_name(requests: DataFrame, registry: DataFrame, id_col: str = "app_id",
                      given: str = "game_name") -> DataFrame:
    """The given name, else the registry name, else ``Game_<id>``. The
    registry is reduced to one name per id before the join."""
    names = registry.groupBy("app_id").agg(F.min("name").alias("_reg_name"))
    j = requests.join(names.withColumnRenamed("app_id", id_col), id_col, "left")
    name = F.coalesce(F.nullif(F.col(given), F.lit("")), F.col("_reg_name"),
                      F.concat(F.lit("Game_"), F.col(id_col).cast("string")))
    return j.withColumn(given, name).drop("_reg_name")


def upsert_tracking_config(current: DataFrame, requests: DataFrame, registry: DataFrame | None = None,
                           as_of=None, seq: str = "_seq") -> DataFrame:
    """Upsert by app_id. Flags and interval are updated and
    ``last_updated`` set to now; the stored name is never changed. New games
    get their name from the request, else the registry, else ``Game_<id>``."""
    req = requests
    if registry is not None:
        req = resolve_game_name(req, registry)
    if seq not in req.columns:
        req = req.withColumn(seq, F.monotonically_increasing_id())
    now = anchor(as_of)
    req = req.withColumn("last_updated", now)
    if "added_by" in current.columns and "added_by" not in req.columns:
        req = req.withColumn("added_by", F.lit("system"))
    return upsert(current, req, "app_id", CONFIG_UPDATE, seq, set_exprs={"last_updated": now})


def upsert_registry(current: DataFrame, incoming: DataFrame, as_of=None, seq: str = "_seq",
                    present: str = "_present") -> DataFrame:
    """Only the columns present in an incoming record overwrite the
    stored row (an explicit NULL does overwrite, an absent column does not);
    ``last_updated`` becomes now. ``present`` is an array of the record's
    column names. Later records of a batch apply on top of earlier ones."""
    cols = current.columns
    inc = incoming
    if seq not in inc.columns:
        inc = inc.withColumn(seq, F.monotonically_increasing_id())
    # Per key, fold the batch in arrival order column by column: the value of
    # a column is the one from the last record that carried it.
    per_col = []
    for c in cols:
        if c == "app_id":
            continue
        if c in inc.columns:
            carried = F.when(F.array_contains(F.col(present), F.lit(c)), F.struct(F.col(seq), F.col(c).alias("v")))
            per_col.append(F.max(carried).alias(f"_c_{c}"))
    folded = inc.filter(F.col("app_id").isNotNull()).groupBy("app_id").agg(*per_col)
    stored = current.select(F.struct(*[F.col(c) for c in cols]).alias("_old"), F.col("app_id").alias("_stored"))
    j = stored.join(folded, F.col("_stored") == F.col("app_id"), "full_outer")
    old, new = F.col("_old").isNotNull(), F.col("app_id").isNotNull()
    out = []
    for c in cols:
        kind = current.schema[c].dataType
        if c == "app_id":
            value = F.coalesce(F.col("_old.app_id"), F.col("app_id"))
        elif c == "last_updated":
            value = F.when(new, anchor(as_of)).otherwise(F.col("_old.last_updated"))
        elif f"_c_{c}" in folded.columns:
            carried = F.col(f"_c_{c}")
            value = F.when(carried.isNotNull(), carried["v"].cast(kind)).when(old, F.col(f"_old.{c}"))
        else:
            value = F.when(old, F.col(f"_old.{c}"))
        out.append(value.alias(c))
    return j.select(*out)
