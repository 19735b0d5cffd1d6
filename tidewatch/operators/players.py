"""Player-count and source-level checks.

Joins against the configuration dimension always aggregate the fact side
first (one row per game), so the join input is bounded by the number of
configured games, never by the number of readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.frames import attach
from ..functions.timefns import anchor, minus, minutes_between
from .sentiment import has_text


def games_missing_data(config: DataFrame, players: DataFrame, as_of=None, hours: float = 2,
                       low: int = 3) -> DataFrame:
    """D3: enabled configs (tracking players) with their reading count and
    last reading in the window; the window predicate is part of the join
    condition in the reference (games without readings stay, with 0), which
    is what pre-aggregating the window and left-joining gives."""
    recent = (players.filter(F.col("timestamp") > minus(as_of, hours=hours))
              .groupBy("app_id").agg(F.count("id").alias("recent_records"),
                                     F.max("timestamp").alias("last_player_update")))
    cfg = config.filter(F.col("tracking_enabled") & F.col("track_players")).select("app_id", "game_name")
    j = cfg.join(recent, "app_id", "left").select(
        "app_id", "game_name", F.coalesce("recent_records", F.lit(0)).alias("recent_records"),
        "last_player_update")
    n = F.col("recent_records")
    issue = (F.when(n == 0, F.format_string("No recent player data for %s (ID: %d)",
                                            F.col("game_name"), F.col("app_id")))
             .when(n < low, F.format_string("Low data frequency for %s: %d records in 2 hours",
                                            F.col("game_name"), n)))
    return j.withColumn("issue", issue).orderBy("recent_records", "app_id")


def pipeline_summary_stats(players: DataFrame, as_of=None, recent_hours: float = 24,
                           days: float = 7) -> DataFrame:
    """The reference cross-joins two one-row CTEs; here it is one scan
    restricted to the wider window with the narrower one as a filtered count."""
    ts = F.col("timestamp")
    wide = players.filter(ts > minus(as_of, days=days))
    week = wide.agg(F.count_distinct("app_id").alias("active_games"),
                    F.avg("player_count").alias("avg_player_count"),
                    F.max("player_count").alias("peak_player_count"),
                    F.count_if(ts > minus(as_of, hours=recent_hours)).alias("recent_in_week"))
    if recent_hours <= days * 24:
        return week.select(F.col("recent_in_week").alias("recent_player_records"), "active_games",
                           "avg_player_count", "peak_player_count")
    recent = players.filter(ts > minus(as_of, hours=recent_hours)).agg(
        F.count(F.lit(1)).alias("recent_player_records"))
    return attach(recent, week.drop("recent_in_week"))


def initial_collection_needed(config: DataFrame, reviews: DataFrame, threshold: int = 10,
                              backfill: int = 100, regular: int = 10) -> DataFrame:
    """Games with fewer than ``threshold`` stored review texts get a
    backfill fetch size."""
    counts = reviews.groupBy("app_id").agg(F.count_if(has_text(reviews)).alias("stored_reviews"))
    cfg = config.filter(F.col("tracking_enabled") & F.col("track_reviews")).select("app_id")
    j = cfg.join(counts, "app_id", "left").select(
        "app_id", F.coalesce("stored_reviews", F.lit(0)).alias("stored_reviews"))
    need = F.col("stored_reviews") < threshold
    return j.select("app_id", "stored_reviews", need.alias("needs_backfill"),
                    F.when(need, F.lit(backfill)).otherwise(F.lit(regular)).alias("fetch_size"))


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of=None) -> DataFrame:
    """Per table: rows with a timestamp, newest timestamp and minutes
    since it. One aggregate over the times of all tables, so that one row
    per task is exchanged, and an empty table has its row."""
    times = [df.select(F.lit(k).alias("_table"), F.col(col).cast("timestamp_ntz").alias("_time")) for k, (df, col) in enumerate(tables.values())]
    union = times[0]
    for t in times[1:]:
        union = union.union(t)
    own = lambda k: F.when(F.col("_table") == k, F.col("_time"))
    rows = union.agg(*[F.struct(F.lit(name).alias("table_name"), F.count(own(k)).alias("total_records"), F.max(own(k)).alias("last_update")).alias(f"t{k}")
                       for k, name in enumerate(tables)])
    out = rows.select(F.inline(F.array(*rows.columns)))
    return out.withColumn("minutes_since_update", minutes_between(anchor(as_of), F.col("last_update")))


def api_health(players: DataFrame, as_of=None, hours: float = 2, slow_ms: float = 10000) -> DataFrame:
    """Request count, mean latency and slow share over the window."""
    ms = F.col("api_response_time_ms")
    agg = (players.filter((F.col("timestamp") > minus(as_of, hours=hours)) & ms.isNotNull())
           .agg(F.count(F.lit(1)).alias("total_requests"), F.avg(ms).alias("avg_response_time"),
                F.count_if(ms > slow_ms).alias("slow_requests")))
    return agg.withColumn("slow_pct", F.coalesce(
        F.try_divide(F.col("slow_requests").cast("double"), F.col("total_requests").cast("double")) * 100,
        F.lit(0.0)))


def player_source_stats(players: DataFrame) -> DataFrame:
    """E24."""
    return players.agg(F.count(F.lit(1)).alias("total_records"),
                       F.count_distinct("app_id").alias("games_tracked"),
                       F.max("timestamp").alias("last_update"), F.min("timestamp").alias("first_record"))


def review_source_stats(reviews: DataFrame) -> DataFrame:
    """Processed share as 1-dp percent (0 when empty)."""
    agg = reviews.agg(F.count(F.lit(1)).alias("total_reviews"),
                      F.count_if(F.col("sentiment_label").isNotNull()).alias("processed_reviews"),
                      F.count_distinct("app_id").alias("games_with_reviews"))
    rate = F.round(F.try_divide(F.col("processed_reviews").cast("double"),
                                F.col("total_reviews").cast("double")) * 100, 1)
    return agg.withColumn("processing_rate", F.coalesce(rate, F.lit(0.0)))


def config_stats(config: DataFrame) -> DataFrame:
    """E26."""
    return config.agg(F.count(F.lit(1)).alias("configured_games"),
                      F.count_if(F.col("tracking_enabled")).alias("active_games"))
