"""Projections and filters over the base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefns import minus, pg_dow, trunc_ntz


def stg_player_tracking(players: DataFrame) -> DataFrame:
    """Positive readings with calendar parts (``day_of_week`` 0 = Sunday)."""
    ts = F.col("timestamp")
    return (players.filter(F.col("player_count") > 0)
            .select("id", "app_id", "game_name", "player_count", "timestamp",
                    "api_response_time_ms", F.to_date(ts).alias("date"),
                    F.hour(ts).cast("int").alias("hour_of_day"),
                    pg_dow(ts).alias("day_of_week")))


def tracked_games(config: DataFrame) -> DataFrame:
    """Enabled games, newest configuration first (``app_id`` breaks ties)."""
    return (config.filter(F.col("tracking_enabled"))
            .orderBy(F.col("last_updated").desc(), F.col("app_id"))
            .select("app_id", "game_name", "track_players", "track_prices", "track_reviews",
                    F.col("update_interval_minutes").alias("update_interval")))


def unprocessed_reviews(reviews: DataFrame, limit: int | None = None) -> DataFrame:
    """All unlabelled reviews with non-empty text (blank text passes).
    ``limit`` gives the first so many by id, a poller's batch."""
    out = (reviews.filter(F.col("sentiment_label").isNull() & F.col("review_text").isNotNull()
                          & (F.col("review_text") != ""))
           .select("id", "app_id", "game_name", "review_id", "review_text", "review_helpful",
                   "review_timestamp"))
    if limit is None:
        return out
    return out.orderBy("id").limit(limit)


def _labelled_since(reviews: DataFrame, as_of, hours: float) -> DataFrame:
    return reviews.filter((F.col("processed_timestamp") > minus(as_of, hours=hours))
                          & F.col("sentiment_label").isNotNull())


def snippet(col, n: int = 200) -> F.Column:
    """Text cut to n characters with '...' when longer."""
    return F.when(F.length(col) > n, F.concat(F.substring(col, 1, n), F.lit("..."))).otherwise(col)


def recent_reviews(reviews: DataFrame, app_id=None, as_of=None, hours: float = 24,
                   k: int = 20, texts: DataFrame | None = None) -> DataFrame:
    """Newest k labelled reviews of one game (``app_id=None``: of every
    game). The per-game form is ``row_number() <= k``, which Spark plans with
    a partial WindowGroupLimit before the shuffle, so a hot game ships at most
    k rows per map task. ``texts`` (text_key, review_text): fetched for the
    chosen rows only, when ``reviews`` has ``text_key`` instead."""
    df = reviews if app_id is None else reviews.filter(F.col("app_id") == app_id)
    df = _labelled_since(df, as_of, hours)
    newest = [F.col("processed_timestamp").desc(), F.col("id").desc()]
    if app_id is not None:
        top = df.orderBy(*newest).limit(k)
    else:
        rank = F.row_number().over(Window.partitionBy("app_id").orderBy(*newest))
        top = df.withColumn("_rn", rank).filter(F.col("_rn") <= k).drop("_rn")
    if texts is not None:
        top = top.join(texts, "text_key", "left")
    return top.select(*(["app_id"] if app_id is None else []), snippet(F.col("review_text")).alias("text"),
                      F.col("sentiment_label").alias("sentiment"),
                      F.round("sentiment_score", 3).alias("score"),
                      F.col("review_timestamp").alias("timestamp"),
                      F.coalesce("review_helpful", F.lit(0)).alias("helpful_votes"))


def game_name_of(reviews: DataFrame) -> DataFrame:
    """One name per game (the reference takes an unordered LIMIT 1; the
    smallest name pins it)."""
    return reviews.groupBy("app_id").agg(F.min("game_name").alias("game_name"))


def review_export_projection(reviews: DataFrame, as_of=None, hours: float = 24) -> DataFrame:
    """Labelled rows in the window with their hour bucket."""
    return (_labelled_since(reviews, as_of, hours)
            .select("app_id", "game_name", "sentiment_label", "sentiment_score",
                    "sentiment_confidence", "review_helpful", "processed_timestamp",
                    trunc_ntz("hour", "processed_timestamp").alias("hour_bucket")))
