"""Per-game marts.

Both sides are aggregated before the join, so the join sees one row per
(app_id, game_name) on each side: partial (map-side) aggregation absorbs key
skew, and the joined inputs are tiny whatever the table size, which AQE then
turns into a broadcast join after measuring them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def player_metrics(stg_players: DataFrame) -> DataFrame:
    """Average and peak players per game over the staging model."""
    return stg_players.groupBy("app_id", "game_name").agg(
        F.avg("player_count").alias("avg_players"),
        F.max("player_count").alias("peak_players"))


def game_sentiment_metrics(reviews: DataFrame) -> DataFrame:
    """Labelled-review metrics per game."""
    return (reviews.filter(F.col("sentiment_label").isNotNull())
            .groupBy("app_id", "game_name").agg(
                F.avg("sentiment_score").alias("avg_sentiment"),
                F.count_if(F.col("sentiment_label") == "positive").alias("positive_reviews"),
                F.count_if(F.col("sentiment_label") == "negative").alias("negative_reviews"),
                F.count(F.lit(1)).alias("total_reviews")))


def pct_1dp(part, whole) -> F.Column:
    """``ROUND(part::NUMERIC / NULLIF(whole, 0) * 100, 1)`` in exact decimal
    arithmetic (HALF_UP, as PostgreSQL numeric), returned as double."""
    num = part.cast("decimal(20,0)")
    den = F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(num * F.lit(100) / den, 1).cast("double")


def mart_game_sentiment(stg_players: DataFrame, reviews: DataFrame,
                        by_app_only: bool = False) -> DataFrame:
    """Player metrics LEFT JOIN sentiment metrics on app_id.

    As in the reference both sides group by (app_id, game_name) and join on
    app_id only, so a game whose name drifted fans out; ``by_app_only=True``
    joins on the name as well and avoids it."""
    p = player_metrics(stg_players).alias("p")
    s = game_sentiment_metrics(reviews).alias("s")
    cond = F.col("p.app_id") == F.col("s.app_id")
    if by_app_only:
        cond = cond & (F.col("p.game_name") == F.col("s.game_name"))
    return p.join(s, cond, "left").select(
        F.col("p.app_id").alias("app_id"), F.col("p.game_name").alias("game_name"),
        "p.avg_players", "p.peak_players", "s.avg_sentiment", "s.positive_reviews",
        "s.negative_reviews", "s.total_reviews",
        pct_1dp(F.col("s.positive_reviews"), F.col("s.total_reviews")).alias("positive_review_pct"))
