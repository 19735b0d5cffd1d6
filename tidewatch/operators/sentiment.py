"""Review-sentiment aggregates (E1-E6, E9, E13-E23, E27, E28) and the
trending comparison (D2).

Every aggregate is a hash aggregate with partial (map-side) combine, so a
game holding a third of all reviews costs one partial row per map task, not a
hot reducer. Time windows are plain predicates on ``processed_timestamp``;
with a literal ``as_of`` they are pushed into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefns import minus, trunc_ntz



def labelled(reviews: DataFrame) -> DataFrame:
    return reviews.filter(F.col("sentiment_label").isNotNull())


def labelled_since(reviews: DataFrame, as_of=None, hours: float = 24) -> DataFrame:
    return reviews.filter((F.col("processed_timestamp") > minus(as_of, hours=hours)) & F.col("sentiment_label").isNotNull())


def has_text(reviews: DataFrame) -> F.Column:
    """The stored flag where the table carries one (no text is read), else a
    test of the text."""
    return F.col("has_text") if "has_text" in reviews.columns else F.col("review_text").isNotNull()


def n_label(name: str) -> F.Column:
    return F.count_if(F.col("sentiment_label") == name)


def pct(part, whole, digits: int | None = 1) -> F.Column:
    """``part / whole * 100`` in double (0 when whole is 0), optionally rounded."""
    v = F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")) * 100, F.lit(0.0))
    return F.round(v, digits) if digits is not None else v


def sentiment_summary(reviews: DataFrame, as_of=None, hours: float = 24, limit: int = 10,
                      min_n: int = 5) -> DataFrame:
    """Per-game counts by label over the window, at least ``min_n``
    reviews, busiest first; trend from the positive ratio."""
    agg = (labelled_since(reviews, as_of, hours).groupBy("app_id", "game_name").agg(
        F.count(F.lit(1)).alias("total_reviews"), n_label("positive").alias("positive_count"),
        n_label("negative").alias("negative_count"), n_label("neutral").alias("neutral_count"),
        F.avg(F.col("sentiment_score")).alias("avg_raw")).filter(F.col("total_reviews") >= min_n))
    ratio = F.col("positive_count") / F.col("total_reviews")
    trend = (F.when(ratio > 0.6, "very positive").when(ratio > 0.4, "positive")
             .when(ratio > 0.3, "mixed").otherwise("negative"))
    return (agg.orderBy(F.col("total_reviews").desc(), F.col("avg_raw").desc_nulls_last(),
                        "app_id", "game_name").limit(limit)
            .select("app_id", "game_name", "total_reviews", "positive_count", "negative_count",
                    "neutral_count",
                    F.round(F.coalesce("avg_raw", F.lit(0.0)), 3).alias("avg_sentiment_score"),
                    trend.alias("sentiment_trend")))


def _game_filter(df: DataFrame, app_id):
    return df if app_id is None else df.filter(F.col("app_id") == app_id)


def sentiment_distribution(reviews: DataFrame, app_id=None, as_of=None, hours: float = 24) -> DataFrame:
    """Review counts by label for one game (``app_id=None``: per game)."""
    keys = ["sentiment_label"] if app_id is not None else ["app_id", "sentiment_label"]
    return (labelled_since(_game_filter(reviews, app_id), as_of, hours)
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("count")))


def hourly_game_sentiment(reviews: DataFrame, app_id=None, as_of=None, hours: float = 24) -> DataFrame:
    """Hour x label counts and mean score, newest hour first."""
    keys = [] if app_id is not None else ["app_id"]
    df = labelled_since(_game_filter(reviews, app_id), as_of, hours)
    return (df.groupBy(*keys, trunc_ntz("hour", F.col("processed_timestamp")).alias("hour"), F.col("sentiment_label").alias("sentiment"))
            .agg(F.count(F.lit(1)).alias("count"), F.round(F.avg(F.col("sentiment_score")), 3).alias("avg_score"))
            .orderBy(F.col("hour").desc(), *keys, "sentiment"))


def sentiment_metrics(reviews: DataFrame, as_of=None) -> DataFrame:
    """Overall labelled-review metrics; NULL becomes 0."""
    return labelled(reviews).agg(
        F.count(F.lit(1)).alias("total_reviews_processed"),
        F.count_distinct("app_id").alias("games_analyzed"),
        F.round(F.coalesce(F.avg("processing_time_ms"), F.lit(0.0)), 2).alias("avg_processing_time_ms"),
        F.round(F.coalesce(F.avg("sentiment_confidence"), F.lit(0.0)), 3).alias("avg_confidence"),
        F.count_if(F.col("processed_timestamp") > minus(as_of, hours=1)).alias("processed_last_hour"),
        F.count_if(F.col("processed_timestamp") > minus(as_of, hours=24)).alias("processed_last_24h"))


def label_distribution_24h(reviews: DataFrame, as_of=None, hours: float = 24) -> DataFrame:
    """E5: counts by label over the window, all games."""
    return (labelled_since(reviews, as_of, hours).groupBy("sentiment_label")
            .agg(F.count(F.lit(1)).alias("count")))


def processing_rate_hourly(reviews: DataFrame, as_of=None, hours: float = 24) -> DataFrame:
    """Reviews processed per hour with mean scoring time (2 dp)."""
    return (labelled_since(reviews, as_of, hours)
            .groupBy(trunc_ntz("hour", F.col("processed_timestamp")).alias("hour"))
            .agg(F.count(F.lit(1)).alias("reviews_processed"),
                 F.round(F.coalesce(F.avg("processing_time_ms"), F.lit(0.0)), 2)
                 .alias("avg_processing_time_ms"))
            .orderBy(F.col("hour").desc()))


def processing_stats(reviews: DataFrame) -> DataFrame:
    """Scorer statistics over reviews that have text."""
    df = reviews.filter(has_text(reviews))
    ms = F.col("processing_time_ms")
    return df.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_if(F.col("sentiment_label").isNotNull()).alias("processed_reviews"),
        F.count_if(F.col("sentiment_label").isNull()).alias("pending_reviews"),
        n_label("positive").alias("positive_reviews"), n_label("negative").alias("negative_reviews"),
        n_label("neutral").alias("neutral_reviews"),
        F.round(F.coalesce(F.avg(F.when(F.col("sentiment_label").isNotNull(), F.col("sentiment_score"))), F.lit(0.0)), 3)
        .alias("avg_sentiment_score"),
        F.round(F.coalesce(F.avg(F.when(ms > 0, ms)), F.lit(0.0)), 2).alias("avg_processing_time_ms"))


def sentiment_backlog(reviews: DataFrame, as_of=None) -> DataFrame:
    """Processed / pending / mean time over reviews written in the last
    24 h OR scored in the last 2 h."""
    df = reviews.filter((F.col("review_timestamp") > minus(as_of, hours=24))
                        | (F.col("processed_timestamp") > minus(as_of, hours=2)))
    ms = F.col("processing_time_ms")
    return df.agg(
        F.count_if(F.col("sentiment_label").isNotNull()).alias("processed_reviews"),
        F.count_if(F.col("sentiment_label").isNull() & has_text(reviews)).alias("pending_reviews"),
        F.round(F.coalesce(F.avg(F.when(ms > 0, ms)), F.lit(0.0)), 2).alias("avg_processing_time"))


def stuck_reviews(reviews: DataFrame, as_of=None, days: float = 1) -> DataFrame:
    """Reviews with text, still unlabelled, older than a day."""
    return (reviews.filter(has_text(reviews) & F.col("sentiment_label").isNull()
                           & (F.col("review_timestamp") < minus(as_of, days=days)))
            .agg(F.count(F.lit(1)).alias("stuck_reviews")))


def scorer_activity(reviews: DataFrame, as_of=None, hours: float = 2) -> DataFrame:
    """Recent scoring volume and rate per minute (0 when the span is 0)."""
    agg = labelled_since(reviews, as_of, hours).agg(
        F.count(F.lit(1)).alias("recent_reviews"),
        F.coalesce(F.avg("processing_time_ms"), F.lit(0.0)).alias("avg_processing_time"),
        F.min(F.col("processed_timestamp")).alias("oldest_processed"), F.max(F.col("processed_timestamp")).alias("latest_processed"))
    span = (F.unix_micros(F.col("latest_processed").cast("timestamp"))
            - F.unix_micros(F.col("oldest_processed").cast("timestamp"))) / F.lit(60_000_000.0)
    rate = F.when(span > 0, F.col("recent_reviews") / span).otherwise(F.lit(0.0))
    return agg.withColumn("processing_rate", F.coalesce(rate, F.lit(0.0)))


def score_distribution(reviews: DataFrame, as_of=None, hours: float = 24) -> DataFrame:
    """Per-label count, mean, min, max and share of all labelled rows."""
    agg = labelled_since(reviews, as_of, hours).groupBy("sentiment_label").agg(
        F.count(F.lit(1)).alias("count"), F.avg(F.col("sentiment_score")).alias("avg_score"),
        F.min(F.col("sentiment_score")).alias("min_score"), F.max(F.col("sentiment_score")).alias("max_score"))
    # One row per label: the global window runs over a handful of rows.
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return agg.withColumn("percentage", F.col("count") / total * 100)


def low_confidence_share(reviews: DataFrame, as_of=None, hours: float = 24,
                         threshold: float = 0.3) -> DataFrame:
    """Count of labelled rows below the confidence threshold and share."""
    agg = labelled_since(reviews, as_of, hours).agg(
        F.count_if(F.col("sentiment_confidence") < threshold).alias("low_confidence_count"),
        F.count(F.lit(1)).alias("total_count"))
    return agg.withColumn("pct", pct(F.col("low_confidence_count"), F.col("total_count"), None))


def scoring_timeouts(reviews: DataFrame, as_of=None, hours: float = 24,
                     limit_ms: float = 30000) -> DataFrame:
    """Rows processed in the window whose scoring exceeded the time-out."""
    return (reviews.filter((F.col("processed_timestamp") > minus(as_of, hours=hours)) & (F.col("processing_time_ms") > limit_ms))
            .agg(F.count(F.lit(1)).alias("timeout_count")))


def _ranked_games(reviews, as_of, hours, min_n, label, share_name):
    return (labelled_since(reviews, as_of, hours).groupBy("app_id", "game_name").agg(
        F.count(F.lit(1)).alias("review_count"), F.avg(F.col("sentiment_score")).alias("avg_raw"),
        n_label(label).alias("n_label")).filter(F.col("review_count") >= min_n))


def top_positive_games(reviews: DataFrame, as_of=None, hours: float = 24, min_n: int = 5,
                       cut: float = 0.5, k: int = 5) -> DataFrame:
    """Best-scored games (mean above ``cut``)."""
    g = _ranked_games(reviews, as_of, hours, min_n, "positive", "positive_percentage")
    return (g.filter(F.col("avg_raw") > cut)
            .orderBy(F.col("avg_raw").desc(), F.col("review_count").desc(), "app_id", "game_name")
            .limit(k)
            .select("app_id", "game_name", "review_count", F.round("avg_raw", 3).alias("avg_sentiment"),
                    pct(F.col("n_label"), F.col("review_count")).alias("positive_percentage")))


def top_negative_games(reviews: DataFrame, as_of=None, hours: float = 24, min_n: int = 5,
                       cut: float = -0.2, k: int = 5) -> DataFrame:
    """Worst-scored games (mean below ``cut``)."""
    g = _ranked_games(reviews, as_of, hours, min_n, "negative", "negative_percentage")
    return (g.filter(F.col("avg_raw") < cut)
            .orderBy(F.col("avg_raw").asc(), F.col("review_count").desc(), "app_id", "game_name")
            .limit(k)
            .select("app_id", "game_name", "review_count", F.round("avg_raw", 3).alias("avg_sentiment"),
                    pct(F.col("n_label"), F.col("review_count")).alias("negative_percentage")))


def sentiment_trend_24h(reviews: DataFrame, as_of=None, hours: float = 24, k: int | None = 24) -> DataFrame:
    """Newest ``k`` hours (None: every hour of the window; one that
    begins within an hour touches 25): volume, mean and label shares."""
    agg = labelled_since(reviews, as_of, hours).groupBy(trunc_ntz("hour", F.col("processed_timestamp")).alias("hour")).agg(
        F.count(F.lit(1)).alias("review_count"), F.avg(F.col("sentiment_score")).alias("avg_raw"),
        n_label("positive").alias("pos"), n_label("negative").alias("neg"))
    newest = agg if k is None else agg.orderBy(F.col("hour").desc()).limit(k)
    return (newest
            .select("hour", "review_count", F.round("avg_raw", 3).alias("avg_sentiment"),
                    pct(F.col("pos"), F.col("review_count")).alias("positive_percentage"),
                    pct(F.col("neg"), F.col("review_count")).alias("negative_percentage")))


def overall_sentiment(reviews: DataFrame, as_of=None, hours: float = 24, band: float = 0.2) -> DataFrame:
    """Window volume, mean score and its class (±band)."""
    agg = labelled_since(reviews, as_of, hours).agg(
        F.count(F.lit(1)).alias("review_volume"), F.avg(F.col("sentiment_score")).alias("overall_score"))
    s = F.col("overall_score")
    cls = F.when(s > band, "positive").when(s < -band, "negative").otherwise("neutral")
    return agg.withColumn("overall_sentiment", cls)


def duplicate_reviews(reviews: DataFrame) -> DataFrame:
    """Labelled review ids stored more than once (NULL ids group together)."""
    return (labelled(reviews).groupBy("review_id").agg(F.count(F.lit(1)).alias("duplicate_count"))
            .filter(F.col("duplicate_count") > 1))


def daily_sentiment_trend(reviews: DataFrame, as_of=None, days: float = 30) -> DataFrame:
    """Day x label volume and mean over 30 days (unlabelled rows form
    their own NULL group, as in the dashboard query)."""
    return (reviews.filter(F.col("processed_timestamp") > minus(as_of, days=days))
            .groupBy(trunc_ntz("day", F.col("processed_timestamp")).alias("date"), "sentiment_label")
            .agg(F.count(F.lit(1)).alias("reviews"), F.avg(F.col("sentiment_score")).alias("avg_score"))
            .orderBy("date", "sentiment_label"))


def game_sentiment_ranking(reviews: DataFrame, as_of=None, days: float = 7, min_n: int = 10) -> DataFrame:
    """Per game name over 7 days, at least ``min_n`` reviews, best first."""
    return (reviews.filter(F.col("processed_timestamp") > minus(as_of, days=days)).groupBy("game_name").agg(
        F.count(F.lit(1)).alias("total_reviews"), F.avg(F.col("sentiment_score")).alias("avg_sentiment"),
        n_label("positive").alias("positive_reviews"))
        .filter(F.col("total_reviews") >= min_n)
        .orderBy(F.col("avg_sentiment").desc_nulls_last(), "game_name"))


def trending_sentiment(reviews: DataFrame, as_of=None, window_hours: float = 4, min_n: int = 3,
                       min_change: float = 0.1, k: int = 10) -> DataFrame:
    """Last window vs the window before it, per game.

    One scan over the 2-window span computes both halves as conditional
    aggregates per (app_id, game_name); the halves are then joined on app_id
    exactly as the reference joins its two CTEs (so a drifted name fans out
    the same way). The join inputs are one row per game and name.
    The boundary row at ``as_of - window`` belongs to the previous half only
    (recent uses ``>``, previous an inclusive BETWEEN)."""
    lo, mid, hi = minus(as_of, hours=2 * window_hours), minus(as_of, hours=window_hours), minus(as_of)
    recent = F.col("processed_timestamp") > mid
    previous = F.col("processed_timestamp").between(lo, mid)
    halves = (reviews.filter(F.col("sentiment_label").isNotNull() & (F.col("processed_timestamp") >= lo))
              .groupBy("app_id", "game_name").agg(
                  F.avg(F.when(recent, F.col("sentiment_score"))).alias("recent_avg"),
                  F.count_if(recent).alias("recent_count"),
                  F.avg(F.when(previous, F.col("sentiment_score"))).alias("previous_avg"),
                  F.count_if(previous).alias("previous_count")))
    r = halves.filter(F.col("recent_count") >= min_n).select(
        "app_id", "game_name", "recent_avg", "recent_count").alias("r")
    p = halves.filter(F.col("previous_count") >= min_n).select(
        "app_id", "previous_avg", "previous_count").alias("p")
    change = F.col("r.recent_avg") - F.col("p.previous_avg")
    joined = r.join(p, "app_id").withColumn("change", change).filter(F.abs(F.col("change")) > min_change)
    return (joined.orderBy(F.abs(F.col("change")).desc(), "app_id", "game_name").limit(k)
            .select("app_id", "game_name",
                    F.round("recent_avg", 3).alias("recent_sentiment"),
                    F.round("previous_avg", 3).alias("previous_sentiment"),
                    F.round("change", 3).alias("sentiment_change"),
                    F.when(F.col("change") > 0, "improving").otherwise("declining").alias("trend_direction"),
                    (F.col("recent_count") + F.col("previous_count")).alias("total_reviews")))
