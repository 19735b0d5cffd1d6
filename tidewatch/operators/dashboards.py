"""Dashboard queries described in the docs (M1-M8).

All are aggregates over the staging model or the review table; time-zone
views multiply each reading by a bounded, caller-given list of zones with
``explode`` (a generator, no join), and correlations aggregate both sides
to (game, hour) before joining.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.moments import co_moments, correlation
from ..functions.timefns import minus, trunc_ntz

# The dashboard's reporting zone and the default zone list.
REPORT_ZONE = "America/Chicago"
DEFAULT_ZONES = ("America/Los_Angeles", "America/Chicago", "America/New_York", "Europe/London",
                 "Europe/Berlin", "Asia/Tokyo")


def local_hour(ts_col: str, zone) -> F.Column:
    z = zone if isinstance(zone, F.Column) else F.lit(zone)
    return F.hour(F.from_utc_timestamp(F.col(ts_col).cast("timestamp"), z)).cast("int")


def _peak(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key group: the hour with the highest mean players (earliest hour on ties)."""
    best = F.max(F.struct(F.col("avg_players"), (-F.col("hour")).alias("neg_hour")))
    return df.groupBy(*keys).agg(best.alias("b")).select(
        *keys, (-F.col("b.neg_hour")).alias("peak_hour"), F.col("b.avg_players").alias("peak_avg_players"))


def peak_hours(stg_players: DataFrame, zone: str = REPORT_ZONE) -> DataFrame:
    """M1: busiest local hour per game."""
    hourly = (stg_players.groupBy("app_id", "game_name", local_hour("timestamp", zone).alias("hour"))
              .agg(F.avg("player_count").alias("avg_players")))
    return _peak(hourly, ["app_id", "game_name"])


def activity_heatmap(stg_players: DataFrame) -> DataFrame:
    """M2: mean players by day of week (0 = Sunday) x hour of day, long form."""
    return (stg_players.groupBy("day_of_week", "hour_of_day")
            .agg(F.avg("player_count").alias("avg_players"), F.count(F.lit(1)).alias("readings")))


def weekend_uplift(stg_players: DataFrame) -> DataFrame:
    """M3: weekend vs weekday mean players per game and the uplift in %."""
    we = F.col("day_of_week").isin(0, 6)
    agg = stg_players.groupBy("app_id", "game_name").agg(
        F.avg(F.when(~we, F.col("player_count"))).alias("weekday_avg"),
        F.avg(F.when(we, F.col("player_count"))).alias("weekend_avg"))
    return agg.withColumn("uplift_pct", F.try_divide(F.col("weekend_avg") - F.col("weekday_avg"),
                                                     F.col("weekday_avg")) * 100)


def player_sentiment_correlation(stg_players: DataFrame, reviews: DataFrame) -> DataFrame:
    """M4: per game, Pearson correlation of hourly mean players and hourly
    mean sentiment over the hours that have both; NULL for one such hour or a
    side that never changes."""
    p = (stg_players.groupBy("app_id", trunc_ntz("hour", "timestamp").alias("hour"))
         .agg(F.avg("player_count").alias("avg_players")))
    s = (reviews.filter(F.col("sentiment_label").isNotNull())
         .groupBy("app_id", trunc_ntz("hour", "processed_timestamp").alias("hour"))
         .agg(F.avg("sentiment_score").alias("avg_sentiment")))
    both = p.join(s, ["app_id", "hour"]).groupBy("app_id").agg(co_moments("avg_players", "avg_sentiment").alias("state"), F.count(F.lit(1)).alias("hours"))
    return both.select("app_id", correlation(F.col("state")).alias("correlation"), "hours")


def executive_kpis(reviews: DataFrame, as_of=None, hours: float = 24) -> DataFrame:
    """M5: one KPI row over the window."""
    lab = reviews.filter(F.col("sentiment_label").isNotNull()
                         & (F.col("processed_timestamp") > minus(as_of, hours=hours)))
    agg = lab.agg(F.count(F.lit(1)).alias("review_volume"), F.avg("sentiment_score").alias("avg_sentiment"),
                  F.count_if(F.col("sentiment_label") == "positive").alias("positive"),
                  F.count_distinct("app_id").alias("games_analyzed"))
    return agg.select("review_volume", "avg_sentiment", "games_analyzed",
                      F.coalesce(F.try_divide(F.col("positive").cast("double"),
                                              F.col("review_volume").cast("double")) * 100,
                                 F.lit(0.0)).alias("positive_share"))


def report_trend(reports: DataFrame) -> DataFrame:
    """M6: per day and overall status, number of runs and mean issue count
    over stored quality reports."""
    return (reports.groupBy(F.to_date("created_at").alias("date"), "overall_status")
            .agg(F.count(F.lit(1)).alias("runs"), F.avg("total_issues").alias("avg_issues")))


def timezone_peaks(stg_players: DataFrame, zones: Sequence[str] = DEFAULT_ZONES) -> DataFrame:
    """M7: busiest local hour per zone. Zones differ from UTC by quarters of
    an hour, so readings are summed per UTC quarter hour first, and only these
    few rows are multiplied by the (bounded) list of zones."""
    length = 15 * 60 * 1_000_000
    quarter = F.timestamp_micros(F.floor(F.unix_micros(F.col("timestamp").cast("timestamp")) / length) * length)
    quarters = stg_players.groupBy(quarter.alias("quarter")).agg(F.sum("player_count").alias("total"), F.count("player_count").alias("n"))
    z = quarters.select("total", "n", "quarter", F.explode(F.array(*[F.lit(v) for v in zones])).alias("zone"))
    hourly = (z.groupBy("zone", local_hour("quarter", F.col("zone")).alias("hour"))
              .agg(F.try_divide(F.sum("total").cast("double"), F.sum("n")).alias("avg_players")))
    return _peak(hourly, ["zone"])


def review_volume_quality(reviews: DataFrame, low: float = 0.3) -> DataFrame:
    """M8: per game per day: labelled reviews, mean confidence, mean helpful
    votes and the low-confidence share."""
    lab = reviews.filter(F.col("sentiment_label").isNotNull())
    return (lab.groupBy("app_id", F.to_date("processed_timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("reviews"), F.avg("sentiment_confidence").alias("avg_confidence"),
        F.avg("review_helpful").alias("avg_helpful"),
        (F.count_if(F.col("sentiment_confidence") < low) / F.count(F.lit(1)) * 100).alias("low_confidence_pct")))
