"""Hourly review states (J8 for E3, E6, E21, E27).

A state is one row per hour, game and label: counts and sums that add up, so
states of parts (micro-batches, days) merge to those of the whole. A stream
keeps them in a stored table by day; a late review changes its own hour only.
Windows are then read from states: whole hours from the table, and the hour
that a window cuts from its reviews, so that the results are those of the
scans in ``operators.sentiment``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefns import trunc_ntz
from ..sinks.stored import DAY, StoredTable
from .sentiment import pct

KEYS = ("hour", "app_id", "sentiment_label")
SUMS = ("reviews", "scored", "score_sum", "timed", "time_sum")
SCHEMA = T.StructType([T.StructField("state_id", T.StringType()), T.StructField("hour", T.TimestampNTZType()), T.StructField("app_id", T.IntegerType()),
                       T.StructField("sentiment_label", T.StringType()), T.StructField("reviews", T.LongType()), T.StructField("scored", T.LongType()),
                       T.StructField("score_sum", T.DoubleType()), T.StructField("timed", T.LongType()), T.StructField("time_sum", T.DoubleType())])


def hourly_states(reviews: DataFrame) -> DataFrame:
    """The states of these reviews; reviews without a time have no hour."""
    hours = reviews.filter(F.col("processed_timestamp").isNotNull()).groupBy(trunc_ntz("hour", "processed_timestamp").alias("hour"), "app_id", "sentiment_label")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0.0)).cast("double")
    return hours.agg(F.count(F.lit(1)).alias("reviews"), F.count("sentiment_score").alias("scored"), zero("sentiment_score").alias("score_sum"),
                     F.count("processing_time_ms").alias("timed"), zero("processing_time_ms").alias("time_sum"))


def _added(states: DataFrame, *keys: str) -> DataFrame:
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


# -- stored states ---------------------------------------------------------------

def states_table(spark: SparkSession, path: str) -> StoredTable:
    return StoredTable(spark, path, "state_id", "hour", hashed=1)


def add_batch(spark: SparkSession, reviews: DataFrame, batch_id: int, path: str) -> None:
    """One micro-batch: its states are added to the stored ones of its days.
    A replayed batch is counted once."""
    name = F.concat_ws("|", F.col("hour").cast("string"), *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in KEYS[1:]])
    batch = hourly_states(reviews).select(name.alias("state_id"), *KEYS, *SUMS)
    add = lambda current, new: _added(current.unionByName(new.select(*current.columns)), "state_id", *KEYS, DAY)
    states_table(spark, path).upsert(batch, add, batch_id, SCHEMA)


def stream_states(spark: SparkSession, scored: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Keeps the states of a stream of scored reviews."""
    w = scored.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda b, i: add_batch(spark, b, i, path))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")).start()


def read_states(spark: SparkSession, path: str, since: dt.datetime | None = None) -> DataFrame | None:
    """Stored states, those of hours after ``since`` only: other days' folders
    are not read."""
    table = states_table(spark, path)
    if table.schema() is None:
        return None
    states = table.read(from_day=since and since.date())
    return states if since is None else states.filter(F.col("hour") > F.lit(since))


# -- windows -------------------------------------------------------------------------

def window(states: DataFrame, reviews: DataFrame, as_of: dt.datetime, hours: float = 0, days: float = 0) -> DataFrame:
    """States of the reviews later than ``as_of`` less the span: stored ones
    of the hours behind the cut one, and those of the cut hour's reviews."""
    cut = as_of - dt.timedelta(hours=hours, days=days)
    first = cut.replace(minute=0, second=0, microsecond=0)
    ntz = lambda t: F.lit(t).cast("timestamp_ntz")
    time = F.col("processed_timestamp")
    edge = hourly_states(reviews.filter((time > ntz(cut)) & (time < ntz(first + dt.timedelta(hours=1)))))
    return states.filter(F.col("hour") > ntz(first)).select(*KEYS, *SUMS).unionByName(edge)


def _mean(total: str, n: str) -> F.Column:
    return F.try_divide(F.col(total), F.col(n))


def hourly_game_sentiment(states: DataFrame) -> DataFrame:
    """E3."""
    return _added(states.filter(F.col("sentiment_label").isNotNull()), "app_id", "hour", "sentiment_label").select(
        "app_id", "hour", F.col("sentiment_label").alias("sentiment"), F.col("reviews").alias("count"), F.round(_mean("score_sum", "scored"), 3).alias("avg_score"))


def processing_rate_hourly(states: DataFrame) -> DataFrame:
    """E6."""
    return _added(states.filter(F.col("sentiment_label").isNotNull()), "hour").select(
        "hour", F.col("reviews").alias("reviews_processed"), F.round(F.coalesce(_mean("time_sum", "timed"), F.lit(0.0)), 2).alias("avg_processing_time_ms"))


def sentiment_trend(states: DataFrame, k: int = 24) -> DataFrame:
    """The newest ``k`` hours."""
    of = lambda v: F.coalesce(F.sum(F.when(F.col("sentiment_label") == v, F.col("reviews"))), F.lit(0))
    hours = states.filter(F.col("sentiment_label").isNotNull()).groupBy("hour").agg(
        F.sum("reviews").alias("review_count"), F.sum("score_sum").alias("total"), F.sum("scored").alias("n"), of("positive").alias("pos"), of("negative").alias("neg"))
    return hours.orderBy(F.desc("hour")).limit(k).select(
        "hour", "review_count", F.round(_mean("total", "n"), 3).alias("avg_sentiment"),
        pct(F.col("pos"), F.col("review_count")).alias("positive_percentage"), pct(F.col("neg"), F.col("review_count")).alias("negative_percentage"))


def daily_sentiment_trend(states: DataFrame) -> DataFrame:
    """E27."""
    return _added(states.withColumn("date", trunc_ntz("day", "hour")), "date", "sentiment_label").select(
        "date", "sentiment_label", "reviews", _mean("score_sum", "scored").alias("avg_score"))
