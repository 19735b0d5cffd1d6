"""Hourly states kept by a stream give the windows of a full scan."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import hourly as H
from tidewatch.operators import sentiment as S
from tidewatch.sources import fixtures

from .conftest import SF001


def near(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """States of all reviews, which arrive newest first in four files, so
    that all but the first are late."""
    d = tmp_path_factory.mktemp("hourly")
    r = fixtures.review_tracking(spark, SF001)
    edge = r.limit(6).withColumns({"id": F.col("id") + 10**9, "processed_timestamp": F.when(F.col("id") % 2 == 0, F.col("processed_timestamp")),
                                   "app_id": F.when(F.col("id") % 3 == 0, F.col("app_id")), "sentiment_label": F.lit(None).cast("string")})
    r = r.unionByName(edge)
    r.repartitionByRange(4, F.desc("processed_timestamp")).write.parquet(f"{d}/reviews")
    r = spark.read.schema(r.schema).parquet(f"{d}/reviews")
    for _ in range(2):  # a restart finds nothing new
        src = spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/reviews")
        H.stream_states(spark, src, f"{d}/states", f"{d}/ck").awaitTermination()
    return r, f"{d}/states"


def test_states_equal_those_of_a_scan(spark, stored):
    reviews, path = stored
    assert near(H.read_states(spark, path).select(*H.KEYS, *H.SUMS).collect()) == near(H.hourly_states(reviews).collect())


def test_a_replayed_batch_is_counted_once(spark, stored, tmp_path):
    reviews, _ = stored
    for _ in range(3):
        H.add_batch(spark, reviews, 0, str(tmp_path / "s"))
    assert near(H.read_states(spark, str(tmp_path / "s")).select(*H.KEYS, *H.SUMS).collect()) == near(H.hourly_states(reviews).collect())
    H.add_batch(spark, reviews, 1, str(tmp_path / "s"))
    twice = {(r.hour, r.app_id, r.sentiment_label): r.reviews for r in H.read_states(spark, str(tmp_path / "s")).collect()}
    assert twice == {(r.hour, r.app_id, r.sentiment_label): 2 * r.reviews for r in H.hourly_states(reviews).collect()}


@pytest.mark.parametrize("as_of", [dt.datetime(2024, 1, 20, 0, 0), dt.datetime(2024, 1, 20, 13, 27, 11, 5), dt.datetime(2024, 1, 30, 23, 59, 59)])
def test_windows_equal_those_of_a_scan(spark, stored, as_of):
    reviews, path = stored
    reviews = reviews.filter(F.col("processed_timestamp") <= F.lit(as_of).cast("timestamp_ntz"))  # nothing later is known then
    states = H.read_states(spark, path).filter(F.col("hour") <= F.lit(as_of).cast("timestamp_ntz"))
    if as_of.minute:  # the newest hour as it is at this moment
        hour = F.lit(as_of.replace(minute=0, second=0, microsecond=0)).cast("timestamp_ntz")
        now = H.hourly_states(reviews.filter(F.col("processed_timestamp") >= hour))
        states = states.filter(F.col("hour") < hour).select(*H.KEYS, *H.SUMS).unionByName(now)
    else:
        states = states.filter(F.col("hour") < F.lit(as_of).cast("timestamp_ntz"))
        reviews = reviews.filter(F.col("processed_timestamp") < F.lit(as_of).cast("timestamp_ntz"))
    day = H.window(states, reviews, as_of, hours=24)
    assert near(H.hourly_game_sentiment(day).collect()) == near(S.hourly_game_sentiment(reviews, None, as_of).select("app_id", "hour", "sentiment", "count", "avg_score").collect())
    assert near(H.processing_rate_hourly(day).collect()) == near(S.processing_rate_hourly(reviews, as_of).collect())
    assert near(H.sentiment_trend(day).collect()) == near(S.sentiment_trend_24h(reviews, as_of).collect())
    assert near(H.daily_sentiment_trend(H.window(states, reviews, as_of, days=30)).collect()) == near(S.daily_sentiment_trend(reviews, as_of).collect())


def test_a_day_reads_the_folders_of_its_days(spark, stored):
    _, path = stored
    files = H.read_states(spark, path, dt.datetime(2024, 1, 29, 12)).inputFiles()
    days = {f.split("part_day=")[1][:10] for f in H.read_states(spark, path, dt.datetime(2024, 1, 29, 12)).select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert days == {"2024-01-29", "2024-01-30"} and len(files) >= len(days)


def test_no_states_yet(spark, tmp_path):
    assert H.read_states(spark, str(tmp_path / "none")) is None
