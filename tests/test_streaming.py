"""Streaming = batch equivalence on file streams (availableNow), restart
without duplicates, tolerant decoding, stateful change detection."""

from __future__ import annotations

import datetime as dt
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import windows as W
from tidewatch.sinks.stored import StoredTable
from tidewatch.sources import fixtures
from tidewatch.streaming import jobs as J
from tidewatch.streaming import ordered as O

from .conftest import SF001


def _scratch():
    return tempfile.mkdtemp(prefix="tw-stream-")


def _player_messages(spark, n_files=3):
    """Flat messages for every player reading of sf0.001, split over files
    by time, plus bad ones: broken JSON, count 0, missing field, envelope."""
    p = fixtures.player_tracking(spark, SF001).orderBy("timestamp", "id").collect()
    msgs = [json.dumps({"app_id": r.app_id, "player_count": r.player_count,
                        "timestamp": r.timestamp.isoformat(), "game_name": r.game_name,
                        "message_id": f"{r.app_id}_{r.id}", "api_response_time_ms": r.api_response_time_ms})
            for r in p]
    return p, msgs


def test_player_ingest_valid_rejected_and_restart(spark):
    d = _scratch()
    rows, msgs = _player_messages(spark)
    extra = ['{broken', json.dumps({"app_id": 1, "player_count": 0, "timestamp": "2024-01-02T00:00:00"}),
             json.dumps({"app_id": 2, "timestamp": "2024-01-02T00:00:00"}),
             json.dumps({"event_type": "player_count", "app_id": 3, "timestamp": "2024-01-02T00:00:00",
                         "data": {"app_id": 3, "player_count": 42, "timestamp": "2024-01-02T00:00:00"}})]
    chunks = [msgs[i::3] for i in range(3)] + [extra]
    for i, c in enumerate(chunks[:2]):
        spark.createDataFrame([(m,) for m in c], "value string").coalesce(1).write.text(f"{d}/in/{i}")
    src = J.read_stream(spark, J.PLAYER_TOPIC, path=f"{d}/in/*")
    q = J.stream_player_ingest(spark, src, f"{d}/table", f"{d}/dead", f"{d}/ckpt")
    q.awaitTermination()
    for i, c in enumerate(chunks[2:], start=2):
        spark.createDataFrame([(m,) for m in c], "value string").coalesce(1).write.text(f"{d}/in/{i}")
    src = J.read_stream(spark, J.PLAYER_TOPIC, path=f"{d}/in/*")
    q = J.stream_player_ingest(spark, src, f"{d}/table", f"{d}/dead", f"{d}/ckpt")
    q.awaitTermination()
    stored = spark.read.parquet(f"{d}/table")
    # app_id 0 is falsy and rejected like a missing id (C4), as is a 0 count
    ok = [r for r in rows if r.player_count and r.app_id]
    expected_valid = len(ok) + 1  # + the envelope message
    assert stored.count() == expected_valid
    assert stored.select("message_id").filter(F.col("message_id").isNotNull()).distinct().count() == expected_valid
    dead = spark.read.parquet(f"{d}/dead")
    assert dead.count() == len(rows) - len(ok) + 3


def test_strict_mode_rejects_envelope(spark):
    env = json.dumps({"event_type": "player_count", "app_id": 3, "timestamp": "2024-01-02T00:00:00",
                      "data": {"app_id": 3, "player_count": 42, "timestamp": "2024-01-02T00:00:00"}})
    df = spark.createDataFrame([(env,)], "value string")
    strict = J.normalize_player_event(df, accept_envelope=False)
    assert strict.filter(J.valid_player_message(strict)).count() == 0
    loose = J.normalize_player_event(df)
    assert loose.filter(J.valid_player_message(loose)).first().player_count == 42


def _all_results(spark, ordered, folder):
    """What was compared in the stream, and what still waits."""
    return ordered.results().unionByName(ordered.waiting(O.last_batch(spark, folder)))


@pytest.mark.parametrize(("hours", "rows_per_task"), [(24 * 40, None), (48, None), (48, 20)])
def test_changes_of_shuffled_messages_equal_the_batch(spark, monkeypatch, hours, rows_per_task):
    """J4 == F2, whatever the order of arrival within the delay, also where
    the hot game's rows are cut into buckets."""
    if rows_per_task:
        lag = W.lag_by_key
        monkeypatch.setattr(O, "lag_by_key", lambda *a: lag(*a, rows_per_task=rows_per_task))
    d = _scratch()
    rows, msgs = _player_messages(spark)
    rng = random.Random(hours)
    arrival = sorted(range(len(rows)), key=lambda i: rows[i].timestamp + dt.timedelta(hours=rng.uniform(0, hours * 0.99)))
    third = len(msgs) // 3
    for i, part in enumerate([arrival[:third], arrival[third:2 * third], arrival[2 * third:]]):
        spark.createDataFrame([(msgs[k],) for k in part], "value string").coalesce(1).write.text(f"{d}/in/{i}")
    for _ in range(2):  # a restart finds nothing new
        src = J.read_stream(spark, J.PLAYER_TOPIC, path=f"{d}/in/*", max_per_trigger=1)
        J.stream_significant_changes(J.normalize_player_event(src), f"{d}/changes", f"{d}/ck", delay=dt.timedelta(hours=hours)).awaitTermination()
    got = _all_results(spark, J.significant_changes(spark, f"{d}/changes"), f"{d}/changes")
    valid = [(f"{r.app_id}_{r.id}", r.app_id, r.game_name, r.player_count, r.timestamp) for r in rows if r.player_count and r.app_id]
    want = W.significant_changes(spark.createDataFrame(valid, "id string, app_id int, game_name string, player_count int, timestamp timestamp_ntz"))
    key = ["app_id", "timestamp", "previous_count", "current_count", "change_percent", "direction"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))
    assert spark.read.parquet(f"{d}/changes/late").count() == 0
    assert sorted(os.listdir(f"{d}/changes/state")) == ["batch=1", "batch=2"]


def test_messages_beyond_the_delay_are_set_apart(spark):
    d = _scratch()
    day = lambda k: f"2024-01-0{k}T00:00:00"
    m = lambda k, n: json.dumps({"app_id": 1, "player_count": n, "timestamp": day(k), "message_id": f"{k}"})
    for i, part in enumerate([[m(1, 100), m(5, 100)], [m(2, 300), m(4, 200), m(6, 100)], []]):
        _write(spark, f"{d}/in/{i}", part)
        src = J.read_stream(spark, J.PLAYER_TOPIC, path=f"{d}/in/*")
        J.stream_significant_changes(J.normalize_player_event(src), f"{d}/c", f"{d}/ck", delay=dt.timedelta(days=2)).awaitTermination()
    ordered = J.significant_changes(spark, f"{d}/c")
    assert [r.timestamp.day for r in spark.read.parquet(f"{d}/c/late").collect()] == [2]
    assert [(r.timestamp.day, r.previous_count, r.current_count) for r in ordered.results().collect()] == [(4, 100, 200)]
    assert [(r.timestamp.day, r.previous_count, r.current_count) for r in ordered.waiting(O.last_batch(spark, f"{d}/c")).collect()] == [(5, 200, 100)]


def test_a_replayed_batch_of_changes_gives_the_same(spark):
    d = _scratch()
    ordered = J.price_changes(spark, f"{d}/p", delay=dt.timedelta(0))
    t = lambda k: dt.datetime(2024, 1, k)
    frame = lambda rows: spark.createDataFrame(rows, J.PRICE)
    ordered.process(frame([(1, 5.0, t(1), True)]), 0)
    for _ in range(3):
        ordered.process(frame([(1, 6.0, t(2), True), (2, None, t(2), True)]), 1)
    ordered.process(frame([]), 2)
    assert sorted((r.app_id, r.price_change_detected) for r in ordered.results().collect()) == [(1, False), (1, True), (2, False)]


def _write(spark, folder, messages):
    spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.text(folder)


def _ingest(spark, d, dedupe):
    src = J.read_stream(spark, J.PLAYER_TOPIC, path=f"{d}/in/*")
    J.stream_player_ingest(spark, src, f"{d}/table", f"{d}/dead", f"{d}/ck", dedupe=dedupe).awaitTermination()
    return spark.read.parquet(f"{d}/table"), spark.read.parquet(f"{d}/dead")


def test_dedupe_by_id_within_and_across_batches(spark):
    d = _scratch()
    m = lambda i, t: json.dumps({"app_id": 1, "player_count": 5, "timestamp": t, "message_id": i})
    no_id = json.dumps({"app_id": 1, "player_count": 5, "timestamp": "2024-01-02T00:00:00"})
    _write(spark, f"{d}/in/0", [m("a", "2024-01-02T00:00:00"), m("a", "2024-01-02T00:00:00"), no_id, no_id])
    _ingest(spark, d, True)
    _write(spark, f"{d}/in/1", [m("a", "2024-01-02T00:00:00"), m("b", "2023-01-01T00:00:00"), no_id])
    stored, _ = _ingest(spark, d, True)
    assert sorted(r.message_id or "" for r in stored.collect()) == ["", "", "", "a", "b"]


def test_dedupe_beyond_the_stream_s_memory(spark):
    """A new checkpoint remembers nothing; the stored rows of the message's
    date do. No other date's folder is read."""
    d = _scratch()
    m = lambda i, t, n=5: json.dumps({"app_id": 1, "player_count": n, "timestamp": t, "message_id": i})
    _write(spark, f"{d}/in/0", [m("a", "2024-01-02T00:00:00"), m("c", "2024-01-05T00:00:00"), m("x", "2024-01-02T00:00:00", 0)])
    _ingest(spark, d, True)
    batch = J.normalize_player_event(spark.createDataFrame([(v,) for v in (m("a", "2024-01-02T00:00:00"), m("b", "2024-01-02T00:00:00"), m("x", "2024-01-02T00:00:00"))], "value string"))
    rows = batch.withColumn("date", F.to_date("timestamp"))
    new = J.not_stored(rows, 7, f"{d}/table")
    assert sorted(r.message_id for r in new.collect()) == ["b", "x"]
    scanned = [f for f in new.inputFiles() if f.endswith(".parquet")]
    assert scanned and all("date=2024-01-02" in f for f in scanned)
    assert J.not_stored(rows, 0, f"{d}/table").count() == 3  # a replay does not find itself
    J.player_ingest_batch(batch, 7, f"{d}/table", f"{d}/dead", True)
    J.player_ingest_batch(batch, 7, f"{d}/table", f"{d}/dead", True)
    assert sorted(r.message_id for r in spark.read.parquet(f"{d}/table").collect()) == ["a", "b", "c", "x"]


def test_ids_are_kept_in_the_state_store(spark):
    d = _scratch()
    _write(spark, f"{d}/in/0", [json.dumps({"app_id": 1, "player_count": 5, "timestamp": "2024-01-02T00:00:00", "message_id": i}) for i in "aab"])
    src = J.read_stream(spark, J.PLAYER_TOPIC, path=f"{d}/in/*")
    q = J.stream_player_ingest(spark, src, f"{d}/table", f"{d}/dead", f"{d}/ck", dedupe=True)
    q.awaitTermination()
    ops = [o for p in q.recentProgress for o in p["stateOperators"]]
    assert ops[-1]["operatorName"] == "dedupeWithinWatermark" and ops[-1]["numRowsTotal"] == 2 and "rocksdbPutCount" in ops[-1]["customMetrics"]
    assert spark.read.parquet(f"{d}/table").count() == 2


def test_dedupe_keeps_envelopes_without_ids(spark):
    d = _scratch()
    env = [json.dumps({"event_type": "player_count", "app_id": a, "timestamp": "2024-01-02T00:00:00",
                       "data": json.dumps({"player_count": 7})}) for a in range(1, 6)]
    _write(spark, f"{d}/in/0", env)
    stored, dead = _ingest(spark, d, True)
    assert sorted(r.message_id for r in stored.collect()) == [f"{a}_1704153600" for a in range(1, 6)] and dead.count() == 0


def test_bad_times_counts_and_json_go_to_the_dead_letter(spark):
    d = _scratch()
    good = json.dumps({"app_id": 1, "player_count": 5, "timestamp": "2024-01-02T00:00:00"})
    bad = [json.dumps({"app_id": 1, "player_count": 5, "timestamp": "yesterday"}), "{broken", "", "[1]", "null",
           json.dumps({"app_id": 1, "player_count": 5_000_000_000, "timestamp": "2024-01-02T00:00:00"})]
    _write(spark, f"{d}/in/0", [good, *bad])
    stored, dead = _ingest(spark, d, False)
    assert stored.count() == 1 and dead.count() == len(bad)
    _write(spark, f"{d}/in/1", [good])
    assert _ingest(spark, d, False)[0].count() == 2


def test_decode_flags_broken_values(spark):
    df = spark.createDataFrame([('{"app_id": 1}',), ("{broken",), (None,)], "value string")
    assert [r._corrupt for r in J.decode_safe(df, "app_id int").collect()] == [False, True, True]


def _reviews(app, *reviews):
    return json.dumps({"event_type": "review_batch", "app_id": app, "timestamp": "2024-01-02T00:00:00", "data": {"reviews": [
        {"app_id": app, "review_id": i, "review_text": t, "review_timestamp": when} for i, t, when in reviews]}})


def test_scored_reviews_are_stored_once_with_the_last_score(spark):
    d = _scratch()
    ok = "2024-01-02T00:00:00"

    def run():
        src = J.read_stream(spark, J.REVIEW_TOPIC, path=f"{d}/in/*")
        J.stream_score_reviews(spark, src, f"{d}/table", f"{d}/ck").awaitTermination()
        return {r.review_id: r for r in StoredTable(spark, f"{d}/table", "review_id").read().collect()}
    long_text = "great " + "x" * 5000
    _write(spark, f"{d}/in/0", [_reviews(1, ("r1", "good", ok), ("r1", "bad", ok), ("r2", long_text, "not a time")),
                                "{broken", json.dumps({"event_type": "other"})])
    first = run()
    assert {k: r.sentiment_label for k, r in first.items()} == {"r1": "negative", "r2": "positive"}
    assert first["r1"].review_text == "good" and first["r2"].review_text == long_text and first["r2"].review_timestamp is None
    _write(spark, f"{d}/in/1", [_reviews(1, ("r2", "awful", ok), ("r3", "fun", ok))])
    second = run()
    assert {k: r.sentiment_label for k, r in second.items()} == {"r1": "negative", "r2": "negative", "r3": "positive"}
    assert second["r2"].review_text == long_text


def test_price_stream_flags_as_the_batch_does(spark):
    d = _scratch()
    rows = [(1, None, "2024-01-01"), (1, 5.0, "2024-01-02"), (1, 5.0, "2024-01-03"), (1, None, "2024-01-04"), (1, 5.0, "2024-01-05"),
            (2, 3.0, "2024-01-01"), (2, 3.01, "2024-01-02"), (2, 3.5, "2024-01-06")]
    df = spark.createDataFrame(rows, "app_id int, price_current double, t string").select(
        "app_id", "price_current", F.col("t").cast("timestamp_ntz").alias("timestamp"))
    for k, (lo, hi) in enumerate((("2024-01-01", "2024-01-02"), ("2024-01-03", "2024-01-09"))):
        df.filter(F.col("timestamp").between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz"))).coalesce(1).write.parquet(f"{d}/in/{k}")
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in/*")
    J.stream_price_changes(src, f"{d}/out", f"{d}/ck").awaitTermination()
    key = lambda r: (r.app_id, r.timestamp)
    got = sorted(_all_results(spark, J.price_changes(spark, f"{d}/out"), f"{d}/out").collect(), key=key)
    want = sorted(W.price_changes(df).collect(), key=key)
    assert [r.price_change_detected for r in got] == [r.price_change_detected for r in want]


def test_hourly_window_stream_takes_late_reviews_and_the_last_hour(spark):
    d = _scratch()
    r = fixtures.review_tracking(spark, SF001)
    r.orderBy(F.desc("processed_timestamp")).repartitionByRange(4, F.desc("processed_timestamp")).write.parquet(f"{d}/reviews")
    src = spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/reviews")
    (J.hourly_sentiment_stream(src).writeStream.format("memory").queryName("hourly_t")
     .outputMode("complete").trigger(availableNow=True).start().awaitTermination())
    got = {x.hour: x.reviews_processed for x in spark.sql("select * from hourly_t").collect()}
    want = (r.filter(F.col("sentiment_label").isNotNull())
            .groupBy(F.date_trunc("hour", "processed_timestamp").cast("timestamp_ntz").alias("hour")).count())
    assert got == {x.hour: x["count"] for x in want.collect()}
