"""Pinned semantics on hand-built frames (FIXTURES.md §2) and property tests
of the skew-safe operators against plain-Python models."""

from __future__ import annotations

import datetime as dt
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.functions import scoring_fns as K
from tidewatch.operators import merge as M
from tidewatch.operators import quality as Q
from tidewatch.operators import sentiment as S
from tidewatch.operators import staging
from tidewatch.operators import windows as W
from tidewatch.plans import REGISTRY
from tidewatch.sinks import writers as B

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


@pytest.mark.parametrize("rows_per_task", [50, 10_000_000])
def test_lag_by_key_equals_plain_lag_on_skewed_data(spark, rows_per_task):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = 0 if rng.random() < 0.6 else rng.randrange(1, 6)  # one hot key
        rows.append((i, key, T0 + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 10)), rng.randrange(0, 500)))
    df = spark.createDataFrame(rows, "id long, k int, ts timestamp_ntz, v int")
    got = W.lag_by_key(df, ["k"], ["ts", "id"], ["v"], rows_per_task=rows_per_task).select("id", "prev_v")
    pdf = pd.DataFrame(rows, columns=["id", "k", "ts", "v"]).sort_values(["k", "ts", "id"])
    pdf["prev_v"] = pdf.groupby("k")["v"].shift(1)
    want = {r.id: (None if pd.isna(r.prev_v) else int(r.prev_v)) for r in pdf.itertuples()}
    assert {r.id: r.prev_v for r in got.collect()} == want


def test_price_flag_float_quirk(spark):
    rows = [(1, "9.99", T0), (1, "10.00", T0 + dt.timedelta(hours=1)), (2, "1.00", T0),
            (2, "1.01", T0 + dt.timedelta(hours=1)), (2, "1.01", T0 + dt.timedelta(hours=2))]
    df = spark.createDataFrame(rows, "app_id int, p string, timestamp timestamp_ntz").select(
        "app_id", F.col("p").cast("decimal(10,2)").alias("price_current"), "timestamp")
    got = [r.price_change_detected for r in W.price_changes(df).orderBy("app_id", "timestamp").collect()]
    # 9.99 -> 10.00 is not flagged in float arithmetic, 1.00 -> 1.01 is; first rows never
    assert got == [False, False, False, True, False]


def test_trending_boundary_row_is_previous_only(spark):
    rows = []
    for i in range(3):
        rows.append((i, 1, "G", "positive", 0.9, T0 - dt.timedelta(minutes=10 + i)))
    for i in range(3):
        rows.append((10 + i, 1, "G", "negative", -0.9, T0 - dt.timedelta(hours=5, minutes=i)))
    rows.append((20, 1, "G", "negative", -0.9, T0 - dt.timedelta(hours=4)))  # exactly as_of - 4 h
    df = spark.createDataFrame(rows, "id long, app_id int, game_name string, sentiment_label string, "
                                     "sentiment_score double, processed_timestamp timestamp_ntz")
    r = S.trending_sentiment(df, T0).first()
    assert r.total_reviews == 7 and r.trend_direction == "improving"


def test_day_of_week_and_snippet(spark):
    df = spark.createDataFrame([(1, 1, "G", 5, dt.datetime(2024, 1, 7, 3), 1.0)],
                               "id long, app_id int, game_name string, player_count int, "
                               "timestamp timestamp_ntz, api_response_time_ms double")
    assert staging.stg_player_tracking(df).first().day_of_week == 0  # a Sunday
    t = spark.createDataFrame([("a" * 200,), ("b" * 201,)], "t string")
    out = [r[0] for r in t.select(staging.snippet(F.col("t"))).collect()]
    assert out[0] == "a" * 200 and out[1] == "b" * 200 + "..."


def test_unprocessed_blank_passes_empty_rejected(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, ""), (3, None, "  "), (4, "positive", "y"), (5, None, None)],
                               "id long, sentiment_label string, review_text string").select(
        "id", F.lit(1).alias("app_id"), F.lit("G").alias("game_name"), F.lit("r").alias("review_id"),
        "review_text", F.lit(0).alias("review_helpful"), F.lit(None).cast("timestamp_ntz").alias("review_timestamp"),
        "sentiment_label")
    assert [r.id for r in staging.unprocessed_reviews(df, 50).collect()] == [1, 3]


def test_label_mapping_and_reply_parsing(spark):
    raw = spark.createDataFrame([(x, 0.8) for x in ("POSITIVE", "pos", "LABEL_2", "neg", "LABEL_0", "LABEL_1",
                                                    "other")], "l string, s double")
    out = [tuple(r) for r in raw.select(K.normalize_label("l", "s").alias("n")).select("n.*").collect()]
    assert [o[0] for o in out] == ["positive"] * 3 + ["negative"] * 2 + ["neutral"] * 2
    assert [o[1] for o in out] == [0.8] * 3 + [-0.8] * 2 + [0.0] * 2
    rep = spark.createDataFrame([('{"sentiment":"Positive","score":0.7,"confidence":0.9}',), ("not json",)], "r string")
    p = rep.select(K.parse_reply("r").alias("p")).select("p.*").collect()
    assert p[0].sentiment_label == "positive" and not p[0].score_error
    assert p[1].sentiment_label == "neutral" and p[1].sentiment_score == 0.0 and p[1].score_error


def test_quality_score_weights(spark):
    df = spark.createDataFrame(
        [(1, "A", "game", "short", "dev", "pub", 9.99, "img", "[]", "[]", '["x"]', dt.date(2020, 1, 1))],
        "app_id int, name string, type string, short_description string, developer string, publisher string, "
        "price_current double, header_image string, screenshots string, categories string, genres string, "
        "release_date date")
    v = df.select(K.registry_quality_score(df).alias("q")).first().q
    # 5 x 0.06 + 0.2 + 0.1 + 0.1 ('[]' screenshots are truthy) + 0.075 (genres only) + 0.15
    assert v == pytest.approx(0.3 + 0.2 + 0.2 + 0.075 + 0.15)


# -- upsert against a sequential dict model ------------------------------------

def _model(current, batch, update_cols):
    state = {r["review_id"]: dict(r) for r in current}
    nulls = []
    for r in sorted(batch, key=lambda r: r["id"]):
        if r["review_id"] is None:
            nulls.append(dict(r))
        elif r["review_id"] in state:
            state[r["review_id"]].update({c: r[c] for c in update_cols})
        else:
            state[r["review_id"]] = dict(r)
    return sorted([tuple(sorted(v.items())) for v in list(state.values()) + nulls], key=str)


row = st.fixed_dictionaries({"review_id": st.sampled_from(["a", "b", "c", None]),
                             "sentiment_score": st.floats(-1, 1, allow_nan=False),
                             "game_name": st.sampled_from(["X", "Y"])})


@settings(max_examples=15, deadline=None)
@given(cur=st.lists(row, max_size=4, unique_by=lambda r: r["review_id"]), batch=st.lists(row, max_size=6))
def test_upsert_matches_sequential_model(spark, cur, batch):
    cur = [dict(r, id=i) for i, r in enumerate(c for c in cur if c["review_id"] is not None)]
    batch = [dict(r, id=100 + i) for i, r in enumerate(batch)]
    schema = "id long, review_id string, sentiment_score double, game_name string"
    cdf = spark.createDataFrame([(r["id"], r["review_id"], r["sentiment_score"], r["game_name"]) for r in cur], schema)
    bdf = spark.createDataFrame([(r["id"], r["review_id"], r["sentiment_score"], r["game_name"]) for r in batch], schema)
    got = M.upsert(cdf, bdf, "review_id", ["sentiment_score"], "id").collect()
    got = sorted([tuple(sorted(r.asDict().items())) for r in got], key=str)
    assert got == _model(cur, batch, ["sentiment_score"])


def test_insert_ignore_first_writer_wins(spark):
    schema = "id long, review_id string, v int"
    cur = spark.createDataFrame([(1, "a", 1)], schema)
    inc = spark.createDataFrame([(5, "a", 9), (6, "b", 2), (7, "b", 3), (8, None, 4), (9, None, 5)], schema)
    out = sorted(tuple(r) for r in M.insert_ignore(cur, inc, "review_id", "id").collect())
    assert out == sorted([(1, "a", 1), (6, "b", 2), (8, None, 4), (9, None, 5)], key=str)


def test_dedup_keeps_newest_labelled_and_all_unlabelled(spark):
    rows = [(1, "r1", "positive", T0), (2, "r1", "negative", T0 + dt.timedelta(hours=1)),
            (3, "r1", None, T0), (4, None, "neutral", T0), (5, None, "neutral", T0 + dt.timedelta(hours=2))]
    df = spark.createDataFrame(rows, "id long, review_id string, sentiment_label string, processed_timestamp timestamp_ntz")
    assert sorted(r.id for r in W.dedup_reviews(df).collect()) == [2, 3, 5]


def test_new_price_flags_against_the_stored_price(spark):
    schema = "app_id int, price_current double, timestamp timestamp_ntz"
    stored = spark.createDataFrame([(1, 5.0, T0)], schema)
    batch = spark.createDataFrame([(1, 5.0, T0 + dt.timedelta(hours=1)), (1, 6.0, T0 + dt.timedelta(hours=2))], schema)
    flags = [r.price_change_detected for r in B.flag_new_prices(stored, batch).orderBy("timestamp").collect()]
    assert flags == [False, True]


def test_chunks_hold_the_whole_text(spark):
    texts = ["", "a", "b" * 512, "c" * 513, "é\U0001F600" * 700]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, r in zip(texts, df.select(K.chunks_for_model("t", 512).alias("c")).collect(), strict=True):
        assert "".join(r.c) == t and all(len(x) <= 512 for x in r.c) and len(r.c) == max(1, -(-len(t) // 512))


def test_route_events_and_schema_evolution(spark):
    ev = spark.createDataFrame([("player_count", 1, T0, "{}"), ("other", 2, T0, "{}")],
                               "event_type string, app_id int, timestamp timestamp_ntz, data string")
    topics = [r.topic for r in B.route_events(ev).orderBy("key").collect()]
    assert topics == ["steam-player-counts", "steam-tracking-events"]
    df = spark.createDataFrame([(1,)], "id long")
    once = B.evolve_schema(df, {"llm_backend": "local"})
    assert B.evolve_schema(once, {"llm_backend": "x"}).first().llm_backend == "local"


def test_insights_lists_have_every_hour_of_the_window(spark):
    """A window of 24 hours that begins within an hour touches 25."""
    now = dt.datetime(2024, 1, 20, 13, 30)
    rows = [(1, "Game_1", "positive", 0.5, now - dt.timedelta(minutes=5 + 30 * k)) for k in range(60)]
    reviews = spark.createDataFrame(rows, "app_id int, game_name string, sentiment_label string, sentiment_score double, processed_timestamp timestamp_ntz")
    got = REGISTRY["insights_lists"].build(SimpleNamespace(reviews=reviews, review_as_of=now)).filter("section = 'sentiment_trends'").collect()
    assert [(r["rank"], r.game_name, r.review_count) for r in got] == [
        (k + 1, f"{now - dt.timedelta(hours=k):%Y-%m-%dT%H}", 1 if k in (0, 24) else 2) for k in range(25)]
    assert len(Q.insights_document(reviews, now).first().sentiment_trends) == 24
