"""Parsers on hand-built bodies (FIXTURES.md section 2), malformed ones included."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import scoring as K
from tidewatch.sources import payloads as A

T0 = dt.datetime(2024, 1, 2)


def raw(spark, *bodies):
    return spark.createDataFrame([(a, b if b is None or isinstance(b, str) else json.dumps(b), T0) for a, b in bodies],
                                 "app_id int, body string, fetched_at timestamp_ntz")


def price(**po):
    return {"success": True, "data": {"price_overview": po}}


def test_prices(spark):
    got = A.parse_price_payload(raw(
        spark, (1, {"1": price(final=999, initial=1099, discount_percent=10, currency="EUR")}), (2, {"2": {"success": False}}),
        (3, {"3": {"success": True, "data": {}}}), (4, {"4": price(final=0)}), (5, {"6": price(final=1)}), (7, "{broken"), (8, None),
        (9, {"9": price(final=10**15)}))).collect()
    assert {r.app_id: (r.price_current, r.price_original, r.discount_percent, r.currency) for r in got} == {
        1: (Decimal("9.99"), Decimal("10.99"), 10, "EUR"), 3: (Decimal(0), Decimal(0), 0, "USD"), 4: (Decimal(0), Decimal(0), 0, "USD"),
        9: (None, Decimal(0), 0, "USD")}


@pytest.mark.parametrize("parse", [A.parse_price_payload, A.flatten_app_details, A.flatten_owner_estimates])
def test_bodies_are_parsed_once(spark, parse):
    plan = parse(raw(spark, (1, "{}")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_reviews(spark):
    def r(i, **more):
        return {"recommendationid": i, **more}
    got = A.explode_review_payload(raw(
        spark, (1, {"success": 1, "reviews": [r("a", review="x", votes_helpful=3, timestamp_created=86400), r("b", timestamp_created=0), r(None, review="y")]}),
        (2, {"success": 2, "reviews": [r("z")]}), (3, {"success": 1, "reviews": []}), (4, "{broken"), (5, {"success": 1}))).collect()
    assert [(x.app_id, x.review_id, x.review_text, x.review_helpful, x.review_timestamp) for x in got] == [
        (1, "a", "x", 3, dt.datetime(1970, 1, 2)), (1, "b", "", 0, None), (1, None, "y", 0, None)]


def test_app_list_and_its_argument(spark):
    apps = [{"appid": i, "name": n} for i, n in enumerate(("ab", "x", None, "", "cd", "ef"))]
    body = raw(spark, (0, {"applist": {"apps": apps}}), (0, "{broken"))
    assert [r.name for r in A.explode_app_list(body).collect()] == ["ab", "cd", "ef"]
    assert [r.name for r in A.explode_app_list(body, 5).collect()] == ["ab", "cd"]


def test_details(spark):
    full = {"name": "N", "type": "game", "is_free": False, "developers": ["A", "B"], "publishers": ["P"], "platforms": {"windows": True},
            "categories": [{"description": "c"}], "genres": [{"description": "g"}], "screenshots": [{"path_full": "s"}],
            "movies": [{"webm": {"max": "m"}}], "release_date": {"date": "21 Aug, 2012"}, "price_overview": {"final": 199, "initial": 0},
            "pc_requirements": {"minimum": "8 GB"}, "mac_requirements": [], "metacritic": {"score": 80, "url": "u"}}
    got = {r.app_id: r for r in A.flatten_app_details(raw(
        spark, (1, {"1": {"success": True, "data": full}}), (2, {"2": {"success": True, "data": {"release_date": {"date": "Coming soon"}}}}),
        (3, {"3": {"success": False}}), (4, "{broken"), (5, {"5": {"success": True, "data": {"release_date": {"date": "Aug 1, 2013"}}}}))).collect()}
    assert sorted(got) == [1, 2, 5]
    a = got[1]
    assert (a.developer, a.publisher, a.genres, a.screenshots, a.movies) == ("A, B", "P", '["g"]', '["s"]', '["m"]')
    assert (a.release_date, a.price_current, a.price_original, a.metacritic_score) == (dt.date(2012, 8, 21), Decimal("1.99"), None, 80)
    assert json.loads(a.pc_requirements) == {"minimum": "8 GB"} and a.mac_requirements == "[]" and a.linux_requirements == "{}"
    assert got[2].release_date is None and got[2].release_date_text == "Coming soon" and got[2].developer == ""
    assert got[5].release_date == dt.date(2013, 8, 1)


def test_estimates_without_values_do_not_overlay(spark):
    est = A.flatten_owner_estimates(raw(spark, (1, {"owners": "1 .. 2", "players_forever": 5}), (2, "{broken"), (3, {"error": "no"}), (4, {}), (5, None)))
    assert [r.app_id for r in est.collect()] == [1]
    details = spark.createDataFrame([(1, "a", "old"), (2, "b", "old")], "app_id int, name string, owners_estimate string")
    merged = A.merge_estimates(details, est.select("app_id", "owners_estimate"))
    assert {r.app_id: r.owners_estimate for r in merged.collect()} == {1: "1 .. 2", 2: "old"}


def short_reply():
    return lambda texts: (["pos"], [0.5])


def raising():
    def predict(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError
        return ["pos"] * len(texts), [0.5] * len(texts)
    return predict


def scored(spark, texts, factory, parts=1):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, review_text string").repartition(parts)
    return sorted((r.id, r.sentiment_label, r.score_error) for r in K.score_with_model(df, factory, model_name=factory.__name__).collect())


def test_wrong_length_reply_falls_back_per_row(spark):
    assert scored(spark, ["a", "b"], short_reply) == [(0, "positive", False), (1, "positive", False)]


def test_failing_rows_fall_back_to_neutral(spark):
    assert scored(spark, ["a", "bad", "c"], raising) == [(0, "positive", False), (1, "neutral", True), (2, "positive", False)]


def test_model_is_built_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def factory():
        import os
        import uuid
        open(os.path.join(folder, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return lambda texts: (["pos"] * len(texts), [0.5] * len(texts))
    for _ in range(2):
        scored(spark, [f"t{i}" for i in range(64)], factory, parts=16)
    names = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(names) == len(set(names))


def test_pandas_reply_is_accepted(spark):
    def factory():
        return lambda texts: (pd.Series(["neg"] * len(texts)), pd.Series([0.25] * len(texts)))
    assert scored(spark, ["a", "b"], factory) == [(0, "negative", False), (1, "negative", False)]


def test_player_payload_without_count_is_dropped(spark):
    body = raw(spark, (1, {"response": {"player_count": 5}}), (2, {"response": {}}), (3, "{broken"), (4, None)).withColumn("latency_ms", F.lit(1.005))
    assert [(r.app_id, r.player_count, r.message_id) for r in A.parse_player_payload(body).collect()] == [(1, 5, "1_1704153600")]
