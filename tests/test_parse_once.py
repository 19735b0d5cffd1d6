"""A landed or streamed message is parsed once per shape, whatever uses its
fields: counted in the optimized plans of the queries on that path."""

from __future__ import annotations

import json

import pytest

import __spark_entry__ as E
from tidewatch.functions.frames import parse_once
from tidewatch.streaming import jobs as J

from .conftest import SF001

#: query: parses in its plan (a message, and the text that an envelope carries)
PARSES = {"normalize_player_event": 2, "valid_player_message": 2, "realtime_rows": 2, "decode_safe": 1, "stream_review_explode": 1,
          "explode_review_payload": 1, "parse_player_payload": 1, "parse_reply": 1, "flatten_owner_estimates": 1, "parse_price_payload": 1}


@pytest.mark.parametrize("name", sorted(PARSES))
def test_plans_parse_once(spark, name):
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == PARSES[name]


def test_strict_messages_have_no_second_parse(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    ev = J.normalize_player_event(df, accept_envelope=False)
    plan = ev.filter(J.valid_player_message(ev))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_every_row_stays_one_row(spark):
    values = [None, "", "{broken", "null", "[1]", '{"a": 1}', '{"a": "x"}', '{"b": {"c": 1}, "a": 2}']
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, value string")
    got = {r.k: r.p and r.p.a for r in parse_once(df, "value", "a int, b string", "p").collect()}
    assert got == {0: None, 1: None, 2: None, 3: None, 4: None, 5: 1, 6: None, 7: 2}


def test_messages_of_both_shapes(spark):
    """The envelope's own fields win, its app id and time stand in for
    missing ones; a flat message's ``data`` makes it an envelope."""
    t = "2024-01-02T00:00:00"
    messages = [
        {"app_id": 1, "player_count": 5, "timestamp": t, "message_id": "m", "game_name": "G", "source": "s", "api_response_time_ms": 1.5},
        {"event_type": "player_count", "app_id": 2, "timestamp": t, "data": {"player_count": 7}},
        {"event_type": "player_count", "app_id": 2, "timestamp": t, "data": json.dumps({"app_id": 3, "player_count": 8, "source": "in"})},
        {"app_id": 4, "player_count": 9, "timestamp": "soon", "message_id": "x"},
        {"app_id": 5, "player_count": 9, "timestamp": t, "message_id": "y", "data": "{broken"}]
    df = spark.createDataFrame([(json.dumps(m),) for m in messages], "value string").coalesce(1)
    got = [(r.app_id, r.player_count, r.timestamp is not None, r.source, r.message_id, r.game_name) for r in J.normalize_player_event(df).collect()]
    assert got == [(1, 5, True, "s", "m", "G"), (2, 7, True, "kafka_stream", "2_1704153600", None), (3, 8, True, "in", "3_1704153600", None),
                   (4, 9, False, "kafka_stream", "x", None), (5, None, True, "kafka_stream", "5_1704153600", None)]
