"""Mergeable co-moments and the correlation built on them."""

from __future__ import annotations

import datetime as dt
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewatch.functions.moments import co_moments, correlation, merged
from tidewatch.operators import dashboards as D

SF1 = "/root/testdata/sf0.1"


def pearson(rows):
    rows = [(x, y) for x, y in rows if x is not None and y is not None]
    n = len(rows)
    mx, my = (sum(r[k] for r in rows) / n if n else 0 for k in (0, 1))
    xx, yy = (sum((r[k] - m) ** 2 for r in rows) for k, m in ((0, mx), (1, my)))
    return sum((x - mx) * (y - my) for x, y in rows) / math.sqrt(xx * yy) if n > 1 and xx and yy else None


GROUPS = {"plain": [(k * 1.5, (k * 7) % 5) for k in range(40)], "shifted": [(1e9 + k % 3, 1e9 - k % 4) for k in range(60)], "one": [(1.0, 2.0)],
          "constant": [(3.3, k) for k in range(9)], "both": [(0.1, 0.2)] * 5, "nulls": [(None, 1.0), (2.0, None), (1.0, 1.0), (2.0, 5.0), (3.0, 2.0)], "none": [(None, 1.0)]}


@pytest.mark.parametrize("parts", [1, 7])
def test_states_of_parts_merge_to_the_whole(spark, parts):
    rng = random.Random(2)
    rows = [(g, rng.randrange(parts), *map(lambda v: None if v is None else float(v), xy)) for g, xys in GROUPS.items() for xy in xys]
    df = spark.createDataFrame(rows, "g string, part int, x double, y double").repartition(4)
    states = df.groupBy("g", "part").agg(co_moments("x", "y").alias("state"))
    whole = states.groupBy("g").agg(merged("state").alias("s"))
    got = {r.g: (r.c, r.n) for r in whole.select("g", correlation(F.col("s")).alias("c"), F.col("s.n").alias("n")).collect()}
    for g, xys in GROUPS.items():
        want = pearson(xys)
        assert got[g][1] == sum(x is not None and y is not None for x, y in xys)
        assert (got[g][0] is None) == (want is None) and (want is None or abs(got[g][0] - want) < 1e-6)


def test_hours_that_do_not_vary_give_null(spark):
    t = dt.datetime(2024, 1, 1)
    players = [(a, h * 10 if a == 1 else 5, t + dt.timedelta(hours=h)) for a in (1, 2, 3) for h in range(1 if a == 3 else 4)]
    reviews = [(a, s, "positive", t + dt.timedelta(hours=h)) for a in (1, 2, 3) for h, s in enumerate((0.1, None, 0.4, 0.2))]
    got = {r.app_id: (r.correlation, r.hours) for r in D.player_sentiment_correlation(
        spark.createDataFrame(players, "app_id int, player_count int, timestamp timestamp_ntz"),
        spark.createDataFrame(reviews, "app_id int, sentiment_score double, sentiment_label string, processed_timestamp timestamp_ntz")).collect()}
    assert got[2] == (None, 4) and got[3] == (None, 1)
    assert got[1][1] == 4 and abs(got[1][0] - pearson([(0, 0.1), (20, 0.4), (30, 0.2)])) < 1e-12


@pytest.mark.parametrize("name", ["player_sentiment_correlation", "insights_lists"])
def test_at_the_larger_scale(spark, name):
    from tools.check_oracle import TABLES, digest

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{SF1}/{table}.parquet')")
    df = E.queries()[name](spark, SF1)
    cur = con.execute(E.oracle_sql()[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest([d[0] for d in cur.description], cur.fetchall())[0]
