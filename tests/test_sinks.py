"""Stored tables, appends, stored reports and their readers."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import dashboards as D
from tidewatch.operators import merge as M
from tidewatch.operators import quality as Q
from tidewatch.operators import windows as W
from tidewatch.schemas import REPORTS
from tidewatch.sinks import stored as S
from tidewatch.sinks import writers as B
from tidewatch.sources import fixtures

from .conftest import SF001

SCHEMA = "review_id string, v int, id long"


def rows(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def change(cur, new):
    return M.upsert(cur, new, "review_id", ["v"], "id")


def put(table, spark, data, batch_id=None):
    table.upsert(spark.createDataFrame(data, SCHEMA), change, batch_id)


def files(root):
    """Data files of a table with the time of their last change."""
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for f in root.rglob("*.parquet") if "_journal" not in f.parts}


def test_a_batch_of_a_day_rewrites_that_days_folders_only(spark, tmp_path):
    r = fixtures.review_tracking(spark, SF001, "flag").select("review_id", "review_timestamp", "sentiment_label", "sentiment_score", "id")
    table = S.StoredTable(spark, str(tmp_path / "t"), "review_id", "review_timestamp", width=100_000)
    assert table.read() is None
    first = r.groupBy("review_id").agg(F.min_by(F.struct(*[c for c in r.columns if c != "review_id"]), "id").alias("r")).select("review_id", "r.*")
    upsert = lambda cur, new: M.upsert(cur, new, "review_id", ["sentiment_label", "sentiment_score"], "id")
    table.upsert(first, upsert)
    before, stored = files(tmp_path / "t"), {x.review_id: x for x in table.read().collect()}
    assert stored == {x.review_id: x for x in first.collect()} and len({k.split("/")[1] for k in before}) > 20
    day = dt.date(2024, 1, 15)
    batch = first.filter(F.to_date("review_timestamp") == F.lit(day)).withColumn("sentiment_label", F.lit("changed"))
    touched = {x.review_id for x in batch.collect()}
    new = spark.createDataFrame([("r99999999", dt.datetime(2024, 1, 15, 3), "new", 0.5, 7)], first.schema)
    table.upsert(batch.unionByName(new), upsert)
    after = files(tmp_path / "t")
    changed = {k.rsplit("/", 1)[0] for k in after if after[k] != before.get(k)} | {k.rsplit("/", 1)[0] for k in before if k not in after}
    assert {c.split("/")[1] for c in changed} == {"part_day=2024-01-15"}
    now = {x.review_id: x for x in table.read().collect()}
    assert {k for k, x in now.items() if x.sentiment_label == "changed"} == touched
    assert {k: x for k, x in now.items() if k not in touched} == {k: x for k, x in stored.items() if k not in touched} | {"r99999999": new.first()}


def test_a_row_stays_in_the_day_of_its_first_form(spark, tmp_path):
    schema = "review_id string, t timestamp_ntz, v int, id long"
    table = S.StoredTable(spark, str(tmp_path / "t"), "review_id", "t")
    a, b = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 2)
    put_ = lambda data: table.upsert(spark.createDataFrame(data, schema), change)
    put_([("r1", a, 1, 1), ("r2", None, 2, 2), (None, a, 3, 3), (None, a, 3, 3)])
    put_([("r1", b, 10, 4), ("r2", b, 20, 5), ("r3", b, 30, 6), (None, b, 40, 7), ("r3", a, 31, 8)])
    assert rows(table) == sorted([("r1", a, 10, 1), ("r2", None, 20, 2), (None, a, 3, 3), (None, a, 3, 3), (None, b, 40, 7), ("r3", b, 31, 6)], key=str)


@pytest.mark.parametrize("step", [1, 2])
def test_a_batch_that_stops_is_finished_by_its_replay(spark, tmp_path, monkeypatch, step):
    """Stopped while the journal is written, or half way through the copy."""
    table = S.StoredTable(spark, str(tmp_path / "t"), "review_id", width=10)
    put(table, spark, [(f"r{i}", i, i) for i in range(40)], 0)
    write, calls = S.StoredTable._write, []

    def stop(self, df, folder, dynamic):
        calls.append(folder)
        if len(calls) == step:
            if step == 2:  # one of the folders has been copied
                write(self, df.filter("key_range = 'n0'"), folder, dynamic)
            raise KeyboardInterrupt
        write(self, df, folder, dynamic)
    batch = [("r1", 100, 1), ("r39", 39, 1), ("r40", 7, 2)]
    with monkeypatch.context() as m:
        m.setattr(S.StoredTable, "_write", stop)
        with pytest.raises(KeyboardInterrupt):
            put(table, spark, batch, 1)
    for _ in range(2):
        put(table, spark, batch, 1)
        assert rows(table) == sorted([(f"r{i}", 100 if i == 1 else i, i) for i in range(40)] + [("r40", 7, 2)], key=str)
    put(table, spark, [], 2)
    assert len(rows(table)) == 41 and [f.name for f in (tmp_path / "t/_journal").iterdir() if f.is_dir()] == ["batch=2"]


def test_keys_fall_into_ranges(spark):
    keys = [None, "r5", "r999999", "r1000000", "12", "abc", "9" * 30]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r[0] for r in df.select(S.key_range("k")).collect()]
    assert got[:5] == ["none", "n0", "n0", "n1", "n0"] and got[5].startswith("h") and got[6].startswith("n")


def test_added_columns_show_their_default_in_old_rows(spark, tmp_path):
    table = S.StoredTable(spark, str(tmp_path / "t"), "review_id", width=10)
    put(table, spark, [("r1", 1, 1), ("r15", 15, 2)])
    defaults = {"backend": "it's \\ local", "ms": 0.5, "tries": 3, "done": True, "v": 9}
    table.add_columns(defaults)
    table.add_columns(defaults)
    old = {r.review_id: r for r in table.read().collect()}
    assert [tuple(old["r1"]), tuple(old["r15"])] == [("r1", 1, 1, "it's \\ local", 0.5, 3, True), ("r15", 15, 2, "it's \\ local", 0.5, 3, True)]
    new = spark.createDataFrame([("r2", 2, 3, None), ("r1", 11, 4, "other")], SCHEMA + ", backend string")
    table.upsert(new, lambda cur, b: M.upsert(cur, b, "review_id", ["v", "backend"], "id"))
    got = {r.review_id: (r.v, r.backend, r.ms, r.tries) for r in table.read().collect()}
    assert got == {"r1": (11, "other", 0.5, 3), "r2": (2, None, 0.5, 3), "r15": (15, "it's \\ local", 0.5, 3)}
    assert table.read().filter("backend = 'other'").count() == 1
    with pytest.raises(ValueError):
        S.StoredTable(spark, str(tmp_path / "none"), "k").add_columns({"a": 1})


def test_repeated_runs_replace_themselves(spark, tmp_path):
    p = fixtures.player_tracking(spark, SF001)
    now = dt.datetime(2024, 1, 30)
    price = "app_id int, price_current double, timestamp timestamp_ntz"
    batches = [[(1, 5.0, now), (2, 1.0, now)], [(1, 5.0, now + dt.timedelta(hours=1)), (1, 6.0, now + dt.timedelta(hours=2)), (3, 1.0, now)]]
    insights = Q.insights_document(fixtures.review_tracking(spark, SF001, "flag"), now)
    read = lambda name: sorted(map(str, spark.read.parquet(str(tmp_path / name)).collect()))
    seen = []
    for _ in range(2):
        B.append_player(p.filter("id % 2 = 0"), str(tmp_path / "p"), "a")
        B.append_player(p.filter("id % 2 = 1"), str(tmp_path / "p"), "b")
        for k, batch in enumerate(batches):
            B.append_prices(spark, spark.createDataFrame(batch, price), str(tmp_path / "prices"), k)
        B.append_report(insights, str(tmp_path / "reports"), 7, now)
        seen.append([read(n) for n in ("p", "prices", "reports")])
    assert seen[0] == seen[1] and len(seen[0][0]) == p.count() and len(seen[0][2]) == 1
    flags = {(r.app_id, r.price_current): r.price_change_detected for r in spark.read.parquet(str(tmp_path / "prices")).filter("run = 1").collect()}
    assert flags == {(1, 5.0): False, (1, 6.0): True, (3, 1.0): False}
    B.append_player(p.filter("id = -1"), str(tmp_path / "p"), "b")  # the run repeated finds fewer rows
    assert spark.read.parquet(str(tmp_path / "p")).filter("run = 'b'").count() == 0


def test_reports_of_each_kind_are_stored_kept_and_read(spark, tmp_path):
    path = str(tmp_path / "reports")
    r = fixtures.review_tracking(spark, SF001, "flag")
    p, c = fixtures.player_tracking(spark, SF001), fixtures.tracking_config(spark, SF001)
    now = dt.datetime(2024, 1, 30)
    tables = {"steam_player_tracking": (p, "timestamp")}
    quality = Q.quality_report(Q.freshness_status(tables, now), Q.completeness_issues(c, p, now), Q.sentiment_health(r, now))
    for k, report in enumerate((quality, Q.insights_document(r, now), Q.scoring_pipeline_report(r, now), quality)):
        B.append_report(report, path, k, now + dt.timedelta(hours=12 * k))
    stored = spark.read.parquet(path).drop("run")
    assert stored.schema == REPORTS and stored.count() == 4 and stored.select("id").distinct().count() == 4
    assert stored.filter(F.col("report_details").isNull() | F.col("overall_status").isNull()).count() == 0
    newest = W.keep_last_n(stored, 2).collect()
    assert [x.created_at for x in sorted(newest, key=lambda x: x.created_at)] == [now + dt.timedelta(hours=12 * k) for k in (2, 3)]
    trend = D.report_trend(stored).collect()
    assert sum(x.runs for x in trend) == 4 and {x.date for x in trend} == {dt.date(2024, 1, 30), dt.date(2024, 1, 31)}


def test_appended_players_are_partitioned_by_date(spark, tmp_path):
    p = fixtures.player_tracking(spark, SF001)
    B.append_player(p, str(tmp_path / "p"), 1)
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.count() == p.count()
    assert "PartitionFilters: [isnotnull(date" in back.filter("date = date'2024-01-05'")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_export_is_newest_first(spark, tmp_path):
    from tidewatch.operators import staging
    rows_ = staging.review_export_projection(fixtures.review_tracking(spark, SF001), dt.datetime(2024, 1, 30), hours=24 * 30)
    for fmt in ("json", "csv"):
        B.export_sentiment(rows_, str(tmp_path / fmt), fmt)
    got = [r.processed_timestamp for r in spark.read.json(str(tmp_path / "json")).collect()]
    assert len(got) == rows_.count() == spark.read.option("header", True).csv(str(tmp_path / "csv")).count()


def test_events_are_routed_with_their_payload(spark, tmp_path):
    ev = spark.createDataFrame([("price_update", 4, dt.datetime(2024, 1, 1), '{"a":1}')],
                               "event_type string, app_id int, timestamp timestamp_ntz, data string")
    r = B.route_events(ev).first()
    assert (r.topic, r.key) == ("steam-price-updates", "4") and '"event_type":"price_update"' in r.value
    B.write_events(B.route_events(ev), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first().topic == "steam-price-updates"


@pytest.mark.parametrize("layout", [("date",), ("run", "date"), ("date", "batch")])
def test_old_days_are_dropped_whole(spark, tmp_path, layout):
    from tidewatch.operators import retention as R

    p = fixtures.player_tracking(spark, SF001).withColumns({"date": F.to_date("timestamp"), "run": F.lit(1), "batch": F.lit(2)})
    path, now = str(tmp_path / "t"), dt.datetime(2024, 1, 20, 12)
    p.write.partitionBy(*layout).parquet(path)
    before = files(tmp_path / "t")
    gone = S.drop_days(spark, path, (now - dt.timedelta(days=14)).date())
    after = files(tmp_path / "t")
    assert len(gone) == 5 and {k: v for k, v in before.items() if k in after} == after and S.drop_days(spark, path, (now - dt.timedelta(days=14)).date()) == []
    kept = R.retention_player(spark.read.parquet(path), now, 14)
    assert sorted(r.id for r in kept.select("id").collect()) == sorted(r.id for r in R.retention_player(p, now, 14).select("id").collect())
    assert spark.read.parquet(path).filter("date < '2024-01-06'").count() == 0


def test_tables_are_loaded_by_name(spark, tmp_path):
    from tidewatch.schemas import TABLES
    from tidewatch.sources.tables import load_table

    name = "steam_review_tracking"
    known = TABLES[name]
    rows = fixtures.review_tracking(spark, SF001)
    have = rows.select(*[F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in known])
    have.write.parquet(str(tmp_path / name))
    df = load_table(spark, str(tmp_path), name)
    assert df.schema.names == known.names and df.count() == rows.count()
    assert spark.sql(f"select count(*) as n from {name} where sentiment_label is null").first().n == rows.filter("sentiment_label is null").count()
    plan = df.filter("app_id = 1").select("review_id")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [IsNotNull(app_id), EqualTo(app_id,1)]" in plan and "ReadSchema: struct<app_id:int,review_id:string>" in plan.replace("ReadSchema: struct<review_id:string,app_id:int>", "ReadSchema: struct<app_id:int,review_id:string>")
