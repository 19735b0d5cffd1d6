"""Landed logs: offsets of batch, bounded and stream reads."""

from __future__ import annotations

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewatch.sources import landed_log as L
from tidewatch.streaming import jobs as J


def land(folder, partition, base, lines, end="\n"):
    os.makedirs(f"{folder}/partition={partition}", exist_ok=True)
    with open(f"{folder}/partition={partition}/{base:020d}.jsonl", "w", newline="") as f:
        f.write("".join(x + "\n" for x in lines[:-1]) + "".join(x + end for x in lines[-1:]))


@pytest.fixture()
def log(tmp_path):
    d = str(tmp_path / "log")
    land(d, 0, 0, ["a0", "a1", "a2"])
    land(d, 0, 3, ["a3", "a4"])
    land(d, 1, 10, ["b10", "é \U0001F600 " + "x" * 3_000_000, "", "b13"])
    land(d, 2, 0, ["c0", "c1 is still being writ"], end="")
    land(d, 10, 0, [])
    return d


MESSAGES = [(0, k, f"a{k}") for k in range(5)] + [(1, 10, "b10"), (1, 11, "é \U0001F600 " + "x" * 3_000_000), (1, 12, ""), (1, 13, "b13"), (2, 0, "c0")]


def test_all_messages_have_their_offsets(spark, log):
    assert sorted(map(tuple, L.read_log(spark, log).collect())) == MESSAGES
    assert L.ends(log) == {0: 5, 1: 14, 2: 1, 10: 0}


def test_ranges_read_only_their_messages(spark, log):
    got = L.read_log(spark, log, {0: 2, 1: 11}, {0: 4, 1: 13, 2: 0})
    assert sorted(map(tuple, got.collect())) == [m for m in MESSAGES if m[:2] in ((0, 2), (0, 3), (1, 11), (1, 12))]
    assert got.rdd.getNumPartitions() == 3  # a file of partition 2 and the other ones are not opened


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 7, 9, 10, 50])
def test_the_first_messages_need_no_sort(spark, log, n):
    df = J.read_topic_bounded(spark, n, log=log)
    assert sorted(r.value for r in df.collect()) == sorted(m[2] for m in MESSAGES[:n])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "TakeOrdered" not in plan


def test_a_stream_goes_on_where_it_stopped(spark, log):
    out = tempfile.mkdtemp(prefix="tw-log-")

    def run():
        src = L.stream_log(spark, log)
        src.writeStream.format("parquet").option("path", f"{out}/t").option("checkpointLocation", f"{out}/ck").trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.read.parquet(f"{out}/t").collect()))
    assert run() == MESSAGES
    land(log, 0, 5, ["a5"])
    land(log, 2, 0, ["c0", "c1 is still being written", "c2"])
    land(log, 7, 100, ["d100"])
    more = [(0, 5, "a5"), (2, 1, "c1 is still being written"), (2, 2, "c2"), (7, 100, "d100")]
    assert run() == sorted(MESSAGES + more) == sorted(map(tuple, L.read_log(spark, log).collect()))
    assert run() == sorted(MESSAGES + more)


def test_ingest_from_a_log_equals_ingest_from_files(spark, tmp_path):
    values = [json.dumps({"app_id": 1 + k % 3, "player_count": k, "timestamp": f"2024-01-0{1 + k % 4}T00:00:00", "message_id": str(k)}) for k in range(40)] + ["{broken"]
    land(str(tmp_path / "log"), 0, 0, values[:20])
    land(str(tmp_path / "log"), 1, 0, values[20:])
    spark.createDataFrame([(v,) for v in values], "value string").write.text(str(tmp_path / "files"))
    rows = {}
    for name, kw in {"log": {"log": str(tmp_path / "log")}, "files": {"path": str(tmp_path / "files")}}.items():
        src = J.read_stream(spark, J.PLAYER_TOPIC, **kw)
        J.stream_player_ingest(spark, src, str(tmp_path / f"{name}-t"), str(tmp_path / f"{name}-d"), str(tmp_path / f"{name}-c")).awaitTermination()
        table = spark.read.parquet(str(tmp_path / f"{name}-t")).drop("processed_at", "batch")
        rows[name] = sorted(map(str, table.collect())), spark.read.parquet(str(tmp_path / f"{name}-d")).select("raw").filter(F.col("raw") == "{broken").count()
    assert rows["log"] == rows["files"] and len(rows["log"][0]) == 39 and rows["log"][1] == 1


def test_kafka_offsets_of_the_first_messages():
    assert json.loads(J.kafka_ends("t", {0: 5, 3: 0}, 10)) == {"t": {"0": 15, "3": 10}}
