from __future__ import annotations

import random

import pytest

from tidewatch.llm.mixing import _plan, interleaved, mixed, period_schedule, quota_limit, schedule

from .helpers import DOCS, clashing, hard_docs


def test_one_period_deviates_by_less_than_a_block(spark):
    slots = {"a": 512, "b": 300, "c": 100, "d": 77, "e": 1, "f": 34}
    period = sum(slots.values())
    got = period_schedule(spark.createDataFrame(list(slots.items()), "lane string, slots long")).collect()
    order = [r.lane for r in sorted(got, key=lambda r: r.slot)]
    assert sorted(r.slot for r in got) == list(range(period))
    ran = dict.fromkeys(slots, 0)
    for t, lane in enumerate(order, 1):
        ran[lane] += 1
        assert all(abs(ran[x] * period - t * n) < period for x, n in slots.items())
    assert ran == slots


def docs_of(spark, sizes, extra=False):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randrange(1, 60), "en", s, 0) for i, s in enumerate(x for x, n in sizes.items() for _ in range(n))]
    return rows, (clashing if extra else lambda s, r: s.createDataFrame(r, DOCS))(spark, rows)


@pytest.mark.parametrize("sizes", [{"hot": 700, **{f"s{i}": 60 for i in range(10)}}, {"only": 50}, {"a": 300, "b": 300},
                                   {"hot": 900, **{f"t{i}": 1 for i in range(200)}, "m": 400, "n": 400}])
def test_blocks_run_within_their_windows(spark, sizes):
    rows, docs = docs_of(spark, sizes)
    got = schedule(docs, block_chars=200).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    blocks = {}
    for r in got:
        assert blocks.setdefault((r.lane, r.block), (r.slot, r.release, r.deadline, r.in_mix)) == (r.slot, r.release, r.deadline, r.in_mix)
        assert 0 <= r.place < 200
    assert len({b[0] for b in blocks.values()}) == len(blocks)
    assert all(release <= slot < due for slot, release, due, _ in blocks.values())
    share = {s: sum(r.chars for r in got if r.in_mix and r.source == s) for s in sizes}
    most = max(0.25, 2 / len(sizes))
    assert max(share.values()) <= most * sum(share.values()) + 200 * len(sizes)
    low = [r for r in got if not r.in_mix]
    assert all(r.source in ("hot",) for r in low)
    # blocks of a lane hold the running characters in the lane's order
    for lane in {r.lane for r in got}:
        mine = sorted((r for r in got if r.lane == lane), key=lambda r: (r.block, r.place))
        at = 0
        for r in mine:
            assert r.block * 200 + r.place == at
            at += r.chars


def test_quota_limit():
    assert quota_limit([700, 20, 10], 1000, 30, 0.25) == 100
    assert quota_limit([500, 400, 300, 2], 1302, 50, 0.25) == 102
    assert quota_limit([50, 50, 50, 50], 1000, 20, 0.25) == 1000
    assert quota_limit([9, 1], 10, 2, 0.25) == 10 and quota_limit([], 0, 0, 0.25) == 0


def test_hard_rows_and_empty_table(spark):
    rows = hard_docs()
    got = schedule(clashing(spark, rows), block_chars=100).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((r[0] for r in rows), key=str)
    assert all(r.release <= r.slot < r.deadline for r in got)
    empty = spark.createDataFrame([], DOCS)
    assert schedule(empty).collect() == [] and mixed(empty).collect() == []


def test_mixed_keeps_all_columns(spark):
    rows, docs = docs_of(spark, {"hot": 700, **{f"s{i}": 60 for i in range(10)}}, extra=True)
    got = mixed(docs, block_chars=200)
    assert got.columns == docs.columns
    inside = {r.doc_id for r in schedule(docs, block_chars=200).where("in_mix").collect()}
    assert {r.doc_id for r in got.collect()} == inside and {r[0] for r in rows if r[3] != "hot"} <= inside


def test_sources_keep_to_their_exact_targets(spark):
    quota = {"hot": 2000, **{f"s{i:02}": 315 + i % 3 for i in range(19)}, **{f"t{i:03}": 1 + i % 5 for i in range(100)}}
    mix = sum(quota.values())
    got = _plan(spark.createDataFrame(list(quota.items()), "lane string, quota long"), mix, span=3000).collect()
    assert sorted(r.slot for r in got) == list(range(mix))
    assert sorted((r.lane, r.nth) for r in got) == sorted((x, b) for x, n in quota.items() for b in range(n))
    most = dict.fromkeys(quota, 0)
    for r in got:  # a source deviates most right before and after its own blocks
        w = quota[r.lane] / mix
        most[r.lane] = max(most[r.lane], abs(r.nth + 1 - w * (r.slot + 1)), abs(r.nth - w * r.slot))
    assert all(most[x] < (1 if n * 1024 >= mix else 2) for x, n in quota.items()), most


def test_interleaved_keeps_all_documents_in_the_order_of_the_schedule(spark):
    rows, docs = docs_of(spark, {"hot": 700, **{f"s{i}": 60 for i in range(10)}}, extra=True)
    got = interleaved(docs, block_chars=200)
    assert got.columns == docs.columns
    at = {r.doc_id: (r.slot, r.place) for r in schedule(docs, block_chars=200).collect()}
    ids = [r.doc_id for r in got.collect()]
    assert sorted(ids) == sorted(r[0] for r in rows) and ids == sorted(ids, key=at.get)
    assert interleaved(spark.createDataFrame([], DOCS)).collect() == []
