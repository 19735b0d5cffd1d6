from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from tidewatch.llm.exact_dedup import ContentTable, dedupe, exact_groups

from .helpers import DOCS, clashing, hard_docs


def expected(rows):
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[re.sub("[\x20\x09-\x0D]", "", r[1] or "")].append((-len(r[1] or ""), r[0] is None, r[0] or 0, i))
    out = []
    for content, members in groups.items():
        keep = rows[min(members)[3]][0]
        for m in members:
            out.append((rows[m[3]][0], keep, len(members), hashlib.sha256(content.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("table_bytes", [64 << 20, 100_000])
def test_groups_match_brute_force(spark, table_bytes):
    rows = hard_docs()
    got = exact_groups(spark.createDataFrame(rows, DOCS).repartition(1), table_bytes=table_bytes).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expected(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("table_bytes", [64 << 20, 100_000])
def test_dedupe_keeps_one_row_of_each_with_all_columns(spark, table_bytes):
    rows = hard_docs()
    docs = clashing(spark, rows)
    got = dedupe(docs, table_bytes=table_bytes)
    assert got.columns == docs.columns
    out = got.collect()
    assert sorted((r.doc_id for r in out), key=str) == sorted({(k, h) for _, k, _, h in expected(rows)} and [k for k, h in {(k, h) for _, k, _, h in expected(rows)}], key=str)
    assert {tuple(r)[:5] for r in out} <= set(rows) and all(r.sha == "sha" for r in out)


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert exact_groups(empty).collect() == [] and dedupe(empty).collect() == []


def test_equal_hashes_are_told_apart_by_content():
    table = ContentTable(10_000)
    assert [table.find_or_add(5, x) for x in (b"a", b"b", b"a", b"c", b"b")] == [0, 1, 0, 2, 1]


def test_table_takes_no_more_than_its_room():
    table = ContentTable(700)
    assert [table.find_or_add(i, bytes(100)) for i in range(4)] == [0, 1, None, None]
    assert table.find_or_add(1, bytes(100)) == 1
