"""The pipeline's stages against plain versions, and the registry."""

from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tidewatch.llm.common import table
from tidewatch.llm.queries import ORACLE_SQL, QUERIES
from tools.check_oracle import TABLES, digest

from ..conftest import SF001, SF01
from .helpers import components, shingles


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF01}/{t}.parquet')")
    df = QUERIES[name](spark, SF01)
    cur = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(columns, want)[0]


def test_all_queries_are_registered():
    names = E.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}


def test_stages_match_plain_versions(spark):
    docs = table(spark, SF001, "documents")
    columns = docs.columns
    text = {r.doc_id: r.text for r in docs.collect()}
    kept = set(text)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, SF001)
        if k == len(corpus_pipeline.STAGES) - 1:
            break
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), before.schema)
        now = {r.doc_id for r in docs.collect()}
        assert now <= kept and all(text[r.doc_id] == r.text for r in docs.collect())
        if k == 0:
            judged = QUERIES["op8_quality_rules"](spark, SF001)
            assert now == {r.doc_id for r in judged.collect() if r.kept}
        if k == 1:
            groups = defaultdict(list)
            for i in kept:
                groups["".join((text[i] or "").split())].append((-len(text[i] or ""), i))
            assert now == {min(g)[1] for g in groups.values()}
        if k == 2:
            ids = sorted(kept)
            assert now == set(components([shingles(text[i], 5) for i in ids], ids, 8, 10))
        kept = now
    pieces = defaultdict(list)
    for p in docs.collect():
        pieces[p.doc_id].append(p)
    assert set(pieces) == kept
    for ps in pieces.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == ps[0].doc_tokens


def test_mixing_deletes_no_documents(spark):
    rows = [(i, f"text {i} " * 9000, "en", "hot" if i % 2 else f"s{i % 20}", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, table(spark, SF001, "documents").schema)
    assert sorted(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, SF001).collect()) == list(range(60))


def test_run_is_its_stages(spark):
    got = corpus_pipeline.run(spark, SF001)
    assert got.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 0
