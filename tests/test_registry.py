"""Every registered query against its DuckDB oracle (sf0.001 for speed;
tools/check_oracle.py runs the same at sf0.01), plus contract checks."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import types as T

from tools.check_oracle import TABLES, digest

from .conftest import SF001

import __spark_entry__ as E  # noqa: E402
from tidewatch.plans import REGISTRY  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "positive_review_pct" in df.columns


def test_every_query_has_oracle_or_is_declared_rows_only():
    sqls = E.oracle_sql()
    rows_only = {n for n, e in REGISTRY.items() if e.sql is None}
    assert set(REGISTRY) <= set(E.queries()) and set(sqls) <= set(E.queries())
    assert set(REGISTRY) - rows_only == set(REGISTRY) & set(sqls)


@pytest.mark.parametrize("name", sorted(n for n, e in REGISTRY.items() if e.sql is not None))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    assert doubles == set(REGISTRY[name].floats), "declared float columns out of sync"
