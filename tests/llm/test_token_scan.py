from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import token_scan
from tidewatch.llm.queries import RANKS
from tidewatch.llm.token_scan import scan, token_counts, write
from tidewatch.llm.tokens import encoder

from .helpers import DOCS, clashing, hard_docs


def brute(stream, separator):
    out, start = [], 0
    for i, x in enumerate(stream):
        if x == separator:
            out.append((start, i - start, True))
            start = i + 1
    if start < len(stream):
        out.append((start, len(stream) - start, False))
    return [(k, *r) for k, r in enumerate(out)]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.lists(st.integers(0, 3), max_size=5), max_size=9), min_size=1, max_size=3))
def test_scan_matches_brute_force(spark, files):
    token_scan.RUN, kept = 2, token_scan.RUN
    try:
        rows = [(f, b, bytearray(np.array(ids, "<u2").tobytes())) for f, blocks in enumerate(files) for b, ids in enumerate(blocks)]
        df = spark.createDataFrame(rows, "file int, block long, ids binary")
        got = sorted((r.file, r.ordinal, r.start, r.n_tokens, r.terminated) for r in scan(df, separator=0).collect())
    finally:
        token_scan.RUN = kept
    assert got == [(f, *r) for f, blocks in enumerate(files) for r in brute([x for b in blocks for x in b], 0)]


@pytest.mark.parametrize("block_ids", [1 << 16, 7])
def test_files_hold_the_documents_in_order(spark, block_ids):
    rows = [r for r in hard_docs() if r[0] not in (900, 901)]
    files, manifest = write(clashing(spark, rows).repartition(2), RANKS, block_ids=block_ids)
    blocks = {}
    for r in files.orderBy("file", "block").collect():
        blocks.setdefault(r.file, []).append(np.frombuffer(r.ids, "<u2"))
    assert all(len(b) == block_ids for bs in blocks.values() for b in bs[:-1])
    streams = {f: np.concatenate(b).tolist() for f, b in blocks.items()}
    found = {(f, k): streams[f][s:s + n] for f in streams for k, s, n, _ in brute(streams[f], token_scan.SEPARATOR)}
    texts = {}
    for r in rows:
        texts.setdefault(r[0], r[1] or "")
    for r in manifest.collect():
        assert found.pop((r.file, r.ordinal)) == encoder(RANKS)(texts[r.key]).tolist()
    assert not found


def test_counts_and_empty_table(spark):
    rows = hard_docs()
    got = token_counts(clashing(spark, rows), RANKS).collect()
    want = sorted(((r[0], len(encoder(RANKS)(r[1] or ""))) for r in rows), key=str)
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == want
    assert token_counts(spark.createDataFrame([], DOCS), RANKS).collect() == []
