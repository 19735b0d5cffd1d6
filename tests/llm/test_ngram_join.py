from __future__ import annotations

import os
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import components as graph
from tidewatch.llm import ngram_join, shingles as hashing
from tidewatch.llm.common import exchanges_end, shared_folder
from tidewatch.llm.ngram_join import Threshold, jaccard_components, representatives, tile_keys
from tidewatch.llm.shingles import token_sets

from .helpers import DOCS, clashing, components, hard_docs, shingles


@pytest.mark.parametrize("num, den, width", [(90, 100, 3), (8, 10, 5)])
def test_components_match_brute_force(spark, num, den, width):
    rows = hard_docs()
    got = jaccard_components(clashing(spark, rows), (num, den), width).collect()
    sets = [shingles(r[1], width) for r in rows]
    want = components(sets, [r[0] for r in rows], num, den)
    key = lambda x: str(x)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(
        ((r[0], len(s), c) for r, s, c in zip(rows, sets, want, strict=True)), key=key)


def test_blocks_across_components(spark, monkeypatch):
    """Chains in which the first node of a tile links with few others."""
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    monkeypatch.setattr(ngram_join, "CHUNK_ROWS", 4)
    words = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i:3 * i + 100]), "en", "a", 0) for i in range(40)]
    got = jaccard_components(spark.createDataFrame(rows, DOCS).repartition(3), (90, 100), 3).collect()
    want = components([shingles(r[1], 3) for r in rows], [r[0] for r in rows], 90, 100)
    assert {r.doc_id: r.component_id for r in got} == dict(zip(range(40), want, strict=True))


@pytest.mark.parametrize("few", [0, 1 << 14])
def test_components_of_graphs(spark, monkeypatch, few):
    """In rounds and in one task."""
    monkeypatch.setattr(graph, "FEW_EDGES", few)
    rng = np.random.default_rng(8)
    edges = [(int(a), int(b)) for a, b in rng.integers(-60, 60, (45, 2))] + [(k, k + 1) for k in range(100, 130)] + [(200, 200 + k) for k in range(20)] + [(5, 5)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    sets = {}
    for a, b in edges:
        both = sets.get(a, {a}) | sets.get(b, {b})
        sets |= dict.fromkeys(both, both)
    assert got == {n: min(c) for n, c in sets.items() if len(c) > 1}
    assert graph.components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_pairs_are_given_out_in_one_tile(monkeypatch):
    """Whatever tiles two nodes share, the lists of their least ones name one
    of them, or leave the pair to all."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(ngram_join, "LEAST_TILES", 4)
    for _ in range(300):
        x, y = (np.sort(rng.choice(30, rng.integers(1, 20), replace=False)) for _ in range(2))
        both = np.intersect1d(x, y)
        lists = ngram_join._least_tiles(pa.array([x[:4].tolist(), y[:4].tolist()], pa.list_(pa.int64())))
        out = [t for t in both.tolist() if ngram_join._once(t, lists[0], lists[1:])[0]]
        assert out == (both[:1].tolist() if len(np.intersect1d(x[:4], y[:4])) else both.tolist())


@pytest.mark.parametrize("least", [1, 8])
def test_near_copies_that_do_not_link(spark, monkeypatch, least):
    """A group of near copies in many common tiles, few of which link."""
    monkeypatch.setattr(ngram_join, "LEAST_TILES", least)
    rng = np.random.default_rng(11)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for k in range(50):
        words = list(base)
        for at in rng.choice(300, int(rng.integers(2, 9)), replace=False):
            words[at] = f"x{rng.integers(40)}"
        rows.append((k, " ".join(words), "en", "a", 0))
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = jaccard_components(docs, (90, 100), 3).collect()
    want = components([shingles(r[1], 3) for r in rows], [r[0] for r in rows], 90, 100)
    assert {r.doc_id: r.component_id for r in got} == dict(zip(range(50), want, strict=True))
    assert 1 < len(set(want)) < 50


def test_row_numbers_hold_however_readings_are_split(spark, monkeypatch, tmp_path):
    """Every reading of the files deals them out anew, as when executors come
    and go."""
    words = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * (i % 40):3 * (i % 40) + 100]), "en", "a", 0) for i in range(120)]
    spark.createDataFrame(rows, DOCS).repartition(6).write.parquet(f"{tmp_path}/docs")
    docs, sizes = spark.read.parquet(f"{tmp_path}/docs"), iter(range(10**6))
    stage = ngram_join.staged

    def shifting(df, name):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str((1 << 27, 900, 2500)[next(sizes) % 3]))
        return stage(df, name)
    monkeypatch.setattr(ngram_join, "staged", shifting)
    try:
        got = {r.doc_id: r.component_id for r in jaccard_components(docs, (90, 100), 3).collect()}
        kept = [r.doc_id for r in representatives(docs, (90, 100), 3).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = components([shingles(r[1], 3) for r in rows], [r[0] for r in rows], 90, 100)
    assert got == dict(zip(range(120), want, strict=True)) and sorted(kept) == sorted(set(want))


def test_representatives_keep_the_smallest_id(spark):
    rows = hard_docs()
    docs = clashing(spark, rows)
    got = representatives(docs)
    assert got.columns == docs.columns
    sets = [shingles(r[1], 5) for r in rows]
    want = components(sets, [r[0] for r in rows], 8, 10)
    keep = sorted({c for c, s in zip(want, sets, strict=True) if s} | {r[0] for r, s in zip(rows, sets, strict=True) if not s}, key=str)
    assert sorted((r.doc_id for r in got.collect()), key=str) == keep


def test_texts_and_sets_are_not_exchanged(spark, monkeypatch):
    """Documents stay in their buckets, and only nodes in pairs that the bit
    counts allow have their sets gathered, however many share tiles."""
    common = [f"c{i}" for i in range(180)]
    rows = [(k, " ".join(common + [f"x{k}_{i}" for i in range(120)]), "en", "a", 0) for k in range(40)]
    rows += [(100 + k, " ".join([f"near{i}" for i in range(300)] + [f"y{k}"] * k), "en", "a", 0) for k in range(3)]
    tables, stage = {}, ngram_join.staged

    def counted(df, name):
        out = stage(df, name)
        tables.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(ngram_join, "staged", counted)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = representatives(docs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning(__row" not in plan
    assert sorted(r.doc_id for r in got.collect()) == [*range(40), 100]
    assert not [t.name for t in spark.catalog.listTables() if "ngram" in t.name]
    assert tables["ngram-places"][0] > 20 and tables["ngram-sets"][0] == 3 and max(tables["ngram-sets"]) <= 3


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert jaccard_components(empty).collect() == [] and representatives(empty).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB c\t\né　\U0001F600", max_size=40)), max_size=12), st.integers(1, 5))
def test_token_sets_match_shingles(texts, width):
    tokens, bounds = token_sets(pa.array(texts, pa.string()), width)
    sets = [shingles(t, width) for t in texts]
    assert np.diff(bounds).tolist() == [len(s) for s in sets]
    names = {}
    for i, s in enumerate(sets):
        names.setdefault(tokens[bounds[i]:bounds[i + 1]].tobytes(), set()).add(s)
    assert all(len(v) == 1 for v in names.values()) and len(names) == len(set(sets))


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 260), st.sampled_from([(9, 10), (8, 10), (90, 100), (1, 2)]), st.integers(0, 2**32))
def test_linked_sets_share_a_tile(n, ratio, seed):
    t = Threshold(*ratio, 3)
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(0, 2**48, n, dtype=np.uint64))
    apart = t.apart(n, t.partner(n))
    new = int(rng.integers(0, apart + 1))
    gone = int(rng.integers(0, apart - new + 1))
    y = np.unique(np.concatenate([rng.permutation(x)[gone:], rng.integers(0, 2**48, new, dtype=np.uint64)]))
    if len(y) and t.links(len(x), len(y), len(np.intersect1d(x, y))):
        key, who = tile_keys(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), t)
        assert set(key[who == 0].tolist()) & set(key[who == 1].tolist())


def _peak(f, *args):
    """(result, bytes held at most besides the arguments)."""
    tracemalloc.start()
    try:
        return f(*args), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _letters(rng, n: int, words: int = 5000) -> str:
    return " ".join(f"w{k}" for k in rng.integers(0, words, n))


def test_memory_of_a_chunk():
    """Numbers per letter, per token and per tile key are held for a bounded
    part of a chunk, or of one long text, at a time."""
    rng = np.random.default_rng(7)
    for texts in ([_letters(rng, 350) for _ in range(1000)], [_letters(rng, 350_000)]):
        texts = pa.array(texts, pa.string())
        (tokens, bounds), most = _peak(token_sets, texts, 5)
        assert most < 16 * texts.nbytes
        if len(texts) > 1:
            (key, _), most = _peak(tile_keys, tokens, bounds, Threshold(8, 10, 5))
            assert most < 24 * len(tokens) + 32 * len(key)


def test_memory_of_a_meeting():
    """Buckets of heads are sorted one after the other."""
    rng = np.random.default_rng(8)
    rows = [(bucket, chunk, rng.integers(0, 1 << 40, 500).astype(np.uint64).tobytes(),
             rng.integers(0, 4096, 500).astype(np.uint16).tobytes(), b"") for chunk in range(50) for bucket in range(16)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
        pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "chunk", "keys", "who", "heads"])
    _, most = _peak(list, ngram_join._meet(iter([batch])))
    assert most < 30 * 50 * 16 * 500


@pytest.mark.parametrize("span", [1, 5, 64])
def test_spans_do_not_matter(monkeypatch, span):
    rng = np.random.default_rng(span)
    texts = pa.array([None, "", " \t", "é" * 40, "A b", *(f" {_letters(rng, n, 9)}\n" for n in (1, 4, 5, 60, 200))], pa.string())

    def both():
        tokens, bounds = token_sets(texts, 5)
        own = bounds[np.append(True, np.diff(bounds) > 0)]
        return tokens, bounds, *(sorted(zip(*map(np.ndarray.tolist, tile_keys(tokens, own, Threshold(8, 10, 5))), strict=True)),)
    want = both()
    monkeypatch.setattr(hashing, "SPAN_BYTES", span)
    monkeypatch.setattr(ngram_join, "RUN_TOKENS", span)
    got = both()
    assert all(np.array_equal(g, w) for g, w in zip(got, want, strict=True))


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 12_000), st.sampled_from([(9, 10), (8, 10), (1, 2)]), st.integers(0, 2**32))
def test_sketches_lose_no_link(n, ratio, seed):
    t = Threshold(*ratio, 3)
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(0, 2**48, n, dtype=np.uint64))
    y = np.unique(np.concatenate([rng.permutation(x)[int(rng.integers(0, t.apart(n, n) + 1)):],
                                  rng.integers(0, 2**48, int(rng.integers(0, t.apart(n, n) + 1)), dtype=np.uint64)]))
    if len(y) and t.links(len(x), len(y), len(np.intersect1d(x, y))):
        a, b = (ngram_join._sketch(s, t.sketch_bits(len(s))) for s in (x, y))
        for words in (16, min(len(a), len(b))):
            assert ngram_join._bound(t, len(x), len(y), ngram_join._folded(a, words), ngram_join._folded(b, words))


@pytest.mark.parametrize("ratio", [(9, 10), (8, 10)])
def test_sketches_tell_large_sets_apart(ratio):
    """Whatever their size, sets that differ in a half more tokens than linked ones do."""
    t = Threshold(*ratio, 3)
    rng = np.random.default_rng(5)
    for n in (300, 1500, 5000, 20_000, 60_000):
        both = rng.integers(0, 2**48, 2 * n, dtype=np.uint64)
        new = 3 * t.apart(n, n) // 4 + 1
        a, b = (ngram_join._sketch(s, t.sketch_bits(n)) for s in (both[:n], both[new:new + n]))
        assert not ngram_join._bound(t, n, n, a, b)


def test_long_texts_with_a_passage_in_common(spark, monkeypatch):
    """Their sets aren't gathered, and what a round of comparing has staged is gone."""
    rng = np.random.default_rng(2)
    passage = " ".join(f"p{i}" for i in range(400))
    rows = [(k, f"{_letters(rng, 4000, 10**9)} {passage}", "en", "a", 0) for k in range(12)]
    rows += [(100 + k, rows[k][1] + " more" * k, "en", "a", 0) for k in range(3)]
    tables, stage = {}, ngram_join.staged

    def counted(df, name):
        out = stage(df, name)
        tables.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(ngram_join, "staged", counted)
    folder = shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    got = representatives(spark.createDataFrame(rows, DOCS).repartition(3))
    assert sorted(r.doc_id for r in got.collect()) == list(range(12))
    assert tables["ngram-places"][0] > 12 and 0 < max(tables["ngram-sets"]) <= 6
    assert not [f for f in set(os.listdir(folder)) - before if f.startswith(("ngram-sets", "ngram-candidates"))]


def test_exchange_files_end_with_their_execution(spark, tmp_path):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in found.mkString("\n").split("\n") if "/shuffle_" in f}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, conf = files(), spark.conf.get(key)
    with exchanges_end(spark):
        spark.range(1000).repartition(4, "id").write.parquet(f"{tmp_path}/out")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(key) == conf
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1000
