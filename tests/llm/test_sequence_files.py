from __future__ import annotations

import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as E
from tests.conftest import SF001
from tidewatch.llm import sequence_files as S

from .helpers import DOCS, clashing, hard_docs

WORDS = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(WORDS)


def ids_of(text: str | None) -> np.ndarray:
    return np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=20) | st.sampled_from(["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", " ", "\x0b", "\x85", "́", "İΣ", "it's", "A.B", "\x00"]), max_size=8).map("".join))
def test_ids_are_those_of_tokenizers(text):
    got = S.word_encoder(WORDS)(pa.array(["before", text, None, text]).slice(1))
    assert [g.tolist() for g in got] == [PLAIN.encode(x, add_special_tokens=False).ids for x in (text, "", text)]


def test_few_kept_runs_change_nothing():
    few, texts = S.WordEncoder(WORDS, kept=3), [f"a{k % 5} b{k % 7} Word{k}" for k in range(40)]
    got = [few(pa.array([t]))[0].tolist() for t in texts]
    assert got == [x.tolist() for x in S.word_encoder(WORDS)(pa.array(texts))]


@pytest.mark.parametrize("shape", [(8, 2, 50), (2048, 64, 1 << 26), (3, 1, 1)])
def test_documents_come_back(spark, tmp_path, shape):
    length, rows, file_ids = shape
    docs = [r for r in hard_docs() if r[0] not in (900, 901)] + [(-7, "x <|endoftext|> y", "en", "a", 1), (950, "w " * 500, "en", "a", 1)]
    folder = f"{tmp_path}/set"
    S.write(clashing(spark, docs).repartition(3), folder, WORDS, length=length, rows=rows, file_ids=file_ids)
    got = sorted(S.read(spark, folder, "documents").collect(), key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    keys = [r.key for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    want = sorted(((k, len(i), zlib.crc32(i)) for k, i in ((r[0], ids_of(r[1])) for r in docs)), key=str)
    assert sorted(((r.key, r.n_tokens, r.ids_crc32) for r in got), key=str) == want
    whole = np.concatenate([ids_of(r[1]) for r in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0))])
    sequences = S.read(spark, folder).collect()
    order = {f["name"]: k for k, f in enumerate(S.manifest(folder)["files"])}
    flat = [i for r in sorted(sequences, key=lambda r: (order[r.file], r.sequence)) for i, m in zip(r.ids, r.mask, strict=True) if m]
    assert all(len(r.ids) == len(r.mask) == length for r in sequences) and len(flat) == len(whole) and sum(flat) == int(whole.sum())


def test_random_access_copies_nothing(tmp_path):
    rng = np.random.default_rng(5)
    docs = [(k, rng.integers(2, 60_000, int(rng.integers(1, 90))).astype("<u2")) for k in range(200)]
    with pa.OSFile(f"{tmp_path}/a.arrow", "wb") as sink:
        file = S.FileWriter(sink, 16, 4, 2)
        for key, ids in docs:
            file.add(key, ids)
        file.close()
    flat = np.concatenate([i for _, i in docs])
    got = S.SequenceFile(str(tmp_path), "a.arrow")
    assert len(got) == -(-len(flat) // 16)
    before = pa.total_allocated_bytes()
    mapped = np.frombuffer(got.source.read_buffer(), np.uint8)
    low = mapped.ctypes.data
    for i in rng.permutation(len(got)).tolist():
        ids, mask = got[i]
        want = flat[i * 16:(i + 1) * 16]
        assert not ids.flags.owndata and low <= ids.ctypes.data < low + got.source.size()
        assert ids[:len(want)].tolist() == want.tolist() and mask.to_pylist() == [k < len(want) for k in range(16)]
    assert pa.total_allocated_bytes() == before
    with pytest.raises(IndexError):
        got[len(got)]


def test_only_a_commit_names_files(spark, tmp_path):
    """A failing task leaves the set as it was; a second write replaces it."""
    from pyspark.sql import functions as F

    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    S.write(spark.createDataFrame([(1, "one")], "doc_id long, text string"), folder, WORDS)
    bad = spark.createDataFrame([(k, "two") for k in range(50)], "doc_id long, text string").withColumn("text", F.when(F.col("doc_id") == 40, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        S.write(bad, folder, WORDS)
    assert [r.key for r in S.read(spark, folder, "documents").collect()] == [1]
    S.write(spark.createDataFrame([(5, "three")], "doc_id long, text string"), folder, WORDS)
    assert [r.key for r in S.read(spark, folder, "documents").collect()] == [5]


def test_empty_table(spark, tmp_path):
    S.write(spark.createDataFrame([], DOCS), f"{tmp_path}/none", WORDS)
    assert S.read(spark, f"{tmp_path}/none", "documents").collect() == [] and S.read(spark, f"{tmp_path}/none").collect() == []


def test_query_matches_the_library(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    at, want = 0, []
    for r in docs:
        ids = ids_of(r.text)
        want.append((r.doc_id, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    got = E.queries()["op12_sequence_files"](spark, SF001)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and sorted(map(tuple, got.collect())) == want
