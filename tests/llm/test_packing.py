from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from tidewatch.llm.packing import TIERS, WINDOW, pack, pack_group, step_groups
from tidewatch.llm.queries import RANKS
from tidewatch.llm.tokens import encoder

from .helpers import DOCS, clashing, hard_docs


def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=" \t\n\r  ab1'sé!\x1c\x85", max_size=40))
def test_ids_are_those_of_tokenizers(text):
    assert encoder(RANKS)(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


TOKENIZER = tokenizer()
DEFAULT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext|", " ", "\n ", "a", " b", "é!", "<"]) | st.text(max_size=5), max_size=12).map("".join))
def test_added_tokens_are_those_of_tokenizers(text):
    assert encoder(RANKS).with_added(text).tolist() == DEFAULT.encode(text, add_special_tokens=False).ids


def test_packed_ids_hold_added_tokens(spark):
    text = "a <|endoftext|> b<|endoftext|>"
    ids = DEFAULT.encode(text, add_special_tokens=False).ids
    assert ids == [64, 220, 50256, 275, 50256]
    got = corpus_pipeline.packing(spark, spark.createDataFrame([(1, text, "en", "a", 0)], DOCS), "").collect()
    whole = np.array([*ids, 1], "<u4")
    assert {r.doc_tokens for r in got} == {6} and sum(r.length for r in got) == 6
    assert all(r.ids_crc32 == zlib.crc32(whole[r.start:r.start + r.length].tobytes()) for r in got)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=60))
def test_groups_hold_each_token_once_in_full_sequences(lengths):
    covered = defaultdict(list)
    for window, pieces in pack_group(lengths):
        assert sum(n for _, _, n in pieces) == window <= WINDOW and window & (window - 1) == 0
        for d, s, n in pieces:
            assert n > 0
            covered[d].append((s, n))
    for d, n in enumerate(lengths):
        at = 0
        for s, k in sorted(covered[d]):
            assert s == at
            at += k
        assert at == n


def test_shorter_documents_fill_long_windows():
    out = pack_group([1500, 500, 48])
    assert out[0] == (2048, [(0, 0, 1500), (1, 0, 500), (2, 0, 48)]) and TIERS[-1] == WINDOW


def test_steps_are_even():
    sizes = [2048] * 63 + [1024] * 10 + [256] * 40
    steps = step_groups(sizes, 1 << 14)
    load = np.bincount(steps, sizes)
    assert load.max() - load.min() <= 2048


@pytest.mark.parametrize("group_tokens", [1 << 21, 3000])
def test_pieces_match_the_documents(spark, group_tokens):
    rows = [r for r in hard_docs() if r[0] != 901] + [(950, "a  b\n\n c <|endoftext|>", "en", "a", 1)]
    got = pack(clashing(spark, rows).repartition(2), RANKS, group_tokens=group_tokens).collect()
    want = {}
    for r in rows:
        ids = np.array([*TOKENIZER.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        want.setdefault(r[0], []).append(ids)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in got:
        pieces[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(pieces) == set(want)
    for doc, ps in pieces.items():
        copies, ids = len(want[doc]), want[doc][0]
        assert sum(p.length for p in ps) == copies * len(ids)
        for p in ps:
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
        assert np.bincount([i for p in ps for i in range(p.start, p.start + p.length)]).tolist() == [copies] * len(ids)
    for ps in sequences.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == ps[0].window <= 2048 and at & (at - 1) == 0


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], DOCS), RANKS).collect() == []
