from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import toxicity
from tidewatch.llm.shingles import _LETTER, _PLACE, mix
from tidewatch.llm.toxicity import GRAMS, LONGEST, features, score, select_features, train, train_chain

from .helpers import DOCS, clashing, hard_docs

LABELS = "doc_id long, quality int, toxic int"
def categories():
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def corpus(n, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["Scumbag", "worthless,", "idiota"])
        rows.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, int(rng.random() < 0.8), int(toxic)))
    return rows, labels


def plain_hash(b, kind):
    with np.errstate(over="ignore"):
        total, power = np.uint64(0), np.uint64(1)
        for c in b:
            total = total + _LETTER[c] * power
            power = power * _PLACE
        return int(mix(np.array([total + np.uint64(kind)]))[0] >> np.uint64(25)) + (2**39 if kind else 0)


def plain_features(text):
    apart = re.sub("[\u00a0-\u00bf\u2000-\u207f\u3000-\u303f]", " ", text)
    out = [(w, 0) for w in re.findall("[0-9A-Za-z\u0080-\U0010ffff]+", apart) if len(w.encode()) <= LONGEST]
    for run in re.findall("[^\x20\x09-\x0D]+", text):
        out += [(run[i:i + k], k) for k in GRAMS for i in range(len(run) - k + 1) if k > 2 or run[i] >= "\u0080"]
    return out


@pytest.mark.parametrize("block", [16, 1 << 18])
def test_features_are_whole_words_and_all_ngrams(monkeypatch, block):
    monkeypatch.setattr(toxicity, "_BLOCK", block)
    rng = random.Random(5)
    letters = "abcdé你好“”-(. \n\u00a0\u3002\U0001F600'7"
    texts = ["(idiot) you-idiot", None, "", "\tabcd", "你真是个白痴,对吧", "x" * 64 + " " + "y" * 65, "you die now", "é", "a b"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(40)]
    got, rows = features(pa.array(texts, pa.string()))
    want = sorted((plain_hash(w.encode(), kind), i) for i, t in enumerate(texts) for w, kind in plain_features(t or ""))
    assert sorted(zip(got.tolist(), rows.tolist(), strict=True)) == want


def test_whole_texts_of_any_script_are_judged(spark):
    """Toxic words quoted, hyphenated, short, without spaces, in capitals, at the end of long texts."""
    rng = random.Random(2)
    words = "the river runs past old stone mills while small boats carry grain to town and people walk home diet diesel слово город 城市".split()
    toxic = ["die", "idiot", "дурак", "白痴"]
    rows, labels = [], []
    for i in range(900):
        some = [rng.choice(words) for _ in range(rng.randrange(8, 30))]
        bad = rng.random() < 0.3
        if bad:
            some.insert(rng.randrange(len(some)), rng.choice(toxic))
        rows.append((i, " ".join(some), "en", "a", 1))
        labels.append((i, 1, int(bad)))
    clean = " ".join(rng.choice(words) for _ in range(20))
    hard = ["(idiot", "“Idiot”", "you-idiot", "IDIOT!!", "you die now", "ДУРАК", "城市白痴城市城市", clean + " " + "river " * 60_000 + "idiot.", "walk/idiot/home"]
    good = [clean, "diet diesel", "城市城市城市", "river " * 60_000]
    rows += [(10_000 + i, t, "en", "a", 1) for i, t in enumerate(hard)] + [(20_000 + i, t, "en", "a", 1) for i, t in enumerate(good)]
    docs = spark.createDataFrame(rows, DOCS)
    chain = train_chain(docs, spark.createDataFrame(labels, LABELS), {"toxic": F.col("toxic") == 1})
    got = {r.doc_id: r.toxic for r in score(docs, chain).collect()}
    assert [t for i, t in enumerate(hard) if not got[10_000 + i]] == []
    assert [t[:30] for i, t in enumerate(good) if got[20_000 + i]] == []


def test_selection_equals_chi_squared_over_all_candidates(spark):
    rows, labels = corpus(200, seed=4)
    sample = spark.createDataFrame([([1 - q, t], r[1].lower()) for r, (_, q, t) in zip(rows, labels, strict=True)], "labels array<int>, text string")
    sets = [set(features(pa.array([r[1].lower()]))[0].tolist()) for r in rows]
    y = np.array([[1 - q, t] for _, q, t in labels])
    chi2 = {}
    for f in set().union(*sets):
        has = np.array([f in s for s in sets])
        n, df = len(sets), has.sum()
        if (y[has].sum(axis=0) >= 5).any():
            p, a = y.sum(axis=0), y[has].sum(axis=0)
            chi2[f] = n * (a * n - df * p) ** 2 / np.maximum(df * (n - df) * p * (n - p), 1e-300) * (df * (n - df) > 0)
    got = set(select_features(sample, 2, 20, 30).tolist())
    for kind, most in ((0, 20), (1, 30)):
        of_kind = [f for f in chi2 if f >> 39 == kind]
        assert len(of_kind) > most
        for i in range(2):
            limit = sorted((chi2[f][i] for f in of_kind), reverse=True)[most - 1]
            assert {f for f in of_kind if chi2[f][i] > limit * (1 + 1e-9)} <= got
    assert got <= set(chi2) and 50 <= len(got) <= 100


def test_toxic_documents_are_caught_and_clean_ones_left_alone(spark):
    rows, labels = corpus(1500)
    docs = spark.createDataFrame(rows, DOCS)
    chain = train_chain(docs, spark.createDataFrame(labels[:800], LABELS), categories())
    got = {r.doc_id: r for r in score(docs, chain).collect()}
    truth = {i: bool(t) for i, _, t in labels[800:]}
    caught = sum(got[i].toxic for i, t in truth.items() if t) / sum(truth.values())
    wrong = sum(got[i].toxic for i, t in truth.items() if not t) / (len(truth) - sum(truth.values()))
    assert caught > 0.95 and wrong < 0.02


def test_later_models_use_out_of_fold_probabilities_of_earlier_ones():
    rng = np.random.default_rng(1)
    n = 400
    first = rng.random(n) < 0.5
    rows = np.repeat(np.arange(n), 1)
    cols = np.where(first, 0, 1)
    labels = np.stack([first, first], axis=1).astype(int)
    chain = train(["a", "b"], np.array([1, 2], np.uint64), rows, cols, labels)
    assert chain.models[0].dense.shape == (0,) and chain.models[1].dense.shape == (1,) and chain.models[1].dense[0] > 0.1
    assert 0 < chain.cutoffs[1] < 1


def test_hard_rows(spark):
    rows, labels = corpus(300)
    docs = clashing(spark, [*rows[:200], *((r[0] if r[0] is None else r[0] + 10_000, *r[1:]) for r in hard_docs())])
    odd = [*labels, (0, None, None), (None, 1, 1), (1, *labels[1][1:]), (77_777, 1, 1)]
    chain = train_chain(docs, spark.createDataFrame(odd, LABELS), categories())
    got = score(docs, chain).collect()
    assert len(got) == docs.count()
    assert not any(r.toxic for r in got if r.doc_id in (10_000, 10_001, 10_002))
    assert all(0 <= r.p_toxic <= 1 for r in got)


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame(corpus(20)[0], DOCS)
    chain = train_chain(docs, spark.createDataFrame([], LABELS), categories())
    assert not any(r.toxic or r.low_quality for r in score(docs, chain).collect())
    assert score(spark.createDataFrame([], DOCS), chain).collect() == []
