"""The learned scorer: held-out accuracy, calibration, defined cases."""

from __future__ import annotations

import json
import math
import random

import pytest

import __spark_entry__ as E
from tidewatch.operators import learned as L
from tidewatch.streaming import jobs as J
from tidewatch.sinks.stored import StoredTable

from .conftest import SF01

SCHEMA = "review_id long, review_text string, sentiment_label string"


def reviews(n: int, noise: float = 0.0):
    """Words of three moods in two scripts, among words of none."""
    rng = random.Random(4)
    words = {"negative": ["grottig", "öde", "плохо", "schlimmste"], "neutral": ["ordentlich", "mittel", "обычно"], "positive": ["prächtig", "famos", "отлично"]}
    plain = ["das", "spiel", "hat", "игра", "level", "2024", "und"]
    rows = []
    for k in range(n):
        mood = rng.choice(L.CLASSES)
        told = rng.choice(L.CLASSES) if rng.random() < noise else mood
        rows.append((k, " ".join(rng.sample(plain, 4) + [rng.choice(words[mood]) + rng.choice(["", "!", "er"])]), told))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(reviews(600) + [(9001, None, "positive"), (9002, "", "negative"), (9003, "x", None), (9004, "x", "mixed")], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def scorer(rows):
    return L.fit(rows)


def test_it_learns_what_the_word_list_does_not_know(scorer, rows):
    got = L.evaluate(scorer, rows).collect()
    n, learned, listed = (sum(r[c] for r in got) for c in ("n", "learned_right", "listed_right"))
    assert n > 80 and learned / n > 0.95 and listed / n < 0.6 and abs(scorer.accuracy - learned / n) < 1e-9


def test_held_out_documents_of_the_tables(spark):
    """Above the word list, and above always giving the more frequent label."""
    got = E.queries()["learned_scorer_report"](spark, SF01).collect()
    n, learned, listed = (sum(r[c] for r in got) for c in ("n", "learned_right", "listed_right"))
    assert learned / n > max(listed, max(r.n for r in got)) / n and learned / n > 0.75


def test_confidence_is_calibrated(spark):
    """With a quarter of the labels drawn anew, the mean confidence is near
    the accuracy, and the chosen temperature is that of the least loss."""
    noisy = spark.createDataFrame(reviews(3000, noise=0.4), SCHEMA)
    scorer = L.fit(noisy, strength=0.0, iterations=60)
    held = scorer.score(noisy.filter(L.held_out("review_id")).withColumnRenamed("sentiment_label", "told")).collect()
    right = sum(r.sentiment_label == r.told for r in held) / len(held)
    assert abs(sum(r.sentiment_confidence for r in held) / len(held) - right) < 0.08
    sharp = L.LearnedScorer(scorer.model, 0.5, None)

    def loss(s):
        rows_ = s.probabilities(noisy.filter(L.held_out("review_id"))).select("sentiment_label", "_p").collect()
        return -sum(math.log(max(r._p[L.CLASSES.index(r.sentiment_label)], 1e-12)) for r in rows_) / len(rows_)
    assert loss(scorer) <= loss(sharp)


def test_scores_and_defined_cases(spark, scorer):
    texts = [(1, "prächtig famos", None), (2, "grottig öde", None), (3, None, None), (4, "", None), (5, "?! \n ***", None), (6, "famos " * 50_000, None)]
    got = {r.review_id: r for r in scorer.score(spark.createDataFrame(texts, SCHEMA)).collect()}
    assert set(got) == {1, 2, 5, 6} and got[1].sentiment_label == got[6].sentiment_label == "positive" and got[2].sentiment_label == "negative"
    assert all(-1 <= r.sentiment_score <= 1 and 1 / 3 <= r.sentiment_confidence <= 1 and r.llm_backend == "learned" for r in got.values())
    assert got[1].sentiment_score > 0.5 > -0.5 > got[2].sentiment_score


def test_a_saved_scorer_gives_the_same(spark, scorer, rows, tmp_path):
    scorer.save(str(tmp_path / "s"))
    back = L.LearnedScorer.load(str(tmp_path / "s"))
    same = lambda s: sorted((r.review_id, r.sentiment_label, r.sentiment_score) for r in s.score(rows.drop("sentiment_label")).collect())
    assert same(back) == same(scorer) and (back.temperature, back.accuracy) == (scorer.temperature, scorer.accuracy)


def test_without_held_out_rows(spark):
    few = spark.createDataFrame([r for r in reviews(60)], SCHEMA).filter(~L.held_out("review_id"))
    scorer = L.fit(few)
    assert scorer.temperature == 1.0 and scorer.accuracy is None


def test_a_stream_scores_with_it(spark, scorer, tmp_path):
    message = json.dumps({"event_type": "review_batch", "app_id": 1, "timestamp": "2024-01-02T00:00:00", "data": {"reviews": [
        {"app_id": 1, "review_id": f"r{k}", "review_text": t, "review_timestamp": "2024-01-02T00:00:00"} for k, t in enumerate(["famos", "grottig"])]}})
    spark.createDataFrame([(message,)], "value string").write.text(str(tmp_path / "in"))
    src = J.read_stream(spark, J.REVIEW_TOPIC, path=str(tmp_path / "in"))
    J.stream_score_reviews(spark, src, str(tmp_path / "t"), str(tmp_path / "c"), score=scorer.score).awaitTermination()
    assert {r.review_id: r.sentiment_label for r in StoredTable(spark, str(tmp_path / "t"), "review_id").read().collect()} == {"r0": "positive", "r1": "negative"}


def test_terms_cover_whole_words_of_any_script(spark):
    df = spark.createDataFrame([("(Idiot), ты-2024 a\n",)], "t string")
    got = df.select(L.terms("t")).first()[0]
    assert got == ["idiot", "ты", "2024", "a", "#<idi", "#idio", "#diot", "#iot>", "#<ты>", "#<202", "#2024", "#024>", "#<a>"]
