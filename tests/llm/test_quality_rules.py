from __future__ import annotations

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from tidewatch.llm.quality_rules import ALPHA, binomial_tail, judge, passing

from .helpers import DOCS, WORD, clashing, hard_docs

LABELS = "doc_id long, quality int, toxic int"


def plain(text):
    t = text or ""
    w = WORD.findall(t)
    g = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if g[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_measures_match_brute_force(spark):
    rows = hard_docs() + [(300, "a b c a b c a b\na b\n\n a b\na b", "en", "a", 1), (301, "##x $ <é> 😀|\n" * 30, "en", "a", 1)]
    got = judge(clashing(spark, rows), spark.createDataFrame([], LABELS)).collect()
    key = lambda x: str(x)
    want = []
    for r in rows:
        m = plain(r[1])
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        want.append((r[0], *m, failed, not failed))  # nothing is certified without labels
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got), key=key) == sorted(want, key=key)


def test_binomial_tail_is_exact(spark):
    cases = [(100, 0, 0.01), (2000, 3, 0.01), (5000, 30, 0.01), (200_000, 1800, 0.01), (50, 49, 0.99), (1, 0, 0.3), (10, 9, 0.5)]
    got = spark.range(1).select(*[binomial_tail(F.lit(n), F.lit(x), p).alias(str(i)) for i, (n, x, p) in enumerate(cases)]).first()
    for value, (n, x, p) in zip(got, cases, strict=True):
        exact = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(x + 1))
        assert value == 1.0 if x >= n * p else math.isclose(value, exact, rel_tol=1e-7)


def _corpus(good, bad, slips):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, labels = [], []
    for i in range(good + bad):
        junk = i >= good or i < slips
        rows.append((i, " ".join(word() + ("***" if junk else "") for _ in range(60)), "en", "a", 1))
        labels.append((i, int(i < good), 0))
    return rows, labels


def test_certified_cutoff_rejects_junk_and_keeps_clean(spark):
    rows, labels = _corpus(600, 60, 0)
    got = judge(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + [(0, None, 0), (9999, 1, 0)], LABELS)).collect()
    assert all(r.kept == (r.doc_id < 600) for r in got)


def test_too_few_or_too_many_slips_certify_nothing(spark):
    for good, slips in ((100, 0), (600, int(600 * 3 * ALPHA))):
        rows, labels = _corpus(good, 40, slips)
        assert all(r.kept for r in judge(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect())


def test_passing_keeps_all_columns_and_empty_table(spark):
    rows, labels = _corpus(600, 20, 0)
    docs = clashing(spark, rows)
    got = passing(docs, spark.createDataFrame(labels, LABELS))
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == list(range(600))
    empty = spark.createDataFrame([], DOCS)
    assert judge(empty, spark.createDataFrame(labels, LABELS)).collect() == []
    assert passing(empty, spark.createDataFrame([], LABELS)).collect() == []
