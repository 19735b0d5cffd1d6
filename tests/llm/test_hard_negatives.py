from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 600), st.integers(0, 22), st.integers(0, 2**32 - 1))
def test_scores_are_exact(width, bits, seed):
    rng = np.random.default_rng(seed)
    top = 1 << bits
    a, b = (rng.integers(-top, top + 1, (n, width)) for n in (5, 7))
    a[0], b[0] = top, -top
    b[1] = top
    bound = top * top * width
    primes = H.enough_primes(bound)
    assert math.prod(primes) > 2 * bound
    got = H.scores(H.residues(a, primes), H.residues(b, primes), primes, bound)
    assert got.tolist() == [[sum(x * y for x, y in zip(r, c, strict=True)) for c in b.tolist()] for r in a.tolist()]


def test_residues_fit_float32():
    assert max(H.PRIMES) < 512 and (max(H.PRIMES) // 2) ** 2 * H.DEPTH < 2**24 and math.prod(H.PRIMES) > 2**63
    assert all(all(p % d for d in range(2, p)) for p in H.PRIMES)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3) | st.just(H._LEAST), min_size=6, max_size=6), min_size=1, max_size=5), st.integers(1, 7))
def test_first_of_each(rows, k):
    x, y = H.first_of_each(np.array(rows), k)
    for i, r in enumerate(rows):
        want = sorted((j for j, v in enumerate(r) if v != H._LEAST), key=lambda j: (-r[j], j))[:k]
        assert sorted(y[x == i].tolist()) == sorted(want)


def plain(rows: list[tuple]) -> list[tuple]:
    good = []
    for key, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if key is not None and key % 7 == 0:
            label = math.fmod(label + 1, 10)
        good.append((key, [math.floor(256 * x) for x in v], label))
    out = []
    place = lambda k, key: (-k, key is None, key or 0)
    for i, (key, v, label) in enumerate(good):
        if key is None or key % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), k, lab) for j, (k, w, lab) in enumerate(good) if j != i]
        near = sorted((s for s in scored if s[2] == label), key=lambda s: place(s[0], s[1]))[:5]
        for p, pid, _ in near:
            inside = sorted((s for s in scored if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p), key=lambda s: place(s[0], s[1]))[:5]
            out += [(key, pid, r + 1, k, p, s) for r, (s, k, _) in enumerate(inside)]
    return out


def rows_of(seed: int, n: int, width: int, scale: float) -> list[tuple]:
    rng = random.Random(seed)
    common = [rng.uniform(-1, 1) * scale for _ in range(width)]
    rows = [(k * rng.choice([1, 1, 5]), [float(np.float32(c + rng.uniform(-1, 1) * scale / 2)) for c in common] if rng.random() < 0.7 else [float(np.float32(c)) for c in common], rng.choice([-1, 0, 1, 2, 9])) for k in range(n)]
    return rows + [(100, None, 1), (200, [0.5] * width, None), (300, [float("nan")] * width, 1), (400, [math.inf] + [0.0] * (width - 1), 1), (500, [None] + [0.5] * (width - 1), 1),
                   (None, [float(np.float32(c)) for c in common], 1), (600, [], 1), (700, [float(np.float32(common[0]))], 2)]


@pytest.mark.parametrize("case", [(1, 90, 5, 0.4, 4, 16), (2, 150, 70, 0.3, 1000, 1000), (3, 60, 300, 40.0, 2, 7)])
def test_pairs_match_brute_force(spark, case):
    from pyspark.sql import functions as F

    seed, n, width, scale, anchor_block, row_block = case
    rows = rows_of(seed, n, width, scale)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(c) for c in ("id", "v", "number", "a", "b", "side", "found")})
    got = sorted(map(tuple, H.mine(frame, anchor_block=anchor_block, row_block=row_block).collect()), key=str)
    assert got == sorted(plain(rows), key=str) and got


def test_tiles_change_nothing(spark, monkeypatch):
    rows = rows_of(4, 120, 6, 0.4)
    monkeypatch.setattr(H, "TILE", 3)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, H.mine(frame).collect()), key=str) == sorted(plain(rows), key=str)


def test_repeated_rows_are_rows_of_their_own(spark):
    v = [0.5, 0.25]
    rows = [(100, v, 1)] * 3 + [(101, v, 1)] * 2 + [(3, v, 2)] * 7
    got = sorted(map(tuple, H.mine(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == sorted(plain(rows)) and len(got) == 3 * 4 * 5


def test_beyond_a_long(spark):
    with pytest.raises(ArithmeticError):
        H.mine(spark.createDataFrame([(100, [1e30], 1), (1, [1.0], 1)], SCHEMA))
    with pytest.raises(ArithmeticError):
        H.mine(spark.createDataFrame([(100, [1e12], 1), (1, [1.0], 1)], SCHEMA))


def test_empty_table(spark):
    assert H.mine(spark.createDataFrame([], SCHEMA)).collect() == []
    assert H.mine(spark.createDataFrame([(1, [0.5], 1)], SCHEMA)).collect() == []
