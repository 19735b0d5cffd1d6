"""Plain versions of the operators' contracts, and small hard tables."""

from __future__ import annotations

import itertools
import random
import re

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text: str | None, width: int) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(zip(*(w[k:] for k in range(width)), strict=False)) if len(w) >= width else frozenset([tuple(w)])


def linked(a: frozenset, b: frozenset, num: int, den: int) -> bool:
    return bool(a) and bool(b) and den * len(a & b) >= num * len(a | b)


def components(sets: list, ids: list, num: int, den: int) -> list:
    """The smallest id reachable, per row; an empty set is alone."""
    at = list(range(len(sets)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    for i, j in itertools.combinations(range(len(sets)), 2):
        if linked(sets[i], sets[j], num, den):
            at[root(j)] = root(i)
    return [min((ids[j] for j in range(len(sets)) if root(j) == root(i)), key=lambda x: (x is None, x)) for i in range(len(sets))]


def hard_docs() -> list[tuple]:
    """Nulls, empty and blank texts, ties, repeated rows, a long text."""
    rng = random.Random(7)
    words = ["w%d" % i for i in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    rows = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, " \t\n\x0b\x0c\r", "en", "a", 6), (3, "One two", "en", "a", 7),
            (4, "one  two", "en", None, 8), (5, "one", None, "b", 3), (None, "one two", "en", "b", 7), (6, " ".join(base), "en", "b", 1),
            (6, " ".join(base), "en", "b", 1), (7, "  ".join(base), "de", "b", 1), (8, "\n".join(base).upper(), "de", "c", 1)]
    for k in range(12):
        new = list(base)
        for _ in range(k // 2):
            new[rng.randrange(len(new))] = rng.choice(words)
        rows.append((20 + k, " ".join(new), "en", "hot", 1))
    for n in (3, 7, 17, 18, 19, 20, 40):
        rows.append((100 + n, " ".join(words[:n]), "fr", "hot", 1))
        rows.append((200 + n, " ".join(words[:n + 1]), "fr", "hot", 1))
    rows.append((900, " ".join(rng.choice(words) for _ in range(60_000)), "es", "hot", 1))
    rows.append((901, "x" * 300_000 + "\nÉ \U0001F600 é", "es", "hot", 1))
    return rows


def clashing(spark, rows):
    """The rows with extra columns that share names with inner ones."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, DOCS)
    return docs.withColumns({c: F.lit(c) for c in ("row", "node", "sha", "chars", "level", "base", "kept", "lane", "block", "stratum", "b", "c0", "key")})
