"""Operator 8: quality rules with risk-controlled cutoffs (DataFrame
functions only).

A document's measures are turned into a severity level: for each rule the
number of its ascending cutoffs that the measure exceeds, the largest of all
rules. Rejecting from level L on is certified for a stratum by labelled good
documents (the holdout): with X rejected of n good ones, the exact binomial
tail ``P(Bin(n, ALPHA) <= X)`` must be at most ``DELTA / strata``. Levels are
tested from the loosest on and testing stops at the first failure
(fixed-sequence testing), and the strata share DELTA (Bonferroni): with
probability ``1 - DELTA`` no stratum loses more than ALPHA of its good
documents. Of the certified levels the one that rejects most labelled bad
documents is taken, the loosest of equals; a stratum without a certified
level rejects nothing beyond the base rules.

Defined cases: a null text has no words and fails the base rules; a null
stratum is one stratum; labels that are null, unknown or repeated count as
none, none and their worst; unlabelled tables certify nothing; repeated rows
are judged one by one; an empty table gives no rows; extra columns pass
through :func:`passing` under any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, WORD, let, staged

#: Most of a stratum's good documents that may be rejected, and the chance that any stratum loses more.
ALPHA, DELTA = 0.01, 0.05
#: Certified strata (a short string and a number each) up to which their cutoffs are broadcast.
FEW_STRATA = 10_000
#: Rule measures and their ascending cutoffs, loosest last.
LEVELS = 8
RULES = {
    "symbols_per_word": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9, 2.0),
    "shouts_per_word": (0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.75, 1.5),
    "repeated_share": (0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45),
    "dup_line_share": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8),
    "capital_share": (0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.7),
    "mean_word": (8.0, 9.0, 10.0, 11.0, 12.0, 14.0, 17.0, 20.0),
}
MEASURED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts", "n_capitals"]


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window which the text has twice or more.
    Windows are compared by 64-bit hashes; a text without equal hashes needs
    no more than the count of distinct ones."""
    n = F.size(words)
    at = F.sequence(F.lit(0), n - 3)
    hashes = F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(h: Column) -> Column:
        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), lambda s: F.size(
            F.array_distinct(F.flatten(F.transform(
                F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])),
                lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))))

    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
    return F.when(n >= 3, found).otherwise(0)


def measures(text: Column) -> Column:
    """A struct of MEASURED for a text; null counts as empty."""
    def of(t: Column) -> Column:
        words = F.filter(F.split(t, f"[{SPACES}]+"), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
        without = lambda chars: (F.length(t) - F.length(F.translate(t, chars, ""))).cast("long")
        return let(F.struct(words.alias("w"), lines.alias("l")), lambda x: F.struct(
            F.size(x["w"]).cast("long").alias("n_words"),
            F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
            without("#*$%&|<>").alias("n_symbols"),
            (F.size(x["l"]) - F.size(F.array_distinct(x["l"]))).cast("long").alias("n_dup_lines"),
            _repeat_words(x["w"]).cast("long").alias("n_repeat_words"),
            F.size(x["l"]).cast("long").alias("n_lines"),
            without("!").alias("n_shouts"),
            without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals")))
    return let(F.coalesce(text, F.lit("")), of)


def severity() -> Column:
    """The number of cutoffs that the worst measure exceeds."""
    per = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    values = {"symbols_per_word": per("n_symbols", "n_words"), "shouts_per_word": per("n_shouts", "n_words"),
              "repeated_share": per("n_repeat_words", "n_words"), "dup_line_share": per("n_dup_lines", "n_lines"),
              "capital_share": per("n_capitals", "word_chars"), "mean_word": per("word_chars", "n_words")}
    level = lambda v, cuts: sum((F.coalesce(v > c, F.lit(False)).cast("int") for c in cuts), F.lit(0))
    return F.greatest(*(level(values[r], cuts) for r, cuts in RULES.items()))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _log_gamma(x: Column) -> Column:
    """ln gamma for x >= 1 by Stirling's series at x + 8."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - sum((F.log(x + k) for k in range(1, 8)), F.log(x))


def binomial_tail(n: Column, x: Column, rate: float) -> Column:
    """P(Bin(n, rate) <= x), exact to rounding; 1 from the mean on, where no
    cutoff can be certified. Terms that lie more than 40 deviations below x
    are under 1e-300 of the largest one and are left out, so the sum has at
    most 40 sqrt(n rate) terms."""
    n, x = n.cast("double"), x.cast("double")
    low = F.greatest(F.lit(0.0), x - F.ceil(40 * F.sqrt(n * rate) + 40))
    term = (_log_gamma(n + 1) - _log_gamma(x + 1) - _log_gamma(n - x + 1) + x * math.log(rate) + (n - x) * math.log1p(-rate))
    steps = F.sequence(F.lit(0).cast("long"), (x - low).cast("long"))
    odds = (1 - rate) / rate
    total = let(F.struct(n.alias("n"), x.alias("x")), lambda v: F.aggregate(
        steps, F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s")),
        lambda acc, k: F.struct((acc["t"] * (v["x"] - k) * odds / (v["n"] - v["x"] + k + 1)).alias("t"), (acc["s"] + acc["t"]).alias("s")),
        lambda acc: acc["s"]))
    return F.when(x >= n * rate, 1.0).otherwise(F.exp(term) * total)


def cutoffs(measured: DataFrame, labels: DataFrame, key: str, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, cutoff): the certified level of each stratum that has one.
    measured: key, stratum, level, base."""
    truth = labels.where("quality in (0, 1)").groupBy(F.col("doc_id").alias("__label")).agg(F.min("quality").alias("quality"))
    held = (measured.where("not base").join(truth, F.col(key) == F.col("__label"))
            .groupBy("stratum", "quality", "level").agg(F.count("*").alias("m")))
    tried = held.withColumn("cutoff", F.explode(F.sequence(F.lit(1), F.lit(LEVELS))))
    hit = F.when(F.col("level") >= F.col("cutoff"), F.col("m")).otherwise(0)
    good = F.col("quality") == 1
    tried = tried.groupBy("stratum", "cutoff").agg(
        F.sum(F.when(good, F.col("m")).otherwise(0)).alias("n"), F.sum(F.when(good, hit).otherwise(0)).alias("x"),
        F.sum(F.when(~good, hit).otherwise(0)).alias("caught"))
    strata = held.agg(F.count_distinct("stratum").alias("strata")).scalar()
    tried = tried.withColumns({"p": binomial_tail(F.col("n"), F.col("x"), alpha), "strata": strata})
    down = Window.partitionBy("stratum").orderBy(F.col("cutoff").desc())
    certified = tried.withColumn("ok", F.min((F.col("p") * F.col("strata") <= delta).cast("int")).over(down)).where("ok = 1")
    best = certified.groupBy("stratum").agg(F.max(F.struct("caught", "cutoff")).alias("b"))
    return best.select("stratum", F.col("b.cutoff").alias("cutoff"))


def _stratum(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("\x00null"))


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang",
          alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per document: key, MEASURED, stratum, level, cutoff (of its
    stratum), base_failed, kept."""
    rows = staged(docs.select(F.col(key).alias("doc_id"), _stratum(stratum).alias("stratum"), measures(F.col(text)).alias("m"))
                  .select("doc_id", "stratum", "m.*").withColumn("level", severity()).withColumn("base", base_failed()), "quality")
    return _decide(rows, labels, "doc_id", alpha, delta).withColumnRenamed("base", "base_failed")


def _decide(rows: DataFrame, labels: DataFrame, key: str, alpha: float, delta: float) -> DataFrame:
    cuts = cutoffs(rows.select(F.col(key), "stratum", "level", "base"), labels, key, alpha, delta)
    kept = ~F.col("base") & ~F.coalesce(F.col("level") >= F.col("cutoff"), F.lit(False))
    cuts = staged(cuts, "quality-cutoffs")
    if cuts.count() <= FEW_STRATA:  # documents stay where they are; else they meet their stratum in an exchange
        cuts = F.broadcast(cuts)
    return rows.join(cuts, "stratum", "left").withColumn("kept", kept)


def passing(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang",
            alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The documents that are kept, with all their columns."""
    plain = [f"c{i}" for i in range(len(docs.columns))]  # inner names, so that no column clashes
    name = dict(zip(docs.columns, plain, strict=True))
    rows = docs.toDF(*plain)
    rows = staged(rows.select(*plain, _stratum(name[stratum]).alias("stratum"), measures(F.col(name[text])).alias("m"))
                  .select(*plain, "stratum", "m.*").withColumn("level", severity()).withColumn("base", base_failed()), "quality")
    return _decide(rows, labels, name[key], alpha, delta).where("kept").select(
        *[F.col(p).alias(c) for p, c in zip(plain, docs.columns, strict=True)])
