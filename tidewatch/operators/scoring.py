"""Review scoring (K1, K3).

Two interchangeable scorers produce the same output columns:

* ``lexicon_scores`` - the default, pure column expressions: the whole text
  is tokenised with ``split`` and scored with higher-order ``filter``; it
  runs inside the JVM with no Python worker at all.
* ``score_with_model`` - the pluggable path for a real model: an
  Arrow-batched ``mapInPandas`` where the model is loaded once per Python
  worker and applied to whole batches. A failure inside a batch falls back
  to neutral / 0.0 / 0.0 for the failing rows and sets ``score_error``
  (the reference counts such rows as processed).

Rows with NULL or empty text are never scored. The model itself is outside
this repository (no transformer runtime is installed); any callable
``texts -> (labels, scores)`` plugs in.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scoring_fns import normalize_label
from ..functions.timefns import anchor

# The default lexicon (a small polarity word list).
POSITIVE_WORDS = ("good", "great", "excellent", "amazing", "love", "fun", "best", "awesome",
                  "enjoy", "beautiful", "perfect", "recommend", "nice", "fantastic", "happy")
NEGATIVE_WORDS = ("bad", "terrible", "awful", "boring", "hate", "worst", "broken", "bug",
                  "crash", "poor", "waste", "refund", "annoying", "slow", "ugly")
TOKEN_SPLIT = "[^a-z]+"

SCORE_COLUMNS = ("sentiment_label", "sentiment_score", "sentiment_confidence")


def _scorable(df: DataFrame, text: str) -> F.Column:
    return F.col(text).isNotNull() & (F.col(text) != "")


def lexicon_scores(text) -> F.Column:
    """struct(label, score, confidence) from polarity word counts over the
    whole text: score = (pos - neg) / (pos + neg), 0 without hits."""
    tokens = F.split(F.lower(text if isinstance(text, F.Column) else F.col(text)), TOKEN_SPLIT)
    pos = F.size(F.filter(tokens, lambda t: t.isin(*POSITIVE_WORDS)))
    neg = F.size(F.filter(tokens, lambda t: t.isin(*NEGATIVE_WORDS)))
    hits = pos + neg
    raw = F.when(hits > 0, (pos - neg) / hits).otherwise(F.lit(0.0)).cast("double")
    label = F.when(pos > neg, "positive").when(neg > pos, "negative").otherwise("neutral")
    return F.struct(label.alias("sentiment_label"), raw.alias("sentiment_score"),
                    F.abs(raw).alias("sentiment_confidence"))


def score_reviews(reviews: DataFrame, as_of=None, text: str = "review_text", backend: str = "lexicon",
                  method: str = "database") -> DataFrame:
    """K1 with the default scorer: unscored rows with text get label, score,
    confidence, processing time, processed time, backend and method."""
    todo = reviews.filter(_scorable(reviews, text))
    s = lexicon_scores(text)
    return (todo.withColumn("_s", s)
            .withColumn("sentiment_label", F.col("_s.sentiment_label"))
            .withColumn("sentiment_score", F.col("_s.sentiment_score"))
            .withColumn("sentiment_confidence", F.col("_s.sentiment_confidence"))
            .withColumn("processing_time_ms", F.lit(0.0))
            .withColumn("processed_timestamp", anchor(as_of))
            .withColumn("llm_backend", F.lit(backend))
            .withColumn("processing_method", F.lit(method))
            .drop("_s"))


# -- pluggable model path -------------------------------------------------

def _worker_model(factory: Callable[[], Callable], version: str) -> Callable:
    """The model of this Python worker: built on first use, kept for later
    tasks. Functions sent to workers arrive as copies with globals of their
    own, so the cache hangs on an interpreter-wide module."""
    import sys
    kept = sys.__dict__.setdefault("_tidewatch_models", {})
    key = (factory.__module__, factory.__qualname__, version)
    if key not in kept:
        kept[key] = factory()
    return kept[key]


def lexicon_model() -> Callable[[pd.Series], tuple[list[str], list[float]]]:
    """The default lexicon as a Python model (same answers as
    ``lexicon_scores``), used to exercise the pluggable path."""
    import re
    pos_w, neg_w = set(POSITIVE_WORDS), set(NEGATIVE_WORDS)
    split = re.compile(TOKEN_SPLIT)

    def predict(texts: pd.Series):
        labels, scores = [], []
        for t in texts:
            toks = split.split(t.lower())
            p = sum(1 for w in toks if w in pos_w)
            n = sum(1 for w in toks if w in neg_w)
            raw = (p - n) / (p + n) if p + n else 0.0
            labels.append("POSITIVE" if p > n else "NEGATIVE" if n > p else "NEUTRAL")
            scores.append(abs(raw))
        return labels, scores
    return predict


def score_with_model(reviews: DataFrame, model_factory: Callable[[], Callable] = lexicon_model,
                     as_of=None, text: str = "review_text", backend: str = "local",
                     method: str = "database", model_name: str = "default") -> DataFrame:
    """K1 + K3 on the pluggable path. ``model_factory()`` returns a
    callable ``texts -> (raw_labels, raw_scores)``; it is built once per
    Python worker, factory and ``model_name`` (its version). Output raw labels go through ``normalize_label`` (K2) in
    the JVM."""
    todo = reviews.filter(_scorable(reviews, text))

    def run(batches):
        model = _worker_model(model_factory, model_name)
        for pdf in batches:
            t0 = time.perf_counter()
            try:
                labels, scores = (list(x) for x in model(pdf[text]))
                if not len(labels) == len(scores) == len(pdf):
                    raise ValueError("a reply of the wrong length")
                err = [False] * len(pdf)
            except Exception:  # noqa: BLE001 - K3: fall back per batch, row by row
                labels, scores, err = [], [], []
                for t in pdf[text]:
                    try:
                        lab, sc = model(pd.Series([t]))
                        labels.append(lab[0]), scores.append(float(sc[0])), err.append(False)
                    except Exception:  # noqa: BLE001
                        labels.append(None), scores.append(0.0), err.append(True)
            ms = (time.perf_counter() - t0) * 1000.0 / max(len(pdf), 1)
            yield pdf.assign(raw_label=labels, raw_score=scores, score_error=err, _ms=ms)

    # Whole rows go through the (narrow, Arrow-batched) Python stage, so no
    # shuffle or join back is needed afterwards.
    drop = [c for c in (*SCORE_COLUMNS, "processing_time_ms", "processed_timestamp", "llm_backend",
                        "processing_method") if c in todo.columns]
    base = todo.drop(*drop)
    schema = T.StructType(list(base.schema.fields) + [
        T.StructField("raw_label", T.StringType()), T.StructField("raw_score", T.DoubleType()),
        T.StructField("score_error", T.BooleanType()), T.StructField("_ms", T.DoubleType())])
    raw = base.mapInPandas(run, schema)
    n = normalize_label(F.coalesce("raw_label", F.lit("neutral")), F.col("raw_score"))
    failed = F.col("score_error")
    return (raw.withColumn("_n", n)
            .withColumn("sentiment_label", F.when(failed, "neutral").otherwise(F.col("_n.sentiment_label")))
            .withColumn("sentiment_score", F.when(failed, 0.0).otherwise(F.col("_n.sentiment_score")))
            .withColumn("sentiment_confidence", F.when(failed, 0.0).otherwise(F.col("_n.sentiment_confidence")))
            .withColumn("processing_time_ms", F.col("_ms"))
            .withColumn("processed_timestamp", anchor(as_of))
            .withColumn("llm_backend", F.lit(backend))
            .withColumn("processing_method", F.lit(method))
            .drop("_n", "_ms", "raw_label", "raw_score"))
