"""Registered queries: review scoring over every unprocessed review with
text (K1 default lexicon in the JVM, and the pluggable Arrow path)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import learned as L
from ..operators import scoring as K
from ..operators import staging
from .registry import query

_POS = ", ".join(f"'{w}'" for w in K.POSITIVE_WORDS)
_NEG = ", ".join(f"'{w}'" for w in K.NEGATIVE_WORDS)

LEXICON_SQL = f"""
select id, case when p > n then 'positive' when n > p then 'negative' else 'neutral' end as sentiment_label,
  case when p + n > 0 then (p - n) / (p + n) else 0.0 end as sentiment_score,
  abs(case when p + n > 0 then (p - n) / (p + n) else 0.0 end) as sentiment_confidence
from (select id, len(list_filter(tok, lambda t: t in ({_POS}))) as p,
        len(list_filter(tok, lambda t: t in ({_NEG}))) as n
      from (select id, string_split_regex(lower(review_text), '[^a-z]+') as tok from review_tracking
            where sentiment_label is null and review_text is not null and review_text <> '') a) b
"""
_F = ("sentiment_score", "sentiment_confidence")


@query("score_reviews", LEXICON_SQL, floats=_F)
def _k1(x):
    todo = staging.unprocessed_reviews(x.reviews_text, None)
    return K.score_reviews(todo, x.review_as_of).select("id", *K.SCORE_COLUMNS)


@query("score_with_model", LEXICON_SQL, floats=_F)
def _k1_model(x):
    todo = staging.unprocessed_reviews(x.reviews_text, None)
    return K.score_with_model(todo, as_of=x.review_as_of).select("id", *K.SCORE_COLUMNS)


@query("learned_scorer_report", None)
def _k1_learned(x):
    """Fitted on the labelled documents (negative: toxic or of low quality),
    with what it and the word list get right of the held-out ones."""
    negative = (F.col("toxic") == 1) | (F.col("quality") == 0)
    labels = x.table("labels").select(F.col("doc_id").alias("review_id"), F.when(negative, "negative").otherwise("positive").alias("sentiment_label"))
    rows = x.table("documents").select(F.col("doc_id").alias("review_id"), F.col("text").alias("review_text")).join(labels, "review_id")
    return L.evaluate(L.fit(rows), rows)
