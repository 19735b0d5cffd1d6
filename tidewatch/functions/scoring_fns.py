"""Column expressions for the scorer surface (K2, K4, K5, K6): label
normalisation, model-input chunks, reply parsing and the registry
completeness score. All JVM-side; no Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import let

# Fixed values that must equal the reference's label mapping.
POSITIVE_LABELS = ("positive", "pos", "label_2")
NEGATIVE_LABELS = ("negative", "neg", "label_0")

# Per-field weights of the registry completeness score.
TEXT_FIELDS = ("name", "type", "short_description", "developer", "publisher")
TEXT_WEIGHT = 0.06
PRICE_WEIGHT = 0.2
MEDIA_FIELDS = ("header_image", "screenshots")
MEDIA_WEIGHT = 0.1
TAXONOMY_FIELDS = ("categories", "genres")
TAXONOMY_WEIGHT = 0.075
RELEASE_WEIGHT = 0.15

REPLY_SCHEMA = "sentiment string, score double, confidence double"


def normalize_label(raw_label, raw_score) -> Column:
    """K2: model label/score -> struct(label, score, confidence)."""
    lab = F.lower(raw_label if isinstance(raw_label, Column) else F.col(raw_label))
    sc = raw_score if isinstance(raw_score, Column) else F.col(raw_score)
    label = (F.when(lab.isin(*POSITIVE_LABELS), "positive")
             .when(lab.isin(*NEGATIVE_LABELS), "negative").otherwise("neutral"))
    score = (F.when(lab.isin(*POSITIVE_LABELS), sc)
             .when(lab.isin(*NEGATIVE_LABELS), -sc).otherwise(F.lit(0.0)))
    return F.struct(label.alias("sentiment_label"), score.cast("double").alias("sentiment_score"),
                    sc.cast("double").alias("sentiment_confidence"))


def chunks_for_model(text, n: int = 512) -> Column:
    """K4: the whole text in pieces of at most ``n`` characters, the input
    size of a model (500 for hosted backends, 512 for the stream scorer); an
    empty text is one empty piece. The reference scores the first piece only."""
    t = text if isinstance(text, Column) else F.col(text)
    pieces = F.greatest(F.ceil(F.length(t) / F.lit(n)), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), pieces - 1), lambda i: F.substring(t, i * n + 1, F.lit(n)))


def parse_reply(reply) -> Column:
    """K5: reply text ``{sentiment, score, confidence}`` -> struct; bad JSON or
    missing fields fall back to neutral / 0.0 / 0.0 (K3) and set ``score_error``."""
    r = reply if isinstance(reply, Column) else F.col(reply)

    def fields(parsed: Column) -> Column:
        ok = parsed.isNotNull() & parsed["sentiment"].isNotNull()
        return F.struct(
            F.when(ok, F.lower(parsed["sentiment"])).otherwise("neutral").alias("sentiment_label"),
            F.when(ok, F.coalesce(parsed["score"], F.lit(0.0))).otherwise(0.0).alias("sentiment_score"),
            F.when(ok, F.coalesce(parsed["confidence"], F.lit(0.0))).otherwise(0.0).alias("sentiment_confidence"),
            (~ok).alias("score_error"))
    return let(F.from_json(r, REPLY_SCHEMA), fields)


def with_reply(df: DataFrame, reply: str, name: str = "reply") -> DataFrame:
    """K5 for a frame: ``df`` with the struct of :func:`parse_reply`, which
    fields and filters above it do not repeat."""
    return df.select("*", F.explode(F.array(parse_reply(reply))).alias(name))


def _present(df: DataFrame, c: str) -> bool:
    return c in df.columns


def registry_quality_score(df: DataFrame) -> Column:
    """K6: completeness in 0..1, added in the reference's order so the double
    sum is the same. Absent columns count as missing."""
    def truthy(c):
        return F.col(c).isNotNull() & (F.length(F.col(c).cast("string")) > 0)

    total = F.lit(0.0)
    for c in TEXT_FIELDS:
        if _present(df, c):
            total = total + F.when(F.trim(F.col(c).cast("string")) != "", TEXT_WEIGHT).otherwise(0.0)
    if _present(df, "price_current"):
        total = total + F.when(F.col("price_current").isNotNull(), PRICE_WEIGHT).otherwise(0.0)
    for c in MEDIA_FIELDS:
        if _present(df, c):
            total = total + F.when(truthy(c), MEDIA_WEIGHT).otherwise(0.0)
    for c in TAXONOMY_FIELDS:
        if _present(df, c):
            total = total + F.when(truthy(c) & (F.col(c) != "[]"), TAXONOMY_WEIGHT).otherwise(0.0)
    if _present(df, "release_date"):
        total = total + F.when(F.col("release_date").isNotNull(), RELEASE_WEIGHT).otherwise(0.0)
    return F.least(total, F.lit(1.0))
