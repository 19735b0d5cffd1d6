"""Registered queries: remaining projections (C3, C5, C6, C7) and the scorer
column functions (K2, K4, K6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring_fns as K
from ..operators import staging
from .oracle_views import R_NOW
from .registry import query


@query("unprocessed_reviews", """
select id, app_id, game_name, review_id, review_text, review_helpful, review_timestamp
from review_tracking
where sentiment_label is null and review_text is not null and review_text <> ''
""")
def _c3(x):
    return staging.unprocessed_reviews(x.reviews_text)


@query("recent_reviews", f"""
select app_id,
  case when length(review_text) > 200 then concat(substring(review_text, 1, 200), '...') else review_text end as text,
  sentiment_label as sentiment, round(sentiment_score, 3) as score, review_timestamp as timestamp,
  coalesce(review_helpful, 0) as helpful_votes
from review_tracking
where processed_timestamp > {R_NOW} - to_hours(24) and sentiment_label is not null
qualify row_number() over (partition by app_id order by processed_timestamp desc, id desc) <= 20
""", floats=("score",))
def _c5(x):
    texts = x.table("documents").select(F.col("doc_id").alias("text_key"), F.col("text").alias("review_text"))
    return staging.recent_reviews(x.reviews_key, None, x.review_as_of, texts=texts)


@query("game_name_of", """
select app_id, min(game_name) as game_name from review_tracking group by app_id
""")
def _c6(x):
    return staging.game_name_of(x.reviews)


@query("review_export_projection", f"""
select app_id, game_name, sentiment_label, sentiment_score, sentiment_confidence, review_helpful,
  processed_timestamp, date_trunc('hour', processed_timestamp) as hour_bucket
from review_tracking
where sentiment_label is not null and processed_timestamp > {R_NOW} - to_hours(24)
""", floats=("sentiment_score", "sentiment_confidence"))
def _c7(x):
    return staging.review_export_projection(x.reviews, x.review_as_of)


# Raw model outputs over the labels table: one of the seven label spellings
# the mapping distinguishes, chosen by doc_id, with a score from the flags.
_RAW = ("POSITIVE", "pos", "LABEL_2", "neg", "LABEL_0", "LABEL_1", "other")


def _raw_labels(x):
    lab = x.table("labels")
    spelled = F.element_at(F.array(*[F.lit(v) for v in _RAW]), (F.col("doc_id") % len(_RAW) + 1).cast("int"))
    return lab.select("doc_id", spelled.alias("raw_label"),
                      (F.col("quality") * 0.5 + F.col("toxic") * 0.25 + 0.1).cast("double").alias("raw_score"))


_RAW_SQL = ", ".join(f"'{v}'" for v in _RAW)


@query("normalize_label", f"""
select doc_id,
  case when lower(raw_label) in ('positive','pos','label_2') then 'positive'
       when lower(raw_label) in ('negative','neg','label_0') then 'negative' else 'neutral' end as sentiment_label,
  case when lower(raw_label) in ('positive','pos','label_2') then raw_score
       when lower(raw_label) in ('negative','neg','label_0') then -raw_score else 0.0 end as sentiment_score,
  raw_score as sentiment_confidence
from (select doc_id, [{_RAW_SQL}][doc_id % 7 + 1] as raw_label,
        cast(quality * 0.5 + toxic * 0.25 + 0.1 as double) as raw_score from labels) r
""", floats=("sentiment_score", "sentiment_confidence"))
def _k2(x):
    r = _raw_labels(x)
    return r.select("doc_id", K.normalize_label("raw_label", "raw_score").alias("n")).select("doc_id", "n.*")


@query("chunks_for_model", """
select doc_id, i as chunk, substring(text, i * 512 + 1, 512) as model_text
from (select doc_id, text, unnest(range(0, cast(ceil(greatest(length(text), 1) / 512.0) as bigint))) as i from documents
      where text is not null) c
""")
def _k4(x):
    docs = x.table("documents").select("doc_id", F.posexplode(K.chunks_for_model("text", 512)).alias("chunk", "model_text"))
    return docs.withColumn("chunk", F.col("chunk").cast("long"))


@query("registry_quality_score", """
select app_id, cast(least(
    0.0
    + case when trim(cast(name as varchar)) <> '' then 0.06 else 0.0 end
    + case when trim(cast(type as varchar)) <> '' then 0.06 else 0.0 end
    + case when trim(cast(developer as varchar)) <> '' then 0.06 else 0.0 end
    + case when price_current is not null then 0.2 else 0.0 end
    + case when genres is not null and length(genres) > 0 and genres <> '[]' then 0.075 else 0.0 end,
  1.0) as double) as data_quality_score
from game_registry
""", floats=("data_quality_score",))
def _k6(x):
    reg = x.registry
    return reg.select("app_id", K.registry_quality_score(reg).cast("double").alias("data_quality_score"))
