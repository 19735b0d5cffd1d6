"""The operators' queries over the input tables, with production parameters,
and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f
    return add


@query("op3_exact_dedup", sql=r"""
with n as (select doc_id, length(coalesce(text, '')) as chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents),
g as (select *, first_value(doc_id) over (partition by text_sha256 order by chars desc, doc_id) as keep_id,
    count(*) over (partition by text_sha256) as group_size from n)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from g""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op5_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), RANKS, added=True)


@query("op6_ngram_join", sql=oracles.NGRAM_JOIN)
def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), ratio=(90, 100), width=3).select("doc_id", "n_shingles", "component_id")


@query("op8_quality_rules", sql=oracles.QUALITY_RULES)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import judge

    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op4_source_mixing")
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import schedule

    return schedule(table(spark, sf_dir, "documents")).drop("row")


#: (host, path, verdict)
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


@query("op1_url_filter", sql=oracles.URL_FILTER)
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs of the pages whose markup is full of symbol
    runs, so other addresses of the same page are blocked as well."""
    from .url_filter import canonical, host, judge, path

    pages = table(spark, sf_dir, "pages")
    runs = F.regexp_count("html", F.lit(r"[*#$%]{3}"))
    junk = pages.where(100 * runs > F.length("html")).select("url")
    listed = junk.select(canonical(host(F.col("url")), path(F.col("url"))).alias("url"))
    return judge(pages, listed, URL_RULES)


@query("op2_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain: low quality, toxic, and both at once."""
    from .toxicity import score, train_chain

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    low, toxic = F.col("quality") == 0, F.col("toxic") == 1
    chain = train_chain(docs, labels, {"low_quality": low, "toxic": toxic, "toxic_low_quality": low & toxic})
    return score(docs, chain).select("doc_id", "p_low_quality", "p_toxic", "p_toxic_low_quality", "toxic")


@query("op7_pii_surrogates")
def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pseudonymise

    return pseudonymise(table(spark, sf_dir, "documents"), secret="corpus-2024")


@query("op9_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import main_text

    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query("op10_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import token_scan

    return token_scan.token_counts(table(spark, sf_dir, "documents"), RANKS)


WORDS = public_tokenizers.path("word_bpe_49k.json")


@query("op11_turn_repair")
def turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .turn_repair import damage, repair

    return repair(damage(table(spark, sf_dir, "conversations")))


@query("op12_sequence_files")
def sequence_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sequence_files import document_ids

    return document_ids(table(spark, sf_dir, "documents"), WORDS)


@query("op13_hard_negatives", sql=oracles.HARD_NEGATIVES)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hard_negatives import mine

    return mine(table(spark, sf_dir, "embeddings"))
