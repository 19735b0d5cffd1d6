"""A corpus pipeline of five stages over the documents table.

Each stage works on all rows its predecessor kept and returns the columns of
documents; the last returns pieces of token sequences. Between stages the
rows are written as Parquet to the shared folder and read again."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.common import Scratch, staged, table
from tidewatch.llm.exact_dedup import dedupe
from tidewatch.llm.mixing import interleaved
from tidewatch.llm.ngram_join import representatives
from tidewatch.llm.packing import pack
from tidewatch.llm.quality_rules import passing
from tidewatch.llm.queries import RANKS


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_scratch = Scratch()


def stage(f: Stage) -> Stage:
    """A stage begins when its predecessor's result has been written: the
    tables that the predecessor staged for itself go, so that the disk holds
    those of one stage at a time."""
    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _scratch.clear()
        with _scratch:
            return f(spark, docs, sf_dir)
    return run


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the certified cutoffs reject go."""
    return passing(docs, table(spark, sf_dir, "labels"))


@stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return dedupe(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of five-word shingle sets with a similarity of 0.8
    or more, the document with the smallest doc_id stays."""
    return representatives(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, ordered by the schedule: sources interleaved at their
    target weights."""
    return interleaved(docs)


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, RANKS, added=True)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
          ("mixing sources", mix_sources), ("packing", packing)]

#: Tokenizing and the component search have no SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name.replace(" ", "-"))
    return docs
