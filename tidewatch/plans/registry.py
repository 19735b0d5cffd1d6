"""Registry of named queries: each is a Spark plan over the input tables plus
an independent DuckDB SQL oracle over the same Parquet tables.

Doubles are rounded to ``DIGITS`` places on both sides before comparison
(sums of doubles depend on partition order; adding 0.0 turns -0.0 into 0.0), so every registration declares
its double columns; ``tests/test_registry.py`` keeps that list in sync with
the Spark schema.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefns import latest
from ..sources import fixtures

DIGITS = 6


@dataclass
class Entry:
    name: str
    build: Callable[["Inputs"], DataFrame]
    sql: str | None
    floats: tuple[str, ...] = ()
    ctes: str | None = None


REGISTRY: dict[str, Entry] = {}
_AS_OF: dict[tuple[str, str, str], object] = {}


def query(name: str, sql: str | None, floats: tuple[str, ...] = (), ctes: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, tuple(floats), ctes)
        return fn
    return deco


class Inputs:
    """Lazily built views of one input folder (one Spark plan each)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def players(self) -> DataFrame:
        return fixtures.player_tracking(self.spark, self.sf_dir)

    @cached_property
    def reviews(self) -> DataFrame:
        return fixtures.review_tracking(self.spark, self.sf_dir)

    @cached_property
    def reviews_flag(self) -> DataFrame:
        """With ``has_text``, without the texts."""
        return fixtures.review_tracking(self.spark, self.sf_dir, "flag")

    @cached_property
    def reviews_key(self) -> DataFrame:
        """With ``text_key``, to fetch the texts of a few rows later."""
        return fixtures.review_tracking(self.spark, self.sf_dir, "key")

    @cached_property
    def reviews_text(self) -> DataFrame:
        return fixtures.review_tracking(self.spark, self.sf_dir, "whole")

    @cached_property
    def config(self) -> DataFrame:
        return fixtures.tracking_config(self.spark, self.sf_dir)

    @cached_property
    def prices(self) -> DataFrame:
        return fixtures.price_tracking(self.spark, self.sf_dir)

    @cached_property
    def registry(self) -> DataFrame:
        return fixtures.game_registry(self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    @cached_property
    def review_as_of(self):
        """``NOW()`` for review queries: newest processed time, resolved once to
        a literal so that window predicates are pushed into the scan."""
        return self._as_of("reviews", "processed_timestamp")

    @cached_property
    def player_as_of(self):
        return self._as_of("players", "timestamp")

    @cached_property
    def event_as_of(self):
        """Newest event of any kind (the anchor of multi-table checks)."""
        return self._as_of("events", "ts")

    def _as_of(self, of: str, column: str):
        """Once per session and input folder, not per query."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, of)
        if key not in _AS_OF:
            _AS_OF[key] = latest(self.table(of) if of == "events" else getattr(self, of), column)
        return _AS_OF[key]


def normalise(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = [(F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = REGISTRY[name]
    return normalise(entry.build(Inputs(spark, sf_dir)))


def oracle(name: str) -> str | None:
    entry = REGISTRY[name]
    if entry.sql is None:
        return None
    from .oracle_views import wrap
    return wrap(entry.sql, entry.floats, DIGITS, entry.ctes)
