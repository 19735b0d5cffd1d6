"""Retention (G3-G5): the surviving rows after the reference's DELETEs.

A DELETE becomes the complement filter; rows for which the delete predicate
is NULL (e.g. a NULL timestamp) are kept, as in SQL. When the table is
partitioned by date, the same predicate prunes whole partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import minus


def _keep_unless(df: DataFrame, delete_when) -> DataFrame:
    return df.filter(~F.coalesce(delete_when, F.lit(False)))


def retention_player(players: DataFrame, as_of=None, days: float = 14) -> DataFrame:
    """Drop readings older than ``days``."""
    return _keep_unless(players, F.col("timestamp") < minus(as_of, days=days))


def retention_unlabelled(reviews: DataFrame, as_of=None, days: float = 7) -> DataFrame:
    """Drop unlabelled reviews written more than ``days`` ago."""
    return _keep_unless(reviews, F.col("sentiment_label").isNull()
                        & (F.col("review_timestamp") < minus(as_of, days=days)))


def retention_labelled(reviews: DataFrame, as_of=None, days: float = 7) -> DataFrame:
    """Drop labelled reviews processed more than ``days`` ago."""
    return _keep_unless(reviews, (F.col("processed_timestamp") < minus(as_of, days=days))
                        & F.col("sentiment_label").isNotNull())
