"""Combining one-row results without a join, and parsing texts once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame (a global aggregate) to ``df`` as a
    scalar subquery: Spark evaluates it once and inlines the value, so no
    join (and no cartesian product) is planned. ``inline`` keeps it one
    subquery, whatever the number of columns."""
    packed = one_row.select(F.struct(*one_row.columns).alias("s")).scalar()
    return df.select("*", F.inline(F.array(packed)))


def parse_once(df: DataFrame, text: str, schema, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the JSON of ``text`` as the struct ``name`` (NULL where it
    cannot be parsed). Explode of a one-element array gives each row once, and
    is a border that no projection or filter above it is merged through: what
    uses the struct's fields cannot bring copies of the parse along."""
    return df.select("*", F.explode(F.array(F.from_json(F.col(text), schema, options or {}))).alias(name))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, as the variable
    of a transform over one element: for expressions that add no row border."""
    return F.transform(F.array(value), body)[0]
