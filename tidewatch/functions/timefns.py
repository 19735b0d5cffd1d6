"""Time helpers: the ``as_of`` anchor that replaces ``NOW()``, interval
arithmetic, PostgreSQL-compatible date parts.

``as_of`` may be a Python ``datetime`` (becomes a constant-folded literal, so
window predicates reach the Parquet scan as ``PushedFilters``), a ``Column``,
or ``None`` (``current_timestamp()`` as naive UTC).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ts_literal(value: _dt.datetime) -> Column:
    """A naive-UTC ``timestamp_ntz`` literal."""
    if value.tzinfo is not None:
        value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value).cast("timestamp_ntz")


def anchor(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        return ts_literal(as_of)
    raise TypeError(f"as_of must be datetime, Column or None, got {type(as_of)!r}")


def minus(as_of, hours: float = 0, days: float = 0) -> Column:
    """``NOW() - INTERVAL 'n hours'`` / ``'n days'``."""
    if isinstance(as_of, _dt.datetime):
        return ts_literal(as_of - _dt.timedelta(hours=hours, days=days))
    secs = int(round((hours + 24 * days) * 3600))
    return anchor(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(secs))


def latest(df: DataFrame, col: str) -> _dt.datetime | None:
    """Resolve an ``as_of`` from data: ``max(col)`` as one scalar (a one-row
    aggregate with partial aggregation, nothing else reaches the driver)."""
    return df.agg(F.max(col).alias("m")).first()["m"]


def trunc_ntz(unit: str, col) -> Column:
    """``DATE_TRUNC(unit, ts)`` keeping the naive timestamp type."""
    return F.date_trunc(unit, col).cast("timestamp_ntz")


def pg_dow(col) -> Column:
    """PostgreSQL ``EXTRACT(dow)``: 0 = Sunday."""
    return (F.dayofweek(col) - 1).cast("int")


def minutes_between(later, earlier) -> Column:
    """``EXTRACT(EPOCH FROM later - earlier) / 60`` as double."""
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(60_000_000.0)
