"""Checkpoint and time-window predicates (FLT-1..4, FN-1..6).

Every bound is a typed literal (or a Spark expression such as
``current_date()``), never text spliced into SQL, so that Catalyst folds it
to a constant and the Parquet scan shows it under ``PushedFilters``.
Predicates follow SQL three-valued logic: a row whose column is NULL never
passes.
"""

from __future__ import annotations

import datetime as _dt
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampType

Bound = Union[Column, str, _dt.date, _dt.datetime, int, float, None]


def literal_text(value) -> str:
    """Render a Python value as text that Spark casts back without loss."""
    if isinstance(value, _dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, _dt.date):
        return value.isoformat()
    return str(value)


# Text form of a session-time-zone timestamp that names its UTC offset, so
# that casting it back gives the same instant even in a repeated DST hour.
LTZ_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def value_text(c: Column, dtype: DataType) -> Column:
    """Text that :func:`typed_lit` turns back into exactly the same value."""
    if isinstance(dtype, TimestampType):
        return F.date_format(c, LTZ_TEXT_FORMAT)
    return c.cast("string")


def typed_lit(value: Bound, dtype: DataType | str) -> Column:
    """A literal of exactly ``dtype`` (no implicit cast of the column side)."""
    if isinstance(value, Column):
        return value.cast(dtype)
    if value is None:
        return F.lit(None).cast(dtype)
    return F.lit(literal_text(value)).cast(dtype)


def column_type(df: DataFrame, column: str) -> DataType:
    return df.schema[column].dataType


def _bound(df: DataFrame, column: str, value: Bound) -> Column:
    return typed_lit(value, column_type(df, column))


def _as_of_timestamp(df: DataFrame, column: str, as_of: Bound) -> Column:
    """``as_of`` as a value of the column's type; ``None`` means now (FN-2)."""
    if as_of is None:
        return F.current_timestamp().cast(column_type(df, column))
    return _bound(df, column, as_of)


def _as_of_date(as_of: Bound) -> Column:
    """The calendar day of ``as_of``; ``None`` means today (FN-1)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return F.to_date(as_of)
    return F.to_date(F.lit(literal_text(as_of)))


def since(df: DataFrame, column: str, checkpoint: Bound) -> Column:
    """FLT-1/FLT-2: inclusive ``column >= checkpoint`` (boundary rows re-read, E1)."""
    return F.col(column) >= _bound(df, column, checkpoint)


def between_half_open(df: DataFrame, column: str, start: Bound, end: Bound) -> Column:
    """``start <= column < end``; a bound of ``None`` is open, a NULL column never passes."""
    cond = F.col(column).isNotNull()
    if start is not None:
        cond = cond & (F.col(column) >= _bound(df, column, start))
    if end is not None:
        cond = cond & (F.col(column) < _bound(df, column, end))
    return cond


def previous_day(df: DataFrame, column: str, as_of: Bound = None) -> Column:
    """FLT-3: ``[as_of day - 1 day, as_of day)`` (FN-1, FN-3).

    The bounds are midnights, cast to the column's type, as PostgreSQL's
    ``CURRENT_DATE - INTERVAL '1 day'`` would be.
    """
    day = _as_of_date(as_of)
    dtype = column_type(df, column)
    start = F.date_sub(day, 1).cast(dtype)
    end = day.cast(dtype)
    return (F.col(column) >= start) & (F.col(column) < end)


def lagged_range(df: DataFrame, column: str, start: Bound, as_of: Bound = None,
                 lag: str = "1 hour") -> Column:
    """FLT-4: ``[start, as_of - lag)``; the lag keeps in-flight rows out (FN-2, FN-3).
    A ``start`` of ``None`` is open."""
    end = _as_of_timestamp(df, column, as_of) - F.expr(f"INTERVAL {lag}")
    return between_half_open(df, column, start, end)


def run_date_suffix(run_date: _dt.date | _dt.datetime | str) -> str:
    """FN-6: the ``YYYY-MM-DD`` suffix of a per-day table (driver side, explicit date)."""
    if isinstance(run_date, str):
        return _dt.date.fromisoformat(run_date[:10]).isoformat()
    if isinstance(run_date, _dt.datetime):
        return run_date.date().isoformat()
    return run_date.isoformat()
