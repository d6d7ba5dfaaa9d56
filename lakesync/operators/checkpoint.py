"""High-water marks (AGG-1) and latest-row checkpoints (TOP-1).

Both reduce a table of any size to one row with a partial (map-side)
aggregate or a per-partition top-1, so only one value per partition ever
reaches the final task. The collected value is the only thing a job brings
to the driver; it is kept as Spark's own text rendering so that it casts
back to the column's exact type, whatever the Python time zone.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lakesync.functions.windows import typed_lit, value_text


@dataclass(frozen=True)
class Checkpoint:
    """One scalar taken from a target table."""

    column: str
    dtype: DataType
    text: str
    value: object

    def lit(self) -> Column:
        return typed_lit(self.text, self.dtype)


def max_value_frame(df: DataFrame, column: str, alias: str = "checkpoint") -> DataFrame:
    """AGG-1 as a lazy one-row frame: ``max(column)``; NULL on an empty table."""
    return df.agg(F.max(F.col(column)).alias(alias))


def latest_value_frame(df: DataFrame, value_col: str, order_col: str | None = None,
                       alias: str = "checkpoint") -> DataFrame:
    """TOP-1 as a lazy frame: ``value_col`` of the row with the greatest ``order_col``.

    ``order_col`` defaults to ``value_col`` (E4). Ties on the order column go
    to the greatest value (E5) and NULL order values come last, so the answer
    is deterministic. Plans as ``TakeOrderedAndProject(limit=1)``: one row per
    partition is merged. Empty input gives zero rows.
    """
    order_col = order_col or value_col
    return (df.select(F.col(value_col).alias(alias), F.col(order_col).alias("__order"))
            .orderBy(F.col("__order").desc_nulls_last(), F.col(alias).desc_nulls_last())
            .limit(1)
            .select(alias))


def _collect(frame: DataFrame, source: DataFrame, column: str) -> Checkpoint | None:
    alias = frame.columns[0]
    dtype = source.schema[column].dataType
    rows = frame.select(F.col(alias).alias("v"), value_text(F.col(alias), dtype).alias("t")).collect()
    if not rows or rows[0]["v"] is None:
        return None
    return Checkpoint(column, dtype, rows[0]["t"], rows[0]["v"])


def high_water_mark(df: DataFrame, column: str) -> Checkpoint | None:
    """AGG-1 collected: ``None`` when the table is empty or the column all NULL."""
    return _collect(max_value_frame(df, column), df, column)


def latest_checkpoint(df: DataFrame, value_col: str, order_col: str | None = None) -> Checkpoint | None:
    """TOP-1 collected: ``None`` for an empty table (E3) instead of an IndexError.

    When the order column is the value column this is exactly ``max`` and is
    planned as one (a partial hash aggregate).
    """
    if order_col is None or order_col == value_col:
        return high_water_mark(df, value_col)
    return _collect(latest_value_frame(df, value_col, order_col), df, value_col)


def latest_row(df: DataFrame, columns: Sequence[str]) -> list[Checkpoint] | None:
    """The greatest row by ``columns`` in order, as one checkpoint per column:
    the end of a key-set load. Rows with a NULL among them do not count; ``None``
    if there are no others. One aggregate with a partial step."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    top = df.filter(known).agg(F.max(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])).alias("m"))
    row = top.select(*[x for i, c in enumerate(columns) for x in (
        F.col(f"m.c{i}").alias(f"v{i}"), value_text(F.col(f"m.c{i}"), schema[c]).alias(f"t{i}"))]).first()
    if row["t0"] is None:
        return None
    return [Checkpoint(c, schema[c], row[f"t{i}"], row[f"v{i}"]) for i, c in enumerate(columns)]
