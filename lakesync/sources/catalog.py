"""Tables of the session catalog, ``namespace.table`` (SNK-3, SNK-4, SNK-5).

The staging and mart side of the jobs on Spark's own catalog: namespaces keep
two tables of one name apart, ``truncate_load`` empties and refills a table whose
definition (columns, comments, properties) stays, ``replace`` drops and creates.
Data is inserted by column name, never by position. Data files lie in the
namespace's location or the warehouse folder, which must be shared.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from lakesync.operators import checkpoint as _cp
from lakesync.operators.upsert import align_to
from lakesync.session import staged
from lakesync.sources.lake import TableNotFound, spelled

_PART = re.compile(r"^\w+$")


def _quoted(name: str) -> str:
    parts = name.split(".")
    if not all(_PART.match(p) for p in parts):
        raise ValueError(f"not a plain identifier: {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``, at ``location`` if given."""
    at = "" if location is None else " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(name)}{at}")


class CatalogTable:
    """``[namespace.]table`` in the session catalog."""

    def __init__(self, spark: SparkSession, table: str, schema: str | None = None):
        self.spark = spark
        self.name = _quoted(f"{schema}.{table}" if schema else table)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        if not self.exists():
            raise TableNotFound(self.name)
        return self.spark.table(self.name)

    def read_or_none(self) -> DataFrame | None:
        return self.read() if self.exists() else None

    def schema(self):
        return self.read().schema

    def max_value(self, column: str) -> _cp.Checkpoint | None:
        """AGG-1 (a missing table raises, E13)."""
        return _cp.high_water_mark(self.read(), column)

    def latest_value(self, value_col: str, order_col: str | None = None) -> _cp.Checkpoint | None:
        df = self.read_or_none()
        return None if df is None else _cp.latest_checkpoint(df, value_col, order_col)

    def _aligned(self, df: DataFrame) -> DataFrame:
        """``df`` by the table's column names and types; missing columns are NULL."""
        schema = self.schema()
        df = spelled(df, schema)
        extra = [c for c in df.columns if c not in schema.fieldNames()]
        if extra:
            raise ValueError(f"table {self.name} has no columns {extra}")
        return align_to(df, schema, strict=False)

    def append(self, df: DataFrame) -> None:
        """Add rows by column name; creates the table if missing."""
        if self.exists():
            self._aligned(df).write.insertInto(self.name)
        else:
            df.write.format("parquet").saveAsTable(self.name)

    def replace(self, df: DataFrame) -> None:
        """SNK-3: drop and create from ``df``, which is materialised first, so it
        may read the table itself and a failing source leaves the old one."""
        staged(df).write.format("parquet").mode("overwrite").saveAsTable(self.name)

    def truncate_load(self, df: DataFrame) -> None:
        """SNK-4/SNK-5: keep the table's definition, replace all rows. Columns are
        checked and the source materialised before anything is removed (E10)."""
        ready = staged(self._aligned(df))
        self.spark.sql(f"TRUNCATE TABLE {self.name}")
        ready.write.insertInto(self.name)
