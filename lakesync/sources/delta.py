"""Delta Lake tables, when the ``delta-spark`` package and jars are present.

The same methods as :class:`lakesync.sources.lake.LakeTable`, delegated to
Delta's own MERGE, OPTIMIZE and VACUUM. Delta is not installed in this
environment, so this module is import-guarded and untested here.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakesync.operators import checkpoint as _cp
from lakesync.operators.upsert import prepare_source, version_col
from lakesync.sources.lake import TableNotFound

RETENTION_CHECK = "spark.databricks.delta.retentionDurationCheck.enabled"

try:  # pragma: no cover - depends on optional package
    from delta.tables import DeltaTable

    HAVE_DELTA = True
except ImportError:  # pragma: no cover
    DeltaTable = None
    HAVE_DELTA = False


def _cond(keys: Sequence[str]) -> str:
    return " AND ".join(f"target.{k} = source.{k}" for k in keys)


class DeltaTableSink:  # pragma: no cover - needs delta-spark
    def __init__(self, spark: SparkSession, path: str):
        if not HAVE_DELTA:
            raise ImportError("delta-spark is not installed")
        self.spark = spark
        self.path = path

    def exists(self) -> bool:
        return DeltaTable.isDeltaTable(self.spark, self.path)

    def read(self) -> DataFrame:
        if not self.exists():
            raise TableNotFound(self.path)
        return self.spark.read.format("delta").load(self.path)

    def read_or_none(self) -> DataFrame | None:
        return self.read() if self.exists() else None

    def schema(self):
        return self.read().schema

    def max_value(self, column: str):
        return _cp.high_water_mark(self.read(), column)

    def latest_value(self, value_col: str, order_col: str | None = None):
        df = self.read_or_none()
        return None if df is None else _cp.latest_checkpoint(df, value_col, order_col)

    def append(self, df: DataFrame) -> None:
        df.write.format("delta").option("mergeSchema", "true").mode("append").save(self.path)

    def overwrite(self, df: DataFrame, merge_schema: bool = True) -> None:
        opt = "mergeSchema" if merge_schema else "overwriteSchema"
        df.write.format("delta").option(opt, "true").mode("overwrite").save(self.path)

    def replace(self, df: DataFrame) -> None:
        self.overwrite(df, merge_schema=False)

    def truncate_load(self, df: DataFrame) -> None:
        df.write.format("delta").mode("overwrite").save(self.path)

    def merge(self, source: DataFrame, keys: Sequence[str] | str, on_duplicate: str = "error",
              order_col: str | None = None, **_) -> str:
        """As :meth:`LakeTable.merge`: repeated source keys raise or give way to
        the latest, and an older version never replaces a newer one."""
        keys = [keys] if isinstance(keys, str) else list(keys)
        target = self.read()
        source, _summary = prepare_source(target, source, keys, on_duplicate, order_col)
        version = version_col(target, on_duplicate, order_col)
        newer = f"target.{version} IS NULL OR source.{version} >= target.{version}" if version else None
        (DeltaTable.forPath(self.spark, self.path).alias("target")
         .merge(source.alias("source"), _cond(keys))
         .whenMatchedUpdateAll(condition=newer).whenNotMatchedInsertAll().execute())
        return "merge"

    def insert_missing(self, source: DataFrame, keys: Sequence[str] | str) -> None:
        keys = [keys] if isinstance(keys, str) else list(keys)
        (DeltaTable.forPath(self.spark, self.path).alias("target")
         .merge(source.alias("source"), _cond(keys)).whenNotMatchedInsertAll().execute())

    def compact(self) -> None:
        DeltaTable.forPath(self.spark, self.path).optimize().executeCompaction()

    def vacuum(self, retention_hours: float, retention_check: bool = False) -> None:
        """The reference's maintenance job switches Delta's retention check off."""
        self.spark.conf.set(RETENTION_CHECK, str(retention_check).lower())
        DeltaTable.forPath(self.spark, self.path).vacuum(retention_hours)
