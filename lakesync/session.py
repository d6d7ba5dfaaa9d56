"""Session helpers.

The library never starts or stops a session of its own accord: jobs take the
caller's ``SparkSession``. These helpers only build a local session for tests
and the benchmark, and locate the shared folder where jobs may write scratch
tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Confs every session used with this library should carry. Timestamps are
# compared as typed literals, so the session time zone is pinned (E16).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "lakesync", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system (HDFS, object store). The
    library never invents one; tests set it when the session leaves it unset.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; lakesync needs a shared folder for "
            "materialised intermediates and scratch tables")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def ensure_checkpoint_dir(spark: SparkSession, fallback) -> str:
    """Use the session's checkpoint folder, or ``fallback`` (a path, or a
    callable returning one) only when none is set."""
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get(
            "spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(fallback() if callable(fallback) else fallback)
    return checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lakesync/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, required: bool = True) -> DataFrame:
    """Materialise ``df`` under the shared checkpoint folder and cut its lineage.

    A reliable checkpoint survives executor loss (unlike ``localCheckpoint``).
    With ``required=False`` a session without ``spark.checkpoint.dir`` gets
    ``df`` back unchanged (it is then recomputed where it is used).
    """
    try:
        checkpoint_dir(df.sparkSession)
    except RuntimeError:
        if required:
            raise
        return df
    return df.checkpoint(eager=True)
