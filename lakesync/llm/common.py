"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.session import scratch_path
from lakesync.sources import files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: a lineage cut
    that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Scratch:
    """Tables written to the shared scratch folder by one operator, deleted when
    it no longer needs them: at the latest when the ``with`` block ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[tuple[DataFrame, str]] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.free(*[df for df, _ in self.paths])

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back, until freed."""
        path = scratch_path(self.spark, "step")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((out, path))
        return out

    def free(self, *frames: DataFrame) -> None:
        for out, path in [x for x in self.paths if any(x[0] is f for f in frames)]:
            files.delete(self.spark, path)
            self.paths = [x for x in self.paths if x[0] is not out]

    def result(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back, to outlive the block."""
        return stored(df, "result")


def with_position(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """file, row (place in its Parquet file), doc_id, text and ``doc`` (the whole
    row), which identify every row however ``docs`` is read again. A frame that
    is not a plain file scan is written first."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    read = [F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")]
    try:
        return docs.select(*place, *read)
    except AnalysisException:
        return scratch.keep(docs).select(*place, *read)


def balanced(df: DataFrame) -> DataFrame:
    """Rows dealt round-robin when the input has fewer splits than the session's
    cores, so that per-row Python work uses all of them."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want * 2)


def lower_ascii(col):
    """Only A-Z lower-cased, whatever the locale."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sampled(df: DataFrame, columns: list[str], rows: int, total: int | None = None) -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if it has no more), picked by the hash
    of ``columns``; at most twice as many, whatever repeats."""
    total = df.count() if total is None else total
    if total <= rows:
        return df
    return df.where(F.xxhash64(*columns) < F.lit(hash_bound(rows, total))).limit(2 * rows)


def hash_bound(rows: int, total: int) -> int:
    """64-bit hashes below this are ``rows`` of ``total``, at any size."""
    return (rows << 64) // total - (1 << 63)
