"""JOB-1 as a Structured Streaming query.

The reference polls its source table with a checkpoint and a row bound. When
the source arrives as files (an export or change feed landing in a folder),
the same job is a file stream: Spark's own streaming checkpoint replaces the
high-water mark, ``maxFilesPerTrigger`` replaces the ``LIMIT`` as the bound
per micro-batch, and ``foreachBatch`` applies the idempotent upsert, so a
micro-batch replayed after a failure leaves the same table. With
``availableNow`` the query drains what is there and stops, as a scheduled
batch job would.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakesync.operators.upsert import assert_unique_keys, latest_per_key
from lakesync.sources.lake import LakeTable


def _apply(target: LakeTable, keys: Sequence[str], order_col: str | None):
    def apply(batch: DataFrame, epoch_id: int) -> None:
        # The micro-batch is read once: the merge caches its prepared
        # (de-duplicated, aligned) form for the key check, change detection
        # and write. A lost executor only means re-reading the batch's files.
        if target.exists():
            if order_col:
                target.merge(batch, list(keys), on_duplicate="latest", order_col=order_col)
            else:
                target.merge(batch, list(keys))
        elif order_col:
            target.append(latest_per_key(batch, list(keys), order_col))
        else:
            assert_unique_keys(batch, list(keys))
            target.append(batch)
    return apply


def stream_incremental_load(spark: SparkSession, source_dir: str, schema: StructType, target: LakeTable,
                            keys: Sequence[str] = ("id",), checkpoint_location: str | None = None,
                            max_files_per_trigger: int = 100, order_col: str | None = None,
                            wait: bool = True):
    """Upsert every new Parquet file of ``source_dir`` into ``target``.

    ``order_col`` (optional) keeps the latest row per key when one
    micro-batch, the first included, holds several versions of a row; without
    it such a batch raises. Across micro-batches, too, an older version never
    replaces a newer one; without ``order_col`` the later batch wins. The streaming checkpoint
    defaults to ``<target>/_stream_checkpoint`` on the target's shared
    storage. Returns the (finished, when ``wait``) ``StreamingQuery``.
    """
    location = checkpoint_location or f"{target.path}/_stream_checkpoint"
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))
    query = (stream.writeStream
             .foreachBatch(_apply(target, keys, order_col))
             .option("checkpointLocation", location)
             .trigger(availableNow=True)
             .start())
    if wait:
        query.awaitTermination()
    return query
