"""Sharding by extendible hashing.

The directory is indexed by the leading bits of a document's hash. All documents
start in one bucket; only buckets over the byte limit split on another bit. The
sizes of cells of ``CELL_BITS`` bits are summed once, so splitting reads the
cells; only documents of a cell that is still too large are split one by one.

A document over the limit, and equal rows (which have one hash), cannot be
split: their shard is as deep as the hash and ``fits`` is false. Null texts
count 0 bytes; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

HASH_BITS = 60
CELL_BITS = 20
SHARD_BYTES = 1 << 20


def document_hash():
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _directory(units: DataFrame, first: int, last: int, limit: int):
    """(h, depth, prefix, shard_bytes, shard_docs) of the units (h of ``last``
    bits, bytes, docs) in buckets of ``first`` to ``last`` bits that fit, and the
    rest, which do not fit at ``last`` bits."""
    done, active = [], units
    for depth in range(first, last + 1):
        prefix = F.shiftright("h", last - depth)
        sizes = active.groupBy(prefix.alias("prefix")).agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
        seen = stored(active.withColumn("prefix", prefix).join(sizes, "prefix").withColumn("depth", F.lit(depth)), "buckets")
        done.append(seen.where(F.col("shard_bytes") <= limit).select("h", "depth", "prefix", "shard_bytes", "shard_docs"))
        over = seen.where(F.col("shard_bytes") > limit)
        active = over.select("h", "bytes", "docs")
        if not over.head(1):
            break
    fits = done[0]
    for level in done[1:]:
        fits = fits.unionByName(level)
    return fits, over.select("h", "depth", "prefix", "shard_bytes", "shard_docs")


def shard(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """doc_id, bytes and the shard (its bits as text) of every document row."""
    d = stored(docs.select("doc_id", F.col("text").cast("string").alias("text")).select(
        "doc_id", document_hash().alias("h60"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")), "hashes")
    d = d.withColumn("cell", F.shiftright("h60", HASH_BITS - CELL_BITS))
    cells = stored(d.groupBy(F.col("cell").alias("h")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs")), "cells")
    fits, large = _directory(cells, 0, CELL_BITS, limit)
    shards = d.join(fits.withColumnRenamed("h", "cell"), "cell").withColumn("fits", F.lit(True))
    if large.head(1):
        rest = d.join(large.select(F.col("h").alias("cell")), "cell", "left_semi")
        units = rest.groupBy(F.col("h60").alias("h")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs"))
        deep, whole = _directory(units, CELL_BITS + 1, HASH_BITS, limit)
        both = deep.withColumn("fits", F.lit(True)).unionByName(whole.withColumn("fits", F.lit(False)))
        shards = shards.unionByName(rest.join(both.withColumnRenamed("h", "h60"), "h60"))
    bits = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    return shards.select("doc_id", "bytes", bits.alias("shard"), F.col("depth").cast("int").alias("depth"), "shard_bytes", "shard_docs", "fits")


ORACLE_SQL = f"""
with d as (select doc_id, coalesce(strlen(text), 0)::bigint as bytes,
                  ('0x' || substr(md5(coalesce(doc_id::varchar, '') || '|' || coalesce(text, '')), 1, {HASH_BITS // 4}))::bigint as h
           from documents),
p as (select doc_id, bytes, depth::int as depth, h >> ({HASH_BITS} - depth)::int as prefix
      from d, range(0, {HASH_BITS + 1}) r(depth)),
s as (select *, sum(bytes) over w as shard_bytes, count(*) over w as shard_docs from p window w as (partition by depth, prefix)),
t as (select *, shard_bytes <= {SHARD_BYTES} as fits,
             row_number() over (partition by doc_id order by shard_bytes > {SHARD_BYTES}, case when shard_bytes <= {SHARD_BYTES} then depth else -depth end) as n
      from s)
select doc_id, bytes, case when depth = 0 then '' else lpad(bin(prefix), depth, '0') end as shard, depth,
       shard_bytes::bigint as shard_bytes, shard_docs, fits
from t where n = 1
"""
