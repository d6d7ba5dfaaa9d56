"""Table maintenance: compaction (MNT-1) and retention-based vacuum (MNT-2).

Both start from the file listing, a Spark job (the ``binaryFile`` source with
its ``content`` column pruned: only paths, sizes and times are read).

Compaction reads the live small files, and only those, with an input split size
of the target: Spark packs whole files into splits by size, and every split is
one task and one new file, so small files meet without a shuffle. Files near the
target size are carried over by the commit under their own names.

Vacuum removes what the current version does not reach and that is older than
the retention: replaced files, superseded segments, and segments that a write
left without a commit (whatever it left inside).
"""

from __future__ import annotations

import datetime as _dt
import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.sources import files
from lakesync.sources.lake import SEGMENT, LakeTable, Version

DEFAULT_TARGET_FILE_BYTES = 128 * 1024 * 1024
# Shortest retention accepted while the retention check is on (Delta's default: 7 days).
MIN_RETENTION_HOURS = 168


def _epoch_seconds(as_of: _dt.datetime | None) -> float:
    """``as_of`` as an instant; naive values are UTC, ``None`` is now."""
    if as_of is None:
        return _dt.datetime.now(_dt.timezone.utc).timestamp()
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=_dt.timezone.utc)
    return as_of.timestamp()


def file_listing(table: LakeTable, version: Version | None) -> DataFrame:
    """Every data file under the table: ``path, segment, file, modification_time,
    length`` and ``live`` (``version`` holds it)."""
    listed = (table.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .load(table.path).select("path", "modificationTime", "length"))
    listed = listed.select("path", F.element_at(F.split("path", "/"), -2).alias("segment"),
                           F.substring_index("path", "/", -1).alias("file"),
                           F.col("modificationTime").alias("modification_time"), "length")
    if version is None:
        return listed.withColumn("live", F.lit(False))
    # the commit's own lists: one name per segment and per replaced file
    named = table.spark.createDataFrame([(s, gone) for s, gone in version.segments.items()], "segment string, gone array<string>")
    return listed.join(named, "segment", "left").withColumn(
        "live", F.coalesce(~F.array_contains("gone", F.col("file")), F.lit(False))) \
        .select("path", "segment", "file", "modification_time", "length", "live")


def compaction_plan(table: LakeTable, target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES) -> dict:
    """What a compaction would do: the live files under half the target size
    (``small_files``), the segments that hold no other live file (``whole``), and
    how many files the small ones fill. ``needed`` if that is fewer than there
    are. Files near the target size never trigger it."""
    version = table.current()
    if version is None:
        raise LookupError(table.path)
    small = F.col("length") < target_file_bytes // 2
    per_segment = file_listing(table, version).filter("live").groupBy("segment").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.count_if(small).alias("small"),
        F.coalesce(F.sum(F.when(small, F.col("length"))), F.lit(0)).alias("small_bytes"),
        F.collect_list(F.when(small, F.col("file"))).alias("names")).collect()  # one name per small file
    total = lambda c: sum(r[c] for r in per_segment)
    want = max(1, math.ceil(total("small_bytes") / target_file_bytes)) if total("small") else 0
    return {"version": version, "bytes": total("bytes"), "files": total("files"), "small_files": total("small"),
            "target_files": want, "needed": total("small") >= 2 and total("small") > want,
            "names": [f"{r['segment']}/{n}" for r in per_segment for n in r["names"]],
            # live files all small, or no live file left
            "whole": sorted(set(version.segments) - {r["segment"] for r in per_segment if r["files"] > r["small"]})}


def compact(table: LakeTable, target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES, force: bool = False) -> dict:
    """MNT-1: rewrite small files into files of about ``target_file_bytes``.

    The same rows (same multiset); a no-op when :func:`compaction_plan` finds
    nothing worth merging, unless ``force``.
    """
    plan = compaction_plan(table, target_file_bytes)
    if plan["small_files"] and (plan["needed"] or force):
        # a session of its own: its split size does not touch the caller's
        packing = table.spark.newSession()
        packing.conf.set("spark.sql.files.maxPartitionBytes", str(target_file_bytes))
        packing.conf.set("spark.sql.files.openCostInBytes", "0")
        packing.conf.set("spark.sql.files.minPartitionNum", "1")
        held = LakeTable(packing, table.path)
        held.replace_files(plan["version"], plan["names"], held.files_of(plan["version"], plan["names"]), plan["whole"])
    return plan


def vacuum_plan(table: LakeTable, retention_hours: float, as_of: _dt.datetime | None = None,
                retention_check: bool = True) -> DataFrame:
    """MNT-2 plan: files that the current version does not hold and that were
    last modified more than ``retention_hours`` before ``as_of`` (default now)
    are removable, those of uncommitted writes included.

    With ``retention_check`` (default) retention below ``MIN_RETENTION_HOURS`` is
    refused, as Delta does; the reference's maintenance job switches that check
    off, and then any ``retention_hours >= 0`` is accepted.
    """
    limit = _limit(retention_hours, as_of, retention_check)
    listing = file_listing(table, table.current())
    return listing.withColumn("removable", ~F.col("live") & (F.col("modification_time") < F.timestamp_seconds(F.lit(limit))))


def _limit(retention_hours: float, as_of: _dt.datetime | None, retention_check: bool) -> float:
    if retention_hours < 0:
        raise ValueError("retention_hours must be >= 0")
    if retention_check and retention_hours < MIN_RETENTION_HOURS:
        raise ValueError(f"retention_hours {retention_hours} < {MIN_RETENTION_HOURS}; "
                         f"pass retention_check=False to allow it")
    return _epoch_seconds(as_of) - float(retention_hours) * 3600.0


def vacuum(table: LakeTable, retention_hours: float, as_of: _dt.datetime | None = None,
           dry_run: bool = False, retention_check: bool = True) -> list[str]:
    """MNT-2 apply. A segment outside the current version goes as a directory
    when nothing in it is younger than the retention; replaced files of live
    segments go one by one. Returns what was deleted (or would be)."""
    limit = _limit(retention_hours, as_of, retention_check)
    plan = vacuum_plan(table, retention_hours, as_of, retention_check)
    version = table.current()
    live = set(version.segments) if version else set()
    kept = {r["segment"] for r in plan.filter(~F.col("removable")).select("segment").distinct().collect()}  # segments
    doomed = [path for name, path, modified in files.child_dirs(table.spark, table.path)
              if name.startswith(SEGMENT) and name not in live | kept and modified / 1000 < limit]
    # replaced files first: the plan reads the listing, and they come one by one
    single = plan.filter(F.col("removable") & F.col("segment").isin(sorted(live))).select("path")
    removed = []
    for path in itertools.chain((r["path"] for r in single.toLocalIterator()), doomed):
        removed.append(path)
        if not dry_run:
            files.delete(table.spark, path)
    return removed
