"""Lake tables (SRC-1, SRC-5..7, SNK-1, SNK-2, DML-1..3).

A table is a directory of Parquet segments and numbered commits:

    <path>/segment-<id>/part-*.parquet   the files of one Spark write
    <path>/_commits/<n>.json             the table's n-th version

A commit names the segments that make up the table, the files of each that no
longer count, and the table's schema. Every write goes to a segment of its own
and becomes visible when its commit file is created, all of it or nothing: a job
that ends before leaves the table as it was, and :func:`vacuum
<lakesync.operators.maintenance.vacuum>` frees what it wrote. A table is thus
never overwritten while it is read. Creating a commit that another writer has
created meanwhile raises :class:`CommitConflict`; nothing of the later write is
visible then. A commit holds one name per segment and per replaced file;
compaction folds both.

``merge`` rewrites only the files that hold a changed row: their updated rows go
to a new segment, together with the new rows. ``append`` and ``insert_missing``
write only the new rows. With Delta Lake installed,
:class:`lakesync.sources.delta.DeltaTableSink` offers the same methods on Delta.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid
from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lakesync.functions.windows import run_date_suffix
from lakesync.operators import checkpoint as _cp
from lakesync.operators.upsert import (
    CHANGED,
    DEFAULT_BROADCAST_KEYS,
    FILE,
    align_to,
    insert_missing,
    match_files,
    prepare_source,
    same_type,
    shuffled,
    updated_rows,
    version_col,
)
from lakesync.sources import files

SEGMENT = "segment-"
COMMITS = "_commits"
_COMMIT_RE = re.compile(r"^(\d+)\.json$")


class TableNotFound(LookupError):
    """The table location holds no committed version (SRC-7 "path not found")."""


class CommitConflict(RuntimeError):
    """Another writer committed between this writer's read and its commit."""


@dataclass(frozen=True)
class Version:
    """The ``n``-th version: per segment the names of its files that are not
    part of it, and the schema."""

    n: int
    segments: dict[str, list[str]]
    schema: StructType

    @property
    def replaced(self) -> list[str]:
        return [name for names in self.segments.values() for name in names]


def table_path(root: str, data_source: str, source: str, table: str,
               run_date: _dt.date | _dt.datetime | str | None = None) -> str:
    """SRC-5 / SRC-6: ``root/data_source/source/table`` or, per day,
    ``root/data_source/source_daily/table_YYYY-MM-DD`` (explicit ``run_date``)."""
    root = root.rstrip("/")
    if run_date is None:
        return f"{root}/{data_source}/{source}/{table}"
    return f"{root}/{data_source}/{source}_daily/{table}_{run_date_suffix(run_date)}"


def union_schema(old: StructType, new: StructType) -> StructType:
    """Schema merge: old fields in order, then new-only fields. Names that
    differ only in case are one column, as in Spark's name resolution, and keep
    the old spelling. Types must agree."""
    fields = list(old.fields)
    names = {f.name.lower(): f for f in old.fields}
    for f in new.fields:
        known = names.get(f.name.lower())
        if known is None:
            fields.append(StructField(f.name, f.dataType, True))
        elif not same_type(known.dataType, f.dataType):
            raise TypeError(f"column {f.name!r}: {known.dataType.simpleString()} vs {f.dataType.simpleString()}")
    return StructType(fields)


def spelled(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with its columns spelled as in ``schema``."""
    names = {f.name.lower(): f.name for f in schema.fields}
    return df.toDF(*[names.get(c.lower(), c) for c in df.columns])


class LakeTable:
    """A versioned Parquet table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # ---- versions -----------------------------------------------------
    def _commit_numbers(self) -> list[int]:
        names = files.child_files(self.spark, f"{self.path}/{COMMITS}")
        return sorted(int(m.group(1)) for m in map(_COMMIT_RE.match, names) if m)

    def _load(self, n: int) -> Version | None:
        """Version ``n``; ``None`` for a commit file that was not written to its end."""
        try:
            doc = json.loads(files.read_text(self.spark, f"{self.path}/{COMMITS}/{n:020d}.json"))
        except ValueError:
            return None
        return Version(n, doc["segments"], StructType.fromJson(doc["schema"]))

    def versions(self) -> list[int]:
        """Numbers of the committed versions, ascending."""
        return [n for n in self._commit_numbers() if self._load(n) is not None]

    def current(self) -> Version | None:
        for n in reversed(self._commit_numbers()):
            version = self._load(n)
            if version is not None:
                return version
        return None

    def _required(self) -> Version:
        version = self.current()
        if version is None:
            raise TableNotFound(self.path)
        return version

    def exists(self) -> bool:
        return self.current() is not None

    def _commit(self, base: Version | None, segments: dict[str, list[str]], schema: StructType) -> Version:
        """Make ``segments`` the table, on top of ``base`` (the version read)."""
        numbers = self._commit_numbers()
        seen = self.current()
        n = (numbers[-1] + 1) if numbers else 0
        text = json.dumps({"segments": segments, "schema": schema.jsonValue()})
        unchanged = (seen is None and base is None) or (seen is not None and base is not None and seen.n == base.n)
        if not unchanged or not files.write_new(self.spark, f"{self.path}/{COMMITS}/{n:020d}.json", text):
            raise CommitConflict(f"{self.path}: another writer committed meanwhile")
        return Version(n, segments, schema)

    def write_segment(self, df: DataFrame) -> str:
        """Write ``df`` as a segment that no commit names yet; returns its name."""
        name = f"{SEGMENT}{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{self.path}/{name}")
        return name

    # ---- reads --------------------------------------------------------
    def frame(self, version: Version, keep: Column | None = None) -> DataFrame:
        """The rows of ``version`` with their file (``segment/file``) in ``__file``;
        ``keep`` is a condition on ``_metadata``, which prunes files when listed."""
        rows = self.spark.read.schema(version.schema).parquet(*[f"{self.path}/{s}" for s in version.segments])
        if version.replaced:
            rows = rows.filter(~F.col("_metadata.file_name").isin(version.replaced))
        if keep is not None:
            rows = rows.filter(keep)
        return rows.withColumn(FILE, F.substring_index("_metadata.file_path", "/", -2))

    def files_of(self, version: Version, names: Iterable[str]) -> DataFrame:
        """The rows of the files ``names`` (``segment/file``); no other file is read."""
        return self.frame(version, F.col("_metadata.file_name").isin([n.rpartition("/")[2] for n in names])).drop(FILE)

    def read(self) -> DataFrame:
        """SRC-1: the current version."""
        return self.frame(self._required()).drop(FILE)

    def read_or_none(self) -> DataFrame | None:
        """SRC-7: ``None`` only when the table does not exist."""
        version = self.current()
        return None if version is None else self.frame(version).drop(FILE)

    def schema(self) -> StructType:
        return self._required().schema

    def max_value(self, column: str) -> _cp.Checkpoint | None:
        """AGG-1 on this table (raises :class:`TableNotFound` if missing, E13)."""
        return _cp.high_water_mark(self.read(), column)

    def latest_value(self, value_col: str, order_col: str | None = None) -> _cp.Checkpoint | None:
        """TOP-1 on this table; ``None`` if missing or empty (E3)."""
        df = self.read_or_none()
        return None if df is None else _cp.latest_checkpoint(df, value_col, order_col)

    def latest_row(self, columns: Sequence[str]) -> list[_cp.Checkpoint] | None:
        """The lexicographically greatest values of ``columns`` (none NULL);
        ``None`` if the table is missing or has no such row."""
        df = self.read_or_none()
        return None if df is None else _cp.latest_row(df, columns)

    # ---- writes -------------------------------------------------------
    def _replace_all(self, base: Version | None, df: DataFrame) -> None:
        self._commit(base, {self.write_segment(df): []}, df.schema)

    def append(self, df: DataFrame) -> None:
        """SNK-1: add rows; new columns are added (schema merge), existing
        columns must keep their type. Creates the table if missing."""
        base = self.current()
        if base is None:
            self._replace_all(base, df)
            return
        merged = union_schema(base.schema, df.schema)
        self._commit(base, {**base.segments, self.write_segment(spelled(df, merged)): []}, merged)

    def overwrite(self, df: DataFrame, merge_schema: bool = True) -> None:
        """SNK-2: contents become ``df``. With ``merge_schema`` the schema is
        the union of old and new (old-only columns read as NULL); without it
        the table takes ``df``'s schema (drop + create, SNK-3 semantics)."""
        base = self.current()
        if merge_schema and base is not None:
            merged = union_schema(base.schema, df.schema)
            df = align_to(spelled(df, merged), merged, strict=False)
        self._replace_all(base, df)

    def replace(self, df: DataFrame) -> None:
        """Staging replace (SNK-3 semantics): drop and recreate from ``df``."""
        self.overwrite(df, merge_schema=False)

    def truncate_load(self, df: DataFrame) -> None:
        """SNK-4/5 semantics: keep the table's schema, replace its rows.

        Columns are checked before anything is removed (E10); the old version
        stays current until the new one is committed, so a failing source leaves
        the table as it was."""
        base = self._required()
        df = spelled(df, base.schema)
        extra = [c for c in df.columns if c not in base.schema.fieldNames()]
        if extra:
            raise ValueError(f"table {self.path} has no columns {extra}")
        self._replace_all(base, align_to(df, base.schema, strict=False))

    def replace_files(self, base: Version, names: Iterable[str], rows: DataFrame, whole: Iterable[str] = ()) -> Version:
        """Commit ``rows`` in place of the files ``names`` of ``base`` (each as
        ``segment/file``) and of the segments ``whole``."""
        segments = {s: list(gone) for s, gone in base.segments.items() if s not in set(whole)}
        for name in sorted(names):
            segment, _, file = name.rpartition("/")
            if segment in segments:
                segments[segment].append(file)
        return self._commit(base, {**segments, self.write_segment(rows): []}, base.schema)

    def merge(self, source: DataFrame, keys: str | Sequence[str], on_duplicate: str = "error",
              order_col: str | None = None, broadcast_keys: int | None = DEFAULT_BROADCAST_KEYS) -> str:
        """DML-1/DML-2: upsert ``source`` on ``keys`` (see :mod:`lakesync.operators.upsert`).

        One scan of the target's key range finds the files that hold a row to
        change, and the keys that are there. Only those files are read again and
        replaced; source rows with other keys are new. Nothing to change: the new
        rows are appended (re-read boundary rows cost nothing). Returns
        ``"append"`` or ``"rewrite"``.
        """
        keys = [keys] if isinstance(keys, str) else list(keys)
        base = self._required()
        target = self.frame(base)
        # The prepared source is read up to four times (key summary, match,
        # updates, new rows); it is cached for this call only and recomputed if lost.
        incoming, summary = prepare_source(target.drop(FILE), spelled(source, base.schema), keys, on_duplicate, order_col, persist=True)
        fit = summary.fit(broadcast_keys)
        version = version_col(target, on_duplicate, order_col)
        matched = match_files(target, incoming, keys, summary, fit, version).persist()
        try:
            # one name per file to rewrite
            touched = {r[FILE] for r in matched.filter(CHANGED).select(FILE).distinct().collect()}
            present = matched.select(*keys).distinct()
            fresh = incoming.join(F.broadcast(present) if fit.keys else shuffled(present), on=keys, how="left_anti")
            if not touched:
                self._commit(base, {**base.segments, self.write_segment(fresh): []}, base.schema)
                return "append"
            rows = updated_rows(self.files_of(base, touched), incoming, keys, fit, version)
            self.replace_files(base, touched, rows.unionByName(fresh))
            return "rewrite"
        finally:
            matched.unpersist()
            incoming.unpersist()

    def insert_missing(self, source: DataFrame, keys: str | Sequence[str]) -> None:
        """DML-2 for key-only tables: append the pairs not yet present."""
        base = self._required()
        # Read twice (key summary, append): cached for this call only.
        source = source.persist()
        try:
            fresh = insert_missing(self.frame(base).drop(FILE), source, keys)
            self._commit(base, {**base.segments, self.write_segment(fresh): []}, base.schema)
        finally:
            source.unpersist()
