"""Idempotent upsert (DML-1, DML-2; JOIN-2, JOIN-3) as DataFrame operators.

``MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *`` on key equality is

    (target rows, each taking the values of the source row with its key)
    UNION ALL (source rows whose key no target row has)

Semantics kept from MERGE, whatever the source's size:

* NULL keys never match: such target rows stay, such source rows are added.
* A key that the target repeats has every copy updated; none is dropped.
* Every target column must be present in the source; extra source columns
  are ignored; source values are cast to the target's types.
* Two source rows with one key raise (MERGE raises when several source rows
  match one target row). ``on_duplicate="latest"`` keeps, per key, the row
  with the greatest ``order_col`` instead, and an update then needs an
  ``order_col`` at least as great as the target row's, so an older version that
  comes late never replaces a newer one.
* Rows absent from the source are never deleted (E14).

Plan: a left join of the target with the source, and an anti-join for the new
rows. When the source is known to be small (a bounded batch) it is broadcast
after its rows and bytes are checked, so the target is scanned and never shuffled.
If only its keys are small they are broadcast, and the target rows that have one
are shuffled. Otherwise both sides shuffle on the key and AQE may split skewed keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    MapType,
    NullType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from lakesync.functions.windows import typed_lit, value_text

# Most source rows whose keys or values are broadcast (checked by counting).
DEFAULT_BROADCAST_KEYS = 2_000_000
# Most bytes of one broadcast (checked by summing): the driver collects it.
BROADCAST_BYTES = 8 << 20


class DuplicateKeyError(ValueError):
    """Several source rows share one merge key."""


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


_DATETIME = (DateType, TimestampType, TimestampNTZType)


def same_type(a: DataType, b: DataType) -> bool:
    """Equal types whatever their nested nullability (Parquet reads back nullable)."""
    return a.simpleString() == b.simpleString()


def comparable(c: Column, dtype: DataType) -> Column:
    """``c`` with every map in it as its sorted entries: maps have neither order
    nor equality in Spark, their entries have both."""
    if isinstance(dtype, MapType):
        return F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(
            comparable(e["key"], dtype.keyType).alias("key"), comparable(e["value"], dtype.valueType).alias("value"))))
    if "map<" not in dtype.simpleString():
        return c
    if isinstance(dtype, ArrayType):
        return F.transform(c, lambda e: comparable(e, dtype.elementType))
    if isinstance(dtype, StructType):
        return F.when(c.isNotNull(), F.struct(*[comparable(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]))
    return c


def assignable(src: DataType, dst: DataType) -> bool:
    """ANSI store assignment: same type, numeric to numeric, datetime to
    datetime, anything atomic to string, NULL to anything."""
    if same_type(src, dst) or isinstance(src, NullType):
        return True
    if isinstance(src, NumericType) and isinstance(dst, NumericType):
        return True
    if isinstance(src, _DATETIME) and isinstance(dst, _DATETIME):
        return True
    return isinstance(dst, StringType) and src.typeName() not in ("struct", "array", "map", "binary")


def align_to(source: DataFrame, target_schema, strict: bool = True) -> DataFrame:
    """Project ``source`` onto the target's columns and types (MERGE ``*``).

    Types follow store-assignment rules: a value that cannot be stored in the
    target column's type (e.g. text into a number) raises ``TypeError``.
    """
    missing = [f.name for f in target_schema.fields if f.name not in source.columns]
    if missing and strict:
        raise ValueError(f"source lacks target columns {missing}")
    cols = []
    src_types = {f.name: f.dataType for f in source.schema.fields}
    for f in target_schema.fields:
        if f.name in source.columns:
            if not assignable(src_types[f.name], f.dataType):
                raise TypeError(f"column {f.name!r}: cannot store {src_types[f.name].simpleString()} "
                                f"in {f.dataType.simpleString()}")
            same = same_type(src_types[f.name], f.dataType)
            cols.append(F.col(f.name) if same else F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return source.select(*cols)


def _non_null(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


class Fit(NamedTuple):
    """Whether a source has few enough rows to be compared with the target's, and
    whether its keys and its whole rows are small enough to be broadcast."""

    compared: bool
    keys: bool
    rows: bool


@dataclass(frozen=True)
class KeySummary:
    """Non-NULL-key rows of a source, the largest number sharing one key
    (``None`` when not counted per key), each key column's (min, max) as
    exact text (``None`` when there is no non-NULL key), and about how many bytes
    the keys and the whole rows take."""

    rows: int
    most: int | None
    bounds: list[tuple[str, str]] | None
    key_bytes: int
    row_bytes: int

    def fit(self, broadcast_keys: int | None) -> Fit:
        few = bool(broadcast_keys) and self.rows <= broadcast_keys
        return Fit(few, few and self.key_bytes <= BROADCAST_BYTES, few and self.row_bytes <= BROADCAST_BYTES)


def row_width(schema, columns: Sequence[str]) -> Column:
    """About the bytes of a row's ``columns`` in memory: 8 for each and 8 for the
    row, and what text, binary and nested values hold besides."""
    width = F.lit(8 * (len(columns) + 1)).cast("long")
    for f in schema.fields:
        if f.name in columns and not isinstance(f.dataType, (NumericType, BooleanType, NullType, *_DATETIME)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
    return width


def summarize_keys(source: DataFrame, keys: str | Sequence[str], per_key: bool = True) -> KeySummary:
    """One job: row count, per-key multiplicity (with ``per_key``), key range and
    bytes. Per-key counts are a partial (map-side) aggregate."""
    keys = _keys(keys)
    types = {f.name: f.dataType for f in source.schema.fields}
    base = source.filter(_non_null(keys)).select(
        *keys, row_width(source.schema, keys).alias("__key_bytes"), row_width(source.schema, source.columns).alias("__row_bytes"))
    sizes = [F.sum(c).alias(c) for c in ("__key_bytes", "__row_bytes")]
    if per_key:
        base = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), *sizes)
        aggs = [F.sum("count").alias("rows"), F.max("count").alias("most"), *sizes]
    else:
        aggs = [F.count(F.lit(1)).alias("rows"), F.lit(None).cast("long").alias("most"), *sizes]
    for i, k in enumerate(keys):
        aggs += [value_text(F.min(k), types[k]).alias(f"lo{i}"), value_text(F.max(k), types[k]).alias(f"hi{i}")]
    row = base.agg(*aggs).first()
    rows = int(row["rows"] or 0)
    bounds = [(row[f"lo{i}"], row[f"hi{i}"]) for i in range(len(keys))] if rows else None
    return KeySummary(rows, None if row["most"] is None else int(row["most"]), bounds,
                      int(row["__key_bytes"] or 0), int(row["__row_bytes"] or 0))


def key_stats(source: DataFrame, keys: str | Sequence[str]) -> tuple[int, int]:
    """``(rows with a non-NULL key, largest number of rows sharing one key)``."""
    summary = summarize_keys(source, keys)
    return summary.rows, summary.most or 0


def assert_unique_keys(source: DataFrame, keys: str | Sequence[str]) -> int:
    """Raise :class:`DuplicateKeyError` if two rows share a non-NULL key;
    returns the number of rows with a non-NULL key."""
    return _check_unique(summarize_keys(source, keys), keys).rows


def _check_unique(summary: KeySummary, keys) -> KeySummary:
    if summary.most and summary.most > 1:
        raise DuplicateKeyError(f"{summary.most} source rows share one value of {list(_keys(keys))}")
    return summary


def latest_per_key(source: DataFrame, keys: str | Sequence[str], order_col: str) -> DataFrame:
    """One row per non-NULL key: the one with the greatest ``order_col``
    (ties: greatest whole row). Rows with a NULL key are all kept.

    ``max_by`` over a struct has a map-side partial step, so a hot key is
    reduced inside each task before the shuffle (it plans as a sort
    aggregate: a struct buffer does not fit Spark's hash map).
    """
    keys = _keys(keys)
    cols = source.columns
    types = {f.name: f.dataType for f in source.schema.fields}
    # the tie-break orders whole rows
    ranked = F.struct(F.col(order_col), *[comparable(F.col(c), types[c]).alias(c) for c in cols])
    latest = (source.filter(_non_null(keys)).groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), ranked).alias("__row"))
              .select("__row.*"))
    return latest.unionByName(source.filter(~_non_null(keys)))


def prepare_source(target: DataFrame, source: DataFrame, keys: str | Sequence[str],
                   on_duplicate: str = "error", order_col: str | None = None,
                   persist: bool = False) -> tuple[DataFrame, KeySummary]:
    """Validate and de-duplicate ``source`` for a merge into ``target``.

    Returns the source projected onto the target's columns and types, and a
    :class:`KeySummary` of its keys (a checked size for broadcasts and the
    key range for pruning), from one aggregate job. With ``persist`` the
    returned frame is cached before it is first read (the caller unpersists
    it).
    """
    keys = _keys(keys)
    for k in keys:
        if k not in target.columns or k not in source.columns:
            raise ValueError(f"merge key {k!r} missing from target or source")
    if on_duplicate == "error":
        incoming = align_to(source, target.schema)
        if persist:  # the summary job fills the cache
            incoming = incoming.persist()
        try:
            return incoming, _check_unique(summarize_keys(incoming, keys), keys)
        except DuplicateKeyError:
            if persist:
                incoming.unpersist()
            raise
    if on_duplicate == "latest":
        if not order_col:
            raise ValueError("on_duplicate='latest' needs order_col")
        source = latest_per_key(source, keys, order_col)
    elif on_duplicate != "allow":
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    incoming = align_to(source, target.schema)
    if persist:
        incoming = incoming.persist()
    return incoming, summarize_keys(incoming, keys, per_key=False)


def shuffled(side: DataFrame) -> DataFrame:
    """``side`` for a join that must not broadcast it: what is cached looks small to
    the planner, by its compressed size."""
    return side.hint("merge")


def updated_rows(target: DataFrame, incoming: DataFrame, keys: str | Sequence[str], fit: Fit,
                 order_col: str | None = None) -> DataFrame:
    """The rows of ``target``, each with the values of the source row of its key
    if there is one (and, with ``order_col``, if that is not older)."""
    keys = _keys(keys)
    source = incoming.filter(_non_null(keys)).select(*keys, F.struct(*target.columns).alias("__src"))
    newer = F.col("__src").isNotNull()
    if order_col:
        newer = newer & F.coalesce(F.col(f"__src.`{order_col}`") >= F.col(order_col), F.col(order_col).isNull())
    take = lambda rows: rows.select(*[
        F.col(c) if c in keys else F.when(newer, F.col(f"__src.`{c}`")).otherwise(F.col(c)).alias(c) for c in target.columns])
    if fit.rows:
        return take(target.join(F.broadcast(source), on=keys, how="left"))
    if fit.keys:  # only target rows with a key of the source are shuffled
        wanted = F.broadcast(source.select(*keys))
        return take(target.join(wanted, on=keys, how="left_semi").join(shuffled(source), on=keys, how="left")).unionByName(
            target.join(wanted, on=keys, how="left_anti"))
    # NULL-key target rows can never match, so they bypass the exchange
    # instead of all hashing to one reducer; AQE can split a hot key of the
    # target, the left side.
    return take(target.filter(_non_null(keys)).join(shuffled(source), on=keys, how="left")).unionByName(target.filter(~_non_null(keys)))


def unmatched_rows(target: DataFrame, incoming: DataFrame, keys: str | Sequence[str], fit: Fit) -> DataFrame:
    """The source rows whose key no target row has."""
    keys = _keys(keys)
    present = target.select(*keys).filter(_non_null(keys))
    if not fit.keys:  # de-duplicated before the exchange: AQE cannot split the right side of an anti-join
        return incoming.join(present.distinct(), on=keys, how="left_anti")
    wanted = F.broadcast(incoming.select(*keys).filter(_non_null(keys)))
    # at most as many keys as the source has
    present = F.broadcast(present.join(wanted, on=keys, how="left_semi").distinct())
    return incoming.join(present, on=keys, how="left_anti")


def merge_prepared(target: DataFrame, incoming: DataFrame, keys: Sequence[str], summary: KeySummary,
                   broadcast_keys: int | None = DEFAULT_BROADCAST_KEYS, order_col: str | None = None) -> DataFrame:
    """The merged table from a prepared source (see :func:`prepare_source`)."""
    fit = summary.fit(broadcast_keys)
    return updated_rows(target, incoming, keys, fit, order_col).unionByName(unmatched_rows(target, incoming, keys, fit))


def upsert(target: DataFrame, source: DataFrame, keys: str | Sequence[str], *,
           on_duplicate: str = "error", order_col: str | None = None,
           broadcast_keys: int | None = DEFAULT_BROADCAST_KEYS) -> DataFrame:
    """New contents of ``target`` after merging ``source`` on ``keys``."""
    incoming, summary = prepare_source(target, source, keys, on_duplicate, order_col)
    return merge_prepared(target, incoming, _keys(keys), summary, broadcast_keys,
                          version_col(target, on_duplicate, order_col))


def version_col(target: DataFrame, on_duplicate: str, order_col: str | None) -> str | None:
    """The column that versions rows, where the target has it too."""
    return order_col if on_duplicate == "latest" and order_col in target.columns else None


def range_filter(keys: Sequence[str], bounds: list[tuple[str, str]], schema) -> Column:
    """``lo <= key <= hi`` for each key column, as typed literals of
    ``schema``'s key types (Parquet pushes it down to skip row groups)."""
    types = {f.name: f.dataType for f in schema.fields}
    cond = F.lit(True)
    for k, (lo, hi) in zip(_keys(keys), bounds):
        cond = cond & (F.col(k) >= typed_lit(lo, types[k])) & (F.col(k) <= typed_lit(hi, types[k]))
    return cond


def key_range(source: DataFrame, keys: Sequence[str], schema) -> Column | None:
    """:func:`range_filter` over the source's non-NULL keys, or ``None`` when
    it has none (nothing can match)."""
    bounds = summarize_keys(source, keys, per_key=False).bounds
    return None if bounds is None else range_filter(keys, bounds, schema)


FILE = "__file"


def match_files(target: DataFrame, incoming: DataFrame, keys: str | Sequence[str], summary: KeySummary, fit: Fit,
                order_col: str | None = None) -> DataFrame:
    """Where the source's keys are: one row per key and target file, with
    ``__changed`` (a merge would change a row of the key in that file).

    ``target`` carries its files' names in ``__file``. A small source is
    broadcast whole into one scan of the target's row groups in the source's key
    range, and rows are compared there (NULL-safe; maps by their entries). If only
    its keys are small, they are broadcast and the rows that have one are shuffled
    to be compared; if they are not, all rows of the key range are. With more rows
    than may be compared only keys and file names are shuffled and every file with a
    matching key counts as changed. In each case the rows of one key and file are
    reduced inside each task first.
    """
    keys = _keys(keys)
    source = incoming.filter(_non_null(keys))
    if summary.bounds is None:  # only NULL keys: nothing matches
        return target.limit(0).select(*keys, FILE, F.lit(False).alias(CHANGED))
    found = target.filter(_non_null(keys) & range_filter(keys, summary.bounds, target.schema))
    if fit.compared:
        types = {f.name: f.dataType for f in target.schema.fields}
        rest = [c for c in target.columns if c not in keys and c != FILE]
        source = source.select(*keys, F.struct(F.lit(True).alias("__hit"), *rest).alias("__src"))
        same = F.lit(True)
        for c in rest:
            same = same & comparable(F.col(f"__src.`{c}`"), types[c]).eqNullSafe(comparable(F.col(c), types[c]))
        changed = ~same
        if order_col:
            changed = changed & F.coalesce(F.col(f"__src.`{order_col}`") >= F.col(order_col), F.col(order_col).isNull())
        if fit.keys and not fit.rows:
            found = found.join(F.broadcast(source.select(*keys)), on=keys, how="left_semi")
        source = F.broadcast(source) if fit.rows else shuffled(source)
        hits = found.join(source, on=keys).select(*keys, FILE, changed.alias(CHANGED))
    else:
        hits = found.select(*keys, FILE).join(shuffled(source.select(*keys)), on=keys, how="left_semi").withColumn(CHANGED, F.lit(True))
    return hits.groupBy(*keys, FILE).agg(F.bool_or(CHANGED).alias(CHANGED))


MATCHED = "__matched"
CHANGED = "__changed"


def match_keys(target: DataFrame, incoming: DataFrame, keys: str | Sequence[str], n_keys: int,
               broadcast_keys: int = DEFAULT_BROADCAST_KEYS,
               summary: KeySummary | None = None) -> DataFrame:
    """One row per non-NULL key of a small, prepared source: the key columns,
    ``__matched`` (some target row has the key) and ``__changed`` (matched,
    and the rows with the key are not all equal, NULL-safe, so a merge would
    update something).

    The source keys are broadcast into one scan of the target, which first
    skips row groups outside the source's key range (:func:`key_range`).
    Source rows and matched target rows then meet in one aggregate per key
    (min and max of the non-key columns as a struct; equal means unchanged)
    with a map-side partial step, so a key that the target repeats many
    times is reduced inside each task and yields one row, never one row per
    copy. ``n_keys`` is the counted number of source keys (see
    :func:`prepare_source`); above ``broadcast_keys`` this raises instead of
    broadcasting an unbounded set. NULL keys never match and are left out.
    """
    if n_keys > broadcast_keys:
        raise ValueError(f"{n_keys} source keys exceed the broadcast bound {broadcast_keys}")
    keys = _keys(keys)
    types = {f.name: f.dataType for f in target.schema.fields}
    others = [comparable(F.col(c), types[c]).alias(c) for c in target.columns if c not in keys]
    row = F.struct(*others) if others else F.lit(0)
    src = incoming.filter(_non_null(keys)).select(*keys, row.alias("__v"), F.lit(1).alias("__side"))
    if summary is not None:
        in_range = None if summary.bounds is None else range_filter(keys, summary.bounds, target.schema)
    else:
        in_range = key_range(incoming, keys, target.schema)
    if in_range is None:  # only NULL keys: nothing matches
        both = src
    else:
        # A semi-join's build side may repeat keys, so no distinct (and no
        # shuffle) is needed; its size is the counted ``n_keys``.
        src_keys = incoming.select(*keys).filter(_non_null(keys))
        matched = target.filter(in_range).join(F.broadcast(src_keys), on=keys, how="left_semi")
        both = src.unionByName(matched.select(*keys, row.alias("__v"), F.lit(0).alias("__side")))
    per_key = both.groupBy(*keys).agg(F.min("__side").alias("__lo_side"), F.max("__side").alias("__hi_side"),
                                      F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    hit = (F.col("__lo_side") == 0) & (F.col("__hi_side") == 1)
    return per_key.select(*keys, hit.alias(MATCHED), (hit & ~F.col("__lo").eqNullSafe(F.col("__hi"))).alias(CHANGED))


def changed_rows(target: DataFrame, incoming: DataFrame, keys: str | Sequence[str], n_keys: int,
                 broadcast_keys: int = DEFAULT_BROADCAST_KEYS,
                 summary: KeySummary | None = None) -> tuple[DataFrame, DataFrame]:
    """``(inserts, updates)`` of a merge, from :func:`match_keys`.

    ``inserts``: source rows whose key is not in the target (NULL keys
    included). ``updates``: source keys matching a target row whose content
    differs. When ``updates`` is empty the merge is an append of
    ``inserts``: re-read boundary rows (E1) cost nothing.
    """
    keys = _keys(keys)
    per_key = match_keys(target, incoming, keys, n_keys, broadcast_keys, summary)
    return new_rows(incoming, per_key, keys), per_key.filter(F.col(CHANGED)).select(*keys)


def new_rows(incoming: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key :func:`match_keys` found in no target row
    (the anti-join's right side holds each key once)."""
    return incoming.join(per_key.filter(F.col(MATCHED)).select(*keys), on=list(keys), how="left_anti")


def insert_missing(target: DataFrame, source: DataFrame, keys: str | Sequence[str],
                   broadcast_keys: int | None = DEFAULT_BROADCAST_KEYS) -> DataFrame:
    """Rows of ``source`` whose key is not yet in ``target`` (DML-2 on a
    table that holds only its key columns: update-all is then a no-op, so the
    merge is an append of these rows).

    When the source is small (count checked), its keys are broadcast into a
    semi-join over the target: the target is scanned and filtered, never
    shuffled, and only the already-present keys (at most the source's size)
    take part in the final anti-join.
    """
    keys = _keys(keys)
    incoming = align_to(source, target.schema)
    src_keys = incoming.select(*keys).filter(_non_null(keys))
    summary = summarize_keys(incoming, keys, per_key=False) if broadcast_keys else None
    if summary is not None and summary.fit(broadcast_keys).keys:
        # one job gave the size checked for the broadcast and the key range
        if summary.bounds is None:
            return incoming
        in_range = range_filter(keys, summary.bounds, target.schema)
        present = (target.select(*keys).filter(in_range)
                   .join(F.broadcast(src_keys), on=keys, how="left_semi"))
        return incoming.join(present.distinct(), on=keys, how="left_anti")
    # NULL target keys never match; leaving them out keeps them off one
    # reducer. The target keys are de-duplicated before the exchange (partial
    # aggregate), so a key the target repeats reaches the join once: AQE
    # cannot split the right side of an anti-join.
    return incoming.join(target.select(*keys).filter(_non_null(keys)).distinct(), on=keys, how="left_anti")
