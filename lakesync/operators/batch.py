"""Bounded, tie-safe batches (TOP-2): the first ``n`` rows of a source in
checkpoint order.

``ORDER BY c LIMIT n`` written as ``orderBy(...).limit(n)`` plans as
``TakeOrderedAndProject``: every partition keeps its own top ``n`` and all of
them meet in one task, i.e. ``partitions x n`` rows. With the reference's
n = 100000 and tens of thousands of input partitions that single task would
receive nearly the whole table.

Here the n-th row's sort key is found first, with jobs that only aggregate the
sort-key columns; the batch is then one filter, ``key <= n-th key``
lexicographically, which Parquet pushes down to skip row groups.

* Scan 1 builds a KLL sketch of the order column (``kll_sketch_agg_*``; per task,
  merged in two steps) beside exact counts. The sketch brackets the n-th value
  within its rank error.
* Scan 2 counts exactly: the rows below the bracket, and how often each sort key
  in it occurs. The n-th key is read off those counts.

The bracket holds at most ``exact_rows`` rows as long as the source has no more
than about ``exact_rows / (2 * SKETCH_ERROR)`` (some 8e8); beyond that, one more
scan of the bracket alone sketches it again, which shrinks it by the same factor.
A value shared by more than ``exact_rows`` rows is settled by the next key column
among those rows. The answer is exact: a sketch only chooses what to count, and a
bracket that the counts refute is replaced by the side that holds the n-th row.

Order is ``order_col ASC NULLS LAST`` (as PostgreSQL's ``ASC``, E7), then each
key column ascending, so cuts through ties are deterministic (E6). With
``with_ties=True`` the key columns are ignored and every row whose order
value equals the n-th row's value is included.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    IntegralType,
    NumericType,
    TimestampNTZType,
    TimestampType,
)

from lakesync.functions.windows import since, typed_lit, value_text
from lakesync.session import staged

# Largest number of sort-key values one task may order exactly.
DEFAULT_EXACT_ROWS = 2_000_000
# Sketch size, and the rank error it keeps with 99 % confidence.
SKETCH_K = 4096
SKETCH_ERROR = 0.0013
# Partial sketches merge in so many tasks before the last one.
SKETCH_GROUPS = 64
# Rows a sampled bracket may bring to the driver (types without a sketch).
SAMPLE_ROWS = 20_000


def _sketch_number(c: Column, dtype: DataType) -> tuple[Column, str] | None:
    """``c`` as a number of the same order, and the sketch family; ``None`` for
    types without one."""
    if isinstance(dtype, BooleanType):
        return None
    if isinstance(dtype, IntegralType):
        return c.cast("bigint"), "bigint"
    if isinstance(dtype, DateType):
        return F.unix_date(c).cast("bigint"), "bigint"
    if isinstance(dtype, TimestampType):
        return F.unix_micros(c), "bigint"
    if isinstance(dtype, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", _EPOCH_NTZ(), c), "bigint"
    if isinstance(dtype, NumericType):
        return c.cast("double"), "double"
    return None


def _EPOCH_NTZ() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _from_number(v: Column, dtype: DataType) -> Column:
    """The value of ``dtype`` at a sketch's number (a bound; it need not occur)."""
    if isinstance(dtype, DateType):
        return F.date_from_unix_date(v.cast("int"))
    if isinstance(dtype, TimestampType):
        return F.timestamp_micros(v)
    if isinstance(dtype, TimestampNTZType):
        return F.timestamp_add("MICROSECOND", v, _EPOCH_NTZ())
    return v.cast(dtype)


_FAMILY = {
    "bigint": (F.kll_sketch_agg_bigint, F.kll_merge_agg_bigint, F.kll_sketch_get_quantile_bigint, F.kll_sketch_get_rank_bigint),
    "double": (F.kll_sketch_agg_double, F.kll_merge_agg_double, F.kll_sketch_get_quantile_double, F.kll_sketch_get_rank_double),
}


@dataclass(frozen=True)
class _Region:
    """Rows of ``df`` with ``lo <= column <= hi`` (as typed text; ``None`` is
    open); ``open_lo``/``open_hi`` leave the bound itself out."""

    df: DataFrame
    column: str
    lo: str | None = None
    hi: str | None = None
    open_lo: bool = False
    open_hi: bool = False

    def rows(self) -> DataFrame:
        c, dtype = F.col(self.column), self.df.schema[self.column].dataType
        out = self.df.filter(c.isNotNull())
        if self.lo is not None:
            v = typed_lit(self.lo, dtype)
            out = out.filter(c > v if self.open_lo else c >= v)
        if self.hi is not None:
            v = typed_lit(self.hi, dtype)
            out = out.filter(c < v if self.open_hi else c <= v)
        return out


class _Sketch(NamedTuple):
    """Rows, non-NULL values ``n``, a bracket (typed text; ``None`` if the k-th
    row's value is NULL) and the share of the values that lies in it."""

    rows: int
    n: int
    a: str | None = None
    b: str | None = None
    share: float = 1.0


def _sketched(rows: DataFrame, name: str, k: int) -> _Sketch:
    """One scan (two for types without a sketch) around the k-th value."""
    dtype = rows.schema[name].dataType
    number = _sketch_number(F.col(name), dtype)
    if number is None:
        row = rows.agg(F.count(F.lit(1)).alias("rows"), F.count(name).alias("n")).first()
        return _Sketch(row["rows"], row["n"], *_sampled(rows.filter(F.col(name).isNotNull()), name, dtype, k, row["n"]))
    value, family = number
    agg, merge, quantile, rank = _FAMILY[family]
    parts = rows.select(value.alias("v"), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g")) \
        .groupBy("g").agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("n"), agg("v", F.lit(SKETCH_K)).alias("s"))
    whole = parts.agg(F.sum("rows").alias("rows"), F.sum("n").alias("n"), merge("s").alias("s")).first()
    size, n = int(whole["rows"] or 0), int(whole["n"] or 0)
    if k > n:
        return _Sketch(size, n)
    error = 2 * SKETCH_ERROR
    lo, hi = max(k / n - error, 0.0), min(k / n + error, 1.0)
    one = rows.sparkSession.createDataFrame([(bytearray(whole["s"]),)], "s binary")
    ends = one.select(quantile("s", F.lit(lo)).alias("a"), quantile("s", F.lit(hi)).alias("b")).first()
    a, b = F.lit(ends["a"]).cast(family), F.lit(ends["b"]).cast(family)
    below = rank("s", F.lit(ends["a"] - 1).cast(family)) if family == "bigint" else F.lit(0.0)
    row = one.select(value_text(_from_number(a, dtype), dtype).alias("a"), value_text(_from_number(b, dtype), dtype).alias("b"),
                     (rank("s", b) - below).alias("share")).first()
    return _Sketch(size, n, row["a"], row["b"], float(row["share"]) + error)


def _sampled(rows: DataFrame, name: str, dtype: DataType, k: int, size: int) -> tuple[str | None, str | None]:
    """A bracket of the k-th value from a bounded sample."""
    if not size or k > size:
        return None, None
    fraction = min(1.0, SAMPLE_ROWS / size)
    sample = [r["t"] for r in rows.select(F.col(name).alias("v")).sample(False, fraction, seed=17)
              .orderBy("v").select(value_text(F.col("v"), dtype).alias("t")).collect()]
    if not sample:
        return None, None
    pos = k * fraction
    margin = 3.0 * math.sqrt(max(pos, 1.0)) + 2.0
    lo = min(max(int(pos - margin), 0), len(sample) - 1)
    hi = min(max(int(math.ceil(pos + margin)), 0), len(sample) - 1)
    return sample[lo], sample[hi]


def _counted(region: _Region, a: str, b: str, cols: Sequence[str], k: int):
    """One scan of ``region``: ``(below, inside, key)``, the rows below ``a``, the
    rows in ``[a, b]``, and the values of ``cols`` (typed text) of the row at
    ``k`` if that is one of them."""
    df, c = region.df, F.col(region.column)
    types = [df.schema[x].dataType for x in cols]
    lo, hi = typed_lit(a, types[0]), typed_lit(b, types[0])
    inside = c >= lo
    keys = [F.when(inside, F.col(x)).alias(f"k{i}") for i, x in enumerate(cols)]
    names = [f"k{i}" for i in range(len(cols))]
    # a reliable copy of the counts: one row for each key in the bracket
    counts = staged(region.rows().filter(c <= hi).select(inside.alias("inside"), *keys)
                    .groupBy("inside", *names).agg(F.count(F.lit(1)).alias("n")), required=False)
    total = {r["inside"]: int(r["n"]) for r in counts.groupBy("inside").agg(F.sum("n").alias("n")).collect()}
    below, held = total.get(False, 0), total.get(True, 0)
    if not below < k <= below + held:
        return below, held, None
    # at most exact_rows rows, or the distinct values of one column in the bracket
    order = Window.orderBy(*[F.col(x).asc_nulls_last() for x in names])
    running = counts.filter("inside").withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    row = running.filter(F.col("upto") >= k - below).orderBy(F.col("upto")).limit(1) \
        .select(*[value_text(F.col(x), t).alias(x) for x, t in zip(names, types)], (F.col("upto") - F.col("n")).alias("before"), "n").first()
    return below, held, ([row[x] for x in names], below + int(row["before"]), int(row["n"]))


def _nth_value(df: DataFrame, cols: Sequence[str], k: int, exact_rows: int, sketch: _Sketch) -> tuple[list[str], int, int]:
    """Sort-key values of the k-th row by ``cols[0]`` (not NULL there): all of
    ``cols`` where their counts fit, else the first; with the number of rows
    before that key and at it. ``sketch`` is that of the whole of ``df``."""
    name = cols[0]
    region, before = _Region(df, name), 0  # ``before``: rows below the region
    while True:
        a, b = sketch.a, sketch.b
        if a is None:  # nothing was sampled: the region as it is
            a, b = region.lo, region.hi
        fits = sketch.share * sketch.n <= exact_rows
        if not fits and a != b and (a, b) != (region.lo, region.hi):
            # count the bracket's place, then sketch it alone
            c, dtype = F.col(name), df.schema[name].dataType
            row = region.rows().agg(F.count_if(c < typed_lit(a, dtype)).alias("below"),
                                    F.count_if(c <= typed_lit(b, dtype)).alias("upto")).first()
            below, upto, found = int(row["below"]), int(row["upto"]), None
        else:
            below, held, found = _counted(region, a, b, list(cols) if fits else [name], k - before)
            upto = below + held
        if found is not None:
            values, rows_before, at = found
            return values, before + rows_before, at
        if k - before <= below:
            region = replace(region, hi=a, open_hi=True)
        elif k - before > upto:
            region, before = replace(region, lo=b, open_lo=True), before + upto
        else:
            region, before = replace(region, lo=a, hi=b, open_lo=False, open_hi=False), before + below
        sketch = _sketched(region.rows(), name, k - before)


def _exact_tuple(region: DataFrame, cols: Sequence[str], k: int) -> list[str | None]:
    """Sort key of the k-th row of ``region`` by ordering only the key columns.

    One ``TakeOrderedAndProject``; the caller guarantees ``region`` is at most
    ``exact_rows`` rows, so the final merge is bounded.
    """
    named = [F.col(c).alias(f"k{i}") for i, c in enumerate(cols)]
    types = [region.schema[c].dataType for c in cols]
    row = (region.select(*named)
           .orderBy(*[F.col(f"k{i}").asc_nulls_last() for i in range(len(cols))])
           .offset(k - 1).limit(1)
           .select(*[value_text(F.col(f"k{i}"), types[i]).alias(f"t{i}") for i in range(len(cols))])
           .first())
    return [row[f"t{i}"] for i in range(len(cols))]


def nth_sort_key(df: DataFrame, cols: Sequence[str], n: int,
                 exact_rows: int = DEFAULT_EXACT_ROWS) -> list[str | None] | None:
    """Sort key (as typed text, ``None`` = NULL) of the n-th row by ``cols``;
    ``None`` if ``df`` has no more than ``n`` rows.

    Ascending, NULLS LAST. May return a prefix of ``cols`` when the rows
    sharing that prefix all belong to the first ``n``. Regions of at most
    ``exact_rows`` rows are ordered directly; larger ones are sketched and
    counted, and a value too common for that is left to the next column.
    """
    region, k = df, n
    key: list[str | None] = []
    for i, name in enumerate(cols):
        sketch = _sketched(region, name, k)
        if i == 0 and sketch.rows <= n:
            return None
        if sketch.rows <= exact_rows:
            key.extend(_exact_tuple(region, cols[i:], k))
            break
        if k > sketch.n:
            key.append(None)
            region, k, at = region.filter(F.col(name).isNull()), k - sketch.n, sketch.rows - sketch.n
        else:
            values, before, at = _nth_value(region, cols[i:], k, exact_rows, sketch)
            key.extend(values)
            if len(values) == len(cols) - i:
                break
            region, k = region.filter(F.col(name) == typed_lit(values[0], df.schema[name].dataType)), k - before
        if k >= at:
            break
    return key


def sort_key_at_most(df: DataFrame, cols: Sequence[str], key: Sequence[str | None]) -> Column:
    """Lexicographic ``(cols...) <= key`` under ASC NULLS LAST (pushdown-friendly)."""
    pred = None
    for name, text in reversed(list(zip(cols, key))):
        c = F.col(name)
        if text is None:
            lt, eq, le = c.isNotNull(), c.isNull(), F.lit(True)
        else:
            v = typed_lit(text, df.schema[name].dataType)
            lt, eq, le = c < v, c == v, c <= v
        pred = le if pred is None else (lt | (eq & pred))
    return pred if pred is not None else F.lit(True)


def sort_key_after(df: DataFrame, cols: Sequence[str], key: Sequence[Column]) -> Column:
    """Lexicographic ``(cols...) > key`` for non-NULL values (pushdown-friendly:
    the bound on the first column stands alone, so it prunes row groups)."""
    pred = F.lit(False)
    for name, v in reversed(list(zip(cols, key))):
        pred = (F.col(name) > v) | ((F.col(name) == v) & pred)
    return (F.col(cols[0]) >= key[0]) & pred


def first_rows(df: DataFrame, order_col: str, n: int, keys: Sequence[str] = (),
               with_ties: bool = False, exact_rows: int = DEFAULT_EXACT_ROWS) -> DataFrame:
    """The first ``n`` rows of ``df`` by ``order_col`` ASC NULLS LAST, then ``keys``.

    Returns a filter over ``df`` (unsorted; sort it if a consumer needs order).
    If the key columns do not identify rows, rows tied on the whole sort key
    at the boundary are all kept rather than cut arbitrarily.
    """
    if n <= 0:
        return df.filter(F.lit(False))
    cols = [order_col] if with_ties else [order_col, *[k for k in keys if k != order_col]]
    key = nth_sort_key(df, cols, n, exact_rows)
    if key is None:
        return df
    return df.filter(sort_key_at_most(df, cols[:len(key)], key))


def first_rows_sorted(df: DataFrame, order_col: str, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """Plain ``ORDER BY ... LIMIT n`` (``TakeOrderedAndProject``).

    Fine when ``partitions x n`` rows fit one task, e.g. a small or already
    filtered source; kept as the baseline the benchmark compares against.
    """
    order = [F.col(order_col).asc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys if k != order_col]]
    return df.orderBy(*order).limit(n)


def bounded_batch(source: DataFrame, column: str, max_rows: int = 100_000, keys: Sequence[str] = ("id",),
                  checkpoint=None, with_ties: bool = False,
                  exact_rows: int = DEFAULT_EXACT_ROWS, strategy: str = "filter") -> DataFrame:
    """TOP-2 with FLT-2: rows with ``column >= checkpoint`` (all rows when the
    checkpoint is ``None``), the first ``max_rows`` of them in checkpoint order.

    ``checkpoint`` may be a :class:`~lakesync.operators.checkpoint.Checkpoint`
    or a plain value. Only ``None`` means "no checkpoint" (E2: 0 and "" are
    real checkpoints).

    ``strategy="filter"`` (default) finds the n-th key with aggregates and
    filters; use ``"sorted"`` for a source that runs ``ORDER BY ... LIMIT``
    itself (a table of a V2 JDBC catalog shows ``PushedTopN``), where the
    database returns only the batch.
    """
    rows = source
    if checkpoint is not None:
        bound = checkpoint.lit() if hasattr(checkpoint, "lit") else checkpoint
        rows = source.filter(since(source, column, bound))
    missing = [k for k in keys if k not in source.columns]
    if missing:
        raise ValueError(f"source lacks the key columns {missing}")
    if strategy == "sorted" and not with_ties:
        return first_rows_sorted(rows, column, max_rows, keys)
    if strategy not in ("filter", "sorted"):
        raise ValueError(f"unknown strategy {strategy!r}")
    return first_rows(rows, column, max_rows, keys=keys, with_ties=with_ties, exact_rows=exact_rows)
