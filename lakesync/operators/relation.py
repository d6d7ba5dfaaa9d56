"""Changed-relation detection (CTE-1 = FLT-3 -> PRJ-3 -> JOIN-1/FLT-5 -> AGG-2).

"Relation rows touched by a change on either side": the distinct
``(left, right)`` pairs of a link table whose left id changed in the window
*or* whose right id changed in the window.

A disjunction of two ``IN`` subqueries cannot be one equi-join (as one
``left_semi`` with ``OR`` it plans as a ``BroadcastNestedLoopJoin``). Three
plans are correct and the operator picks by measured size:

* ``exists``: ``a.isin(ids) | b.isin(ids)`` -> two ``ExistenceJoin`` in one
  pass over the link table. Used when both id sets are small enough to
  broadcast; the size is counted first, never assumed.
* ``semi``: ``left_semi`` on each side, union, distinct. Each semi-join is a
  plain shuffle join that AQE can split when one id is hot (say a third of
  all link rows share one tag); used when the id sets are large.
* ``bitmap``: integer id sets too large for that, as bitmaps: one bit an id,
  4 KB for a range of 32768 ids. They are broadcast after their bytes are counted,
  and test every link row exactly where it is scanned, so only touched pairs are
  shuffled. ``auto`` takes it between the other two.

Both then de-duplicate with a two-phase hash aggregate (map-side partial
distinct before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lakesync.functions.windows import Bound, between_half_open, previous_day
from lakesync.session import staged

# Upper bound on distinct ids broadcast per side (8-byte keys plus hash-table
# overhead stay well below the default 8 GB broadcast limit).
DEFAULT_BROADCAST_IDS = 2_000_000
# Upper bound on the bytes of one side's broadcast bitmaps.
DEFAULT_BITMAP_BYTES = 256 << 20
BITMAP_BYTES = 4096


def changed_ids(df: DataFrame, id_col: str, date_col: str, start: Bound = None, end: Bound = None,
                as_of: Bound = None) -> DataFrame:
    """PRJ-3 over a window: distinct ``id`` of rows changed in ``[start, end)``,
    or in the day before ``as_of`` (FLT-3) when no explicit bounds are given."""
    if start is not None or end is not None:
        cond = between_half_open(df, date_col, start, end)
    else:
        cond = previous_day(df, date_col, as_of)
    return df.filter(cond).select(F.col(id_col).alias("id")).distinct()


def _broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("lakesync.relation.broadcastIds", str(DEFAULT_BROADCAST_IDS)))


def _bitmaps_fit(tagged: DataFrame) -> bool:
    """Whether both sides' ids are integers whose bitmaps keep the byte bound."""
    if not isinstance(tagged.schema["id"].dataType, IntegralType):
        return False
    limit = int(tagged.sparkSession.conf.get("lakesync.relation.bitmapBytes", str(DEFAULT_BITMAP_BYTES)))
    buckets = tagged.groupBy("side", F.bitmap_bucket_number(F.col("id").cast("bigint")).alias("b")).agg(F.lit(1).alias("one")) \
        .groupBy("side").count().collect()
    return all(r["count"] * BITMAP_BYTES <= limit for r in buckets)


def _held(pairs: DataFrame, column: str, ids: DataFrame):
    """Adds ``__in_<column>``: whether the column's id is one of ``ids`` (false
    for NULL), by broadcast bitmaps; ids must be integers."""
    big = lambda c: F.col(c).cast("bigint")
    source = ids.columns[0]
    bits = ids.filter(F.col(source).isNotNull()).groupBy(F.bitmap_bucket_number(big(source)).alias(f"__b_{column}")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(big(source))).alias(f"__bits_{column}"))
    at = F.bitmap_bit_position(big(column))
    byte = F.conv(F.hex(F.substring(F.col(f"__bits_{column}"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    found = F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False))

    def add(rows: DataFrame) -> DataFrame:
        joined = rows.withColumn(f"__b_{column}", F.bitmap_bucket_number(big(column))).join(
            F.broadcast(bits), f"__b_{column}", "left")
        return joined.withColumn(f"__in_{column}", found).drop(f"__b_{column}", f"__bits_{column}")

    return add


def touched_pairs(rel: DataFrame, left_col: str, right_col: str, left_ids: DataFrame, right_ids: DataFrame,
                  strategy: str = "auto", out_left: str = "lead_id", out_right: str = "tag_id") -> DataFrame:
    """JOIN-1 + AGG-2: distinct pairs with ``left in left_ids OR right in right_ids``.

    NULL on one side of a pair does not block a match on the other side;
    a NULL id never matches.
    """
    checked = strategy == "auto"
    if checked:
        # Materialise both id sets once, as one tagged frame (one job, a
        # reliable checkpoint under spark.checkpoint.dir), count each side
        # from it, and join from the same files.
        tagged = staged(left_ids.select(F.lit(0).alias("side"), F.col(left_ids.columns[0]).alias("id"))
                        .unionByName(right_ids.select(F.lit(1).alias("side"),
                                                      F.col(right_ids.columns[0]).alias("id"))),
                        required=False)
        sizes = {r["side"]: r["n"] for r in tagged.groupBy("side").count().withColumnRenamed("count", "n").collect()}
        left_ids = tagged.filter(F.col("side") == 0).select("id")
        right_ids = tagged.filter(F.col("side") == 1).select("id")
        limit = _broadcast_limit(rel.sparkSession)
        if max(sizes.values(), default=0) <= limit:
            strategy = "exists"
        else:
            strategy = "bitmap" if _bitmaps_fit(tagged) else "semi"
    pairs = rel.select(F.col(left_col).alias(out_left), F.col(right_col).alias(out_right))
    lid = left_ids.select(F.col(left_ids.columns[0]).alias("__lid"))
    rid = right_ids.select(F.col(right_ids.columns[0]).alias("__rid"))
    if strategy == "exists":
        if checked:  # sizes counted above: broadcast both id sets
            lid, rid = F.broadcast(lid), F.broadcast(rid)
        touched = pairs.filter(F.col(out_left).isin(lid) | F.col(out_right).isin(rid))
    elif strategy == "bitmap":
        left, right = (_held(pairs, c, ids) for c, ids in ((out_left, lid), (out_right, rid)))
        touched = right(left(pairs)).filter(F.col(f"__in_{out_left}") | F.col(f"__in_{out_right}")).select(out_left, out_right)
    elif strategy == "semi":
        by_left = pairs.join(lid, F.col(out_left) == F.col("__lid"), "left_semi")
        by_right = pairs.join(rid, F.col(out_right) == F.col("__rid"), "left_semi")
        touched = by_left.unionByName(by_right)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return touched.distinct()


def relation_delta(lead: DataFrame, tag: DataFrame, rel: DataFrame, *, as_of: Bound = None,
                   start: Bound = None, end: Bound = None,
                   lead_id: str = "id", lead_date: str = "write_date",
                   tag_id: str = "id", tag_date: str = "write_date",
                   rel_lead: str = "lead_id", rel_tag: str = "tag_id",
                   strategy: str = "auto") -> DataFrame:
    """CTE-1: pairs of ``rel`` touched by a lead or tag changed in the window.

    The window is ``[start, end)`` when given, else the day before ``as_of``
    (``None`` = today, as the reference's ``CURRENT_DATE``). Table and column
    names are parameters (E17). Output columns: ``lead_id, tag_id``.
    """
    changed_leads = changed_ids(lead, lead_id, lead_date, start, end, as_of)
    changed_tags = changed_ids(tag, tag_id, tag_date, start, end, as_of)
    return touched_pairs(rel, rel_lead, rel_tag, changed_leads, changed_tags, strategy=strategy)
