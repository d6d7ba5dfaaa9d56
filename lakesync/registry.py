"""Acceptance queries: each operator and job run on the driver's tables,
paired with SQL that states the same result for an independent engine.

Roles (FIXTURES.md B): ``events`` is the operational source table
(``event_id`` = id, ``ts`` = write_date); ``orders`` is the lead table
(``o_orderkey``, ``o_orderdate``); the tag table is derived from
``lineitem`` (``l_partkey`` and its latest ``l_shipdate``); ``lineitem`` is
the relation (``l_orderkey`` = lead_id, ``l_partkey`` = tag_id).

Every query reads whole tables. Earlier table states (what the lake or mart
held before a run) are time windows of the same tables, never id subsets.
Queries that write go to fresh locations under ``spark.checkpoint.dir`` and
return the table read back.
"""

from __future__ import annotations

import datetime as _dt
import re
import tempfile
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.functions.windows import lagged_range, previous_day, since
from lakesync.operators import maintenance
from lakesync.operators.batch import bounded_batch, first_rows
from lakesync.operators.checkpoint import latest_checkpoint, latest_value_frame, max_value_frame
from lakesync.operators.relation import relation_delta
from lakesync.operators.upsert import upsert
from lakesync.plans import jobs
from lakesync.session import checkpoint_dir, ensure_checkpoint_dir, scratch_path
from lakesync.sources.catalog import CatalogTable, create_namespace
from lakesync.sources.lake import LakeTable

# Fixed scenario parameters (dates inside the driver tables' ranges).
RELATION_START = "2001-07-31 00:00:00"
RELATION_END = "2001-08-01 00:00:00"
EVENTS_LOADED_BEFORE = "2024-01-16 00:00:00"
PREVIOUS_DAY_AS_OF = "2024-01-15"
BACKFILL_START = "2024-01-10 00:00:00"
BACKFILL_AS_OF = "2024-01-20 00:00:00"
ORDERS_TARGET_BEFORE = "1999-01-01 00:00:00"
ORDERS_SOURCE_FROM = "1998-01-01 00:00:00"
ORDERS_REVISED_FROM = "2000-01-01 00:00:00"
PAIRS_LOADED_BEFORE = "2001-07-01 00:00:00"
BATCH_ROWS = 1000
DAILY_RUN_DATE = "2024-01-15"
SMALL_FILES = 64
STREAM_FILES = 8
# Region size below which the n-th key is found by one top-k; the descent
# queries set it far below the table size so the scale path (percentile
# brackets + counts) is what the oracle checks.
DESCENT_EXACT_ROWS = 256

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
PAIR_COLS = ["lead_id", "tag_id"]


def _ready(spark: SparkSession) -> None:
    """Use the session's shared checkpoint folder. Only a single-machine session
    without one (a local test run) gets a temporary folder; a cluster must name
    its shared folder."""
    if re.match(r"local(\[|$)", spark.sparkContext.master):
        ensure_checkpoint_dir(spark, lambda: tempfile.mkdtemp(prefix="lakesync-ckpt-"))
    else:
        checkpoint_dir(spark)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _ready(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scratch(spark: SparkSession, name: str) -> LakeTable:
    _ready(spark)
    return LakeTable(spark, scratch_path(spark, name))


def _relation_inputs(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    lineitem = _t(spark, sf_dir, "lineitem")
    lead = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("write_date"))
    tag = lineitem.groupBy(F.col("l_partkey").alias("id")).agg(F.max("l_shipdate").alias("write_date"))
    rel = lineitem.select(F.col("l_orderkey").alias("lead_id"), F.col("l_partkey").alias("tag_id"))
    return lead, tag, rel


def _relation(spark, sf_dir, strategy="auto") -> DataFrame:
    lead, tag, rel = _relation_inputs(spark, sf_dir)
    return relation_delta(lead, tag, rel, start=RELATION_START, end=RELATION_END, strategy=strategy)


def _events_before(events: DataFrame) -> DataFrame:
    return events.filter(F.col("ts") < F.lit(EVENTS_LOADED_BEFORE).cast("timestamp_ntz"))


def _events_from(events: DataFrame) -> DataFrame:
    return events.filter(F.col("ts") >= F.lit(EVENTS_LOADED_BEFORE).cast("timestamp_ntz"))


# ---------------------------------------------------------------- operators
def q_checkpoint_max(spark, sf_dir):
    return max_value_frame(_t(spark, sf_dir, "orders"), "o_orderdate")


def q_checkpoint_latest(spark, sf_dir):
    return latest_value_frame(_t(spark, sf_dir, "orders"), "o_orderkey", order_col="o_orderdate")


def q_incremental_inclusive(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    cp = latest_checkpoint(_events_before(events), "ts")
    return events.filter(since(events, "ts", cp.lit())).select(*EVENT_COLS)


def q_bounded_batch_first(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    return first_rows(orders, "o_orderdate", BATCH_ROWS, keys=["o_orderkey"]).select(*ORDER_COLS)


def q_bounded_batch_next(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    first = first_rows(orders, "o_orderdate", BATCH_ROWS, keys=["o_orderkey"])
    cp = latest_checkpoint(first, "o_orderdate")
    return bounded_batch(orders, "o_orderdate", BATCH_ROWS, keys=["o_orderkey"], checkpoint=cp).select(*ORDER_COLS)


def q_bounded_batch_with_ties(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    return first_rows(orders, "o_orderdate", BATCH_ROWS, with_ties=True).select("o_orderkey", "o_orderdate")


def q_bounded_batch_events(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    return bounded_batch(events, "ts", BATCH_ROWS, keys=["event_id"]).select(*EVENT_COLS)


def q_bounded_batch_descent(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    return first_rows(events, "ts", BATCH_ROWS, keys=["event_id"],
                      exact_rows=DESCENT_EXACT_ROWS).select(*EVENT_COLS)


def q_bounded_batch_with_ties_descent(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    return first_rows(orders, "o_orderdate", BATCH_ROWS, with_ties=True,
                      exact_rows=DESCENT_EXACT_ROWS).select("o_orderkey", "o_orderdate")


def q_previous_day_window(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    return events.filter(previous_day(events, "ts", PREVIOUS_DAY_AS_OF)).select(*EVENT_COLS)


def q_backfill_lag_window(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    return events.filter(lagged_range(events, "ts", BACKFILL_START, BACKFILL_AS_OF, "1 hour")).select(*EVENT_COLS)


def q_relation_delta(spark, sf_dir):
    return _relation(spark, sf_dir).select(*PAIR_COLS)


def q_relation_delta_previous_day(spark, sf_dir):
    lead, tag, rel = _relation_inputs(spark, sf_dir)
    return relation_delta(lead, tag, rel, as_of=RELATION_END[:10]).select(*PAIR_COLS)


def q_relation_delta_semi(spark, sf_dir):
    return _relation(spark, sf_dir, strategy="semi").select(*PAIR_COLS)


def q_relation_delta_exists(spark, sf_dir):
    return _relation(spark, sf_dir, strategy="exists").select(*PAIR_COLS)


def q_upsert_by_key(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    target = (orders.filter(F.col("o_orderdate") < F.lit(ORDERS_TARGET_BEFORE).cast("timestamp_ntz"))
              .withColumn("o_totalprice", F.lit(0.0)))
    source = orders.filter(F.col("o_orderdate") >= F.lit(ORDERS_SOURCE_FROM).cast("timestamp_ntz"))
    return upsert(target, source, "o_orderkey").select(*ORDER_COLS)


def q_upsert_keep_latest(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    revised = (orders.filter(F.col("o_orderdate") >= F.lit(ORDERS_REVISED_FROM).cast("timestamp_ntz"))
               .withColumn("o_totalprice", F.col("o_totalprice") * 2)
               .withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")))
    target = orders.withColumn("o_totalprice", F.lit(0.0))
    source = orders.unionByName(revised)
    return upsert(target, source, "o_orderkey", on_duplicate="latest", order_col="o_orderdate").select(*ORDER_COLS)


def q_merge_pairs(spark, sf_dir):
    lineitem = _t(spark, sf_dir, "lineitem")
    target = (lineitem.filter(F.col("l_shipdate") < F.lit(PAIRS_LOADED_BEFORE).cast("timestamp_ntz"))
              .select(F.col("l_orderkey").alias("lead_id"), F.col("l_partkey").alias("tag_id")).distinct())
    return upsert(target, _relation(spark, sf_dir), PAIR_COLS).select(*PAIR_COLS)


def q_upsert_repeated_target_keys(spark, sf_dir):
    """The target repeats its key: every copy is updated, as MERGE does."""
    target = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    orders = _t(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit(ORDERS_SOURCE_FROM).cast("timestamp_ntz"))
    source = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("l_linenumber"),
                           F.col("o_totalprice").alias("l_quantity"), F.col("o_orderdate").alias("l_shipdate"))
    table = _scratch(spark, "repeated")
    table.append(target)
    table.merge(source, "l_orderkey")
    table.merge(source, "l_orderkey", broadcast_keys=None)  # the shuffle path: the same result
    return table.read().select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


def q_merge_late_versions(spark, sf_dir):
    """Newer versions first, then the older rows again: the newer ones stay."""
    orders = _t(spark, sf_dir, "orders").select(*ORDER_COLS)
    late = F.col("o_orderdate") >= F.lit(ORDERS_REVISED_FROM).cast("timestamp_ntz")
    newer = orders.filter(late).withColumn("o_totalprice", -F.col("o_totalprice")) \
        .withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
    table = _scratch(spark, "versions")
    table.append(newer)
    for _ in range(2):
        table.merge(orders, "o_orderkey", on_duplicate="latest", order_col="o_orderdate")
    return table.read().select(*ORDER_COLS)


def q_relation_delta_bitmap(spark, sf_dir):
    return _relation(spark, sf_dir, strategy="bitmap").select(*PAIR_COLS)


# ---------------------------------------------------------------- lake I/O
def q_merge_schema_append(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    table = _scratch(spark, "append")
    table.append(_events_before(events).select("event_id", "ts"))
    table.append(_events_from(events).select("event_id", "ts", "value"))
    return table.read().select("event_id", "ts", "value")


def q_merge_schema_overwrite(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    table = _scratch(spark, "overwrite")
    table.append(_events_before(events).select("event_id", "value"))
    table.overwrite(events.select("event_id", "ts"), merge_schema=True)
    return table.read().select("event_id", "value", "ts")


def q_relation_first_load(spark, sf_dir):
    lead, tag, rel = _relation_inputs(spark, sf_dir)
    table = _scratch(spark, "relation-first")
    jobs.relation_to_lake(lead, tag, rel, table, start=RELATION_START, end=RELATION_END)
    return table.read().select(*PAIR_COLS)


def q_staging_replace(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    staging = _scratch(spark, "staging")
    staging.replace(_events_before(events))
    rows = q_incremental_inclusive(spark, sf_dir)
    staging.replace(rows)
    staging.replace(rows)
    return staging.read().select(*EVENT_COLS)


def q_truncate_load(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    mart = _scratch(spark, "mart")
    mart.replace(_events_before(events).select(*EVENT_COLS))
    mart.truncate_load(events.select("event_id", "ts", "value"))
    return mart.read().select(*EVENT_COLS)


def _small_files_table(spark, sf_dir, name) -> LakeTable:
    table = _scratch(spark, name)
    table.replace(_t(spark, sf_dir, "orders").repartition(SMALL_FILES))
    return table


def q_compact_preserves(spark, sf_dir):
    table = _small_files_table(spark, sf_dir, "compact")
    maintenance.compact(table)
    return table.read().select(*ORDER_COLS)


def q_vacuum_plan(spark, sf_dir):
    """Every order row that lies in the table's files, with whether its file is
    removable: replaced files and those of a write that was never committed are."""
    orders = _t(spark, sf_dir, "orders").select(*ORDER_COLS)
    table = _scratch(spark, "vacuum")
    first = F.lit(ORDERS_SOURCE_FROM).cast("timestamp_ntz")
    table.append(orders.filter(F.col("o_orderdate") < first))
    table.append(orders.filter(F.col("o_orderdate") >= first))
    table.merge(orders.filter(F.col("o_orderdate") >= first).withColumn("o_totalprice", -F.col("o_totalprice")), "o_orderkey")
    table.write_segment(orders.filter(F.col("o_orderdate") < F.lit(ORDERS_TARGET_BEFORE).cast("timestamp_ntz")))
    as_of = _dt.datetime.now(_dt.timezone.utc) + _dt.timedelta(hours=2)
    plan = maintenance.vacuum_plan(table, retention_hours=1, as_of=as_of, retention_check=False)
    rows = spark.read.option("recursiveFileLookup", "true").parquet(table.path)
    rows = rows.select("o_orderkey", "o_totalprice", F.col("_metadata.file_name").alias("file"))
    return rows.join(plan.select("file", "removable"), "file").select("o_orderkey", "o_totalprice", "removable")


# ---------------------------------------------------------------- jobs
def _batch_rows(df) -> int:
    """A quarter of the table, so the jobs drain it in a fixed number of runs."""
    return max(BATCH_ROWS, -(-df.count() // 4))


def q_job_incremental_bronze(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    target = _scratch(spark, "bronze")
    rows = _batch_rows(events)
    jobs.drain(lambda: jobs.incremental_load(events, target, "ts", keys=["event_id"], max_rows=rows))
    return target.read().select(*EVENT_COLS)


def q_job_incremental_keyset(spark, sf_dir):
    """JOB-1 over a column that many rows share (the day), by key-set cursor."""
    events = _t(spark, sf_dir, "events").select(*EVENT_COLS).withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    target = _scratch(spark, "keyset")
    rows = _batch_rows(events)
    jobs.drain(lambda: jobs.incremental_load(events, target, "ts", keys=["event_id"], max_rows=rows, resume="keys"))
    return target.read().select(*EVENT_COLS)


def q_job_truncate_load_schema(spark, sf_dir):
    """JOB-7: the lake table into ``<mart>.events`` of the catalog; a table of the
    same name in another schema stays as it is, and so does the definition."""
    events = _t(spark, sf_dir, "events")
    lake = _scratch(spark, "lake")
    lake.replace(events.select("event_id", "ts", "value"))
    run = uuid.uuid4().hex[:12]
    names = [f"lakesync_{kind}_{run}" for kind in ("mart", "other")]
    for name in names:
        create_namespace(spark, name, scratch_path(spark, name))
        spark.sql(f"CREATE TABLE {name}.events (event_id BIGINT COMMENT 'id', value DOUBLE, ts TIMESTAMP_NTZ, note STRING) USING parquet")
        CatalogTable(spark, "events", schema=name).append(_events_before(events).select("event_id", "ts"))
    mart, other = (CatalogTable(spark, "events", schema=name) for name in names)
    jobs.truncate_load(lake, mart)
    tagged = lambda t, tag: t.read().select(F.lit(tag).alias("mart"), "event_id", "value", "ts", "note")
    return tagged(mart, "loaded").unionByName(tagged(other, "other"))


def q_job_daily_bronze(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    root = scratch_path(spark, "lake")
    rows = _batch_rows(events)
    jobs.drain(lambda: jobs.daily_incremental_load(spark, events, root, "bronze", "app", "events", "ts",
                                                   run_date=DAILY_RUN_DATE, keys=["event_id"], max_rows=rows))
    from lakesync.sources.lake import table_path

    return LakeTable(spark, table_path(root, "bronze", "app", "events", DAILY_RUN_DATE)).read().select(*EVENT_COLS)


def q_job_relation_to_lake(spark, sf_dir):
    lead, tag, rel = _relation_inputs(spark, sf_dir)
    table = _scratch(spark, "relation")
    for _ in range(2):
        jobs.relation_to_lake(lead, tag, rel, table, start=RELATION_START, end=RELATION_END)
    return table.read().select(*PAIR_COLS)


def q_job_full_refresh(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    table = _scratch(spark, "refresh")
    for _ in range(2):
        jobs.full_refresh(events, table)
    return table.read().select(*EVENT_COLS)


def q_job_lake_to_staging(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    lake, mart, staging = _scratch(spark, "lake"), _scratch(spark, "mart"), _scratch(spark, "staging")
    lake.replace(events)
    mart.replace(_events_before(events))
    jobs.lake_to_staging(lake, mart, staging, "ts")
    return staging.read().select(*EVENT_COLS)


def q_job_truncate_load(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    lake, mart = _scratch(spark, "lake"), _scratch(spark, "mart")
    lake.replace(events)
    mart.replace(_events_before(events).select(*EVENT_COLS))
    jobs.truncate_load(lake, mart)
    return mart.read().select(*EVENT_COLS)


def q_job_backfill(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    staging = _scratch(spark, "staging")
    jobs.backfill(events, staging, "ts", start=BACKFILL_START, as_of=BACKFILL_AS_OF, lag="1 hour")
    return staging.read().select(*EVENT_COLS)


def q_job_relation_to_staging(spark, sf_dir):
    lead, tag, rel = _relation_inputs(spark, sf_dir)
    staging = _scratch(spark, "staging")
    jobs.relation_to_staging(lead, tag, rel, staging, start=RELATION_START, end=RELATION_END)
    return staging.read().select(*PAIR_COLS)


def q_job_maintenance(spark, sf_dir):
    table = _small_files_table(spark, sf_dir, "maintain")
    table.replace(_t(spark, sf_dir, "orders").repartition(SMALL_FILES))
    jobs.maintain(table, retention_hours=0)
    return table.read().select(*ORDER_COLS)


def q_streaming_incremental_load(spark, sf_dir):
    from lakesync.streaming import stream_incremental_load

    events = _t(spark, sf_dir, "events")
    source_dir = scratch_path(spark, "landing")
    events.repartitionByRange(STREAM_FILES, "ts").write.parquet(source_dir, mode="append")
    revised = (_events_from(events).withColumn("value", F.col("value") * 2)
               .withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR")))
    revised.repartitionByRange(STREAM_FILES // 2, "ts").write.parquet(source_dir, mode="append")
    target = _scratch(spark, "streamed")
    stream_incremental_load(spark, source_dir, events.schema, target, keys=["event_id"],
                            max_files_per_trigger=STREAM_FILES // 4, order_col="ts")
    return target.read().select(*EVENT_COLS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "checkpoint_max": q_checkpoint_max,
    "checkpoint_latest": q_checkpoint_latest,
    "incremental_inclusive": q_incremental_inclusive,
    "bounded_batch_first": q_bounded_batch_first,
    "bounded_batch_next": q_bounded_batch_next,
    "bounded_batch_with_ties": q_bounded_batch_with_ties,
    "bounded_batch_events": q_bounded_batch_events,
    "bounded_batch_descent": q_bounded_batch_descent,
    "bounded_batch_with_ties_descent": q_bounded_batch_with_ties_descent,
    "previous_day_window": q_previous_day_window,
    "backfill_lag_window": q_backfill_lag_window,
    "relation_delta": q_relation_delta,
    "relation_delta_previous_day": q_relation_delta_previous_day,
    "relation_delta_semi": q_relation_delta_semi,
    "relation_delta_exists": q_relation_delta_exists,
    "upsert_by_key": q_upsert_by_key,
    "upsert_keep_latest": q_upsert_keep_latest,
    "upsert_repeated_target_keys": q_upsert_repeated_target_keys,
    "merge_late_versions": q_merge_late_versions,
    "relation_delta_bitmap": q_relation_delta_bitmap,
    "merge_pairs": q_merge_pairs,
    "merge_schema_append": q_merge_schema_append,
    "merge_schema_overwrite": q_merge_schema_overwrite,
    "relation_first_load": q_relation_first_load,
    "staging_replace": q_staging_replace,
    "truncate_load": q_truncate_load,
    "compact_preserves": q_compact_preserves,
    "vacuum_plan": q_vacuum_plan,
    "job_incremental_bronze": q_job_incremental_bronze,
    "job_incremental_keyset": q_job_incremental_keyset,
    "job_truncate_load_schema": q_job_truncate_load_schema,
    "job_daily_bronze": q_job_daily_bronze,
    "job_relation_to_lake": q_job_relation_to_lake,
    "job_full_refresh": q_job_full_refresh,
    "job_lake_to_staging": q_job_lake_to_staging,
    "job_truncate_load": q_job_truncate_load,
    "job_backfill": q_job_backfill,
    "job_relation_to_staging": q_job_relation_to_staging,
    "job_maintenance": q_job_maintenance,
    "streaming_incremental_load": q_streaming_incremental_load,
}


# ---------------------------------------------------------------- oracle SQL
_EV = "event_id, ts, user_id, event_type, value, props"
_OR = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_CP = f"(select max(ts) from events where ts < timestamp '{EVENTS_LOADED_BEFORE}')"
_RD = f"""with tag as (select l_partkey as id, max(l_shipdate) as write_date from lineitem group by l_partkey),
 cl as (select o_orderkey as id from orders where o_orderdate >= timestamp '{RELATION_START}'
        and o_orderdate < timestamp '{RELATION_END}'),
 ct as (select id from tag where write_date >= timestamp '{RELATION_START}'
        and write_date < timestamp '{RELATION_END}')
select distinct l_orderkey as lead_id, l_partkey as tag_id from lineitem
where l_orderkey in (select id from cl) or l_partkey in (select id from ct)"""
_INC = f"select {_EV} from events where ts >= {_CP}"
_B1 = f"select {_OR} from orders order by o_orderdate asc nulls last, o_orderkey asc limit {BATCH_ROWS}"
_EB1 = f"select {_EV} from events order by ts asc nulls last, event_id asc limit {BATCH_ROWS}"
_BACKFILL = (f"select {_EV} from events where ts >= timestamp '{BACKFILL_START}' "
             f"and ts < timestamp '{BACKFILL_AS_OF}' - interval '1' hour")

ORACLE_SQL: dict[str, str] = {
    "checkpoint_max": "select max(o_orderdate) as checkpoint from orders",
    "checkpoint_latest": ("select o_orderkey as checkpoint from orders "
                          "order by o_orderdate desc nulls last, o_orderkey desc limit 1"),
    "incremental_inclusive": _INC,
    "bounded_batch_first": _B1,
    "bounded_batch_next": (f"with b1 as ({_B1}) select {_OR} from orders "
                           f"where o_orderdate >= (select max(o_orderdate) from b1) "
                           f"order by o_orderdate asc nulls last, o_orderkey asc limit {BATCH_ROWS}"),
    "bounded_batch_with_ties": (f"select o_orderkey, o_orderdate from (select o_orderkey, o_orderdate, "
                                f"rank() over (order by o_orderdate asc nulls last) as r from orders) q "
                                f"where r <= {BATCH_ROWS}"),
    "bounded_batch_events": _EB1,
    "bounded_batch_descent": _EB1,
    "bounded_batch_with_ties_descent": (f"select o_orderkey, o_orderdate from (select o_orderkey, o_orderdate, "
                                        f"rank() over (order by o_orderdate asc nulls last) as r from orders) q "
                                        f"where r <= {BATCH_ROWS}"),
    "previous_day_window": (f"select {_EV} from events where ts >= timestamp '2024-01-14 00:00:00' "
                            f"and ts < timestamp '{PREVIOUS_DAY_AS_OF} 00:00:00'"),
    "backfill_lag_window": _BACKFILL,
    "relation_delta": _RD,
    "relation_delta_previous_day": _RD,
    "relation_delta_semi": _RD,
    "relation_delta_exists": _RD,
    "upsert_by_key": (f"with t as (select o_orderkey, o_custkey, o_orderstatus, cast(0 as double) as o_totalprice, "
                      f"o_orderdate, o_orderpriority from orders where o_orderdate < timestamp '{ORDERS_TARGET_BEFORE}'), "
                      f"s as (select {_OR} from orders where o_orderdate >= timestamp '{ORDERS_SOURCE_FROM}') "
                      f"select * from t where o_orderkey not in (select o_orderkey from s) "
                      f"union all select * from s"),
    "upsert_keep_latest": (f"select o_orderkey, o_custkey, o_orderstatus, "
                           f"case when o_orderdate >= timestamp '{ORDERS_REVISED_FROM}' then o_totalprice * 2 "
                           f"else o_totalprice end as o_totalprice, "
                           f"case when o_orderdate >= timestamp '{ORDERS_REVISED_FROM}' "
                           f"then o_orderdate + interval '1' day else o_orderdate end as o_orderdate, "
                           f"o_orderpriority from orders"),
    "merge_pairs": (f"with d as ({_RD}), t as (select distinct l_orderkey as lead_id, l_partkey as tag_id "
                    f"from lineitem where l_shipdate < timestamp '{PAIRS_LOADED_BEFORE}') "
                    f"select lead_id, tag_id from t where not exists (select 1 from d "
                    f"where d.lead_id = t.lead_id and d.tag_id = t.tag_id) "
                    f"union all select lead_id, tag_id from d"),
    "merge_schema_append": (f"select event_id, ts, cast(null as double) as value from events "
                            f"where ts < timestamp '{EVENTS_LOADED_BEFORE}' "
                            f"union all select event_id, ts, value from events "
                            f"where ts >= timestamp '{EVENTS_LOADED_BEFORE}'"),
    "merge_schema_overwrite": "select event_id, cast(null as double) as value, ts from events",
    "relation_delta_bitmap": _RD,
    "upsert_repeated_target_keys": (
        f"with s as (select o_orderkey, o_totalprice, o_orderdate from orders where o_orderdate >= timestamp '{ORDERS_SOURCE_FROM}') "
        f"select l_orderkey, case when o_orderkey is null then l_linenumber else 0 end as l_linenumber, "
        f"coalesce(o_totalprice, l_quantity) as l_quantity, coalesce(o_orderdate, l_shipdate) as l_shipdate "
        f"from lineitem left join s on l_orderkey = o_orderkey "
        f"union all select o_orderkey, 0, o_totalprice, o_orderdate from s "
        f"where not exists (select 1 from lineitem where l_orderkey = o_orderkey)"),
    "merge_late_versions": (
        f"select o_orderkey, o_custkey, o_orderstatus, case when o_orderdate >= timestamp '{ORDERS_REVISED_FROM}' "
        f"then -o_totalprice else o_totalprice end as o_totalprice, case when o_orderdate >= timestamp '{ORDERS_REVISED_FROM}' "
        f"then o_orderdate + interval '1' day else o_orderdate end as o_orderdate, o_orderpriority from orders"),
    "vacuum_plan": (
        f"select o_orderkey, case when o_orderdate >= timestamp '{ORDERS_SOURCE_FROM}' then -o_totalprice else o_totalprice end "
        f"as o_totalprice, false as removable from orders "
        f"union all select o_orderkey, o_totalprice, true from orders where o_orderdate >= timestamp '{ORDERS_SOURCE_FROM}' "
        f"union all select o_orderkey, o_totalprice, true from orders where o_orderdate < timestamp '{ORDERS_TARGET_BEFORE}'"),
    "job_incremental_keyset": ("select event_id, cast(date_trunc('day', ts) as timestamp) as ts, user_id, event_type, value, props "
                               "from events"),
    "job_truncate_load_schema": (
        f"select 'loaded' as mart, event_id, value, ts, cast(null as varchar) as note from events "
        f"union all select 'other', event_id, cast(null as double), ts, cast(null as varchar) from events "
        f"where ts < timestamp '{EVENTS_LOADED_BEFORE}'"),
    "relation_first_load": _RD,
    "staging_replace": _INC,
    "truncate_load": ("select event_id, ts, cast(null as bigint) as user_id, cast(null as varchar) as event_type, "
                      "value, cast(null as varchar) as props from events"),
    "compact_preserves": f"select {_OR} from orders",
    "job_incremental_bronze": f"select {_EV} from events",
    "job_daily_bronze": f"select {_EV} from events",
    "job_relation_to_lake": _RD,
    "job_full_refresh": f"select {_EV} from events",
    "job_lake_to_staging": _INC,
    "job_truncate_load": f"select {_EV} from events",
    "job_backfill": _BACKFILL,
    "job_relation_to_staging": _RD,
    "job_maintenance": f"select {_OR} from orders",
    "streaming_incremental_load": (
        f"select event_id, case when ts >= timestamp '{EVENTS_LOADED_BEFORE}' then ts + interval '1' hour "
        f"else ts end as ts, user_id, event_type, case when ts >= timestamp '{EVENTS_LOADED_BEFORE}' "
        f"then value * 2 else value end as value, props from events"),
}
