"""JOB-1..JOB-10 behaviour beyond the oracle queries: convergence, E2/E4/E9/E13."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakesync.operators.upsert import DuplicateKeyError
from lakesync.plans import jobs
from lakesync.sources.lake import LakeTable, TableNotFound
from tests.conftest import SF_SMALL


def test_repeated_bounded_batches_converge_to_the_source(spark, scratch):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    target = LakeTable(spark, scratch("converge"))
    total = events.count()
    runs = 0
    while runs < 20:
        jobs.incremental_load(events, target, "ts", keys=["event_id"], max_rows=300)
        runs += 1
        if target.read().count() == total:
            break
    assert runs == 4  # 300, 599, 898, 1000 rows: each run re-reads its boundary row
    got = target.read().select(*events.columns)
    assert got.exceptAll(events).count() == 0


def test_checkpoint_value_differs_from_order_column(spark, scratch):
    # E4 / order_differs_from_value: the value of the newest row, not the max value
    target = LakeTable(spark, scratch("e4"))
    target.append(spark.createDataFrame(
        [(1, "2024-01-05", "2024-01-01"), (2, "2024-01-02", "2024-01-09")],
        "id long, create_date string, write_date string")
        .selectExpr("id", "cast(create_date as timestamp_ntz) create_date",
                    "cast(write_date as timestamp_ntz) write_date"))
    cp = target.latest_value("create_date", order_col="write_date")
    assert cp.value == dt.datetime(2024, 1, 2)


def test_existing_target_with_falsy_checkpoint_is_merged(spark, scratch):
    # E2: an existing target is upserted even when its checkpoint is 0
    target = LakeTable(spark, scratch("e2"))
    target.append(spark.createDataFrame([(1, 0, "old")], "id long, seq int, v string"))
    source = spark.createDataFrame([(1, 0, "new"), (2, 1, "x")], "id long, seq int, v string")
    report = jobs.incremental_load(source, target, "seq", keys=["id"])
    assert report.mode == "merge"
    assert sorted(tuple(r) for r in target.read().collect()) == [(1, 0, "new"), (2, 1, "x")]


def test_relation_job_only_creates_on_missing_table(spark, scratch):
    lead = spark.createDataFrame([(1, "2024-01-14 10:00:00")], "id long, write_date string") \
        .selectExpr("id", "cast(write_date as timestamp_ntz) write_date")
    rel = spark.createDataFrame([(1, 5)], "lead_id long, tag_id long")
    target = LakeTable(spark, scratch("e9"))
    assert jobs.relation_to_lake(lead, lead.limit(0), rel, target, as_of="2024-01-15").mode == "create"
    # E9: a schema conflict raises and keeps the table, instead of overwriting it
    bad_rel = spark.createDataFrame([("1", 5)], "lead_id string, tag_id long")
    with pytest.raises(Exception):
        jobs.relation_to_lake(lead, lead.limit(0), bad_rel, target, as_of="2024-01-15")
    assert [tuple(r) for r in target.read().collect()] == [(1, 5)]


def test_lake_to_staging_requires_mart_table(spark, scratch):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    lake, mart, staging = (LakeTable(spark, scratch(n)) for n in ("l", "m", "s"))
    lake.replace(events)
    with pytest.raises(TableNotFound):  # E13
        jobs.lake_to_staging(lake, mart, staging, "ts")
    mart.replace(events.limit(0))  # empty mart -> everything is loaded
    jobs.lake_to_staging(lake, mart, staging, "ts")
    assert staging.read().count() == events.count()


def test_backfill_window_edges(spark, scratch):
    rows = [(1, "2024-01-10 00:00:00"), (2, "2024-01-09 23:59:59.999999"),
            (3, "2024-01-19 22:59:59.999999"), (4, "2024-01-19 23:00:00")]
    src = spark.createDataFrame(rows, "id long, write_date string") \
        .select("id", F.col("write_date").cast("timestamp_ntz").alias("write_date"))
    staging = LakeTable(spark, scratch("backfill"))
    jobs.backfill(src, staging, start="2024-01-10 00:00:00", as_of="2024-01-20 00:00:00")
    assert sorted(r["id"] for r in staging.read().collect()) == [1, 3]


def test_daily_job_starts_each_day_from_the_oldest_rows(spark, scratch):
    # E8: a new day's table does not exist yet, so its first run loads the
    # oldest rows of the whole source, under the date-suffixed path.
    from lakesync.sources.lake import table_path

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    root = scratch("lake")
    for day in ("2024-01-15", "2024-01-16"):
        report = jobs.daily_incremental_load(spark, events, root, "bronze", "app", "events", "ts",
                                             run_date=day, keys=["event_id"], max_rows=10)
        assert report.mode == "append" and report.checkpoint is None
        t = LakeTable(spark, table_path(root, "bronze", "app", "events", day))
        assert t.path.endswith(f"/bronze/app_daily/events_{day}")
        assert sorted(r["event_id"] for r in t.read().collect()) == list(range(10))


def test_full_refresh_keeps_old_columns_as_null(spark, scratch):
    t = LakeTable(spark, scratch("refresh"))
    jobs.full_refresh(spark.createDataFrame([(1, "a", 1.0)], "id long, v string, old double"), t)
    jobs.full_refresh(spark.createDataFrame([(2, "b")], "id long, v string"), t)
    assert t.read().columns == ["id", "v", "old"]
    assert [tuple(r) for r in t.read().collect()] == [(2, "b", None)]


def test_load_advances_through_ties_larger_than_a_batch(spark, scratch):
    rows = [(i, 1) for i in range(8)] + [(8, 2)]
    source = spark.createDataFrame(rows, "id long, seq int")
    target = LakeTable(spark, scratch("ties"))
    jobs.drain(lambda: jobs.incremental_load(source, target, "seq", keys=["id"], max_rows=3))
    assert sorted(tuple(r) for r in target.read().collect()) == rows


def test_first_load_with_a_repeated_key_raises(spark, scratch):
    source = spark.createDataFrame([(1, 1), (1, 2)], "id long, seq int")
    with pytest.raises(DuplicateKeyError):
        jobs.incremental_load(source, LakeTable(spark, scratch("first")), "seq", keys=["id"])


def test_key_set_cursor_reads_a_long_tie_once(spark, scratch):
    # one value shared by 50 batches
    source = spark.range(200).select("id", F.lit(1).alias("seq")).unionByName(spark.createDataFrame([(500, 2), (501, 0)], "id long, seq int"))
    read = []

    def load(target, resume):
        report = jobs.incremental_load(source, target, "seq", keys=["id"], max_rows=4, resume=resume)
        read.append(report.details["batch"].count())
        return report

    target = LakeTable(spark, scratch("cursor"))
    target.append(source.limit(0))
    runs = 0
    while load(target, "keys").details["advanced"]:
        runs += 1
    assert runs == 51 and sum(read) == 202
    assert sorted(r["id"] for r in target.read().collect()) == [*range(200), 500, 501]
    with pytest.raises(ValueError):
        load(target, "rows")


def test_lake_to_catalog_schemas(spark, scratch):
    import uuid

    from lakesync.sources.catalog import CatalogTable, create_namespace

    run = uuid.uuid4().hex[:8]
    for name in ("a", "b"):
        create_namespace(spark, f"mart_{name}_{run}", scratch("ns"))
        spark.sql(f"CREATE TABLE mart_{name}_{run}.t (id BIGINT COMMENT 'the key', v STRING, n INT) USING parquet "
                  "COMMENT 'kept' TBLPROPERTIES ('team' = 'x')")
    first, second = (CatalogTable(spark, "t", schema=f"mart_{n}_{run}") for n in ("a", "b"))
    for t in (first, second):
        t.append(spark.createDataFrame([("old", 1)], "v string, id long"))  # by name
    lake = LakeTable(spark, scratch("lake"))
    lake.replace(spark.createDataFrame([("x", 7), ("y", 8)], "V string, id long"))
    jobs.truncate_load(lake, first)
    assert sorted(tuple(r) for r in first.read().collect()) == [(7, "x", None), (8, "y", None)]
    assert [tuple(r) for r in second.read().collect()] == [(1, "old", None)]
    described = {r["col_name"]: (r["data_type"], r["comment"]) for r in spark.sql(f"DESCRIBE EXTENDED {first.name}").collect()}
    assert described["id"] == ("bigint", "the key") and described["Comment"][0] == "kept" and "team=x" in described["Table Properties"][0]
    lake.replace(spark.createDataFrame([(1, 2)], "id long, zzz int"))
    with pytest.raises(ValueError):  # checked before the table is emptied
        jobs.truncate_load(lake, first)
    assert first.read().count() == 2
    # staging replace takes the rows' definition, and may read the table it replaces
    first.replace(first.read().select("id"))
    assert first.read().columns == ["id"] and first.read().count() == 2
    jobs.lake_to_staging(LakeTable(spark, lake.path), second, CatalogTable(spark, "s", schema=f"mart_a_{run}"), "id")
    with pytest.raises(TableNotFound):
        CatalogTable(spark, "none", schema=f"mart_a_{run}").read()
    with pytest.raises(ValueError):
        CatalogTable(spark, "t; drop table x")
