"""Snapshot lake tables: SRC-1, SRC-5..7, SNK-1, SNK-2, DML-3, MNT-1, MNT-2."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakesync.operators import maintenance
from lakesync.sources.lake import LakeTable, TableNotFound, table_path
from tests.conftest import SF_CHECK


def test_paths():
    assert table_path("s3a://b", "ds", "crm", "lead") == "s3a://b/ds/crm/lead"
    assert table_path("s3a://b/", "ds", "crm", "lead", run_date=dt.date(2024, 1, 5)) == \
        "s3a://b/ds/crm_daily/lead_2024-01-05"


def test_missing_and_empty_targets(spark, scratch):
    t = LakeTable(spark, scratch("missing"))
    assert not t.exists() and t.read_or_none() is None and t.latest_value("id") is None
    with pytest.raises(TableNotFound):
        t.read()
    t.append(spark.createDataFrame([], "id long, write_date timestamp_ntz"))
    assert t.exists() and t.read().count() == 0
    assert t.latest_value("id", "write_date") is None  # E3: empty target -> None


def test_append_merges_schema_and_rejects_type_change(spark, scratch):
    t = LakeTable(spark, scratch("append"))
    t.append(spark.createDataFrame([(1, "a")], "id long, v string"))
    t.append(spark.createDataFrame([(2, "b", 3)], "id long, v string, w int"))
    rows = sorted(tuple(r) for r in t.read().select("id", "v", "w").collect())
    assert rows == [(1, "a", None), (2, "b", 3)]
    with pytest.raises(TypeError):
        t.append(spark.createDataFrame([("x",)], "id string"))


def test_overwrite_keeps_old_columns_as_null(spark, scratch):
    t = LakeTable(spark, scratch("overwrite"))
    t.append(spark.createDataFrame([(1, 1.5)], "id long, v double"))
    t.overwrite(spark.createDataFrame([(2, "b")], "id long, w string"))
    assert t.read().columns == ["id", "v", "w"]
    assert [tuple(r) for r in t.read().collect()] == [(2, None, "b")]


def test_failed_write_leaves_previous_snapshot(spark, scratch):
    t = LakeTable(spark, scratch("failing"))
    t.append(spark.createDataFrame([(1, 1)], "id long, v int"))
    bad = spark.range(5).select(F.col("id"), F.assert_true(F.col("id") < 2).cast("int").alias("v"))
    with pytest.raises(Exception):
        t.overwrite(bad)
    assert [tuple(r) for r in t.read().collect()] == [(1, 1)]
    t.overwrite(spark.createDataFrame([(2, 2)], "id long, v int"))
    assert [tuple(r) for r in t.read().collect()] == [(2, 2)]


def test_truncate_load_checks_columns_first(spark, scratch):
    t = LakeTable(spark, scratch("mart"))
    t.replace(spark.createDataFrame([(1, "a")], "id long, v string"))
    with pytest.raises(ValueError):
        t.truncate_load(spark.createDataFrame([(2, "b", 1)], "id long, v string, zzz int"))
    assert t.read().count() == 1
    t.truncate_load(spark.createDataFrame([(3,)], "id long"))
    assert [tuple(r) for r in t.read().collect()] == [(3, None)]


def _names(table):
    return {f.rsplit("/", 1)[1] for f in table.read().inputFiles()} - set(table.current().replaced)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_compaction_and_vacuum(spark, scratch):
    t = LakeTable(spark, scratch("maint"))
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    t.replace(orders.repartition(64))
    before = maintenance.compaction_plan(t)
    assert before["files"] == 64 and before["needed"]
    maintenance.compact(t)
    after = maintenance.compaction_plan(t)
    assert after["files"] == 1 and not after["needed"]
    assert _same(t.read(), orders)
    # retention not yet passed: nothing removable
    with pytest.raises(ValueError):  # retention check on by default
        maintenance.vacuum(t, retention_hours=1)
    assert maintenance.vacuum(t, retention_hours=1, retention_check=False) == []
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=2)
    plan = maintenance.vacuum_plan(t, retention_hours=1, as_of=later, retention_check=False)
    assert plan.filter("removable and live").count() == 0
    assert plan.filter("removable").count() == 64
    removed = maintenance.vacuum(t, retention_hours=1, as_of=later, retention_check=False)
    assert len(removed) == 1 and not os.path.exists(removed[0].replace("file:", ""))
    assert t.read().count() == orders.count()
    with pytest.raises(ValueError):
        maintenance.vacuum_plan(t, retention_hours=-1, retention_check=False)


def test_compaction_carries_large_files_over(spark, scratch):
    t = LakeTable(spark, scratch("carry"))
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    t.append(orders.coalesce(1))
    large = _names(t)
    for i in range(6):
        t.append(orders.filter(F.col("o_orderkey") % 6 == i).coalesce(1))
    size = maintenance.compaction_plan(t)["bytes"]
    plan = maintenance.compact(t, target_file_bytes=size // 2)
    assert plan["small_files"] == 6 and len(large & _names(t)) == 1 and len(_names(t)) < 7
    assert _same(t.read(), orders.unionByName(orders))


def test_merge_rewrites_only_files_with_a_changed_row(spark, scratch):
    t = LakeTable(spark, scratch("touched"))
    rows = spark.range(0, 8000, 1, 8).select("id", (F.col("id") % 10).alias("v"))
    t.append(rows)
    before = _names(t)
    assert len(before) == 8
    assert t.merge(spark.createDataFrame([(5, 99)], "id long, v long"), "id") == "rewrite"
    kept = before & _names(t)
    assert len(kept) == 7 and t.read().count() == 8000
    # the same for a source too large to broadcast
    assert t.merge(spark.createDataFrame([(7500, 99), (9000, 1)], "id long, v long"), "id", broadcast_keys=None) == "rewrite"
    assert len(kept & _names(t)) == 6
    got = {r["id"]: r["v"] for r in t.read().collect()}
    assert got == {**{i: i % 10 for i in range(8000)}, 5: 99, 7500: 99, 9000: 1}
    # nothing to change: no file is replaced
    now = _names(t)
    assert t.merge(spark.createDataFrame([(5, 99), (9001, 2)], "id long, v long"), "id") == "append"
    assert now <= _names(t)


def test_replaced_files_are_pruned_when_listed(spark, scratch):
    t = LakeTable(spark, scratch("pruned"))
    t.append(spark.range(0, 100, 1, 4).select("id", F.lit(0).alias("v")))
    t.merge(spark.createDataFrame([(i, 1) for i in range(25)], "id long, v int"), "id")
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: [NOT (file_name" in plan
    # the replaced file may even be gone
    removed = maintenance.vacuum(t, 0, as_of=dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1), retention_check=False)
    assert len(removed) == 1 and removed[0].endswith(".parquet")
    assert t.read().count() == 100 and t.read().filter("v = 1").count() == 25


def test_a_write_that_ends_before_its_commit_is_invisible_and_vacuumed(spark, scratch, monkeypatch):
    from lakesync.sources import files

    t = LakeTable(spark, scratch("crash"))
    t.append(spark.createDataFrame([(1, "a")], "id long, v string"))

    def ended(*_):
        raise KeyboardInterrupt("the job ends here")

    for write in (lambda: t.append(spark.createDataFrame([(2, "b")], "id long, v string")),
                  lambda: t.merge(spark.createDataFrame([(1, "z")], "id long, v string"), "id"),
                  lambda: t.overwrite(spark.createDataFrame([(3, "c")], "id long, v string"))):
        with monkeypatch.context() as m:
            m.setattr(files, "write_new", ended)
            with pytest.raises(KeyboardInterrupt):
                write()
        assert [tuple(r) for r in t.read().collect()] == [(1, "a")]
    # a write that ends while its tasks write leaves no commit either
    bad = spark.range(5).select("id", F.assert_true(F.col("id") < 2).cast("string").alias("v"))
    with pytest.raises(Exception):
        t.append(bad)
    # a commit file cut short does not count
    n = t.current().n + 1
    with open(f"{t.path.replace('file:', '')}/_commits/{n:020d}.json", "w") as f:
        f.write('{"segments": {"segm')
    assert [tuple(r) for r in t.read().collect()] == [(1, "a")]
    assert len(files.child_dirs(spark, t.path)) == 6  # the live segment, four others, _commits
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=2)
    assert len(maintenance.vacuum(t, 1, as_of=later, retention_check=False)) == 4
    assert len(files.child_dirs(spark, t.path)) == 2
    t.append(spark.createDataFrame([(2, "b")], "id long, v string"))
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "a"), (2, "b")]


def test_two_writers_on_one_version_conflict(spark, scratch):
    from lakesync.sources.lake import CommitConflict

    t = LakeTable(spark, scratch("writers"))
    t.append(spark.createDataFrame([(1,)], "id long"))
    base = t.current()
    t.append(spark.createDataFrame([(2,)], "id long"))
    with pytest.raises(CommitConflict):
        t.replace_files(base, [], spark.createDataFrame([(3,)], "id long"))
    assert sorted(r["id"] for r in t.read().collect()) == [1, 2]


def test_column_names_that_differ_in_case_are_one_column(spark, scratch):
    t = LakeTable(spark, scratch("case"))
    t.append(spark.createDataFrame([(1, "a")], "Id long, V string"))
    t.append(spark.createDataFrame([("b", 2)], "v string, ID long"))
    t.merge(spark.createDataFrame([(2, "c"), (3, "d")], "id long, v string"), "Id")
    assert t.read().columns == ["Id", "V"]
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "a"), (2, "c"), (3, "d")]
    t.overwrite(spark.createDataFrame([(4,)], "ID long"))
    assert [tuple(r) for r in t.read().collect()] == [(4, None)]
    with pytest.raises(TypeError):
        t.append(spark.createDataFrame([("x",)], "id string"))


def test_an_older_version_never_replaces_a_newer_one(spark, scratch):
    t = LakeTable(spark, scratch("older"))
    rows = lambda *r: spark.createDataFrame(list(r), "id long, seq int, v string")
    t.append(rows((1, 5, "new"), (2, None, "unknown")))
    latest = dict(on_duplicate="latest", order_col="seq")
    for bk in (1000, None):
        t.merge(rows((1, 4, "old"), (2, 1, "known"), (3, 1, "x")), "id", broadcast_keys=bk, **latest)
        assert sorted(tuple(r) for r in t.read().collect()) == [(1, 5, "new"), (2, 1, "known"), (3, 1, "x")]
    t.merge(rows((1, 6, "newer"), (1, 2, "older")), "id", **latest)
    assert t.read().filter("id = 1").first()["v"] == "newer"


def test_merge_appends_when_no_existing_row_changes(spark, scratch):
    t = LakeTable(spark, scratch("fastpath"))
    t.append(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"))
    # boundary row re-read unchanged + one new row: append only
    assert t.merge(spark.createDataFrame([(2, "b"), (3, "c")], "id long, v string"), "id") == "append"
    assert not t.current().replaced
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "a"), (2, "b"), (3, "c")]
    # a changed row replaces its file
    assert t.merge(spark.createDataFrame([(2, "B"), (None, "n")], "id long, v string"), "id") == "rewrite"
    assert t.current().replaced
    assert sorted((tuple(r) for r in t.read().collect()), key=repr) == \
        sorted([(1, "a"), (2, "B"), (3, "c"), (None, "n")], key=repr)
    # NULL-safe comparison: a NULL value equal to NULL is no change
    t.merge(spark.createDataFrame([(4, None)], "id long, v string"), "id")
    assert t.merge(spark.createDataFrame([(4, None)], "id long, v string"), "id") == "append"
    assert t.read().count() == 5


def test_schema_of_the_table_is_that_of_its_commit(spark, scratch):
    t = LakeTable(spark, scratch("schema"))
    t.append(spark.createDataFrame([(1, "a")], "id long, v string"))
    t.append(spark.createDataFrame([(2, "b")], "id long, v string"))
    t.append(spark.createDataFrame([(3,)], "id long"))
    t.append(spark.createDataFrame([(4, 1.5)], "id long, w double"))
    assert t.read().columns == ["id", "v", "w"]
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "a", None), (2, "b", None), (3, None, None), (4, None, 1.5)]


def test_compaction_skips_files_near_target_size(spark, scratch):
    t = LakeTable(spark, scratch("big-files"))
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    t.replace(orders.repartition(4))
    size = maintenance.compaction_plan(t)["bytes"]
    plan = maintenance.compaction_plan(t, target_file_bytes=size // 4 + 1)
    assert plan["small_files"] == 0 and not plan["needed"]
    assert maintenance.compact(t, target_file_bytes=size // 4 + 1)["version"] == t.current()
    assert len(t.versions()) == 1
