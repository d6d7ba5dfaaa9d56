"""CTE-1 / JOIN-1 / FLT-5 / AGG-2 changed-relation detection."""

import pytest
from pyspark.sql import functions as F

from lakesync.functions.windows import between_half_open, lagged_range
from lakesync.operators.relation import relation_delta, touched_pairs
from lakesync.registry import _relation
from tests.conftest import SF_CHECK


def _pairs(df):
    return sorted(((r["lead_id"], r["tag_id"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("strategy", ["exists", "semi", "auto"])
def test_pair_nulls(spark, strategy):
    rel = spark.createDataFrame([(None, 1), (2, None), (None, None), (2, 1), (2, 1), (3, 3)],
                                "lead_id long, tag_id long")
    leads = spark.createDataFrame([(2,)], "id long")
    tags = spark.createDataFrame([(1,)], "id long")
    got = _pairs(touched_pairs(rel, "lead_id", "tag_id", leads, tags, strategy=strategy))
    assert got == sorted([(None, 1), (2, None), (2, 1)], key=repr)


def test_strategies_agree_on_driver_tables(spark):
    a = _relation(spark, SF_CHECK, "exists")
    b = _relation(spark, SF_CHECK, "semi")
    assert a.count() == b.count() == 291
    assert a.exceptAll(b).count() == 0


def test_previous_day_uses_as_of(spark):
    lead = spark.createDataFrame([(1, "2024-01-14 00:00:00"), (2, "2024-01-15 00:00:00"),
                                  (3, "2024-01-13 23:59:59.999999")], "id long, write_date string") \
        .selectExpr("id", "cast(write_date as timestamp_ntz) as write_date")
    tag = lead.limit(0)
    rel = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "lead_id long, tag_id long")
    got = _pairs(relation_delta(lead, tag, rel, as_of="2024-01-15"))
    assert got == [(1, 10)]


def test_plans(spark):
    exists_plan = _relation(spark, SF_CHECK, "exists")._jdf.queryExecution().executedPlan().toString()
    assert "ExistenceJoin" in exists_plan and "BroadcastNestedLoopJoin" not in exists_plan
    semi_plan = _relation(spark, SF_CHECK, "semi")._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in semi_plan and "BroadcastNestedLoopJoin" not in semi_plan


def test_checkpoint_plans(spark):
    from lakesync.registry import q_checkpoint_latest, q_checkpoint_max

    top1 = q_checkpoint_latest(spark, SF_CHECK)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=1" in top1
    agg = q_checkpoint_max(spark, SF_CHECK)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in agg and "ReadSchema: struct<o_orderdate:timestamp_ntz>" in agg


def test_windows_open_on_one_side(spark):
    df = spark.createDataFrame([(1, "2024-01-14"), (2, "2024-01-16"), (3, None)], "id long, d string").selectExpr("id", "cast(d as timestamp_ntz) d")
    ids = lambda cond: sorted(r.id for r in df.filter(cond).collect())
    assert ids(between_half_open(df, "d", "2024-01-15", None)) == [2]
    assert ids(between_half_open(df, "d", None, "2024-01-15")) == [1]
    assert ids(lagged_range(df, "d", None, "2024-01-16 01:00:01")) == [1, 2]


def test_bitmaps_hold_exactly_the_touched_pairs_before_the_shuffle(spark):
    from lakesync.operators.relation import touched_pairs

    big = 10 ** 12
    rel = spark.range(0, 20000, 1, 4).select((F.col("id") * 37 % 9000 - 50).alias("l"), (F.col("id") + big).alias("r"))
    rel = rel.unionByName(spark.createDataFrame([(None, big + 3), (5, None), (None, None)], "l long, r long"))
    left = spark.createDataFrame([(i,) for i in (-50, -1, 0, 7, 8, 32767, 8949, None)], "id long")
    right = spark.createDataFrame([(big + i,) for i in (3, 19999, 20000)], "id long")
    want = touched_pairs(rel, "l", "r", left, right, strategy="exists")
    spark.conf.set("lakesync.relation.broadcastIds", "1")
    try:
        got = touched_pairs(rel, "l", "r", left, right)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "bitmap" in plan and "LeftSemi" not in plan
        # every row that reaches the DISTINCT's exchange is a touched pair
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() > 10
        kept = touched_pairs(rel, "l", "r", left, right, strategy="bitmap")
        before_exchange = kept._jdf.queryExecution().optimizedPlan().toString()
        assert before_exchange.index("Aggregate") < before_exchange.index("Filter")
        spark.conf.set("lakesync.relation.bitmapBytes", "4096")
        semi = touched_pairs(rel, "l", "r", left, right)
        assert "LeftSemi" in semi._jdf.queryExecution().executedPlan().toString()
        assert semi.exceptAll(want).count() == 0 and want.exceptAll(semi).count() == 0
    finally:
        spark.conf.unset("lakesync.relation.broadcastIds")
        spark.conf.unset("lakesync.relation.bitmapBytes")
