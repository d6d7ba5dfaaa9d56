"""Hot keys: one value holding a third of all rows, on the shuffle paths."""

from pyspark.sql import functions as F

from lakesync.operators.batch import first_rows, first_rows_sorted
from lakesync.operators.relation import relation_delta
from lakesync.operators.upsert import latest_per_key, upsert
from tests.conftest import SF_CHECK

WINDOW = dict(start="2001-07-31 00:00:00", end="2001-08-01 00:00:00")


def _skewed_relation(spark):
    lineitem = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    # a third of the link rows point at one hot tag
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_partkey"))
    rel = lineitem.select(F.col("l_orderkey").alias("lead_id"), hot.alias("tag_id"))
    lead = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("write_date"))
    tag = lineitem.select(hot.alias("id"), F.col("l_shipdate")).groupBy("id") \
        .agg(F.max("l_shipdate").alias("write_date"))
    return lead, tag, rel


def test_relation_hot_tag_semi_equals_exists(spark):
    lead, tag, rel = _skewed_relation(spark)
    spark.conf.set("lakesync.relation.broadcastIds", "0")
    try:
        auto = relation_delta(lead, tag, rel, **WINDOW)  # counted ids exceed 0 -> semi
        plan = auto._jdf.queryExecution().executedPlan().toString()
        assert "ExistenceJoin" not in plan
    finally:
        spark.conf.unset("lakesync.relation.broadcastIds")
    exists = relation_delta(lead, tag, rel, strategy="exists", **WINDOW)
    assert auto.count() == exists.count() > 0
    assert auto.exceptAll(exists).count() == 0


def test_upsert_shuffle_path_with_a_third_null_keys(spark):
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    key = F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("o_orderkey"))
    target = orders.withColumn("o_orderkey", key)
    source = orders.filter("o_orderdate >= timestamp'2000-01-01'").withColumn("o_totalprice", F.lit(-1.0))
    shuffled = upsert(target, source, "o_orderkey", broadcast_keys=None)
    broadcast = upsert(target, source, "o_orderkey")
    assert shuffled.count() == broadcast.count()
    assert shuffled.exceptAll(broadcast).count() == 0
    assert shuffled.filter(F.col("o_orderkey").isNull()).count() == target.filter(F.col("o_orderkey").isNull()).count()


def test_keep_latest_with_one_hot_key(spark):
    events = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")))
    latest = latest_per_key(hot, "user_id", "ts")
    want = hot.groupBy("user_id").agg(F.max("ts").alias("ts"))
    assert latest.count() == want.count()
    assert latest.select("user_id", "ts").exceptAll(want).count() == 0


def test_bounded_batch_on_a_hot_order_value(spark):
    events = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    day = F.lit("2024-01-05").cast("timestamp_ntz")
    hot = events.withColumn("ts", F.when(F.col("event_id") % 3 == 0, day).otherwise(F.col("ts")))
    for n in [100, 2000, 5000]:
        got = first_rows(hot, "ts", n, keys=["event_id"], exact_rows=64)
        want = first_rows_sorted(hot, "ts", n, keys=["event_id"])
        assert got.count() == n
        assert got.exceptAll(want).count() == 0


def _hot_pairs(spark):
    lineitem = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet")
    # a third of the target rows are copies of one pair
    hot = F.col("l_orderkey") % 3 == 0
    return lineitem.select(F.when(hot, F.lit(1)).otherwise(F.col("l_orderkey")).alias("lead_id"),
                           F.when(hot, F.lit(1)).otherwise(F.col("l_partkey")).alias("tag_id"))


def test_insert_missing_with_one_hot_target_key(spark):
    from lakesync.operators.upsert import insert_missing

    target = _hot_pairs(spark)
    source = spark.createDataFrame([(1, 1), (1, 2), (10**9, 5)], "lead_id long, tag_id long")
    shuffled = insert_missing(target, source, ["lead_id", "tag_id"], broadcast_keys=None)
    broadcast = insert_missing(target, source, ["lead_id", "tag_id"])
    want = source.exceptAll(target.distinct())
    for got in (shuffled, broadcast):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = shuffled._jdf.queryExecution().executedPlan().toString()
    # the target keys are reduced before their exchange, so the hot pair crosses it once per task
    assert plan.index("HashAggregate") < plan.rindex("Exchange hashpartitioning") or "BroadcastExchange" in plan


def test_merge_decision_with_one_hot_target_key(spark, scratch):
    from lakesync.sources.lake import LakeTable

    table = LakeTable(spark, scratch("hot-merge"))
    table.append(_hot_pairs(spark).withColumn("flag", F.lit("a")))
    # the hot pair re-read unchanged plus a new pair: appended, no rewrite
    source = spark.createDataFrame([(1, 1, "a"), (10**9, 5, "n")], "lead_id long, tag_id long, flag string")
    assert table.merge(source, ["lead_id", "tag_id"], on_duplicate="allow") == "append"
    assert table.read().filter("lead_id = 1000000000").count() == 1
    # a changed value on the hot pair forces a rewrite
    changed = spark.createDataFrame([(1, 1, "b")], "lead_id long, tag_id long, flag string")
    assert table.merge(changed, ["lead_id", "tag_id"]) == "rewrite"
    # every copy of the matched key is updated, as in MERGE
    copies = _hot_pairs(spark).filter("lead_id = 1 and tag_id = 1").count()
    assert [r["flag"] for r in table.read().filter("lead_id = 1 and tag_id = 1").collect()] == ["b"] * copies
