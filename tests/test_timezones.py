"""E16: checkpoint values round-trip exactly, also for session-time-zone
timestamps inside a repeated daylight-saving hour."""

from pyspark.sql import functions as F

from lakesync.functions.windows import since
from lakesync.operators.batch import first_rows
from lakesync.operators.checkpoint import latest_checkpoint

FIRST_0130 = 1730622600   # 2024-11-03 01:30 PDT
SECOND_0130 = 1730626200  # 2024-11-03 01:30 PST, one hour later, same wall clock


def _frame(spark):
    secs = [FIRST_0130 - 60, FIRST_0130, SECOND_0130 - 1, SECOND_0130, SECOND_0130 + 60]
    return (spark.createDataFrame([(i, s) for i, s in enumerate(secs)], "id long, s long")
            .select("id", F.timestamp_seconds("s").alias("write_date")))


def test_ltz_checkpoint_in_repeated_hour(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = _frame(spark)
        cp = latest_checkpoint(df.filter(F.col("id") <= 3), "write_date")
        got = sorted(r["id"] for r in df.filter(since(df, "write_date", cp.lit())).collect())
        assert got == [3, 4]
        for exact_rows in (100, 1):  # one top-k, and the percentile descent
            first = sorted(r["id"] for r in first_rows(df, "write_date", 4, keys=["id"],
                                                       exact_rows=exact_rows).collect())
            assert first == [0, 1, 2, 3]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
