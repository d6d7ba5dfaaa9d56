"""TOP-2 bounded batches: the distributed n-th-key search against brute force."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakesync.operators.batch import bounded_batch, first_rows, first_rows_sorted, nth_sort_key
from lakesync.operators.checkpoint import latest_checkpoint
from tests.conftest import SF_CHECK


def _brute(rows, n, with_ties=False):
    """First n rows by (v asc nulls last, id asc); with ties: all rows <= n-th v."""
    key = lambda r: (r[1] is None, r[1] if r[1] is not None else 0, r[0])
    ordered = sorted(rows, key=key)
    if n >= len(ordered):
        return sorted(rows)
    if not with_ties:
        return sorted(ordered[:n])
    cut = key(ordered[n - 1])[:2]
    return sorted(r for r in rows if key(r)[:2] <= cut)


def _ids(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


@pytest.mark.parametrize("exact_rows", [1, 7, 1000])
@pytest.mark.parametrize("with_ties", [False, True])
def test_matches_brute_force_with_nulls_and_ties(spark, exact_rows, with_ties):
    rows = [(i, (i * 7) % 13 if i % 5 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, v long")
    for n in [1, 2, 13, 50, 157, 160, 161, 199, 200, 250]:
        got = _ids(first_rows(df, "v", n, keys=["id"], with_ties=with_ties, exact_rows=exact_rows))
        assert got == _brute(rows, n, with_ties), (n, exact_rows, with_ties)


def test_sampled_bracket_for_strings(spark):
    rows = [(i, f"k{(i * 31) % 97:03d}") for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v string")
    for n in [1, 100, 333, 499]:
        got = sorted((r["id"], r["v"]) for r in first_rows(df, "v", n, keys=["id"], exact_rows=5).collect())
        want = sorted(sorted(rows, key=lambda r: (r[1], r[0]))[:n])
        assert got == want


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=60), st.integers(1, 70),
       st.sampled_from([1, 3, 100]))
def test_property_first_rows(spark, values, n, exact_rows):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "id long, v long")
    assert _ids(first_rows(df, "v", n, keys=["id"], exact_rows=exact_rows)) == _brute(rows, n)


def test_timestamp_percentile_path_on_driver_table(spark):
    events = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    for n in [1, 999, 5000]:
        got = first_rows(events, "ts", n, keys=["event_id"], exact_rows=50)
        want = first_rows_sorted(events, "ts", n, keys=["event_id"])
        assert got.count() == n
        assert got.exceptAll(want).count() == 0


def test_tied_checkpoint_plain_and_with_ties(spark):
    # E5/E6: five rows share one write_date, batch size 3
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, t) for i in [5, 3, 9, 1, 7]], "id long, write_date timestamp_ntz")
    plain = sorted(r["id"] for r in first_rows(df, "write_date", 3, keys=["id"]).collect())
    assert plain == [1, 3, 5]
    ties = sorted(r["id"] for r in first_rows(df, "write_date", 3, with_ties=True).collect())
    assert ties == [1, 3, 5, 7, 9]


def test_null_checkpoint_rows_last_then_excluded(spark):
    # E7: NULL write_date rows come last in the first batch and never pass >=
    rows = [(1, dt.datetime(2024, 1, 1)), (2, None), (3, dt.datetime(2024, 1, 2)), (4, None)]
    df = spark.createDataFrame(rows, "id long, write_date timestamp_ntz")
    first = sorted(r["id"] for r in bounded_batch(df, "write_date", 3).collect())
    assert first == [1, 2, 3]
    cp = latest_checkpoint(df.filter(F.col("id").isin(first)), "write_date")
    nxt = sorted(r["id"] for r in bounded_batch(df, "write_date", 3, checkpoint=cp).collect())
    assert nxt == [3]


def test_falsy_checkpoint_is_a_checkpoint(spark):
    # E2: checkpoint 0 filters (>= 0) instead of meaning "first load"
    df = spark.createDataFrame([(1, -1), (2, 0), (3, 1)], "id long, seq int")
    got = sorted(r["id"] for r in bounded_batch(df, "seq", 10, checkpoint=0).collect())
    assert got == [2, 3]


def test_nth_sort_key_prefix_when_tie_region_fully_taken(spark):
    df = spark.createDataFrame([(i, i // 10) for i in range(100)], "id long, v long")
    assert nth_sort_key(df, ["v", "id"], 20, exact_rows=5) == ["1"]
    assert nth_sort_key(df, ["v", "id"], 25, exact_rows=5) == ["2", "24"]
    assert nth_sort_key(df, ["v", "id"], 100) is None


def test_final_filter_is_pushed_to_parquet(spark):
    events = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    plan = first_rows(events, "ts", 100, keys=["event_id"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(LessThan(ts," in plan
    assert "TakeOrderedAndProject" not in plan


def test_missing_key_columns_raise(spark):
    df = spark.createDataFrame([(1, 2)], "n long, v long")
    with pytest.raises(ValueError):
        bounded_batch(df, "v", 1)
    with pytest.raises(ValueError):
        bounded_batch(df, "v", 1, keys=["n", "id"])
    assert bounded_batch(df, "v", 1, keys=[]).count() == 1


def test_sketch_path_on_each_type(spark):
    """Brackets by a sketch, for every type that has one, and a heavy tie."""
    base = spark.range(0, 6000, 1, 6).select("id", ((F.col("id") * 7919) % 6000).alias("k"))
    types = {"int": F.col("k").cast("int") - 3000, "bigint": (F.col("k") - 3000) * 10 ** 12, "double": F.col("k") / 7 - 300,
             "decimal(20,4)": (F.col("k") / 8).cast("decimal(20,4)"), "date": F.date_add(F.lit("1960-01-01"), F.col("k").cast("int")),
             "timestamp": F.timestamp_micros(F.col("k") * 999_999_937), "timestamp_ntz": F.timestamp_micros(F.col("k") * 86_399_999_999).cast("timestamp_ntz")}
    for name, value in types.items():
        df = base.select("id", F.when(F.col("k") % 3 == 0, value).when(F.col("k") % 3 == 1, F.lit(None)).otherwise(
            F.when(F.col("k") == 2, value)).alias("v"))
        for n in (1, 1999, 5000):
            got = first_rows(df, "v", n, keys=["id"], exact_rows=40)
            want = first_rows_sorted(df, "v", n, keys=["id"])
            assert got.exceptAll(want).count() == 0 and got.count() == n, (name, n)
