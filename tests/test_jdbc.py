"""JDBC table logic without a database: Spark's JDBC reader and writer are
replaced by recorders (no database may be started in this environment)."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql.types import LongType, StringType, StructField, StructType

import lakesync.sources.jdbc as jdbc_mod
from lakesync.sources.jdbc import JdbcTable


@pytest.fixture()
def recorded(spark, monkeypatch):
    calls = []

    def fake_read(self, table_expr, **kwargs):
        calls.append(("read", table_expr, kwargs))
        if table_expr.startswith("(SELECT MIN"):
            return spark.createDataFrame([(3, 907)], "lo long, hi long")
        if table_expr.startswith("(SELECT MAX"):
            return spark.createDataFrame([("2024-01-15 10:00:00",)], "checkpoint string") \
                .selectExpr("cast(checkpoint as timestamp_ntz) as checkpoint")
        return spark.createDataFrame([(1, "a")], "id long, v string")

    monkeypatch.setattr(JdbcTable, "_read", fake_read)
    return calls


def test_partitioned_read_fetches_bounds_from_the_database(spark, recorded):
    t = JdbcTable(spark, "jdbc:x://h/db", "events", schema="public")
    t.read(partition_column="id", num_partitions=8)
    assert recorded[0][1] == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM public.events) q"
    name, expr, kwargs = recorded[1]
    assert expr == "public.events"
    assert kwargs == {"column": "id", "lowerBound": 3, "upperBound": 907, "numPartitions": 8}


def test_mart_checkpoint_is_a_database_side_max(spark, recorded):
    cp = JdbcTable(spark, "jdbc:x://h/db", "events").max_value("write_date")
    assert recorded[0][1] == "(SELECT MAX(write_date) AS checkpoint FROM events) q"
    assert cp.text == "2024-01-15 10:00:00"


def test_identifiers_are_validated(spark):
    with pytest.raises(ValueError):
        JdbcTable(spark, "jdbc:x://h/db", "events; drop table x")
    t = JdbcTable(spark, "jdbc:x://h/db", "events")
    with pytest.raises(ValueError):
        t.bounds("id) FROM y --")


def test_truncate_load_checks_then_materialises_then_truncates(spark, monkeypatch):
    order = []
    t = JdbcTable(spark, "jdbc:x://h/db", "events", schema="mart")
    monkeypatch.setattr(JdbcTable, "schema", lambda self: StructType(
        [StructField("ID", LongType()), StructField("V", StringType())]))
    monkeypatch.setattr(jdbc_mod, "staged", lambda df: order.append("staged") or df)
    options = {}
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: options.__setitem__(k, v) or self)
    monkeypatch.setattr(DataFrameWriter, "jdbc",
                        lambda self, url, table, mode=None, properties=None: order.append(("jdbc", table, mode)))
    with pytest.raises(ValueError):
        t.truncate_load(spark.createDataFrame([(1, "a", 2)], "id long, v string, extra int"))
    assert order == []  # nothing happened before the column check failed
    t.truncate_load(spark.createDataFrame([(1, "a")], "id long, v string"))
    assert order == ["staged", ("jdbc", "mart.events", "overwrite")]
    assert options == {"numPartitions": "16", "truncate": "true"}


def test_writes_bound_their_connections(spark, monkeypatch):
    writes = []
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: writes.append((k, v)) or self)
    monkeypatch.setattr(DataFrameWriter, "jdbc",
                        lambda self, url, table, mode=None, properties=None: writes.append((table, mode)))
    t = JdbcTable(spark, "jdbc:x://h/db", "events", schema="temp", write_connections=4)
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    t.replace(df)
    t.append(df)
    assert writes == [("numPartitions", "4"), ("temp.events", "overwrite"),
                      ("numPartitions", "4"), ("temp.events", "append")]
    with pytest.raises(ValueError):
        JdbcTable(spark, "jdbc:x://h/db", "events", write_connections=0)


def test_catalog_registration_sets_pushdown_options(spark):
    from lakesync.sources.jdbc import JDBC_CATALOG, register_catalog

    register_catalog(spark, "mart_cat", "jdbc:x://h/db", {"driver": "x.Driver"})
    assert spark.conf.get("spark.sql.catalog.mart_cat") == JDBC_CATALOG
    assert spark.conf.get("spark.sql.catalog.mart_cat.pushDownLimit") == "true"
    assert spark.conf.get("spark.sql.catalog.mart_cat.pushDownAggregate") == "true"
    assert spark.conf.get("spark.sql.catalog.mart_cat.driver") == "x.Driver"


def test_sorted_batch_strategy_is_a_plain_top_n(spark):
    from lakesync.operators.batch import bounded_batch

    df = spark.createDataFrame([(i, i % 4) for i in range(20)], "id long, v long")
    got = bounded_batch(df, "v", 5, keys=["id"], strategy="sorted")
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in got.collect()) == [0, 4, 8, 12, 16]


def test_bounded_extract_is_one_query_with_typed_literals(spark, recorded):
    import datetime as dt

    from pyspark.sql.types import (BooleanType, DateType, DecimalType, DoubleType, IntegerType, StringType, TimestampNTZType,
                                   TimestampType)

    from lakesync.operators.checkpoint import Checkpoint
    from lakesync.sources.jdbc import bounded_query, sql_literal

    assert sql_literal("0", IntegerType()) == "0"
    assert sql_literal("-12.50", DecimalType(8, 2)) == "-12.50"
    assert sql_literal("1.5E10", DoubleType()) == "1.5E10"
    assert sql_literal("NaN", DoubleType()) == "CAST('NaN' AS DOUBLE PRECISION)"
    assert sql_literal("true", BooleanType()) == "TRUE"
    assert sql_literal("2024-01-05", DateType()) == "DATE '2024-01-05'"
    assert sql_literal("2024-01-05 01:02:03.000004", TimestampNTZType()) == "TIMESTAMP '2024-01-05 01:02:03.000004'"
    assert sql_literal("2024-01-05T01:02:03.000004+02:00", TimestampType()) == "TIMESTAMP WITH TIME ZONE '2024-01-05T01:02:03.000004+02:00'"
    assert sql_literal("o'clock", StringType()) == "'o''clock'"
    assert bounded_query("s.t", "id", 10, ["id"]) == 'SELECT * FROM "s"."t" ORDER BY "id" ASC LIMIT 10'
    t = JdbcTable(spark, "jdbc:x://h/db", "events", schema="public")
    t.bounded_extract("write_date", 100, ["id"], Checkpoint("write_date", TimestampNTZType(), "2024-01-05 00:00:00", dt.datetime(2024, 1, 5)))
    assert recorded[0][1] == ('(SELECT * FROM "public"."events" WHERE "write_date" >= TIMESTAMP \'2024-01-05 00:00:00\' '
                              'ORDER BY "write_date" ASC, "id" ASC LIMIT 100) q')
    with pytest.raises(ValueError):
        bounded_query("t", "a; drop", 1)


def test_exists_asks_for_the_name_and_lets_errors_through(spark, monkeypatch):
    asked = []
    answers = [spark.createDataFrame([("events",)], "table_name string"), spark.createDataFrame([], "table_name string")]
    monkeypatch.setattr(JdbcTable, "derived", lambda self, q, alias="q": asked.append(q) or answers[len(asked) - 1])
    t = JdbcTable(spark, "jdbc:x://h/db", "Events", schema="mart")
    assert t.exists() and not t.exists()
    assert asked[0].endswith("WHERE lower(table_name) = 'events' AND lower(table_schema) = 'mart'")

    def refused(self, q, alias="q"):
        raise ConnectionError("no connection")

    monkeypatch.setattr(JdbcTable, "derived", refused)
    with pytest.raises(ConnectionError):  # E9: not read as a missing table
        t.read_or_none()
