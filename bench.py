"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
  {"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...},
   "alternatives": {...}, "sf": ..., ...}

Each query result goes to the ``noop`` sink (queries that write lake tables
do their writes inside). One warm-up pass, then the median of
$BENCH_REPEAT timed runs per query. ``alternatives`` times competing plans of
other, not with the reference, which publishes no numbers.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from lakesync.operators import maintenance  # noqa: E402
from lakesync.operators.batch import first_rows, first_rows_sorted  # noqa: E402
from lakesync.operators.upsert import upsert  # noqa: E402
from lakesync.registry import ORACLE_SQL, QUERIES, SMALL_FILES, _relation  # noqa: E402
from lakesync.session import ensure_checkpoint_dir, local_session, scratch_path  # noqa: E402
from lakesync.sources.lake import LakeTable  # noqa: E402


def _sf_of(path: str):
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _samples(fn, repeat: int) -> list[float]:
    samples = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return samples


def _time(fn, repeat: int) -> float:
    return round(statistics.median(_samples(fn, repeat)), 4)


def alternatives(spark, sf_dir: str, repeat: int) -> dict:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    n = 100_000 // 10  # a batch of 10% of the sf0.1 events table
    target = orders.withColumn("o_totalprice", F.lit(0.0))
    source = orders.filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    cases = {
        "bounded_batch_threshold": lambda: _run(first_rows(events, "ts", n, keys=["event_id"])),
        "bounded_batch_sorted_limit": lambda: _run(first_rows_sorted(events, "ts", n, keys=["event_id"])),
        "bounded_batch_descent": lambda: _run(first_rows(events, "ts", n, keys=["event_id"], exact_rows=n)),
        "relation_delta_exists": lambda: _run(_relation(spark, sf_dir, "exists")),
        "relation_delta_semi": lambda: _run(_relation(spark, sf_dir, "semi")),
        "upsert_broadcast_keys": lambda: _run(upsert(target, source, "o_orderkey")),
        "upsert_shuffle_keys": lambda: _run(upsert(target, source, "o_orderkey", broadcast_keys=None)),
    }
    out = {}
    for name, fn in cases.items():
        fn()
        out[name] = _time(fn, repeat)
    # MNT-1: scanning a table kept as many small files, before and after compaction.
    table = LakeTable(spark, scratch_path(spark, "bench-compact"))
    table.replace(orders.repartition(SMALL_FILES))
    scan = lambda: _run(table.read())
    scan()
    out["scan_small_files"] = _time(scan, repeat)
    maintenance.compact(table)
    scan()
    out["scan_after_compaction"] = _time(scan, repeat)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app_name="lakesync-bench", extra={"spark.driver.memory": "16g",
                                                            "spark.ui.showConsoleProgress": "false"})
    ensure_checkpoint_dir(spark, lambda: tempfile.mkdtemp(prefix="lakesync-bench-ckpt-"))
    names = only or list(QUERIES)
    times, least = {}, {}  # the least tells the machine's noise from the query's time
    for name in names:
        fn = QUERIES[name]
        _run(fn(spark, sf_dir))  # warm-up
        samples = _samples(lambda: _run(fn(spark, sf_dir)), repeat)
        times[name], least[name] = round(statistics.median(samples), 4), round(min(samples), 4)
    alts = {} if os.environ.get("BENCH_SKIP_ALTERNATIVES") else alternatives(spark, sf_dir, repeat)
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "least": least,
        "least_total": round(sum(least.values()), 4),
        "alternatives": alts,
        "oracle_checked": sorted(set(names) & set(ORACLE_SQL)),
        "sf": _sf_of(sf_dir),
        "cpus": cpus,
        "repeat": repeat,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
