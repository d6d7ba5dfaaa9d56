"""Registered queries read whole tables: no modulo or id-range subsets, and a
LIMIT only where the limit is the operator (top-1 checkpoints, bounded batches)."""

import inspect
import re

from lakesync import registry

LIMIT_IS_THE_FEATURE = {"checkpoint_latest", "bounded_batch_first", "bounded_batch_next",
                        "bounded_batch_events", "bounded_batch_descent",
                        "job_incremental_bronze", "job_daily_bronze"}


def test_oracle_sql_has_no_subsets():
    for name, sql in registry.ORACLE_SQL.items():
        low = sql.lower()
        assert "%" not in low and " mod(" not in low, name
        assert not re.search(r"(event_id|o_orderkey|l_orderkey|l_partkey)\s*(<|<=|>|>=|between)\s*\d", low), name
        if " limit " in low:
            assert name in LIMIT_IS_THE_FEATURE, name


def test_query_code_has_no_subsets():
    src = inspect.getsource(registry)
    body = src[src.index("# ---------------------------------------------------------------- operators"):
               src.index("QUERIES: dict")]
    assert "%" not in body
    assert ".limit(" not in body and ".sample(" not in body
    assert not re.search(r'F\.col\("(event_id|o_orderkey|l_orderkey|l_partkey)"\)\s*[<>]', body)
