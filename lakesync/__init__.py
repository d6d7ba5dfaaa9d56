"""lakesync: keep lakehouse tables and relational marts in sync with Spark.

Operators (``lakesync.operators``), column predicates (``lakesync.functions``),
table sources and sinks (``lakesync.sources``), composite batch jobs
(``lakesync.plans``) and a Structured Streaming form of the incremental load
(``lakesync.streaming``).
"""

__version__ = "0.1.0"
