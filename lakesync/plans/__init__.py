"""Composite batch jobs built from the operators."""

from lakesync.plans.jobs import (
    RunReport,
    backfill,
    daily_incremental_load,
    full_refresh,
    incremental_load,
    lake_to_staging,
    maintain,
    relation_to_lake,
    relation_to_staging,
    truncate_load,
)

__all__ = [
    "RunReport",
    "backfill",
    "daily_incremental_load",
    "full_refresh",
    "incremental_load",
    "lake_to_staging",
    "maintain",
    "relation_to_lake",
    "relation_to_staging",
    "truncate_load",
]
