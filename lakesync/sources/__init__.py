"""Table sources and sinks: lake tables, the session catalog, Delta (optional), JDBC."""

from lakesync.session import staged
from lakesync.sources.catalog import CatalogTable, create_namespace
from lakesync.sources.jdbc import JdbcTable
from lakesync.sources.lake import CommitConflict, LakeTable, TableNotFound, table_path, union_schema

__all__ = ["CatalogTable", "CommitConflict", "JdbcTable", "LakeTable", "TableNotFound", "create_namespace",
           "staged", "table_path", "union_schema"]
