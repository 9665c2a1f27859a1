"""All registered queries, each with the SQL that must give the same rows."""

from meshfeed.catalog import columns, feeds, files, messages, rows, streams  # noqa: F401
from meshfeed.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
