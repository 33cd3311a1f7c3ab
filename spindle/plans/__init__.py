"""Named queries over the scale-factor tables, and their DuckDB oracle SQL."""

from spindle.plans.catalog import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
