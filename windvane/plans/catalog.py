"""All registered queries."""

from windvane.plans import queries_blocks, queries_columns, queries_models, queries_tables  # noqa: F401
from windvane.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
