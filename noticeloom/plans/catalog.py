"""All registered queries."""

from noticeloom.plans import extract_queries, source_queries, state_queries, stored_queries, table_queries, text_queries  # noqa: F401
from noticeloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
