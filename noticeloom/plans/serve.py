"""Served queries over the normalized tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.operators import availability as A
from noticeloom.operators.classify import is_listed
from noticeloom.operators.dedupe import key_set


def api_limit(raw, fallback: int = fixed.SERVE_DEFAULT) -> int:
    """Limit from a request: bad → fallback, too large → the maximum."""
    try:
        value = int(raw)
    except (TypeError, ValueError):
        return fallback
    return fallback if value <= 0 else min(value, fixed.SERVE_MAX)


def table_limit(limit: int, fallback: int = fixed.SERVE_DEFAULT) -> int:
    """Limit of a table query: out of range → fallback."""
    return limit if 0 < limit <= fixed.SERVE_MAX else fallback


def newest(df: DataFrame, limit: int, key: str = "id") -> DataFrame:
    return df.orderBy(F.col(key).desc()).limit(limit)


def offerings(table: DataFrame, limit: int = fixed.SERVE_DEFAULT, qa_status: str = "") -> DataFrame:
    """Offerings of one QA status, newest first."""
    return newest(table.where(F.col("qa_status") == (qa_status.strip() or fixed.QA_APPROVED)), table_limit(limit))


def notices(table: DataFrame, limit: int = fixed.SERVE_DEFAULT, hidden=fixed.NOTICE_LIST_HIDDEN) -> DataFrame:
    """Recruitment notices that the list shows, latest posting first."""
    shown = table.where((F.col("category") == fixed.CATEGORY_RECRUITMENT) & is_listed("title", hidden))
    return shown.orderBy(F.col("posted_at").desc_nulls_last(), F.col("id").desc()).limit(table_limit(limit))


def schedules(table: DataFrame, offerings_table: DataFrame, limit: int = fixed.SERVE_DEFAULT) -> DataFrame:
    """Schedules of notices that have an approved offering, earliest start first."""
    approved = key_set(offerings_table.where(F.col("qa_status") == fixed.QA_APPROVED), "notice_id")
    return (table.join(approved, "notice_id", "left_semi")
            .orderBy(F.col("starts_at").asc_nulls_last(), "id").limit(table_limit(limit)))


def availability(notices_table: DataFrame, offerings_table: DataFrame, schedules_table: DataFrame,
                 applications: DataFrame, now: Column, limit: int = fixed.SERVE_DEFAULT, **filters) -> DataFrame:
    """Availability as of ``now``, best first."""
    approved = offerings_table.where(F.col("qa_status") == fixed.QA_APPROVED)
    found = A.availability(notices_table, approved, schedules_table, applications, now, **filters)
    return A.ranked(found, table_limit(limit))
