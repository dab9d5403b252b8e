"""Registry of named queries with the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from noticeloom.operators.staging import several_per_core, spread
from noticeloom.plans.projections import render

# Tables that are the large side of their projections.
LARGE = ("lineitem", "events")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables, and projections of them onto the notice model."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def wide(self, name: str) -> DataFrame:
        """A table for costly per-row work: its rows are spread over tasks, however few row groups the file has."""
        return spread(getattr(self, name), several_per_core(self.spark))

    def project(self, name: str) -> DataFrame:
        sources, sql = render(name, "spark")
        return self.spark.sql(sql.format(**{s: f"{{{s}}}" for s in sources}), **{s: spread(getattr(self, s)) if s in LARGE else getattr(self, s) for s in sources})


def with_projections(sql: str, *names: str) -> str:
    """Put the named projections in front of a SQL text as common table expressions."""
    parts = []
    for name in names:
        sources, body = render(name, "ansi")
        parts.append(f"{name} AS ({body.format(**{s: s for s in sources})})")
    return "WITH RECURSIVE " + ", ".join(parts) + " " + sql


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Register a query; ``sql`` is its counterpart over the same tables, ``uses`` the projections it reads."""
    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = with_projections(sql, *uses) if uses else sql
        return fn
    return add
