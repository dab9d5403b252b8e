"""Counts and run statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.operators import offerings, tables
from noticeloom.session import cut_lineage


def status_counts(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Row count and one count per value, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(column) == v).alias(v) for v in values])


def group_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def discovery_counts(decided: DataFrame, page: list[str], outcome: str = "outcome", category: str = "category") -> DataFrame:
    """Counters of a discovery run; ``page`` names a page read: its board and number."""
    hit = lambda v: F.count_if(F.col(outcome) == v)
    read = F.col(outcome) == "detail"
    return decided.agg(
        F.count_distinct(*page).alias("pages"), F.count(F.lit(1)).alias("list_rows"), hit("detail").alias("details"),
        F.count_if(read & (F.col(category) == "recruitment")).alias("candidates"),
        F.count_if(read & (F.col(category) != "recruitment")).alias("rejected"),
        hit("skipped_old").alias("skipped_old"), hit("skipped_known").alias("skipped_known"),
        hit("skipped_seen").alias("skipped_seen"))


def run_statistics(counters: dict[str, Column]) -> Column:
    """Counters as one map column, the shape a run row stores."""
    return F.create_map(*[x for k, v in counters.items() for x in (F.lit(k), v.cast("bigint"))])


def file_totals(artifacts: DataFrame, offerings: DataFrame, file: str) -> DataFrame:
    """Artifacts and offerings per file, and overall (null file)."""
    a = artifacts.groupBy(file).agg(F.count(F.lit(1)).alias("_a"))
    o = offerings.groupBy(file).agg(F.count(F.lit(1)).alias("_o"))
    per_file = a.join(o, file, "full_outer").select(file, F.coalesce("_a", F.lit(0)).alias("_a"), F.coalesce("_o", F.lit(0)).alias("_o"))
    return per_file.rollup(file).agg(F.count(F.lit(1)).alias("files"), F.sum("_a").alias("artifacts"), F.sum("_o").alias("offerings"))


@dataclass(frozen=True)
class ExtractionReport:
    """``totals``: files, artifacts and offerings per file and overall; ``offerings``: what was found."""

    totals: DataFrame
    offerings: DataFrame


def extraction_report(texts: DataFrame, file: str, rules=tables.DEFAULT_RULES, kind: str = "kind") -> ExtractionReport:
    """What the row generators find in text artifacts (file, kind, source_span, raw_text).

    A file's artifacts are its texts and the table rows in them. Notices in PDF form give
    offerings from single-unit texts and from table rows, those in HWP form from table rows
    only, other kinds none. Files without offerings are in the totals.
    """
    rows = cut_lineage(tables.extract_rows(texts.select(file, kind, "source_span", "raw_text"), rules), "report-rows")
    units = offerings.route_by_kind(texts, kind, {lambda part: offerings.unit_text_offerings(part, [file]): (fixed.KIND_NOTICE_PDF,)})
    listed = offerings.route_by_kind(rows, kind, {lambda part: offerings.table_row_offerings(part, [file]): (fixed.KIND_NOTICE_PDF, fixed.KIND_NOTICE_HWP)})
    both = units.unionByName(listed, allowMissingColumns=True)
    return ExtractionReport(file_totals(texts.select(file).unionByName(rows.select(file)), both, file), both)
