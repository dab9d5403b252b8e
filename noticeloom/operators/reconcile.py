"""Applications linked to notices by title and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.functions import text as T
from noticeloom.operators.dedupe import last_row
from noticeloom.operators.predicates import is_active


def reconcile(applications: DataFrame, candidates: DataFrame, title: str = "title", posted: str = "posted_at",
              position: str = "position") -> tuple[DataFrame, DataFrame]:
    """(linked, unmatched). The last candidate per (title key, day) wins; unknown
    days only meet unknown days.

    Candidates are unique per key after the reduction, so the join never fans out
    and a hot title is a skewed probe side, which AQE splits.
    """
    key = F.concat_ws("|", T.title_key_strict(title), F.date_format(F.col(posted), "yyyy-MM-dd"))
    right = last_row(candidates.withColumn("_key", key), ["_key"], F.col(position)).select(
        "_key", F.col("seq").alias("board_seq"), F.col(title).alias("board_title"))
    left = applications.withColumn("_key", key)
    linked = left.join(right, "_key").drop("_key")
    unmatched = left.join(right.select("_key"), "_key", "left_anti").drop("_key")
    return linked, unmatched


def active_targets(applications: DataFrame, title: str = "title", status: str = "status", active=None) -> DataFrame:
    """Distinct title keys of the open and pending applications."""
    keep = is_active(status) if active is None else is_active(status, active)
    return (applications.where(keep).select(T.title_key_strict(title).alias("target")).where("target <> ''").distinct())


def application_links(linked: DataFrame, notices: DataFrame, applications: DataFrame, board: list[str], source: list[str]) -> DataFrame:
    """(application_id, notice_id) of the links whose both ends are stored.

    A seq counts within its ``board`` columns (agency, board kind), a code within its
    ``source`` columns. Both sides are reduced to one row per key, so nothing fans out.
    """
    ends = notices.groupBy(*board, F.col("seq").alias("board_seq")).agg(F.max("id").alias("notice_id"))
    own = applications.groupBy(*source, "recruit_code").agg(F.max("id").alias("application_id"))
    return (linked.select("recruit_code", "board_seq", *board, *source).join(ends, [*board, "board_seq"])
            .join(own, [*source, "recruit_code"]).select("application_id", "notice_id"))


def attach_artifacts(derived: DataFrame, artifacts: DataFrame, span: str = "source_span", how: str = "left",
                     base: bool = False, owner: tuple[str, ...] = ()) -> DataFrame:
    """Artifact id of derived rows by span, within the ``owner`` columns (attachment).

    Of several artifacts on one span the last counts. ``base`` looks below a schedule
    suffix and drops unmatched rows.
    """
    look = T.base_span(span) if base else F.col(span)
    ids = artifacts.groupBy(*owner, F.col("source_span").alias("_span")).agg(F.max("id").alias("source_artifact_id"))
    return derived.withColumn("_span", look).join(ids, [*owner, "_span"], "inner" if base else how).drop("_span")
