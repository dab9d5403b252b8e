"""Upserts by natural key, with a rule per column."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.operators.dedupe import last_row

Rule = Callable[[Column, Column], Column]


def keep_old_when_null(old: Column, new: Column) -> Column:
    return F.coalesce(new, old)


def keep_old(old: Column, new: Column) -> Column:
    return old


def approval_sticks(old: Column, new: Column) -> Column:
    return F.when(old == fixed.QA_APPROVED, old).otherwise(new)


def add_up(old: Column, new: Column) -> Column:
    return old + new


@dataclass(frozen=True)
class TableSpec:
    """Natural key and conflict rules of a table; columns without a rule are replaced."""

    keys: tuple[str, ...]
    rules: dict[str, Rule] = field(default_factory=dict)


SPECS = {
    "source_boards": TableSpec(("agency", "board_kind")),
    "source_notices": TableSpec(("agency", "board_kind", "seq"), {"posted_at": keep_old_when_null}),
    "application_notices": TableSpec(("agency", "source", "sply_ty", "recrnoti_cd"),
                                     {"notice_id": keep_old_when_null, "posted_at": keep_old_when_null}),
    "stored_objects": TableSpec(("bucket", "object_key")),
    "attachments": TableSpec(("brd_id", "seq", "file_seq")),
    "extracted_artifacts": TableSpec(("merge_key",)),
    "offerings": TableSpec(("merge_key",), {"notice_id": keep_old, "attachment_id": keep_old, "qa_status": approval_sticks}),
    "notice_schedules": TableSpec(("notice_id", "schedule_type", "source_span")),
    "discovery_seen_cache": TableSpec(("agency", "board_kind", "seq"), {"seen_count": add_up, "first_seen_at": keep_old}),
}


def artifact_merge_key(attachment_id="attachment_id", artifact_type="artifact_type", span="source_span") -> Column:
    """Attachment, type and span; type and span alone where there is no attachment."""
    return F.concat_ws("|", F.coalesce(F.col(attachment_id).cast("string"), F.lit("")), F.col(artifact_type), F.col(span))


def offering_merge_key(attachment_id="attachment_id", notice_id="notice_id", span="source_span") -> Column:
    """Attachment and span; notice and span where there is no attachment."""
    owner = F.coalesce(F.concat(F.lit("a"), F.col(attachment_id).cast("string")),
                       F.concat(F.lit("n"), F.col(notice_id).cast("string")), F.lit(""))
    return F.concat_ws("|", owner, F.col(span))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], rules: dict[str, Rule] | None = None,
           position: Column | None = None, version: str | None = None) -> DataFrame:
    """The target after the batch.

    Both sides are unique per key (the batch is cut to its last row per key by
    ``position``), so the join never fans out. Only columns of the target are kept.
    With a ``version`` column, batch rows that are not newer than the stored row
    are ignored, so that running a batch twice counts once.
    """
    rules = rules or {}
    if position is not None:
        batch = last_row(batch, list(keys), position)
    values = [c for c in target.columns if c not in keys]
    old = target.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in values], F.lit(True).alias("_old"))
    new = batch.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in values if c in batch.columns], F.lit(True).alias("_new"))
    joined = old.join(new, list(keys), "full_outer")
    stale = F.coalesce(F.col(f"_o_{version}") >= F.col(f"_n_{version}"), F.lit(False)) if version else F.lit(False)

    def value(c):
        before = F.col(f"_o_{c}")
        if c not in batch.columns:
            return before
        after = F.col(f"_n_{c}")
        both = rules[c](before, after) if c in rules else after
        return F.when(F.col("_new").isNull() | stale, before).when(F.col("_old").isNull(), after).otherwise(both)

    return joined.select(*[F.col(c) if c in keys else value(c).alias(c) for c in target.columns])


def update_column(target: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """Set one column of the rows named by ``changes`` (unique per key)."""
    side = changes.select(key, F.col(column).alias("_value"), F.lit(True).alias("_hit"))
    return target.join(side, key, "left").withColumn(
        column, F.when(F.col("_hit"), F.col("_value")).otherwise(F.col(column))).select(*target.columns)


def replace_rows(target: DataFrame, doomed: Column, key: str, new_rows: DataFrame) -> DataFrame:
    """Delete the matching rows whose key the new rows bring again, then append the new rows."""
    touched = new_rows.select(key).distinct().withColumn("_touched", F.lit(True))
    kept = target.join(touched, key, "left").where(~(F.coalesce(F.col("_touched"), F.lit(False)) & doomed))
    return kept.select(*target.columns).unionByName(new_rows, allowMissingColumns=True)


def duplicates(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Uniqueness report: keys held by more than one row, optionally within a part of the table."""
    part = df if where is None else df.where(where)
    return part.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def append_rows(df: DataFrame, path: str) -> None:
    """Append-only log sink."""
    df.write.mode("append").parquet(path)


def latest_runs(runs: DataFrame, key: str = "run_id", position: str = "recorded_at") -> DataFrame:
    """Current state of each run from its append-only rows (opened, finished)."""
    rest = [c for c in runs.columns if c not in (key,)]
    return runs.groupBy(key).agg(F.max_by(F.struct(*rest), position).alias("_r")).select(key, "_r.*")
