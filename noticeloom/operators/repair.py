"""Artifacts worth another extraction attempt, their request payloads, and the attempt log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import text as T
from noticeloom.functions.payload import json_or_empty, provenance_hash
from noticeloom.operators.dedupe import key_set


def with_context(artifacts: DataFrame, attachments: DataFrame, notices: DataFrame) -> DataFrame:
    """Artifact with its attachment's and notice's names; blanks where there are none."""
    side = attachments.select(F.col("id").alias("attachment_id"), "notice_id", "original_filename", "attachment_kind")
    heads = notices.select(F.col("id").alias("notice_id"), F.col("seq").alias("notice_seq"), F.col("title").alias("notice_title"))
    joined = artifacts.join(side, "attachment_id", "left").join(heads, "notice_id", "left")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    own = [c for c in artifacts.columns if c != "attachment_id"]
    return joined.select(*own, zero("attachment_id"), zero("notice_id"), blank("notice_seq"), blank("notice_title"),
                         blank("original_filename"))


def repair_candidates(artifacts: DataFrame, attachments: DataFrame, notices: DataFrame, offerings: DataFrame,
                      attempts: DataFrame, include_approved: bool = False) -> DataFrame:
    """Readable notice texts that gave no offering and have no successful attempt.

    Whether the notice has an approved offering is found once and used both as the
    filter and as the first sort key. Right sides are reduced to distinct keys first.
    """
    readable = artifacts.where(
        (F.col("status") == fixed.STATUS_EXTRACTED) & F.col("source_span").startswith(fixed.OBJECT_SCHEME)
        & (F.trim("raw_text") != "") & F.col("artifact_type").isin(*fixed.REPAIR_TEXT_TYPES))
    kinds = attachments.where(F.col("attachment_kind").isin(*fixed.REPAIR_ATTACHMENT_KINDS)).select(
        F.col("id").alias("attachment_id"), "notice_id", "original_filename")
    heads = notices.where(F.col("category") == fixed.CATEGORY_RECRUITMENT).select(
        F.col("id").alias("notice_id"), F.col("seq").alias("notice_seq"), F.col("title").alias("notice_title"))
    produced = key_set(offerings.where(F.col("source_artifact_id").isNotNull()), F.col("source_artifact_id").alias("id"))
    done = key_set(attempts.where(F.col("status") == "succeeded"), F.col("artifact_id").alias("id"))
    approved = key_set(offerings.where(F.col("qa_status") == fixed.QA_APPROVED), "notice_id").withColumn(
        "has_approved", F.lit(True))
    found = (readable.join(produced, "id", "left_anti").join(done, "id", "left_anti")
             .join(kinds, "attachment_id").join(heads, "notice_id").join(approved, "notice_id", "left")
             .withColumn("has_approved", F.coalesce("has_approved", F.lit(False))))
    return found if include_approved else found.where(~F.col("has_approved"))


def repair_order() -> list[Column]:
    """No approved offering first, then PDF text, then the longest text, then the id."""
    return [F.col("has_approved"), F.when(F.col("artifact_type") == fixed.ART_PDF_TEXT, 0).otherwise(1),
            F.length("raw_text").desc(), F.col("id")]


def request_payload(raw_text="raw_text", content="content_json", max_chars: int = fixed.REPAIR_CHARS,
                    **context: str) -> Column:
    """Request body of one artifact: its context, content and text cut at the input limit."""
    parts = [F.col(c).cast("string").alias(k) for k, c in context.items()]
    return F.to_json(F.struct(*parts, json_or_empty(content).alias("content_json"),
                              T.truncate_marked(T.trim_ws(raw_text), max_chars).alias("raw_text")))


def requests(candidates: DataFrame, keep: list[str], **kwargs) -> DataFrame:
    """Payload and provenance hash per candidate."""
    return (candidates.select(*keep, request_payload(**kwargs).alias("payload"))
            .withColumn("input_hash", provenance_hash("payload")))


def attempt_rows(results: DataFrame, keep: list[str], payload: str = "payload", response: str = "response") -> DataFrame:
    """Log rows of attempts with the hashes of what went in and came out."""
    return results.select(*keep, provenance_hash(payload).alias("input_hash"), provenance_hash(response).alias("output_hash"))
