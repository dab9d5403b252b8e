"""The layers put together: landed pages and API responses to approved offerings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import text as T
from noticeloom.functions.dates import older_than
from noticeloom.operators import classify, discovery, enrich, offerings, predicates, reconcile, rents, schedules, sheets, tables
from noticeloom.operators.dedupe import key_set
from noticeloom.operators.staging import several_per_core, spread
from noticeloom.session import cut_lineage
from noticeloom.sources import api, pages

BOARD = ["agency", "board_kind"]
NOTICE = [*BOARD, "seq"]


@dataclass(frozen=True)
class BoardRun:
    """Outputs of a board run; refused rows were accepted on their body but not on their title."""

    decided: DataFrame
    candidates: DataFrame
    refused: DataFrame
    rejected: DataFrame


def board_run(list_pages: DataFrame, detail_pages: DataFrame, known: DataFrame, cache: DataFrame,
              applications: DataFrame, now: Column, cutoff: Column, stage: Callable[[DataFrame, str], DataFrame] = cut_lineage) -> BoardRun:
    """List pages (agency, board_kind, page, html) → decisions, and what the detail pages say.

    Known, seen and old rows are dropped before any detail page is parsed. Decisions and judged
    rows are kept by ``stage``, so that each page is parsed once for all outputs; pages are
    spread over tasks, because the small files and shuffles before them would leave them in a few.
    """
    tasks = several_per_core(list_pages.sparkSession)
    rows = cut_lineage(pages.list_rows(spread(list_pages, tasks)), "list-rows")
    targets = reconcile.active_targets(applications)
    hits = discovery.use_up_targets(rows, targets, T.title_key_plain("title"), "target", BOARD, ["page", "position"])
    flagged = discovery.with_seen(hits, cache, NOTICE)
    flagged = flagged.join(key_set(known, *NOTICE).withColumn("is_known", F.lit(True)), NOTICE, "left").fillna(False, ["is_known"])
    decided = flagged.withColumn("outcome", discovery.outcome(
        older_than("posted_at", cutoff), F.col("is_target"), F.col("is_known"), discovery.can_skip_seen("title", "posted_at", now)))
    decided = stage(discovery.early_stop(cut_lineage(decided, "outcomes"), BOARD, "page", everywhere=targets), "decided")
    wanted = decided.where(F.col("outcome") == "detail")
    details = pages.detail_fields(spread(detail_pages.join(key_set(wanted, *NOTICE), NOTICE, "left_semi"), tasks)).select(
        *NOTICE, F.col("title").alias("detail_title"), "body_text")
    judged = stage(discovery.judge_details(wanted.join(details, NOTICE, "left").fillna("", ["detail_title", "body_text"])), "judged")
    recruiting = judged.where(F.col("category") == fixed.CATEGORY_RECRUITMENT)
    accepted, refused = classify.split_persistable(recruiting, "final_title")
    return BoardRun(decided, accepted, refused, judged.where(F.col("category") != fixed.CATEGORY_RECRUITMENT))


@dataclass(frozen=True)
class Extracted:
    table_rows: DataFrame
    offerings: DataFrame
    schedules: DataFrame


def extract_attachments(texts: DataFrame, sheet_rows: DataFrame, rules=tables.DEFAULT_RULES) -> Extracted:
    """Text artifacts (notice_id, attachment_id, kind, artifact_type, source_span, raw_text) and sheet
    rows (notice_id, attachment_id, sheet, row_no, cells, source_span) → table rows, offerings, schedules."""
    keep = ["notice_id", "attachment_id"]
    rows = cut_lineage(tables.extract_rows(texts.select(*keep, "kind", "source_span", "raw_text"), rules), "table-rows")
    routed = offerings.route_by_kind(texts, "kind", {
        lambda a: offerings.unit_text_offerings(a.where(F.col("artifact_type") == fixed.ART_PDF_TEXT), keep): (fixed.KIND_NOTICE_PDF,)})
    listed = offerings.table_row_offerings(rows.where(F.col("kind").isin(fixed.KIND_NOTICE_PDF, fixed.KIND_NOTICE_HWP)), keep)
    from_sheets = sheets.sheet_offerings(sheet_rows, [*keep, "sheet"])
    both = routed.unionByName(listed, allowMissingColumns=True).unionByName(
        from_sheets.drop("raw_row"), allowMissingColumns=True)
    found = schedules.text_schedules(texts, ["notice_id"])
    unique = schedules.dedupe_schedules(found, ["notice_id"], [F.col("source_span"), F.col("position")])
    return Extracted(rows, both, unique)


@dataclass(frozen=True)
class ApiRun:
    bad_pages: DataFrame
    items: DataFrame
    offerings: DataFrame
    schedules: DataFrame


_DETAIL_TEXTS = ["supply_count_text", "target_house_info_text", "support_limit_text", "rent_condition_text",
                 "deposit_condition_text", "monthly_rent_condition_text", "lease_period_text"]


def api_run(responses: DataFrame, detail_pages: DataFrame, file_texts: DataFrame, endpoint: str, agency: str = "") -> ApiRun:
    """API responses (page, body), detail pages (item_seq, html) and file texts (item_seq, raw_text).

    Only items that lack something are enriched; a file is read only when the detail
    page names one and a condition text is still blank. API items count as recruitment.
    """
    parsed = api.parse_pages(responses)
    items = api.project_items(api.page_items(parsed, ["page"]), ["page"]).where(predicates.agency_is("agency", agency))
    absent = [c for c in _DETAIL_TEXTS if c not in items.columns]
    items = items.select("*", *[F.lit("").alias(c) for c in absent])
    told = pages.label_value_columns(detail_pages)
    details = api.detail_columns(told)
    files = told.select("item_seq", F.size("notice_files").alias("_files"))
    summaries = rents.rent_summary(file_texts, "raw_text", ["item_seq"]).withColumnsRenamed(
        {"deposit_text": "deposit_condition_text", "monthly_rent_text": "monthly_rent_condition_text"})

    def enriched(part):
        with_details = enrich.fill_missing(part, details, ["item_seq"], _DETAIL_TEXTS, counts=["supply_count"])
        named = with_details.join(files, "item_seq", "left")
        return enrich.enrich_where(named, predicates.needs_file("_files"), lambda rows: enrich.fill_missing(
            rows, summaries, ["item_seq"], ["deposit_condition_text", "monthly_rent_condition_text"], ["deposit_krw", "monthly_rent_krw"])).drop("_files")

    full = enrich.enrich_where(items, predicates.needs_detail(), enriched)
    span = T.api_span(F.lit(endpoint), "item_seq")
    return ApiRun(api.bad_pages(parsed), full, offerings.item_offerings(full, ["item_seq", "agency"], span),
                  offerings.item_schedules(full, ["item_seq"], span))
