"""The board workflow with its tables: landed pages and attachments to stored, promoted offerings.

A run reads what earlier runs stored (known notices, seen cache, notices for links), decides,
and stores notices, seen entries, artifacts, offerings with their status, schedules,
applications and links as snapshots below one folder, and its own record. Ids are hashes of
natural keys, so a run that is repeated stores the same rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.operators import discovery, promotion, quality, reconcile, runs, snapshots, upsert
from noticeloom.operators.dedupe import first_row, last_row
from noticeloom.operators.staging import several_per_core, spread
from noticeloom.plans.pipeline import BOARD, NOTICE, board_run, extract_attachments
from noticeloom.session import cut_lineage
from noticeloom.sources import artifacts as A

BOARD_COUNTERS = (
    "pages", "list_rows", "details", "candidates", "rejected", "skipped_old", "skipped_known", "skipped_seen", "stopped_by_cutoff", "downloaded",
    "upserted_artifacts", "upserted_offerings", "stored_objects", "total_artifacts", "total_offerings", "upserted_schedules", "upserted_application_notices",
    "linked_application_notices", "upserted_discovery_seen_cache")
APPLICATION = ["agency", "source", "sply_ty", "recrnoti_cd"]
_SHAPES = {
    "source_notices": "agency string, board_kind string, seq string, id long, title string, category string, posted_at date, position long",
    "discovery_seen_cache": "agency string, board_kind string, seq string, status string, list_title_hash string, posted_at date, expires_at timestamp, seen_count int, "
                            "first_seen_at timestamp, last_seen_at timestamp",
}
_SHEETS = "notice_id long, attachment_id long, sheet string, row_no int, cells array<string>, source_span string"


def stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A stored table; an empty one where no run has written it."""
    if snapshots.current(spark, f"{root}/{table}") is None:
        return spark.createDataFrame([], _SHAPES[table])
    return snapshots.read(spark, f"{root}/{table}", list(upsert.SPECS[table].keys))


def _store(spark: SparkSession, root: str, table: str, batch: DataFrame, position: Column) -> None:
    spec = upsert.SPECS[table]
    if snapshots.current(spark, f"{root}/{table}") is not None or batch.limit(1).count():
        snapshots.upsert_snapshot(spark, f"{root}/{table}", batch, list(spec.keys), spec.rules, position)


def store_board_run(spark: SparkSession, root: str, run_id: str, list_pages: DataFrame, detail_pages: DataFrame, texts: DataFrame,
                    applications: DataFrame, now: Column, cutoff: Column) -> None:
    """One run over landed list pages (agency, board_kind, page, html), detail pages (.., seq, html),
    attachment texts (.., seq, file_seq, kind, artifact_type, object_key, raw_text) and application
    notices (agency, source, sply_ty, recrnoti_cd, title, status, posted_at, board_kind)."""
    with runs.recorded(spark, f"{root}/collection_runs", run_id, "board", BOARD_COUNTERS) as run:
        _board(spark, root, run, list_pages, detail_pages, texts, applications, now, cutoff)


def _board(spark, root, run, list_pages, detail_pages, texts, applications, now, cutoff) -> None:
    applications = cut_lineage(applications, "applications")
    before, cache = stored(spark, root, "source_notices"), stored(spark, root, "discovery_seen_cache")
    hit = lambda outcome: F.count_if(F.col("outcome") == outcome)
    counters = {"decided": dict(list_rows=F.count(F.lit(1)), details=hit("detail"), skipped_old=hit("skipped_old"),
                                skipped_known=hit("skipped_known"), skipped_seen=hit("skipped_seen"))}
    found = board_run(list_pages, detail_pages, before, cache.where(F.col("expires_at") > now), applications, now, cutoff,
                      lambda df, purpose: run.staged(df, purpose, **counters[purpose]) if purpose in counters else cut_lineage(df, purpose))
    read = found.decided.groupBy(*BOARD).agg(F.max("page").alias("last"), F.max(F.col("outcome") == "skipped_old").alias("old"))
    landed = list_pages.groupBy(*BOARD).agg(F.max("page").alias("landed"))
    stops = landed.join(read, BOARD, "left").withColumn("stopped", F.coalesce(F.col("old") & (F.col("last") < F.col("landed")), F.lit(False)))
    within = list_pages.select(*BOARD, "page").distinct().join(stops, BOARD).where(~F.col("stopped") | (F.col("page") <= F.col("last")))
    run.count(pages=within.count(), stopped_by_cutoff=stops.where("stopped").count())

    rejected = run.staged(found.rejected.select(*NOTICE, "title", "category", "posted_at"), "rejected", rejected=F.count(F.lit(1)))
    entries = discovery.seen_entries(first_row(rejected, NOTICE, [F.col("title")]), NOTICE, "title", "category", now).select(
        *NOTICE, "status", "list_title_hash", "posted_at", "expires_at", "seen_count", now.alias("first_seen_at"), now.alias("last_seen_at"))
    _store(spark, root, "discovery_seen_cache", run.staged(entries, "seen", upserted_discovery_seen_cache=F.count(F.lit(1))), F.col("last_seen_at"))

    accepted = found.candidates.select(*NOTICE, F.xxhash64(*NOTICE).alias("id"), F.col("final_title").alias("title"), F.col("category"), "posted_at",
                                       F.col("position").cast("long").alias("position"))
    candidates = run.staged(accepted, "candidates", candidates=F.count(F.lit(1)))
    _store(spark, root, "source_notices", candidates, F.col("position"))

    owned = texts.join(candidates.select(*NOTICE, F.col("id").alias("notice_id")).distinct(), NOTICE)
    owned = owned.withColumn("attachment_id", F.xxhash64(*NOTICE, "file_seq")).withColumn("source_span", F.concat(F.lit(fixed.OBJECT_SCHEME), "object_key"))
    owned = run.staged(spread(owned, several_per_core(spark)), "texts", downloaded=F.count(F.lit(1)), stored_objects=F.count("object_key"))
    keep = ["notice_id", "attachment_id"]
    extracted = extract_attachments(owned.select(*keep, "kind", "artifact_type", "source_span", "raw_text"), spark.createDataFrame([], _SHEETS))
    shown = ["artifact_type", "status", "schema_version", "source_span", "raw_text", "confidence"]
    whole = A.text_artifacts(owned, "raw_text", F.col("source_span"), F.col("artifact_type"), F.lit("text"), keep).select(*keep, *shown)
    evidence = whole.unionByName(extracted.table_rows.select(*keep, *shown)).withColumn("merge_key", upsert.artifact_merge_key())
    evidence = run.staged(evidence.withColumn("id", F.xxhash64("merge_key")), "artifacts", upserted_artifacts=F.count(F.lit(1)))
    _store(spark, root, "extracted_artifacts", evidence, F.col("source_span"))

    offers = reconcile.attach_artifacts(extracted.offerings.withColumn("source", F.lit("board")), evidence, owner=("attachment_id",))
    offers = offers.withColumn("id", F.xxhash64(upsert.offering_merge_key()))
    offers = run.staged(last_row(quality.complete(offers), ["id"], F.col("application_unit_label")), "offerings", upserted_offerings=F.count(F.lit(1)))
    if snapshots.current(spark, f"{root}/offerings") is not None or run.stats["upserted_offerings"]:
        promotion.promote_batch(spark, f"{root}/offerings", offers, stored(spark, root, "source_notices"))

    dated = reconcile.attach_artifacts(extracted.schedules, evidence, base=True)
    dated = run.staged(dated, "schedules", upserted_schedules=F.count(F.lit(1)))
    _store(spark, root, "notice_schedules", dated, F.col("position"))

    notices = stored(spark, root, "source_notices")
    linked, _ = reconcile.reconcile(applications.drop("notice_id"), notices, position="position")
    ids = notices.groupBy(*BOARD, F.col("seq").alias("board_seq")).agg(F.max("id").alias("notice_id"))
    links = linked.join(ids, [*BOARD, "board_seq"]).groupBy(*APPLICATION).agg(F.max("notice_id").alias("notice_id"))
    rows = applications.drop("notice_id").join(links, APPLICATION, "left")
    rows = run.staged(rows, "linked", upserted_application_notices=F.count(F.lit(1)), linked_application_notices=F.count("notice_id"))
    _store(spark, root, "application_notices", rows, F.col("title"))

    state = f"{root}/offerings"
    run.count(total_artifacts=_rows(spark, f"{root}/extracted_artifacts", ["merge_key"]),
              total_offerings=promotion.promoted(spark, state).count() if snapshots.current(spark, state) else 0)


def _rows(spark: SparkSession, path: str, keys: list[str]) -> int:
    return snapshots.read(spark, path, keys).count() if snapshots.current(spark, path) else 0
