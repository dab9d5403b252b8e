"""The stored board workflow over notices rendered from customers: two runs, the tables and the run rows they leave."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticeloom.operators import promotion, snapshots, upsert
from noticeloom.plans import stored
from noticeloom.plans.registry import query
from noticeloom.plans.source_queries import L, text
from noticeloom.session import scratch_dir

PAGE = 50
_NOW = "2026-05-22 12:00:00"


def _rows(t):
    """Customers as notices: a fifth is rejected, a fifth unknown, the rest recruits; half of these have a file."""
    c = F.col("c_custkey")
    kind = F.when(c % 5 == 0, " 당첨자 발표").when(c % 5 == 1, " 안내").otherwise(" 입주자 모집공고")
    board = F.concat(L("b"), (F.col("c_nationkey") % 3).cast("string"))
    return t.customer.select(c, L("SH").alias("agency"), board.alias("board_kind"), c.cast("string").alias("seq"), F.floor(c / PAGE).cast("int").alias("page"),
                             F.concat(L("제 "), c.cast("string"), L(" 호"), kind).alias("title"), F.date_add(L("2026-05-01").cast("date"), (c % 20).cast("int")).alias("posted_at"))


def _landed(t):
    rows = _rows(t)
    line = text("<tr><td>1</td><td><a onclick=\"getDetailView('", F.col("seq"), "')\">", F.col("title"), "</a></td><td>팀</td><td>", F.col("posted_at"), "</td><td>1</td></tr>")
    listed = rows.groupBy("agency", "board_kind", "page").agg(F.array_sort(F.collect_list(F.struct("c_custkey", line.alias("line")))).alias("rows"))
    lists = listed.select("agency", "board_kind", "page", F.concat(L("<table id='listTb'><tbody>"), F.array_join("rows.line", ""), L("</tbody></table>")).alias("html"))
    details = rows.select("agency", "board_kind", "seq", text("<table><caption>", F.col("title"), "</caption></table><div class='cont'>본문</div>").alias("html"))
    body = text("공실 정보 들꽃 101 호 25 ㎡ 40 ㎡ 1 룸 90,000 2,100 들꽃 102 호 25 ㎡ 40 ㎡ 1 룸 0 2,100 들꽃 101 호 25 ㎡ 40 ㎡ 1 룸 90,000 2,100 임대 기간 신청기간 : 2026.5.1 ~ 2026.5.9 ", F.col("seq"))
    files = rows.where("c_custkey % 2 = 0").select("agency", "board_kind", "seq", L("1").alias("file_seq"), L("notice_pdf").alias("kind"), L("pdf_text").alias("artifact_type"),
                                                   F.concat(L("sh/"), "seq").alias("object_key"), body.alias("raw_text"))
    applications = rows.where("c_custkey % 10 = 2").select("agency", "board_kind", L("i").alias("source"), L("01").alias("sply_ty"), F.concat(L("R"), "seq").alias("recrnoti_cd"),
                                                           F.translate("title", " ", "").alias("title"), L("청약중").alias("status"), "posted_at")
    return lists, details, files, applications


def _two_runs(t):
    root, landed = scratch_dir(t.spark, "board"), _landed(t)
    now = L(_NOW).cast("timestamp")
    for run in ("first", "second"):
        stored.store_board_run(t.spark, root, run, *landed, now, L("2020-01-01").cast("date"))
    return root


_NOTICES = """
    WITH c AS (SELECT c_custkey AS k, 'b' || CAST(c_nationkey % 3 AS STRING) AS board_kind, CAST(floor(c_custkey / 50) AS BIGINT) AS page FROM customer),
    n AS (SELECT * FROM c WHERE k % 5 > 1), f AS (SELECT * FROM n WHERE k % 2 = 0)"""


@query("p01_board_run", _NOTICES + """
    SELECT f.board_kind, CAST(k AS STRING) AS seq, '들꽃 ' || u || '호 25㎡' AS application_unit_label, u || '호' AS unit_no, CASE WHEN i <> 2 THEN 90000 ELSE 0 END AS deposit_krw,
           CASE i WHEN 1 THEN 'approved' WHEN 3 THEN 'approved' ELSE 'rejected' END AS qa_status, 'object://sh/' || CAST(k AS STRING) || '#table=vacancy&row=' || CAST(i AS STRING) AS source_span, true AS has_artifact,
           CASE WHEN k % 10 = 2 THEN 'R' || CAST(k AS STRING) END AS recrnoti_cd, '2026-05-01' AS starts
    FROM f, (VALUES (1, '101'), (2, '102'), (3, '101')) AS v(i, u)""")
def _(t):
    """Offerings as they are stored after a run and its repetition, with notice, artifact, schedule and application."""
    root = _two_runs(t)
    table = lambda name: snapshots.read(t.spark, f"{root}/{name}", list(upsert.SPECS[name].keys))
    notices = table("source_notices").select(F.col("id").alias("notice_id"), "board_kind", "seq")
    artifacts = table("extracted_artifacts").select(F.col("id").alias("source_artifact_id"), L(True).alias("has_artifact"))
    dates = table("notice_schedules").select("notice_id", F.date_format("starts_at", "yyyy-MM-dd").alias("starts"))
    linked = table("application_notices").where("notice_id IS NOT NULL").select("notice_id", "recrnoti_cd")
    rows = promotion.promoted(t.spark, f"{root}/offerings").join(notices, "notice_id").join(artifacts, "source_artifact_id", "left")
    rows = rows.join(dates, "notice_id", "left").join(linked, "notice_id", "left")
    return rows.select("board_kind", "seq", "application_unit_label", "unit_no", "deposit_krw", "qa_status", "source_span", "has_artifact", "recrnoti_cd", "starts")


@query("p01_run_rows", _NOTICES + """,
    s AS (SELECT (SELECT count(DISTINCT (board_kind, page)) FROM c) AS pages, (SELECT count(*) FROM c) AS rows, (SELECT count(*) FROM n) AS notices, (SELECT count(*) FROM f) AS files,
                 (SELECT count(*) FROM c WHERE k % 10 = 2) AS applications)
    SELECT run_id, status, name, CAST(CASE name WHEN 'pages' THEN pages WHEN 'list_rows' THEN rows WHEN 'details' THEN CASE WHEN first THEN rows ELSE applications * 0 END
             WHEN 'candidates' THEN CASE WHEN first THEN notices ELSE 0 END WHEN 'rejected' THEN CASE WHEN first THEN rows - notices ELSE 0 END
             WHEN 'skipped_known' THEN CASE WHEN first THEN 0 ELSE notices END WHEN 'skipped_seen' THEN CASE WHEN first THEN 0 ELSE rows - notices END
             WHEN 'downloaded' THEN CASE WHEN first THEN files ELSE 0 END WHEN 'stored_objects' THEN CASE WHEN first THEN files ELSE 0 END
             WHEN 'upserted_artifacts' THEN CASE WHEN first THEN 4 * files ELSE 0 END WHEN 'upserted_offerings' THEN CASE WHEN first THEN 3 * files ELSE 0 END
             WHEN 'upserted_schedules' THEN CASE WHEN first THEN files ELSE 0 END WHEN 'total_artifacts' THEN 4 * files WHEN 'total_offerings' THEN 3 * files
             WHEN 'upserted_application_notices' THEN applications WHEN 'linked_application_notices' THEN applications
             WHEN 'upserted_discovery_seen_cache' THEN CASE WHEN first THEN rows - notices ELSE 0 END ELSE 0 END AS BIGINT) AS n
    FROM s, (VALUES ('first', true), ('second', false)) AS r(run_id, first), (VALUES ('succeeded')) AS w(status),
         (SELECT unnest(['pages', 'list_rows', 'details', 'candidates', 'rejected', 'skipped_old', 'skipped_known', 'skipped_seen', 'stopped_by_cutoff', 'downloaded', 'upserted_artifacts',
                         'upserted_offerings', 'stored_objects', 'total_artifacts', 'total_offerings', 'upserted_schedules', 'upserted_application_notices', 'linked_application_notices',
                         'upserted_discovery_seen_cache']) AS name)""")
def _(t):
    """The counters of both runs."""
    latest = upsert.latest_runs(t.spark.read.parquet(f"{_two_runs(t)}/collection_runs"))
    return latest.select("run_id", "status", F.explode("stats").alias("name", "n"))
