"""Quality gate, availability, serving, reconciliation, discovery, upserts and repair over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import numbers as N
from noticeloom.functions import text as T
from noticeloom.functions.dates import older_than
from noticeloom.operators import availability as A
from noticeloom.operators import classify, dedupe, discovery, enrich, intervals, predicates, promotion, quality, reconcile, rents, repair, reports, upsert
from noticeloom.plans import serve
from noticeloom.plans.registry import query
from noticeloom.session import cut_lineage, scratch_dir, short_shuffles

# --- quality gate ------------------------------------------------------------------------------------------
_NAME = "coalesce(nullif(housing_name, ''), complex_name, '')"
_API_LISTED = "(source = 'myhome' AND trim(list_no) <> '' AND trim(application_unit_label) <> '')"
_CLAUSES = {
    "notice_is_recruitment": "EXISTS (SELECT 1 FROM notices n WHERE n.id = o.notice_id AND n.category = 'recruitment')",
    "notice_linked": "notice_id IS NOT NULL",
    "origin_known": "attachment_id IS NOT NULL OR source = 'myhome'",
    "artifact_linked": "source_artifact_id IS NOT NULL",
    "span_present": "trim(source_span) <> ''",
    "span_scheme": "source_span LIKE 'object://%' OR source_span LIKE 'myhome://%'",
    "labelled": f"trim(application_unit_label) <> '' OR coalesce(trim(unit_no), '') <> '' OR trim({_NAME}) <> ''",
    "label_length": "length(application_unit_label) <= 256",
    "name_length": f"length({_NAME}) <= 128",
    "label_clean": "strpos(application_unit_label, '�') = 0",
    "name_clean": f"strpos({_NAME}, '�') = 0",
    "unit_clean": "strpos(coalesce(unit_no, ''), '�') = 0",
    "countable": f"coalesce(trim(unit_no), '') <> '' OR coalesce(supply_count, 0) > 0 OR {_API_LISTED}",
    "describable": ("coalesce(exclusive_area_m2, 0) > 0 OR trim(occupancy_type) <> '' OR (coalesce(supply_count, 0) > 0 AND "
                    f"(trim(application_unit_label) <> '' OR source = 'myhome')) OR {_API_LISTED}"),
    "priced": ("(coalesce(deposit_krw, 0) > 0 AND coalesce(monthly_rent_krw, 0) > 0) OR coalesce(jeonse_deposit_krw, 0) > 0 "
               "OR coalesce(dormitory_fee_krw, 0) > 0 OR (source = 'myhome' AND coalesce(contract_deposit_krw, 0) > 0 AND "
               "coalesce(balance_payment_krw, 0) > 0) OR (source = 'myhome' AND trim(deposit_text) <> '' AND "
               "trim(monthly_rent_text) <> '' AND strpos(deposit_text, '자세한 사항') = 0 AND strpos(monthly_rent_text, '자세한 사항') = 0)"),
}
_FAILED = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT ({c}) THEN '{n}' END" for n, c in _CLAUSES.items()) + ")"
_EVALUATED = f"evaluated AS (SELECT o.*, {_FAILED} AS failed_clauses FROM offerings o)"
_PROMOTED = f"""{_EVALUATED}, ranked AS (
    SELECT *, min(CASE WHEN failed_clauses = '' THEN id END) OVER (PARTITION BY notice_id, attachment_id, coalesce(source_row, -1),
        md5(coalesce(unit_no, '')), md5({_NAME}), md5(coalesce(application_unit_label, '')), md5(coalesce(source_span, ''))) AS canonical_id
    FROM evaluated), promoted AS (
    SELECT *, CASE WHEN failed_clauses = '' AND id = canonical_id THEN 'approved' ELSE 'rejected' END AS qa_status FROM ranked)"""


def _promoted(t):
    return quality.promote(t.project("offerings"), t.project("notices"))


_QA = ("notices", "offerings")


def _qa(sql: str) -> str:
    return ", " + _PROMOTED + " " + sql


@query("f09_f10_j17_quality_gate", ", " + _EVALUATED + " SELECT id, failed_clauses, failed_clauses = '' AS passes FROM evaluated", _QA)
def _(t):
    return quality.evaluate(t.project("offerings"), t.project("notices")).select("id", "failed_clauses", "passes")


@query("w01_m14_promote", _qa("SELECT id, qa_status, failed_clauses FROM promoted"), _QA)
def _(t):
    return _promoted(t).select("id", "qa_status", "failed_clauses")


@query("m14_decisions", _qa("SELECT id AS offering_id, qa_status AS decision, CASE WHEN qa_status = 'approved' THEN '' WHEN failed_clauses <> '' "
                            "THEN failed_clauses ELSE 'duplicate' END AS reason FROM promoted"), _QA)
def _(t):
    return quality.decisions(_promoted(t))


_FINAL = """, final AS (SELECT o.* REPLACE (CASE WHEN id % 3 <> 0 AND id % 2 <> 0 THEN application_unit_label || ' alt' ELSE application_unit_label END AS application_unit_label,
                                         CASE WHEN id % 3 <> 0 AND id % 2 <> 0 THEN CAST(5 AS INT) ELSE supply_count END AS supply_count) FROM offerings o WHERE id % 10 <> 7 QUALIFY count(*) OVER (PARTITION BY id) = 1), """
_KEPT_STATUS = _FINAL + _PROMOTED.replace("FROM offerings o", "FROM final o")


def _promoted_in_batches(t):
    """Two thirds as first read, then every second one as it is now, then the rest; a tenth is deleted and notices change at last.

    Lines with one key share an id and are left out here, because the state is kept per id.
    """
    path, lines = scratch_dir(t.spark, "promoted"), t.project("offerings")
    with short_shuffles(t.spark):
        shared = cut_lineage(lines.groupBy("id").count().where("count > 1").select("id"), "shared-ids")
    offerings = lines.join(shared, "id", "left_anti")
    notices = t.project("notices")
    first = offerings.where("id % 3 <> 0").withColumns({"application_unit_label": F.concat("application_unit_label", F.lit(" alt")), "supply_count": F.lit(5)})
    open_notices = notices.withColumn("category", F.lit("recruitment"))
    promotion.promote_batch(t.spark, path, first, open_notices)
    promotion.promote_batch(t.spark, path, offerings.where("id % 2 = 0"), open_notices, deleted=offerings.where("id % 10 = 7 AND id % 3 <> 0"))
    for _again in range(2):
        promotion.promote_batch(t.spark, path, offerings.where("id % 2 <> 0 AND id % 3 = 0"), notices, deleted=offerings.where("id % 10 = 7"),
                                changed_notices=notices.where("category <> 'recruitment'").select("id"))
    return promotion.promoted(t.spark, path)


@query("m14_promote_in_batches", _KEPT_STATUS + " SELECT id, qa_status, failed_clauses FROM promoted", _QA)
def _(t):
    return _promoted_in_batches(t).select("id", "qa_status", "failed_clauses")


@query("q01_approved_offerings", _qa("""
    SELECT id, source, application_unit_label, unit_no, exclusive_area_m2, supply_count, deposit_krw, monthly_rent_krw, source_row, source_span, qa_status
    FROM promoted WHERE qa_status = 'approved' ORDER BY id DESC LIMIT 200"""), _QA)
def _(t):
    approved = quality.approved(t.project("offerings"), t.project("notices"))
    return serve.offerings(approved).select(
        "id", "source", "application_unit_label", "unit_no", "exclusive_area_m2", "supply_count", "deposit_krw",
        "monthly_rent_krw", "source_row", "source_span", "qa_status")


@query("q07_a02_qa_summary", _qa("""
    SELECT count(*) FILTER (qa_status = 'approved') AS approved, count(*) FILTER (qa_status = 'rejected') AS rejected,
           count(*) FILTER (qa_status = 'pending') AS pending FROM promoted"""), _QA)
def _(t):
    return quality.summary(_promoted(t))


@query("a01_approved_per_notice", _qa("SELECT notice_id, count(*) AS approved_offerings FROM promoted WHERE qa_status = 'approved' GROUP BY notice_id"), _QA)
def _(t):
    return quality.approved(t.project("offerings"), t.project("notices")).groupBy("notice_id").agg(
        F.count(F.lit(1)).alias("approved_offerings"))


@query("q02_f11_notices", """
    SELECT id, agency, board_kind, seq, title, posted_at FROM notices WHERE category = 'recruitment' AND NOT (title LIKE '%결과%')
    ORDER BY posted_at DESC NULLS LAST, id DESC LIMIT 200""", ("notices",))
def _(t):
    return serve.notices(t.project("notices")).select("id", "agency", "board_kind", "seq", "title", "posted_at")


# --- availability ------------------------------------------------------------------------------------------
_NOW = "2024-01-15 12:00:00"
_VISITED = ("visited_notices", "visited_offerings", "visited_schedules", "visited_applications")
_AVAILABILITY = f"""
    , ac AS (SELECT notice_id, count(*) AS approved_offerings FROM visited_offerings WHERE qa_status = 'approved' GROUP BY notice_id),
    s AS (SELECT notice_id, max(CASE WHEN starts_at <= TIMESTAMP '{_NOW}' AND ends_at >= TIMESTAMP '{_NOW}' THEN 1 ELSE 0 END) AS any_open,
                 max(CASE WHEN starts_at > TIMESTAMP '{_NOW}' THEN 1 ELSE 0 END) AS any_next,
                 min(CASE WHEN starts_at <= TIMESTAMP '{_NOW}' AND ends_at >= TIMESTAMP '{_NOW}' THEN starts_at END) AS o_s,
                 arg_min(ends_at, starts_at) FILTER (starts_at <= TIMESTAMP '{_NOW}' AND ends_at >= TIMESTAMP '{_NOW}') AS o_e,
                 min(CASE WHEN starts_at > TIMESTAMP '{_NOW}' THEN starts_at END) AS n_s,
                 arg_min(ends_at, starts_at) FILTER (starts_at > TIMESTAMP '{_NOW}') AS n_e,
                 max(CASE WHEN ends_at < TIMESTAMP '{_NOW}' THEN ends_at END) AS l_e,
                 arg_max(starts_at, CAST(epoch_us(ends_at) AS HUGEINT) * 100000000000000000 - epoch_us(starts_at)) FILTER (ends_at < TIMESTAMP '{_NOW}') AS l_s
          FROM visited_schedules WHERE schedule_type = 'application' AND starts_at IS NOT NULL AND ends_at IS NOT NULL GROUP BY notice_id),
    a AS (SELECT notice_id, max(CASE status WHEN '청약중' THEN 2 ELSE 1 END) AS r FROM visited_applications
          WHERE status IN ('청약중', '접수예정') GROUP BY notice_id),
    j AS (SELECT n.id AS notice_id, n.agency, n.seq, approved_offerings,
                 CASE WHEN s.notice_id IS NULL THEN 'unknown' WHEN any_open = 1 THEN 'open' WHEN any_next = 1 THEN 'pending' ELSE 'closed' END AS schedule_status,
                 CASE WHEN a.notice_id IS NULL THEN 'unknown' WHEN r = 2 THEN 'open' ELSE 'pending' END AS application_status,
                 CASE WHEN any_open = 1 THEN o_s WHEN any_next = 1 THEN n_s ELSE l_s END AS starts_at,
                 CASE WHEN any_open = 1 THEN o_e WHEN any_next = 1 THEN n_e ELSE l_e END AS ends_at
          FROM visited_notices n JOIN ac ON ac.notice_id = n.id LEFT JOIN s ON s.notice_id = n.id LEFT JOIN a ON a.notice_id = n.id),
    v AS (SELECT *, CASE WHEN application_status <> 'unknown' THEN application_status ELSE schedule_status END AS status,
                 CASE WHEN application_status <> 'unknown' THEN 'application_notice' WHEN schedule_status <> 'unknown' THEN 'schedule' ELSE 'none' END AS status_source,
                 application_status <> 'unknown' AND schedule_status <> 'unknown' AND application_status <> schedule_status AS conflict FROM j)
    SELECT notice_id, agency, seq, approved_offerings, schedule_status, application_status, status, status_source, conflict,
           coalesce(strftime(starts_at, '%Y-%m-%d %H:%M:%S'), '') AS starts_at, coalesce(strftime(ends_at, '%Y-%m-%d %H:%M:%S'), '') AS ends_at FROM v"""
_SHOWN = ("notice_id", "agency", "seq", "approved_offerings", "schedule_status", "application_status", "status", "status_source", "conflict")


def _shown(df):
    show = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias(c)
    return df.select(*_SHOWN, show("starts_at"), show("ends_at"))


def _now():
    return F.lit(_NOW).cast("timestamp_ntz")


@query("j13_a07_a08_a09_a10_availability", _AVAILABILITY, _VISITED)
def _(t):
    approved = t.project("visited_offerings").where("qa_status = 'approved'")
    return _shown(A.availability(t.project("visited_notices"), approved, t.project("visited_schedules"),
                                 t.project("visited_applications"), _now()))


@query("q04_f12_o04_availability_served", _AVAILABILITY + """
    WHERE agency = 'A1' AND status IN ('pending', 'open') ORDER BY CASE status WHEN 'open' THEN 0 ELSE 1 END, v.starts_at NULLS LAST, agency, seq LIMIT 50""", _VISITED)
def _(t):
    return _shown(serve.availability(t.project("visited_notices"), t.project("visited_offerings"), t.project("visited_schedules"),
                                     t.project("visited_applications"), _now(), 50, agency="A1", statuses=("pending", "open")))


@query("q03_j12_o03_schedules", """
    SELECT id, notice_id, starts_at, ends_at FROM visited_schedules s
    WHERE EXISTS (SELECT 1 FROM visited_offerings o WHERE o.notice_id = s.notice_id AND o.qa_status = 'approved')
    ORDER BY starts_at NULLS LAST, id LIMIT 200""", ("visited_schedules", "visited_offerings"))
def _(t):
    return serve.schedules(t.project("visited_schedules"), t.project("visited_offerings")).select("id", "notice_id", "starts_at", "ends_at")


@query("j16_interval_containment", f"""
    SELECT id, notice_id FROM visited_schedules WHERE TIMESTAMP '{_NOW}' BETWEEN starts_at AND ends_at""", ("visited_schedules",))
def _(t):
    return t.project("visited_schedules").where(_now().between(F.col("starts_at"), F.col("ends_at"))).select("id", "notice_id")


_AS_OF = "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS notice_id, ts, ts + CAST(floor(value) AS INT) * 10 * INTERVAL '1' MINUTE AS until, event_type FROM {events}"


@query("j16_as_of_join", f"""
    WITH e AS ({_AS_OF.format(events='events')})
    SELECT m.event_id, count(s.event_id) AS open_schedules, min(s.event_id) AS first_open, max(s.until) AS open_until
    FROM e m LEFT JOIN e s ON s.notice_id = m.notice_id AND s.event_type IN ('view', 'signup') AND m.ts BETWEEN s.ts AND s.until GROUP BY m.event_id""")
def _(t):
    """Schedules open at each of all moments; one notice holds a third of both sides."""
    events = t.spark.sql(_AS_OF, events=t.events)
    schedules = events.where("event_type IN ('view', 'signup')").select(F.col("event_id").alias("id"), "notice_id", F.col("ts").alias("starts_at"), F.col("until").alias("ends_at"))
    moments = events.select("event_id", "notice_id", "ts")
    held = intervals.summarised(moments, schedules, ["notice_id"], "ts", ["event_id"], {
        "open_schedules": (F.sum, F.lit(1)), "first_open": (F.min, F.col("id")), "open_until": (F.max, F.col("ends_at"))})
    return moments.select("event_id").join(held, "event_id", "left").fillna(0, ["open_schedules"])


@query("o01_o06_newest_orders", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 1000")
def _(t):
    return serve.newest(t.orders.select("o_orderkey", "o_custkey"), serve.api_limit("5000"), "o_orderkey")


# --- classification ----------------------------------------------------------------------------------------
_HEAD = "string_split(text, chr(10))[1]"
_PROSE_RULES = (
    classify.Rule("rejected", "title", ("tion", "ist")), classify.Rule("rejected", "title", ("und",)),
    classify.Rule("rejected", "body", ("%%%", "***")), classify.Rule("recruitment", "title", ("the", "les")),
    classify.Rule("recruitment", "body", ("that", "dans")),
)
_PROSE_SQL = f"""CASE WHEN {_HEAD} LIKE '%tion%' OR {_HEAD} LIKE '%ist%' THEN 'rejected' WHEN {_HEAD} LIKE '%und%' THEN 'rejected'
    WHEN text LIKE '%\\%\\%\\%%' ESCAPE '\\' OR text LIKE '%***%' THEN 'rejected' WHEN {_HEAD} LIKE '%the%' OR {_HEAD} LIKE '%les%' THEN 'recruitment'
    WHEN text LIKE '%that%' OR text LIKE '%dans%' THEN 'recruitment' ELSE 'unknown' END"""


def _first_line():
    return F.split_part("text", F.lit("\n"), F.lit(1))


@query("f01_notice_classifier", f"SELECT doc_id, {_PROSE_SQL} AS category FROM documents")
def _(t):
    return t.documents.select("doc_id", classify.notice_category(_first_line(), "text", _PROSE_RULES).alias("category"))


@query("f01_default_rules", """
    SELECT o_orderkey, CASE o_custkey % 6 WHEN 0 THEN 'rejected' WHEN 1 THEN 'rejected' WHEN 2 THEN 'recruitment' WHEN 3 THEN 'recruitment'
           WHEN 4 THEN 'unknown' ELSE 'rejected' END AS category, o_custkey % 6 IN (2, 3, 4, 5) AS is_listed FROM orders""")
def _(t):
    k = F.col("o_custkey") % 6
    title = F.concat(F.col("o_orderpriority"), F.when(k == 0, " 입주자 모집 당첨자 결과").when(k == 1, " 청약경쟁률").when(k == 2, " 정정공고").otherwise(" 안내"))
    body = F.when(k == 3, "공급대상 주택").when(k == 5, "시스템 점검, 입주자 모집").otherwise("")
    return t.orders.select("o_orderkey", classify.notice_category(title, body).alias("category"), classify.is_listed(title).alias("is_listed"))


@query("f02_attachment_classifier", """
    SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'applicant_or_winner_file' WHEN 1 THEN 'application_form' WHEN 2 THEN 'offering_list_xlsx'
           WHEN 3 THEN 'unsupported' WHEN 4 THEN 'schedule_pdf' WHEN 5 THEN 'notice_pdf' WHEN 6 THEN 'notice_hwp' ELSE 'unsupported' END AS kind FROM part""")
def _(t):
    names = ("당첨자 모집.pdf", "신청서 모집.HWP", "주택목록.XLSX", "목록.xlsx", "일정 공고.pdf", "모집공고.PDF ", "모집.hwpx", "모집.doc")
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("p_size") % 8 + 1)
    return t.part.select("p_partkey", classify.attachment_kind(F.concat("p_name", F.lit(" "), name)).alias("kind"))


@query("f02_page_kinds", """
    SELECT page_id, CASE WHEN contains(lower(url), 'blog') THEN 'blog' WHEN regexp_extract(url, '\\.([^./]*)$', 1) IN ('html', 'htm') THEN 'file' ELSE 'page' END AS kind FROM pages""")
def _(t):
    rules = (classify.Rule("blog", "name", ("blog",)), classify.Rule("file", "name", (), {"ext": ("html", "htm")}))
    return t.pages.select("page_id", classify.attachment_kind("url", rules, "page").alias("kind"))


@query("f03_age_cutoff", "SELECT event_id FROM events WHERE event_id % 4 = 0 OR ts >= TIMESTAMP '2024-01-21 00:00:00'")
def _(t):
    posted = F.when(F.col("event_id") % 4 != 0, F.col("ts"))
    return t.events.withColumn("posted", posted).where(
        predicates.within_age("posted", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"), 10)).select("event_id")


@query("f04_f06_agency_and_status", "SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus IN ('O', 'P')")
def _(t):
    return t.orders.where(predicates.agency_is(F.concat(F.lit(" "), "o_orderpriority"), " 2-high ")
                          & predicates.is_active("o_orderstatus", ("O", "P"))).select("o_orderkey")


@query("f05_persistable_guard", f"""
    SELECT doc_id, CASE WHEN {_HEAD} LIKE '%tion%' OR {_HEAD} LIKE '%ist%' OR {_HEAD} LIKE '%und%' THEN false
                        ELSE {_HEAD} LIKE '%the%' OR {_HEAD} LIKE '%les%' END AS accepted FROM documents""")
def _(t):
    docs = t.documents.select("doc_id", _first_line().alias("title"))
    yes, no = classify.split_persistable(docs, "title", _PROSE_RULES)
    return yes.select("doc_id", F.lit(True).alias("accepted")).unionByName(no.select("doc_id", F.lit(False).alias("accepted")))


@query("f07_f08_enrichment_needed", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN false WHEN o_custkey % 3 > 0 AND o_custkey % 2 = 0 AND o_custkey % 5 = 0 THEN false
               WHEN o_orderkey % 4 = 0 THEN true WHEN o_custkey % 7 > 1 THEN o_orderstatus = 'P' OR o_orderstatus = 'F' ELSE false END AS needs_detail,
           o_custkey % 4 > 0 AND (o_orderkey % 2 = 0 OR o_custkey % 2 = 0) AS needs_file FROM orders""")
def _(t):
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    items = t.orders.select(
        "o_orderkey", F.when(k % 10 == 0, " ").otherwise("http://x").alias("detail_url"), (c % 3).alias("house_sn"),
        F.when(c % 2 == 0, 1).alias("contract_payment_krw"), F.when(c % 5 == 0, 1).alias("balance_payment_krw"),
        F.when(k % 4 != 0, 3).alias("supply_count"),
        F.when(F.col("o_orderstatus") == "P", "전세임대").when(F.col("o_orderstatus") == "F", " 매입임대").otherwise("기타").alias("supply_type"),
        F.when(c % 7 <= 1, 5).alias("deposit_krw"), F.when(c % 7 <= 1, 5).alias("monthly_rent_krw"), (c % 4).alias("files"),
        F.when(k % 2 == 0, "").otherwise("a").alias("deposit_condition_text"), F.when(c % 2 == 0, " ").otherwise("b").alias("monthly_rent_condition_text"))
    return items.select("o_orderkey", predicates.needs_detail().alias("needs_detail"), predicates.needs_file("files").alias("needs_file"))


@query("f13_row_search", "SELECT c_custkey FROM customer WHERE contains(lower(c_name || ' ' || c_mktsegment), '9 build')")
def _(t):
    return t.customer.where(predicates.row_search(" 9 BUILD ", "c_name", "c_mktsegment")).select("c_custkey")


@query("f14_f15_repair_budget", "SELECT event_id FROM events WHERE user_id > 0 AND event_type = 'error' ORDER BY value DESC, event_id LIMIT 60")
def _(t):
    rows = t.events.where(predicates.is_repair_target("user_id", F.when(F.col("event_type") == "error", 1)))
    return predicates.within_budget(rows, [F.col("value").desc(), F.col("event_id")], 40, 100).select("event_id")


@query("f16_schedule_row_types", "SELECT page_id, kind FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'pdf_text' WHEN 1 THEN 'hwp_text' WHEN 2 THEN 'html_preview' ELSE 'xlsx_row' END AS kind FROM pages) WHERE kind IN ('pdf_text', 'html_preview')")
def _(t):
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("pdf_text", "hwp_text", "html_preview", "xlsx_row")]), (F.col("page_id") % 4 + 1).cast("int"))
    return t.pages.select("page_id", kinds.alias("kind")).where(predicates.has_schedule_text("kind"))


@query("f10_corrupt_text", "SELECT doc_id, strpos(text, '�') = 0 AS is_clean FROM documents")
def _(t):
    return t.documents.select("doc_id", predicates.is_clean_text("text").alias("is_clean"))


# --- joins and set operations --------------------------------------------------------------------------------
@query("j01_u02_reconcile", """
    , keyed AS (SELECT *, lower(replace(regexp_replace(title, '[^0-9A-Za-z]', '', 'g'), ' ', '')) || '|' || coalesce(CAST(posted_at AS STRING), '') AS k FROM list_rows),
    candidates AS (SELECT k, max(seq) AS board_seq FROM keyed WHERE board <> 0 GROUP BY k)
    SELECT a.seq, c.board_seq FROM keyed a LEFT JOIN candidates c ON a.k = c.k WHERE a.board = 0""", ("list_rows",))
def _(t):
    rows = t.project("list_rows")
    linked, unmatched = reconcile.reconcile(rows.where("board = 0").select("seq", "title", "posted_at"),
                                            rows.where("board <> 0").select("seq", "title", "posted_at", "position"))
    return linked.select("seq", "board_seq").unionByName(unmatched.select("seq", F.lit(None).cast("bigint").alias("board_seq")))


@query("j01_document_copies", """
    SELECT p.doc_id, max(c.doc_id) AS copy_id FROM documents p JOIN documents c
      ON regexp_replace(lower(p.text), '[\\s\\p{P}\\p{S}]+', '', 'g') = regexp_replace(lower(c.text), '[\\s\\p{P}\\p{S}]+', '', 'g')
    WHERE p.doc_id % 2 = 0 AND c.doc_id % 2 = 1 GROUP BY p.doc_id""")
def _(t):
    docs = t.documents.select(F.col("doc_id").alias("seq"), F.sha2(T.title_key_strict("text"), 256).alias("title"),
                              F.lit(None).cast("date").alias("posted_at"), F.col("doc_id").alias("position"))
    linked, _rest = reconcile.reconcile(docs.where("seq % 2 = 0"), docs.where("seq % 2 = 1"))
    return linked.select(F.col("seq").alias("doc_id"), F.col("board_seq").alias("copy_id"))


@query("j02_known_skip", """
    SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events k WHERE k.user_id = e.user_id AND k.event_type = e.event_type AND k.ts < TIMESTAMP '2024-01-08 00:00:00')""")
def _(t):
    known = t.events.where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    return discovery.skip_known(t.events.select("event_id", "user_id", "event_type"), known, ["user_id", "event_type"]).select("event_id")


# cache: one entry per (board, user title), written by early events
_CACHE = """, cache AS (SELECT board, title, max(seq) AS seq FROM list_rows WHERE posted_at < DATE '2024-01-10' GROUP BY board, title),
    entries AS (SELECT c.board, c.title, CASE c.seq % 3 WHEN 0 THEN 'rejected' WHEN 1 THEN 'rejected_unknown' ELSE 'accepted' END AS status,
                       CASE WHEN c.seq % 5 = 0 THEN '' ELSE c.title END AS hashed_title, l.posted_at,
                       CASE WHEN c.seq % 7 = 0 THEN NULL ELSE DATE '2024-01-05' + CAST(c.seq % 20 AS INT) END AS expires_at
                FROM cache c JOIN list_rows l ON l.seq = c.seq)"""


def _cache(t, rows):
    newest = (rows.where(F.col("posted_at") < F.lit("2024-01-10").cast("date")).groupBy("board", "title")
              .agg(F.max_by(F.struct("seq", "posted_at"), "seq").alias("c")))
    s = F.col("c.seq")
    return newest.select(
        "board", "title", F.when(s % 3 == 0, "rejected").when(s % 3 == 1, "rejected_unknown").otherwise("accepted").alias("status"),
        F.when(s % 5 == 0, "").otherwise(T.title_hash("title")).alias("list_title_hash"), F.col("c.posted_at").alias("posted_at"),
        F.when(s % 7 != 0, F.date_add(F.lit("2024-01-05").cast("date"), (s % 20).cast("int"))).alias("expires_at"))


@query("j03_d04_seen_skip", _CACHE + """
    SELECT r.seq, coalesce(e.status IN ('rejected', 'rejected_unknown') AND (e.expires_at IS NULL OR e.expires_at > DATE '2024-01-14')
             AND (e.posted_at IS NULL OR r.posted_at IS NULL OR e.posted_at = r.posted_at), false) AS is_seen
    FROM list_rows r LEFT JOIN entries e ON e.board = r.board AND e.title = r.title""", ("list_rows",))
def _(t):
    rows = t.project("list_rows")
    joined = discovery.with_seen(rows, _cache(t, rows), ["board", "title"])
    return joined.select("seq", discovery.can_skip_seen("title", "posted_at", F.lit("2024-01-14").cast("date")).alias("is_seen"))


@query("j04_target_titles", """
    SELECT p_partkey, (SELECT min(w) FROM (SELECT DISTINCT split_part(p_name, ' ', 2) AS w FROM part WHERE p_size > 10) t
                       WHERE contains(replace(p_name, ' ', ''), w) OR contains(w, replace(p_name, ' ', ''))) AS target FROM part""")
def _(t):
    targets = t.part.where("p_size > 10").select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("w"))
    return discovery.match_targets(t.part.select("p_partkey", "p_name"), targets, T.title_key_plain("p_name"), "w").select("p_partkey", "target")


@query("j04_text_targets", """
    SELECT b.item_id, (SELECT min(k) FROM (SELECT DISTINCT regexp_replace(lower(text), '[\\s\\p{P}\\p{S}]+', '', 'g') AS k FROM conversations WHERE role = 'user') c
                       WHERE k <> '' AND (contains(b.k0, k) OR contains(k, b.k0))) AS target
    FROM (SELECT item_id, regexp_replace(lower(text), '[\\s\\p{P}\\p{S}]+', '', 'g') AS k0 FROM benchmark) b""")
def _(t):
    targets = t.conversations.where("role = 'user'").select(T.title_key_strict("text").alias("k"))
    return discovery.match_targets(t.benchmark, targets, T.title_key_strict("text"), "k").select("item_id", "target")


@query("j04_letter_targets", """
    WITH k AS (SELECT DISTINCT unnest([substr(text, 1, 1), substr(text, 2, 2), substr(text, 1, 12)]) AS k FROM conversations WHERE text <> ''),
    r AS (SELECT DISTINCT text FROM documents UNION SELECT text FROM conversations)
    SELECT md5(text) AS title, min(k) AS target FROM r LEFT JOIN k ON k <> '' AND text <> '' AND (contains(text, k) OR contains(k, text)) GROUP BY text""")
def _(t):
    """Targets of one, two and twelve letters, looked for in all documents and turns."""
    targets = t.conversations.where("text <> ''").select(F.explode(F.array(*[F.substring("text", a, n) for a, n in ((1, 1), (2, 2), (1, 12))])).alias("k"))
    rows = t.documents.select("text").union(t.conversations.select("text")).select("text", F.md5("text").alias("title"))
    return discovery.match_targets(rows, targets, F.col("text"), "k", 3 * t.spark.sparkContext.defaultParallelism).select("title", "target").distinct()


_DECIDED = _CACHE + """,
    targets AS (SELECT DISTINCT board, 'clicknotice' || CAST(user_id AS STRING) AS target FROM (SELECT event_id % 5 AS board, user_id FROM events WHERE value > 150)),
    keyed AS (SELECT DISTINCT lower(translate(title, ' .()', '')) AS k FROM list_rows),
    found AS (SELECT k, list(x.target ORDER BY x.target) AS ts FROM keyed JOIN (SELECT DISTINCT target FROM targets) x ON contains(k, x.target) OR contains(x.target, k) GROUP BY k),
    matched AS (SELECT r.board, r.seq, f.ts, row_number() OVER (PARTITION BY r.board ORDER BY r.seq) AS n FROM list_rows r JOIN found f ON f.k = lower(translate(r.title, ' .()', ''))),
    walk AS (SELECT board, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS seq, CAST([] AS VARCHAR[]) AS used, CAST(NULL AS VARCHAR) AS took FROM (SELECT DISTINCT board FROM matched)
             UNION ALL SELECT m.board, m.n, m.seq, CASE WHEN m.free IS NULL THEN m.used ELSE list_append(m.used, m.free) END, m.free
                       FROM (SELECT x.board, x.n, x.seq, w.used, list_filter(x.ts, lambda t: NOT list_contains(w.used, t))[1] AS free FROM walk w JOIN matched x ON x.board = w.board AND x.n = w.n + 1) m),
    hits AS (SELECT r.*, coalesce(w.took, f.ts[1]) AS target, w.took IS NOT NULL AS is_target FROM list_rows r LEFT JOIN found f ON f.k = lower(translate(r.title, ' .()', ''))
             LEFT JOIN walk w ON w.board = r.board AND w.seq = r.seq),
    flags AS (SELECT h.*, coalesce(h.posted_at < DATE '2024-01-06', false) AS is_old, h.seq % 13 = 0 AS is_known,
                     coalesce(e.status IN ('rejected', 'rejected_unknown') AND (e.expires_at IS NULL OR e.expires_at > DATE '2024-01-14')
                       AND (e.posted_at IS NULL OR h.posted_at IS NULL OR e.posted_at = h.posted_at), false) AS is_seen
              FROM hits h LEFT JOIN entries e ON e.board = h.board AND e.title = h.title),
    decided AS (SELECT *, CASE WHEN is_old AND NOT is_target THEN 'skipped_old' WHEN is_known THEN 'skipped_known' WHEN is_seen AND NOT is_target THEN 'skipped_seen' ELSE 'detail' END AS outcome FROM flags)"""


def _decided(t):
    rows = t.project("list_rows")
    targets = t.events.where("value > 150").select(F.concat(F.lit("clicknotice"), "user_id").alias("target"))
    hits = discovery.use_up_targets(rows, targets, T.title_key_plain("title"), "target", ["board"], ["seq"])
    flagged = discovery.with_seen(hits, _cache(t, rows), ["board", "title"])
    seen = discovery.can_skip_seen("title", "posted_at", F.lit("2024-01-14").cast("date"))
    old = older_than("posted_at", F.lit("2024-01-06").cast("date"))
    return flagged.withColumn("outcome", discovery.outcome(old, F.col("is_target"), F.col("seq") % 13 == 0, seen))


@query("j05_discovery_decision", _DECIDED + " SELECT seq, target, is_target, outcome FROM decided", ("list_rows",))
def _(t):
    return _decided(t).select("seq", "target", "is_target", "outcome")


# pages newest first, so that old rows come late
_LAST_PAGE = 1_000_000_000_000
_STOP = _DECIDED + f""",
    paged AS (SELECT *, {_LAST_PAGE} - page AS depth FROM decided),
    pending AS (SELECT DISTINCT board, target FROM targets WHERE board <> 3),
    met AS (SELECT p.board, p.target, min(depth) AS met FROM pending p LEFT JOIN paged g ON g.board = p.board AND g.target = p.target AND g.is_target GROUP BY p.board, p.target),
    ready AS (SELECT b.board, CASE WHEN count(m.target) = 0 THEN 0 WHEN count(m.met) = count(m.target) THEN max(m.met) END AS ready
              FROM (SELECT DISTINCT board FROM list_rows) b LEFT JOIN met m ON m.board = b.board GROUP BY b.board),
    stop AS (SELECT g.board, min(depth) AS stop FROM paged g JOIN ready r ON r.board = g.board WHERE outcome = 'skipped_old' AND depth >= ready GROUP BY g.board)
    SELECT g.seq, g.outcome FROM paged g LEFT JOIN stop s ON s.board = g.board WHERE stop IS NULL OR depth <= stop"""


def _paged(t):
    decided = _decided(t)
    return decided.withColumn("depth", F.lit(_LAST_PAGE) - F.col("page"))


@query("j06_page_early_stop", _STOP, ("list_rows",))
def _(t):
    pending = t.events.where("value > 150 AND event_id % 5 <> 3").select((F.col("event_id") % 5).alias("board"),
                                                                      F.concat(F.lit("clicknotice"), "user_id").alias("target"))
    return discovery.early_stop(_paged(t), ["board"], "depth", pending).select("seq", "outcome")


@query("j07_u03_wanted_rows", """
    SELECT w.user_id, min(e.event_id) AS event_id FROM (SELECT DISTINCT user_id * 2 AS user_id FROM events) w LEFT JOIN events e ON e.user_id = w.user_id GROUP BY w.user_id""")
def _(t):
    wanted = t.events.select((F.col("user_id") * 2).alias("user_id"))
    return discovery.select_wanted(t.events.select("user_id", "event_id"), wanted, ["user_id"], [F.col("event_id")]).select("user_id", "event_id")


@query("j08_artifact_by_span", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderkey AS source_artifact_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'F'""")
def _(t):
    artifacts = t.orders.where("o_orderstatus <> 'F'").select(F.concat(F.lit("object://"), "o_orderkey").alias("source_span"), F.col("o_orderkey").alias("id"))
    artifacts = artifacts.unionByName(artifacts.withColumn("id", -F.col("id")))  # an earlier artifact of the same span
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                              T.schedule_span(F.concat(F.lit("object://"), "l_orderkey")).alias("source_span"))
    return reconcile.attach_artifacts(lines, artifacts, base=True).drop("source_span")


@query("j09_application_links", """
    SELECT o_orderkey AS application_id, c_custkey AS notice_id FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> 'BUILDING' AND o_orderstatus <> 'P'""")
def _(t):
    """Every seq stands on two boards and every code in two sources; links belong to one of each."""
    board, source = (F.col("o_custkey") % 2).alias("board_kind"), (F.col("o_orderkey") % 2).alias("source")
    linked = t.orders.select(F.concat(F.lit("r"), "o_orderkey").alias("recruit_code"), F.concat(F.lit("s"), "o_custkey").alias("board_seq"), board, source)
    notices = t.customer.where("c_mktsegment <> 'BUILDING'").select(F.concat(F.lit("s"), "c_custkey").alias("seq"), F.explode(F.array(F.lit(0), F.lit(1))).alias("n"), "c_custkey").select(
        "seq", F.col("n").cast("bigint").alias("board_kind"), F.when(F.col("c_custkey") % 2 == F.col("n"), F.col("c_custkey")).otherwise(-F.col("c_custkey")).alias("id"))
    apps = t.orders.where("o_orderstatus <> 'P'").select(F.concat(F.lit("r"), "o_orderkey").alias("recruit_code"), F.explode(F.array(F.lit(0), F.lit(1))).alias("n"), "o_orderkey").select(
        "recruit_code", F.col("n").cast("bigint").alias("source"), F.when(F.col("o_orderkey") % 2 == F.col("n"), F.col("o_orderkey")).otherwise(-F.col("o_orderkey")).alias("id"))
    return reconcile.application_links(linked, notices, apps, ["board_kind"], ["source"])


def _repair_tables(t):
    docs = t.documents.select(
        F.col("doc_id").alias("id"), (F.col("doc_id") % 50).alias("attachment_id"), F.lit("extracted").alias("status"),
        F.when(F.col("lang") == "en", "pdf_text").when(F.col("lang") == "fr", "html_preview").otherwise("xlsx_row").alias("artifact_type"),
        F.concat(F.when(F.col("doc_id") % 9 == 0, "file://").otherwise("object://"), "source").alias("source_span"),
        F.col("text").alias("raw_text"), F.lit("").alias("content_json"))
    ids = t.events.select((F.col("user_id") % 50).alias("id")).distinct()
    attachments = ids.select("id", (F.col("id") % 20).alias("notice_id"), F.concat(F.lit("f"), "id").alias("original_filename"),
                             F.when(F.col("id") % 4 == 0, "schedule_pdf").otherwise("notice_pdf").alias("attachment_kind"))
    notices = t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("seq"), F.col("n_name").alias("title"),
                              F.when(F.col("n_nationkey") % 6 == 0, "rejected").otherwise("recruitment").alias("category"))
    offerings = t.labels.select(F.when(F.col("quality") == 0, F.col("doc_id")).alias("source_artifact_id"), (F.col("doc_id") % 15).alias("notice_id"),
                                F.when((F.col("toxic") == 1) & (F.col("doc_id") % 3 == 0), "approved").otherwise("rejected").alias("qa_status"))
    attempts = t.labels.select(F.col("doc_id").alias("artifact_id"), F.when(F.col("doc_id") % 7 == 0, "succeeded").otherwise("failed").alias("status"))
    return docs, attachments, notices, offerings, attempts


_REPAIR = """
    WITH a AS (SELECT doc_id AS id, doc_id % 50 AS attachment_id, CASE lang WHEN 'en' THEN 'pdf_text' WHEN 'fr' THEN 'html_preview' ELSE 'xlsx_row' END AS artifact_type,
                      CASE WHEN doc_id % 9 = 0 THEN 'file://' ELSE 'object://' END || source AS source_span, text AS raw_text FROM documents),
    f AS (SELECT DISTINCT user_id % 50 AS id FROM events), n AS (SELECT n_nationkey AS id, n_name FROM nation WHERE n_nationkey % 6 <> 0),
    c AS (SELECT a.*, f.id % 20 AS notice_id, n_name AS notice_title,
                 EXISTS (SELECT 1 FROM labels l WHERE l.doc_id % 15 = f.id % 20 AND l.toxic = 1 AND l.doc_id % 3 = 0) AS has_approved
          FROM a JOIN f ON f.id = a.attachment_id JOIN n ON n.id = f.id % 20
          WHERE f.id % 4 <> 0 AND artifact_type IN ('pdf_text', 'html_preview') AND source_span LIKE 'object://%' AND trim(raw_text) <> ''
            AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.quality = 0 AND l.doc_id = a.id)
            AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = a.id AND l.doc_id % 7 = 0))"""


@query("j10_repair_candidates", _REPAIR + " SELECT id, notice_id, notice_title, has_approved FROM c")
def _(t):
    return repair.repair_candidates(*_repair_tables(t), include_approved=True).select("id", "notice_id", "notice_title", "has_approved")


@query("q06_o05_h01_repair_requests", _REPAIR + f"""
    SELECT id, sha256('{{"notice_title":"' || notice_title || '","content_json":"{{}}","raw_text":' || CAST(to_json(CASE WHEN length(r) > 12000 THEN substr(r, 1, 12000) || chr(10) || '[TRUNCATED]' ELSE r END) AS STRING) || '}}') AS input_hash
    FROM (SELECT *, regexp_replace(raw_text, '^{fixed.WS}+|{fixed.WS}+$', '', 'g') AS r FROM c WHERE NOT has_approved)
    ORDER BY CASE artifact_type WHEN 'pdf_text' THEN 0 ELSE 1 END, length(raw_text) DESC, id LIMIT 20""")
def _(t):
    found = repair.repair_candidates(*_repair_tables(t)).orderBy(*repair.repair_order()).limit(serve.table_limit(0, fixed.REPAIR_LIST_DEFAULT))
    return repair.requests(found, ["id"], notice_title="notice_title").select("id", "input_hash")


@query("j11_artifact_context", """
    SELECT doc_id AS id, coalesce(f.id, 0) * 0 + CASE WHEN f.id IS NULL THEN 0 ELSE f.id % 20 END AS notice_id, coalesce(n_name, '') AS notice_title,
           CASE WHEN f.id IS NULL THEN '' ELSE 'f' || CAST(f.id AS STRING) END AS original_filename
    FROM documents LEFT JOIN (SELECT DISTINCT user_id % 50 AS id FROM events) f ON f.id = doc_id % 70 LEFT JOIN nation ON n_nationkey = f.id % 20""")
def _(t):
    docs, attachments, notices, _o, _a = _repair_tables(t)
    return repair.with_context(docs.withColumn("attachment_id", F.col("id") % 70), attachments, notices).select(
        "id", "notice_id", "notice_title", "original_filename")


@query("j14_j15_fill_missing", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN c_mktsegment ELSE o_orderpriority END AS condition_text,
           CASE WHEN o_orderkey % 3 = 0 THEN c_custkey ELSE 7 END AS deposit_krw, CASE WHEN o_orderkey % 5 = 0 THEN 9 ELSE CAST(o_orderkey % 5 AS INT) END AS supply_count
    FROM orders JOIN customer ON c_custkey = o_custkey""")
def _(t):
    k = F.col("o_orderkey")
    left = t.orders.select("o_orderkey", F.col("o_custkey").alias("key"), F.when(k % 2 == 0, " ").otherwise(F.col("o_orderpriority")).alias("condition_text"),
                           F.when(k % 3 != 0, 7).cast("bigint").alias("deposit_krw"), (k % 5).cast("int").alias("supply_count"))
    right = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("condition_text"), F.col("c_custkey").alias("deposit_krw"), F.lit(9).alias("supply_count"))
    routed = enrich.enrich_where(left, (k % 2 == 0) | (k % 3 == 0) | (k % 5 == 0), lambda d: enrich.fill_missing(
        d, right, ["key"], ["condition_text"], ["deposit_krw"], ["supply_count"]))
    return routed.select("o_orderkey", "condition_text", "deposit_krw", "supply_count")


# --- aggregates, windows, reports ------------------------------------------------------------------------------
@query("a02_status_counts", "SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'X') AS \"X\" FROM orders")
def _(t):
    return reports.status_counts(t.orders, "o_orderstatus", ["O", "X"])


@query("q08_a03_discovery_report", _DECIDED + """
    SELECT count(DISTINCT (board, page)) AS pages, count(*) AS list_rows, count(*) FILTER (outcome = 'detail') AS details,
           count(*) FILTER (outcome = 'detail' AND title LIKE 'view%') AS candidates, count(*) FILTER (outcome = 'detail' AND title NOT LIKE 'view%') AS rejected,
           count(*) FILTER (outcome = 'skipped_old') AS skipped_old, count(*) FILTER (outcome = 'skipped_known') AS skipped_known,
           count(*) FILTER (outcome = 'skipped_seen') AS skipped_seen FROM decided""", ("list_rows",))
def _(t):
    rules = (classify.Rule("recruitment", "title", ("view",)),)
    judged = discovery.judge_details(_decided(t).withColumn("detail_title", F.lit("")).withColumn("body_text", F.lit("")), rules=rules)
    return reports.discovery_counts(judged, ["board", "page"])


@query("a03_run_statistics", "SELECT event_type, count(*) AS items, count(*) FILTER (value > 50) AS large, CAST(sum(CASE WHEN value > 50 THEN event_id ELSE 0 END) AS BIGINT) AS weight FROM events GROUP BY event_type")
def _(t):
    stats = reports.run_statistics({"items": F.count(F.lit(1)), "large": F.count_if(F.col("value") > 50),
                                    "weight": F.sum(F.when(F.col("value") > 50, F.col("event_id")).otherwise(0))})
    d = t.events.groupBy("event_type").agg(stats.alias("stats"))
    return d.select("event_type", *[F.col("stats")[k].alias(k) for k in ("items", "large", "weight")])


@query("a05_amount_ranges", """
    SELECT l_orderkey, low, high, CASE WHEN low = high THEN format('{:,}', low) || '원' ELSE format('{:,}', low) || '~' || format('{:,}', high) || '원' END AS range_text
    FROM (SELECT l_orderkey, min(CAST(floor(l_extendedprice) AS BIGINT)) AS low, max(CAST(floor(l_extendedprice) AS BIGINT)) AS high FROM lineitem GROUP BY l_orderkey)""")
def _(t):
    return rents.amount_range(t.lineitem.select("l_orderkey", F.floor("l_extendedprice").alias("amount")), ["l_orderkey"], "amount")


@query("a06_active_targets", "SELECT DISTINCT regexp_replace(lower(c_name || c_mktsegment), '[^a-z0-9]', '', 'g') AS target FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')")
def _(t):
    apps = t.customer.select(F.concat_ws(" - ", "c_name", "c_mktsegment").alias("title"), F.col("c_mktsegment").alias("status"))
    return reconcile.active_targets(apps, active=("BUILDING", "FURNITURE"))


@query("a11_type_distribution", "SELECT event_type, count(*) AS rows FROM events GROUP BY event_type")
def _(t):
    return reports.group_counts(t.events, "event_type")


@query("w02_fill_down", """
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM events""")
def _(t):
    rows = t.events.select("event_id", "user_id", F.when(F.col("event_type") == "signup", F.col("event_id")).alias("mark"))
    return dedupe.fill_down(rows, ["user_id"], "event_id", "mark", "carried").select("event_id", "user_id", "carried")


@query("w03_w05_ordinals", """
    SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS ordinal, count(*) OVER (PARTITION BY user_id, event_type) AS total FROM events""")
def _(t):
    return dedupe.ordinals(t.events.select("event_id", "user_id", "event_type"), ["user_id", "event_type"], "event_id", total="total").select("event_id", "ordinal", "total")


@query("w04_first_and_last_wins", """
    SELECT user_id, event_type, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY user_id, event_type""")
def _(t):
    rows = t.events.select("user_id", "event_type", "event_id")
    first = dedupe.first_row(rows, ["user_id", "event_type"], [F.col("event_id")]).withColumnRenamed("event_id", "first_id")
    last = dedupe.last_row(rows, ["user_id", "event_type"], F.col("event_id")).withColumnRenamed("event_id", "last_id")
    return first.join(last, ["user_id", "event_type"])


@query("q09_rent_conversion", """
    SELECT o_orderkey, convertible AS convertible_rent_krw, CAST(floor(convertible / 1000 * 150000) AS BIGINT) AS added_deposit_krw,
           5000000 + CAST(floor(convertible / 1000 * 150000) AS BIGINT) AS max_deposit_krw, rent - convertible AS min_rent_krw
    FROM (SELECT *, CAST(floor(rent * ratio) AS BIGINT) AS convertible FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS rent,
          CASE o_orderpriority WHEN '1-URGENT' THEN 0.5 WHEN '2-HIGH' THEN 0.25 ELSE 0.75 END AS ratio FROM orders) WHERE rent > 0)""")
def _(t):
    rules = t.orders.select(F.col("o_orderpriority").alias("notice")).distinct().select(
        "notice", F.when(F.col("notice") == "1-URGENT", 0.5).when(F.col("notice") == "2-HIGH", 0.25).otherwise(0.75).alias("max_ratio"),
        F.lit(1000).alias("rent_unit_krw"), F.lit(150000).alias("deposit_per_unit_krw"))
    offers = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("notice"), F.floor("o_totalprice").alias("monthly_rent_krw"),
                             F.lit(5000000).cast("bigint").alias("deposit_krw"))
    return rents.conversion_estimates(offers, rules, ["notice"]).select(
        "o_orderkey", "convertible_rent_krw", "added_deposit_krw", "max_deposit_krw", "min_rent_krw")
