"""Landed pages, API responses, objects and artifacts.

Where the given tables lack a shape (tables in pages, API envelopes), each row of
a given table is rendered into one landed document, which the operator then reads
back; the SQL counterpart states the expected rows from the table itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import text as T
from noticeloom.functions.payload import json_payload
from noticeloom.operators import snapshots
from noticeloom.plans.registry import query
from noticeloom.session import cut_lineage, scratch_dir
from noticeloom.sources import api, artifacts, objects, pages

L = F.lit


def text(*parts):
    """Concatenation of columns and literal texts."""
    return F.concat(*[p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts])



def K():
    return F.col("o_orderkey")


def C():
    return F.col("o_custkey")


def D():
    return F.date_format("o_orderdate", "yyyy-MM-dd")


# --- API -----------------------------------------------------------------------------------------------------


def _envelopes(t):
    """One response per event: a bad code, an array of two items, one object, or no item."""
    e, u, v = F.col("event_id"), F.col("user_id"), F.col("value")
    numbers = F.struct(e.alias("pblancId"), u.alias("houseSn"), F.floor(v).alias("rentGtn"), v.alias("refrnc"),
                       (u % 4).alias("sumSuplyCo"), F.lit("공급 1,2 호").alias("suplyHoCo"))
    texts = F.struct(text(" ", e, " ").alias("pblancId"), F.format_number(u * 100, 0).alias("houseSn"), F.format_number(F.floor(v), 0).alias("rentGtn"),
                     F.lit("x").alias("refrnc"), F.lit("").alias("sumSuplyCo"), text("총 ", F.format_number(u + 1000, 0), "호").alias("suplyHoCo"))
    code = F.when(e % 10 == 9, "99").when(e % 10 == 8, "").otherwise("00")
    envelope = lambda body: F.to_json(F.struct(F.struct(F.struct(code.alias("resultCode"), L("m").alias("resultMsg")).alias("header"), body.alias("body")).alias("response")))
    body = (F.when(e % 3 == 0, envelope(F.struct(e.alias("totalCount"), numbers.alias("item"))))
            .when(e % 3 == 1, envelope(F.struct(F.format_number(e, 0).alias("totalCount"), F.array(texts, texts).alias("item"))))
            .otherwise(envelope(F.struct(L("").alias("totalCount")))))
    return t.wide("events").select("event_id", F.when(e % 50 == 5, L("{not json")).otherwise(body).alias("body"))


@query("s01_api_pages", """
    SELECT event_id, event_id % 10 = 9 OR event_id % 50 = 5 AS is_bad,
           CASE WHEN event_id % 50 = 5 OR event_id % 3 = 2 THEN 0 ELSE event_id END AS total_count,
           CASE WHEN event_id % 10 = 9 OR event_id % 50 = 5 THEN 0 WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 3 = 1 THEN 2 ELSE 0 END AS items FROM events""")
def _(t):
    parsed = api.parse_pages(_envelopes(t))
    items = api.page_items(parsed, ["event_id"]).groupBy("event_id").agg(F.count(L(1)).alias("items"))
    return parsed.select("event_id", "is_bad", "total_count").join(items, "event_id", "left").fillna(0, ["items"])


@query("s01_bad_pages", "SELECT event_id FROM events WHERE event_id % 10 = 9 OR event_id % 50 = 5")
def _(t):
    return api.bad_pages(api.parse_pages(_envelopes(t))).select("event_id")


@query("s02_api_items", """
    SELECT event_id, position, CAST(event_id AS STRING) AS notice_id,
           CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS INT) ELSE CAST(user_id * 100 AS INT) END AS house_sn,
           CASE WHEN floor(value) > 0 THEN CAST(floor(value) AS BIGINT) END AS deposit_krw,
           CAST(CASE WHEN event_id % 3 = 1 THEN user_id + 1000 WHEN user_id % 4 > 0 THEN user_id % 4 ELSE 12 END AS INT) AS supply_count,
           CAST(event_id AS STRING) || CASE WHEN user_id = 0 THEN '' WHEN event_id % 3 = 0 THEN ':' || CAST(user_id AS STRING) ELSE ':' || CAST(user_id * 100 AS STRING) END AS item_seq
    FROM events, (VALUES (0), (1)) AS p(position)
    WHERE event_id % 10 <> 9 AND event_id % 50 <> 5 AND (event_id % 3 = 1 OR (event_id % 3 = 0 AND position = 0))""")
def _(t):
    items = api.page_items(api.parse_pages(_envelopes(t)), ["event_id"])
    return api.project_items(items, ["event_id", "position"]).select("event_id", "position", "notice_id", "house_sn", "deposit_krw", "supply_count", "item_seq")


@query("s03_page_completeness", """
    WITH landed AS (SELECT event_type AS board, CAST(floor(event_id / 200) AS INT) + 1 AS page, event_id + 1 AS total FROM events WHERE floor(event_id / 200) % 7 <> 3 OR event_type = 'view')
    SELECT b.board, p.page FROM (SELECT board, (max(total) + 199) // 200 AS pages FROM landed GROUP BY board) b,
           LATERAL (SELECT unnest(generate_series(1, b.pages)) AS page) p
    WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.board = b.board AND l.page = p.page)""")
def _(t):
    page = F.floor(F.col("event_id") / 200)
    landed = t.events.where((page % 7 != 3) | (F.col("event_type") == "view")).select(
        F.col("event_type").alias("board"), (page + 1).alias("page"), (F.col("event_id") + 1).alias("total"))
    return api.missing_pages(landed, ["board"], "page", "total", 200).select("board", F.col("page").cast("bigint").alias("page"))


# --- list and detail pages -------------------------------------------------------------------------------------


def _list_pages(t):
    """A list page per order: one listed row, one without a number, one that is too short."""
    listed = text('<tr class="r"><td>1</td><td class=\'t\'><a href="#" onclick="getDetailView(\'', K(), '\');return false;"> Notice ', C(),
                  ' &amp; more<span class="icoNew">NEW</span></a></td><td> Team ', C() % 9, '</td><td>', D(), '</td><td>', F.format_number(C() * 7, 0), '</td></tr>')
    second = text('<TR><TD>2</TD><TD><a href="javascript:getDetailView(', K() + 1, ')">Plain', F.when(C() % 2 == 0, "\n  title").otherwise(" x"),
                  '</a></TD><TD></TD><TD>soon</TD><TD>-</TD></TR>')
    html = text('<table id="other"><tr><td>x</td></tr></table><table class="w" id="listTb"><tbody>', listed,
                '<tr><td>n</td><td><a>no number</a></td><td></td><td></td><td></td></tr><tr><td>short</td></tr>', second, '</tbody></table>')
    return t.wide("orders").select("o_orderkey", html.alias("html"))


@query("s04_list_rows", """
    SELECT o_orderkey, 0 AS position, CAST(o_orderkey AS STRING) AS seq, 'Notice ' || CAST(o_custkey AS STRING) || ' & more' AS title, 'Team ' || CAST(o_custkey % 9 AS STRING) AS department,
           CAST(o_orderdate AS DATE) AS posted_at, CAST(o_custkey * 7 AS INT) AS view_count, true AS is_new FROM orders
    UNION ALL SELECT o_orderkey, 3, CAST(o_orderkey + 1 AS STRING), CASE WHEN o_custkey % 2 = 0 THEN 'Plain title' ELSE 'Plain x' END, '', NULL, 0, false FROM orders""")
def _(t):
    return pages.list_rows(_list_pages(t))


@query("s04_page_links", """
    SELECT page_id, i - 1 AS position, regexp_extract(li[i], 'href="([^"]*)"', 1) AS href, regexp_replace(li[i], '<[^>]*>', '', 'g') AS label
    FROM (SELECT page_id, li, unnest(generate_series(1, len(li))) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li>', 1) AS li FROM pages))""")
def _(t):
    rows = t.pages.select("page_id", F.posexplode(pages.elements("html", "li")).alias("position", "li"))
    return rows.select("page_id", F.col("position").cast("bigint").alias("position"), pages.attribute("li", "href").alias("href"), T.inner_text("li").alias("label"))


def _detail_pages(t):
    """Detail pages that carry their title, body and dates in different places."""
    kind = K() % 5
    titled = F.when(kind == 0, text("<tr><th>제목</th><td>T", C(), "</td></tr>")).otherwise("")
    caption = F.when(kind == 1, text("<caption>C", C(), "</caption>")).otherwise("")
    head = F.when(kind == 2, text("<thead><tr><th>H", C(), "</th></tr></thead>")).otherwise("")
    other = F.when(kind == 3, text("<table><caption>O", C(), "</caption></table>")).otherwise("")
    stats = F.when(kind % 2 == 0, text("<tr><th>작성일</th><td>", D(), "</td></tr><tr><th>조회수</th><td>", F.format_number(C(), 0), "</td></tr>")).otherwise(
        "")
    inline = F.when(kind % 2 == 1, text("<ul><li>담당 : x</li><li>등록일 : ", D(), "</li><li>조회수: ", F.format_number(C(), 0), "</li></ul>")).otherwise("")
    body = F.when(C() % 2 == 0, text('<div class="view cont">Body<br/>of <b>', K(), "</b></div>")).otherwise(text("<table><tr><td>Last<BR>", K(), "</td></tr></table>"))
    html = text('<table class="detailTable x">', caption, head, titled, stats, "</table>", other, inline, body)
    return t.wide("orders").select("o_orderkey", html.alias("html"))


@query("s05_s11_detail_fields", """
    SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'T' || k WHEN 1 THEN 'C' || k WHEN 2 THEN 'H' || k WHEN 3 THEN 'O' || k ELSE '' END AS title,
           CASE WHEN o_custkey % 2 = 0 THEN 'Body of ' ELSE 'Last ' END || CAST(o_orderkey AS STRING) AS body_text, CAST(o_custkey AS INT) AS view_count, CAST(o_orderdate AS DATE) AS posted_at
    FROM (SELECT *, CAST(o_custkey AS STRING) AS k FROM orders)""")
def _(t):
    return pages.detail_fields(_detail_pages(t))


def _attachment_pages(t):
    item = lambda n: text('{"brdId":"b', C(), '","seq":"', K(), '","fileSeq":"', str(n), '","oriFileNm":"f', str(n), '.pdf","fileSize":"', C(), '"}')
    array = F.when(K() % 4 == 0, L("[{broken")).otherwise(text("[", item(1), ",", item(2), "]"))
    html = text("<script>var a=1; initParam.downList = ", array, ";</script>",
                '<a href="/x/htmlConverter.do?brd_id=b', C(), "&amp;seq=", K(), '&amp;file_seq=2">view</a><a href="/other?brd_id=1">no</a>')
    return t.wide("orders").select("o_orderkey", html.alias("html"))


@query("s06_s07_attachments", """
    SELECT o_orderkey, n - 1 AS position, 'b' || CAST(o_custkey AS STRING) AS brd, CAST(n AS STRING) AS file_seq, 'f' || CAST(n AS STRING) || '.pdf' AS name, CAST(o_custkey AS STRING) AS size,
           CASE WHEN n = 2 THEN '/x/htmlConverter.do?brd_id=b' || CAST(o_custkey AS STRING) || '&seq=' || CAST(o_orderkey AS STRING) || '&file_seq=2' ELSE '' END AS preview_path
    FROM orders, (VALUES (1), (2)) AS v(n) WHERE o_orderkey % 4 <> 0""")
def _(t):
    rows = pages.attachments_with_previews(_attachment_pages(t))
    return rows.select("o_orderkey", "position", F.col("brdId").alias("brd"), F.col("fileSeq").alias("file_seq"),
                       T.first_non_empty(F.coalesce("filename", L("")), "oriFileNm").alias("name"),
                       T.first_non_empty(F.coalesce("size", L("")), "fileSize").alias("size"), "preview_path")


def _application_pages(t):
    row = lambda code, title, status: text(
        '<tr><td>1</td><td><a href="#" onclick="userSsnCheck(\'', code, "', 'N', '", F.when(C() % 2 == 0, "").otherwise("04"), "', 'R1', 'Y', '', '", title, "')\">",
        "fallback ", C(), "</a></td><td>", F.format_number(C() * 3, 0), "</td><td>", D(), "</td><td> ", status, " </td></tr>")
    html = text("<table>", row(text("A", K()), text("공고, ", C()), "청약중"), row(text("A", K()), L("again"), "[청약중]"), row(text("A", K()), L(""), "접수예정"),
                row(text("B", K()), L("closed"), "마감"), row(L(" "), L("x"), "청약중"), "</table>")
    return t.wide("orders").select("o_orderkey", html.alias("html"))


@query("s08_application_rows", """
    SELECT o_orderkey, n AS position, 'A' || CAST(o_orderkey AS STRING) AS recruit_code, CASE WHEN o_custkey % 2 = 0 THEN '' ELSE '04' END AS supply_type, 'R1' AS recruit_type,
           CASE n WHEN 0 THEN '공고, ' ELSE 'fallback ' END || CAST(o_custkey AS STRING) AS title, CAST(o_custkey * 3 AS INT) AS supply_count, CAST(o_orderdate AS DATE) AS posted_at,
           CASE n WHEN 0 THEN '청약중' ELSE '접수예정' END AS status FROM orders, (VALUES (0), (2)) AS v(n)""")
def _(t):
    return pages.application_rows(_application_pages(t), page_key=("o_orderkey",)).select(
        "o_orderkey", "position", "recruit_code", "supply_type", "recruit_type", "title", "supply_count", "posted_at", "status")


def _label_pages(t):
    html = text("<table><tr><th> 공급호수</th><td>총 ", F.format_number(C() + 1, 0), " 호</td></tr><tr><th>임대조건</th><td>- 임대보증금 :&nbsp;", C(), "만원 - 월임대료 : ", K(), "원</td></tr>",
                "<tr><th>임대기간</th><td></td></tr><tr><th>임대기간</th><td>", C() % 30, "년</td></tr></table><a href=\"javascript:fnDownFile('F", K(), "', '2')\">공고 ", C(), ".pdf</a>")
    return t.wide("orders").select("o_orderkey", html.alias("html"), F.lit("http://d").alias("detail_url"))


@query("s09_label_values", """
    SELECT o_orderkey, CAST(o_custkey + 1 AS INT) AS supply_count, '임대보증금 : ' || CAST(o_custkey AS STRING) || '만원' AS deposit_condition_text,
           '월임대료 : ' || CAST(o_orderkey AS STRING) || '원' AS monthly_rent_condition_text, CAST(o_custkey % 30 AS STRING) || '년' AS lease_period_text, '' AS support_limit_text,
           'F' || CAST(o_orderkey AS STRING) || '/2/공고 ' || CAST(o_custkey AS STRING) || '.pdf' AS file FROM orders""")
def _(t):
    d = api.detail_columns(pages.label_value_columns(_label_pages(t)))
    f = F.col("notice_files")[0]
    return d.select("o_orderkey", "supply_count", "deposit_condition_text", "monthly_rent_condition_text", "lease_period_text", "support_limit_text",
                    F.concat_ws("/", f["file_id"], f["file_sn"], f["filename"]).alias("file"))


def _unescape(x):
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{char}')"
    return x


_VISIBLE = ("regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<noscript\\b.*?</noscript\\s*>', '', 'g'), "
            "'(?s)<!--.*?-->', '', 'g')")
_VISIBLE = f"trim(regexp_replace({_unescape(f'regexp_replace({_VISIBLE}, ' + chr(39) + '<[^>]*>' + chr(39) + ', ' + chr(39) * 2 + ', ' + chr(39) + 'g' + chr(39) + ')')}, '{fixed.WS}+', ' ', 'g'))"


@query("s10_visible_text", f"SELECT page_id, md5({_VISIBLE}) AS digest, length({_VISIBLE}) AS chars FROM pages")
def _(t):
    return pages.visible_text_artifacts(t.wide("pages").select("page_id", "html")).select("page_id", F.md5("raw_text").alias("digest"), "chars")


@query("s11_break_tags", "SELECT page_id, md5(regexp_replace(html, '<(?:br|BR) ?/?>', ' ', 'g')) AS digest FROM pages")
def _(t):
    return t.pages.select("page_id", F.md5(T.normalize_breaks("html")).alias("digest"))


# --- objects and artifacts ---------------------------------------------------------------------------------------
@query("s12_object_manifest", "SELECT source || '/' || CAST(doc_id AS STRING) AS object_key, sha256(text) AS sha256, strlen(text) AS size_bytes FROM documents")
def _(t):
    return objects.manifest(t.documents.withColumn("key", F.concat_ws("/", "source", "doc_id")), "key", "text", [])


@query("s12_hash_mismatches", "SELECT CAST(doc_id AS STRING) AS object_key FROM documents JOIN labels USING (doc_id) WHERE quality = 0")
def _(t):
    found = objects.manifest(t.documents.withColumn("key", F.col("doc_id").cast("string")), "key", "text", [])
    want = t.documents.join(t.labels, "doc_id").select(F.col("doc_id").cast("string").alias("object_key"),
                                                       F.sha2(F.when(F.col("quality") == 0, F.concat("text", L("!"))).otherwise(F.col("text")), 256).alias("sha256"))
    return objects.hash_mismatches(found, want).select("object_key")


@query("s12_stored_files", """
    SELECT source || '/' || CAST(block AS STRING) AS object_key, sha256(string_agg(text || chr(10), '' ORDER BY doc_id)) AS sha256, CAST(sum(strlen(text) + 1) AS BIGINT) AS size_bytes, block % 3 = 0 AS differs
    FROM (SELECT *, doc_id // 50 AS block FROM documents) GROUP BY source, block""")
def _(t):
    """Documents written as files, read back as bytes, and held against digests of which a third is wrong."""
    root = scratch_dir(t.spark, "objects")
    docs = t.documents.select("source", F.expr("doc_id div 50").alias("block"), "doc_id", "text")
    objects.write_objects(docs.repartition("source", "block").sortWithinPartitions("source", "block", "doc_id"), root, ["source", "block"], "text")
    files = objects.read_objects(t.spark, root, "*.txt")
    key = F.concat_ws("/", *[F.regexp_extract("path", r"source=([^/]*)/block=([0-9]+)\.", n) for n in (1, 2)])
    found = cut_lineage(objects.manifest(files.withColumn("key", key), "key", "content", []), "digests")  # the bytes are read once
    snapshots.remove(t.spark, root)
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda x: F.concat(x["text"], L("\n"))), "")
    want = docs.groupBy("source", "block").agg(whole.alias("whole")).select(
        F.concat_ws("/", "source", F.col("block").cast("string")).alias("object_key"), F.sha2(F.when(F.col("block") % 3 == 0, F.concat("whole", L("!"))).otherwise(F.col("whole")), 256).alias("sha256"))
    wrong = objects.hash_mismatches(found, want).select("object_key", L(True).alias("differs"))
    return found.join(wrong, "object_key", "left").select("object_key", "sha256", "size_bytes", F.coalesce("differs", L(False)).alias("differs"))


@query("s13_object_keys", """
    SELECT doc_id, 'originals/' || CASE WHEN doc_id % 3 = 0 THEN 'unknown' ELSE lang END || '/' || CASE doc_id % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN source ELSE CAST(doc_id AS STRING) END
           || '/0-a_b (' || source || ').pdf' AS key, 'previews/' || lang || '/' || CAST(doc_id AS STRING) || '/' || CAST(n_chars AS STRING) || '-preview.html' AS preview FROM documents""")
def _(t):
    d = F.col("doc_id")
    return t.documents.select("doc_id", objects.attachment_key(
        F.when(d % 3 == 0, " ").otherwise(F.upper(F.concat(L(" "), "lang"))), F.when(d % 4 > 1, d.cast("string")).otherwise(""),
        F.when(d % 4 == 1, F.col("source")).otherwise(" "), L(""), F.concat(L("x/a?*b ("), "source", L(").pdf"))).alias("key"),
        objects.preview_key("lang", d.cast("string"), L(""), F.col("n_chars").cast("string")).alias("preview"))


@query("s14_object_key_validity", "SELECT doc_id, doc_id % 5 IN (0, 1) AS accepted FROM documents")
def _(t):
    d = F.col("doc_id")
    key = F.when(d % 5 == 0, F.col("source")).when(d % 5 == 1, F.concat("source", L("/..x"))).when(d % 5 == 2, "  ").when(d % 5 == 3, F.concat(L(" /"), "source")).otherwise(F.concat("source", L("/../x")))
    good, bad = objects.split_by_key_validity(t.documents.select("doc_id", key.alias("object_key")))
    return good.select("doc_id", L(True).alias("accepted")).unionByName(bad.select("doc_id", L(False).alias("accepted")))


@query("s15_sheet_rows", """
    SELECT p_partkey, n AS row_no, CASE n WHEN 1 THEN p_brand || '|' || p_type ELSE replace(p_name, ' ', ' ') || '|' || CAST(p_size AS STRING) END AS cells,
           'object://p' || CAST(p_partkey AS STRING) || '#sheet=' || replace(p_type || ' 1', ' ', '+') || '&row=' || CAST(n AS STRING) AS source_span
    FROM part, (VALUES (1), (2)) AS v(n)""")
def _(t):
    sheets = t.part.select("p_partkey", text("p", F.col("p_partkey")).alias("object_key"), text(F.col("p_type"), " 1").alias("sheet"), F.array(
        F.array(text(" ", F.col("p_brand"), "\n"), F.col("p_type")), F.array(F.replace("p_name", L(" "), L(" \t ")), F.col("p_size").cast("string"))).alias("rows"))
    out = artifacts.sheet_rows(sheets, "object_key", "sheet", "rows")
    return out.select(F.substring("object_key", 2, 20).cast("bigint").alias("p_partkey"), "row_no", F.array_join("cells", "|").alias("cells"), "source_span")


@query("s16_s17_text_artifacts", """
    SELECT doc_id, CASE WHEN lang = 'de' THEN 'hwp_unsupported' ELSE 'pdf_text' END AS artifact_type, CASE WHEN lang = 'de' THEN 'unsupported' ELSE 'extracted' END AS status,
           CASE WHEN lang = 'de' THEN 0 ELSE length(text) END AS chars, CASE WHEN lang = 'de' THEN 0.0 ELSE 1.0 END AS confidence,
           CASE WHEN lang = 'de' THEN 'hwp text extractor is not available' ELSE '' END AS error_text, 'object://' || CAST(doc_id AS STRING) AS source_span FROM documents""")
def _(t):
    docs = t.documents.select("doc_id", F.when(F.col("lang") != "de", F.concat(L("\x00"), "text")).alias("text"))
    return artifacts.text_artifacts(docs, "text", T.object_span(F.col("doc_id").cast("string")), L("pdf_text"), L("text"), ["doc_id"]).select(
        "doc_id", "artifact_type", "status", "chars", "confidence", "error_text", "source_span")


@query("s18_source_registry", """
    WITH wanted AS (SELECT DISTINCT lpad(CAST(o_custkey % 14 AS STRING), 2, '0') AS code FROM orders)
    SELECT code AS supply_type, code IN ('01', '02', '03', '04', '05', '06', '07', '12', '10') AS is_known FROM wanted""")
def _(t):
    wanted = t.orders.select(F.concat(L(" "), F.lpad((C() % 14).cast("string"), 2, "0")).alias("supply_type"))
    known, unknown = objects.select_sources(objects.application_registry(t.spark), wanted, "supply_type")
    return known.select("supply_type", L(True).alias("is_known")).unionByName(unknown.select("supply_type", L(False).alias("is_known")))


@query("s19_table_sink", "SELECT o_orderpriority AS agency, count(*) AS rows, CAST(sum(o_custkey) AS BIGINT) AS total FROM orders GROUP BY 1")
def _(t):
    path = scratch_dir(t.spark, "sink")
    artifacts.write_table(t.orders.select(F.col("o_orderpriority").alias("agency"), "o_orderkey", "o_custkey"), path, ["agency"])
    return t.spark.read.parquet(path).groupBy("agency").agg(F.count(L(1)).alias("rows"), F.sum("o_custkey").alias("total"))


@query("s02_js1_item_artifacts", """
    SELECT o_orderkey, 'myhome://rsdt/' || CAST(o_orderkey AS STRING) || '/' || CAST(o_custkey % 5 + 1 AS STRING) AS source_span, 'myhome_api_item' AS artifact_type, 1.0 AS confidence FROM orders""")
def _(t):
    items = t.orders.select("o_orderkey", L("t").alias("title"), json_payload(a=L(1)).alias("raw_json"), api.item_seq(K().cast("string"), C() % 5 + 1).alias("item_seq"))
    return items.select("o_orderkey").join(api.item_artifacts(items, "rsdt").withColumn(
        "o_orderkey", F.split_part("source_span", L("/"), L(4)).cast("bigint")), "o_orderkey").select("o_orderkey", "source_span", "artifact_type", "confidence")
