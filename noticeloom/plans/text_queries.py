"""Scalar functions over the given tables: text, numbers, dates, JSON, hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import dates as D
from noticeloom.functions import numbers as N
from noticeloom.functions import payload as P
from noticeloom.functions import text as T
from noticeloom.operators.staging import hold
from noticeloom.plans.registry import query

WS = fixed.WS


def clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def padded_dates(x: str) -> str:
    months = "regexp_replace(lower(" + trim(x) + r"), '(^|[^0-9])([0-9]{4})\.([0-9])\.', '\1\2.0\3.', 'g')"
    return "regexp_replace(" + months + r", '([0-9]{4}\.[0-9]{2})\.([0-9])([^0-9]|$)', '\1.0\2\3', 'g')"


def plain_key(x: str) -> str:
    return f"translate({padded_dates(x)}, ' .()', '')"


def strict_key(x: str) -> str:
    return f"regexp_replace({padded_dates(x)}, " + r"'[\s\p{P}\p{S}]+', '', 'g')"


@query("t01_t02_collapse_white_space",
       f"SELECT doc_id, md5({clean('text')}) AS digest, length({clean('text')}) AS chars FROM documents")
def _(t):
    c = T.collapse_ws("text")
    return t.wide("documents").select("doc_id", F.md5(c).alias("digest"), F.length(c).cast("bigint").alias("chars"))


@query("t03_strip_title_marker",
       "SELECT p_partkey, trim(regexp_replace(CASE WHEN p_partkey % 3 = 0 THEN 'NEW ' || p_name WHEN p_partkey % 3 = 1 "
       "THEN p_name || 'NEW' ELSE p_name || ' NEW x' END, '^NEW|NEW$', '', 'g')) AS title FROM part")
def _(t):
    raw = (F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" NEW  "), "p_name"))
           .when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit("NEW "))).otherwise(F.concat("p_name", F.lit(" NEW x"))))
    return t.part.select("p_partkey", T.strip_marker(raw).alias("title"))


_DATED = "CAST(year(o_orderdate) AS STRING) || '.' || CAST(month(o_orderdate) AS STRING) || '.' || CAST(day(o_orderdate) AS STRING)"


@query("t04_t05_t06_title_keys",
       "SELECT o_orderkey, 'notice' || strftime(o_orderdate, '%Y%m%d') || lower(o_orderpriority) AS plain_key, "
       "'notice' || strftime(o_orderdate, '%Y%m%d') || regexp_replace(lower(o_orderpriority), '[^a-z0-9]', '', 'g') AS strict_key, "
       "sha256('notice' || strftime(o_orderdate, '%Y%m%d') || lower(o_orderpriority)) AS title_hash "
       "FROM (SELECT o_orderkey, o_orderdate, replace(o_orderpriority, ' ', '') AS o_orderpriority FROM orders)")
def _(t):
    title = F.expr(f"' Notice (' || {_DATED} || '.) ' || o_orderpriority")
    return t.orders.select("o_orderkey", T.title_key_plain(title).alias("plain_key"),
                           T.title_key_strict(title).alias("strict_key"), T.title_hash(title).alias("title_hash"))


@query("t04_t05_text_keys",
       f"SELECT doc_id, md5({plain_key('text')}) AS plain_key, md5({strict_key('text')}) AS strict_key, "
       f"sha256({plain_key('text')}) AS title_hash FROM documents")
def _(t):
    return t.wide("documents").select("doc_id", F.md5(T.title_key_plain("text")).alias("plain_key"),
                              F.md5(T.title_key_strict("text")).alias("strict_key"), T.title_hash("text").alias("title_hash"))


@query("t07_header_keys",
       "SELECT p_partkey, replace(p_name, ' ', '') || p_type AS header_key FROM part")
def _(t):
    return t.part.select("p_partkey", T.header_key(F.concat(F.lit(" ["), "p_name", F.lit("]\n("), "p_type", F.lit(")\t"))).alias("header_key"))


@query("t08_first_non_blank",
       "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_name END AS blank_aware, "
       "CASE WHEN c_custkey % 2 = 0 THEN '  ' ELSE c_name END AS plain FROM customer")
def _(t):
    head = F.when(F.col("c_custkey") % 2 == 0, "  ").otherwise(F.concat(F.lit(" "), "c_name"))
    exact = F.when(F.col("c_custkey") % 2 == 0, "  ").otherwise(F.col("c_name"))
    return t.customer.select("c_custkey", T.first_non_blank(head, "c_mktsegment").alias("blank_aware"),
                             T.first_non_empty(exact, "c_mktsegment").alias("plain"))


@query("t09_join_non_blank",
       "SELECT s_suppkey, concat_ws(' ', s_name, CASE WHEN s_nationkey % 2 = 0 THEN 'n' || CAST(s_nationkey AS STRING) END, "
       "CASE WHEN s_acctbal > 5000 THEN 'rich' END) AS label FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", T.join_non_blank(
        "s_name", F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit(" n"), "s_nationkey")).otherwise("  "),
        F.when(F.col("s_acctbal") > 5000, "rich").otherwise("")).alias("label"))


@query("t10_n08_unit_labels", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           'L' || CAST(l_linenumber AS STRING) || ' ' || area || ' ' || l_returnflag AS label, area AS area_text
    FROM (SELECT *, CASE WHEN l_quantity / 4 = floor(l_quantity / 4) THEN CAST(CAST(l_quantity / 4 AS BIGINT) AS STRING)
                         ELSE regexp_replace(printf('%.2f', l_quantity / 4), '\\.?0+$', '') END || '㎡' AS area FROM lineitem)""")
def _(t):
    area = F.col("l_quantity") / 4
    return t.wide("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", N.unit_label(
        F.lit(" "), F.concat(F.lit("L"), "l_linenumber"), area, "l_returnflag", F.lit("")).alias("label"), N.area_text(area).alias("area_text"))


@query("t11_t12_t13_addresses", """
    SELECT o_orderkey, '서울시 ' || gu || ' 가온로' || a || '길 ' || b AS address, gu AS district,
           '서울시 ' || gu || ' 가온로' || a || '길 ' || b AS loose_address
    FROM (SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN '중구' ELSE '가평군' END AS gu,
                 CAST(o_custkey AS STRING) AS a, CAST(o_orderkey % 90 + 1 AS STRING) AS b FROM orders)""")
def _(t):
    gu = F.when(F.col("o_custkey") % 2 == 0, "중구").otherwise("가평군")
    a, b = F.col("o_custkey").cast("string"), (F.col("o_orderkey") % 90 + 1).cast("string")
    tokens = F.array(F.lit("서울시"), gu, F.lit("가온"), F.lit("로"), a, F.lit("길"), b)
    loose = T.join_branch_roads(F.concat_ws("  ", F.lit("서울시"), gu, F.lit("가온로"), a, F.lit("길"), b), loose=True)
    joined = hold(t.wide("orders").select("o_orderkey", tokens.alias("_tokens"), loose.alias("loose_address")), address=T.assemble_address(F.col("_tokens")))
    return joined.select("o_orderkey", "address", T.district_of("address").alias("district"), "loose_address")


_SECTION = ("CASE WHEN strpos(text, '{a}') = 0 THEN '' WHEN strpos(substr(text, strpos(text, '{a}')), '{b}') > 1 THEN "
            "substr(substr(text, strpos(text, '{a}')), 1, strpos(substr(text, strpos(text, '{a}')), '{b}') - 1) "
            "ELSE substr(text, strpos(text, '{a}')) END")


@query("t14_section_between",
       f"SELECT doc_id, md5({_SECTION.format(a='the ', b=' of ')}) AS section, length({_SECTION.format(a='und ', b='qqqq')}) AS open_end FROM documents")
def _(t):
    return t.wide("documents").select("doc_id", F.md5(T.section_between("text", "the ", " of ")).alias("section"),
                              F.length(T.section_between("text", "und ", "qqqq")).cast("bigint").alias("open_end"))


_TOKENS = (f"list_filter(list_transform(string_split({clean('text')}, ' '), lambda x: trim(x, '[](){{}}:：')), lambda x: x <> '')")


@query("t15_t16_tokens", f"""
    SELECT doc_id, len(k) AS tokens, coalesce(list_position(k, 'the'), 0) AS first_the, md5(array_to_string(k, ' ')) AS digest,
           CASE WHEN coalesce(list_position(k, 'of'), 0) = 0 THEN 0 ELSE coalesce(list_max(list_filter(
               list_transform(range(1, list_position(k, 'of')), lambda i: CASE WHEN k[i] = 'and' THEN i END), lambda i: i IS NOT NULL)), 0) END AS and_before_of
    FROM (SELECT doc_id, {_TOKENS} AS k FROM documents)""")
def _(t):
    d = t.wide("documents").select("doc_id", T.tokens("text").alias("k"))
    k = F.col("k")
    return d.select("doc_id", F.size("k").cast("bigint").alias("tokens"), T.token_index(k, "the").cast("bigint").alias("first_the"),
                    F.md5(F.array_join("k", " ")).alias("digest"),
                    T.last_token_before(k, "and", T.token_index(k, "of")).cast("bigint").alias("and_before_of"))


@query("t17_evidence_spans", """
    SELECT doc_id, 'object://' || source || '/' || CAST(doc_id AS STRING) AS object_span,
           'object://' || source || '/' || CAST(doc_id AS STRING) || '#sheet=' || lang || '%26x&row=' || CAST(n_chars AS STRING) AS sheet_span,
           'object://' || source || '/' || CAST(doc_id AS STRING) || '#table=t&row=1&llm_item=2' AS item_span,
           source || '#llm_item=3' AS plain_item_span,
           'myhome://rsdt/' || CAST(doc_id AS STRING) || '/7' AS api_span,
           'object://' || source || '/' || CAST(doc_id AS STRING) AS base_span FROM documents""")
def _(t):
    key = F.concat_ws("/", "source", "doc_id")
    span = T.object_span(key)
    return t.wide("documents").select(
        "doc_id", span.alias("object_span"), T.sheet_span(key, F.concat("lang", F.lit("&x")), "n_chars").alias("sheet_span"),
        T.item_span(T.table_span(span, F.lit("t"), F.lit(1)), F.lit(2)).alias("item_span"),
        T.item_span("source", F.lit(3)).alias("plain_item_span"),
        T.api_span(F.lit("rsdt"), F.concat("doc_id", F.lit(":7"))).alias("api_span"),
        T.base_span(T.schedule_span(span)).alias("base_span"))


@query("t18_s13_file_names", """
    SELECT page_id, lower(regexp_extract(url, '\\.([^./]*)$', 1)) AS extension, 'text/html' AS media,
           substr(regexp_replace(CASE WHEN regexp_extract(url, '([^/]*)/*$', 1) = '' THEN 'attachment.bin'
               ELSE regexp_extract(url, '([^/]*)/*$', 1) END, '[^0-9A-Za-z가-힣._() \\-\\[\\]]+', '_', 'g'), 1, 180) AS safe_name FROM pages""")
def _(t):
    return t.pages.select("page_id", T.file_extension("url").alias("extension"),
                          T.media_type(F.concat(F.lit("Text/HTML ; charset="), "url")).alias("media"),
                          T.sanitize_filename("url").alias("safe_name"))


@query("t19_redact", """
    SELECT page_id, replace(replace('GET ' || url || ' k=' || host, host, '[REDACTED]'), replace(host, ' ', '+'), '[REDACTED]') AS message
    FROM (SELECT *, regexp_extract(url, '//([^/]+)', 1) AS host FROM pages)""")
def _(t):
    host = F.regexp_extract("url", "//([^/]+)", 1)
    return t.pages.select("page_id", T.redact(F.concat(F.lit("GET "), "url", F.lit(" k="), F.url_encode(host)), host).alias("message"))


@query("t20_truncate_marked",
       "SELECT conv_id, turn, md5(CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || chr(10) || '[TRUNCATED]' ELSE text END) AS cut FROM conversations")
def _(t):
    return t.conversations.select("conv_id", "turn", F.md5(T.truncate_marked("text", 200)).alias("cut"))


@query("t21_split_csv", """
    SELECT doc_id, len(p) AS parts, md5(array_to_string(p, '|')) AS digest
    FROM (SELECT doc_id, list_filter(list_transform(string_split(text, ','), lambda x: %s), lambda x: x <> '') AS p FROM documents)""" % trim("x"))
def _(t):
    p = T.split_csv("text")
    return t.wide("documents").select("doc_id", F.size(p).cast("bigint").alias("parts"), F.md5(F.array_join(p, "|")).alias("digest"))


@query("t22_first_keyword", """
    SELECT doc_id, CASE WHEN contains(text, 'tion') THEN 'tion' WHEN contains(text, 'und') THEN 'und' WHEN contains(text, 'les') THEN 'les' ELSE '' END AS word
    FROM documents""")
def _(t):
    return t.wide("documents").select("doc_id", T.first_keyword("text", [(w, w) for w in ("tion", "und", "les")]).alias("word"))


@query("t23_canonical_names", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN '정릉 희망하우징' WHEN o_orderstatus = 'F' THEN '연남 공공원룸텔'
                            ELSE o_orderpriority END AS name FROM orders""")
def _(t):
    raw = F.when(F.col("o_orderstatus") == "O", " 정릉희망하우징").when(F.col("o_orderstatus") == "F", "연남  공공원룸텔").otherwise(F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", T.canonical_name(raw, fixed.HOPE_NAMES).alias("name"))


@query("t24_rent_conditions", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN '임대보증금 : ' || k || '원' WHEN 'F' THEN '시중 전세가격의 ' || k ELSE '' END AS deposit,
           CASE o_orderstatus WHEN 'O' THEN '월임대료 : 5원' WHEN 'F' THEN '시중 전세가격의 ' || k ELSE '임대료 ' || k END AS monthly
    FROM (SELECT *, CAST(o_custkey AS STRING) AS k FROM orders)""")
def _(t):
    k = F.col("o_custkey").cast("string")
    raw = (F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("- 자세한 사항 참조 - • 임대보증금 : "), k, F.lit("원 - 월임대료 :  5원")))
           .when(F.col("o_orderstatus") == "F", F.concat(F.lit("* 시중 전세가격의 "), k, F.lit(" - 상세내역")))
           .otherwise(F.concat(F.lit("임대료 1 - 임대료 "), k)))
    c = T.rent_conditions(raw)
    return t.orders.select("o_orderkey", c["deposit"].alias("deposit"), c["monthly"].alias("monthly"))


@query("n01_n02_n03_n04_amounts", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(trunc(l_extendedprice) AS INT) AS whole, l_extendedprice AS number,
           CAST(trunc(l_extendedprice) AS BIGINT) AS krw, CAST(trunc(l_extendedprice) AS BIGINT) * 1000 AS scaled, CAST(NULL AS INT) AS nothing
    FROM lineitem""")
def _(t):
    text = F.concat(F.lit("약 "), F.format_number("l_extendedprice", 2), F.lit(" 원 (77)"))
    return t.wide("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", N.first_int(text).alias("whole"),
                             N.first_float(text).alias("number"), N.first_krw(text).alias("krw"),
                             N.money_with_unit(text, F.lit("전세금액(천원)")).alias("scaled"), N.first_int("l_returnflag").alias("nothing"))


@query("n01_first_int_in_text", f"""
    SELECT doc_id, TRY_CAST(string_split(n, '.')[1] AS INT) AS first_int, TRY_CAST(n AS DOUBLE) AS first_float
    FROM (SELECT doc_id, replace(regexp_extract(text, '{fixed.NUMBER}'), ',', '') AS n FROM documents)""")
def _(t):
    return t.wide("documents").select("doc_id", N.first_int("text").alias("first_int"), N.first_float("text").alias("first_float"))


@query("n05_n10_n11_korean_amounts", """
    SELECT o_orderkey, CASE WHEN e > 30 THEN 1 ELSE 2 END AS amounts, CASE WHEN e > 30 THEN 0 ELSE e * 100000000 + m * 10000 END + 0 * m AS first_amount,
           greatest(CASE WHEN e > 30 THEN 0 ELSE e * 100000000 + m * 10000 END, 200000000) AS largest,
           200000000 * 8 // 10 AS max_support, (e * 100000000 + m) * 2 // 10 AS own_part
    FROM (SELECT o_orderkey, CAST(o_orderkey % 40 AS BIGINT) AS e, CAST(o_custkey AS BIGINT) AS m FROM orders)""")
def _(t):
    e, m = (F.col("o_orderkey") % 40), F.col("o_custkey")
    text = F.concat(F.lit("최대 "), e.cast("string"), F.lit("억 "), F.format_number(m, 0), F.lit("만원, 또는 2�원"))
    a = N.korean_amounts(text)
    d = t.orders.select("o_orderkey", a.alias("a"), N.support_split(e * fixed.EOK + m)["own_part"].alias("own_part"))
    return d.select("o_orderkey", F.size("a").alias("amounts"),
                    F.when(F.size("a") > 1, N.first_positive(F.slice("a", 1, 1))).otherwise(0).alias("first_amount"),
                    N.largest(F.col("a")).alias("largest"), N.support_split(F.lit(200000000).cast("bigint"))["max_support"].alias("max_support"), "own_part")


@query("n06_thousands_and_ranges", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, format('{:,}', lo) AS low_text,
           CASE WHEN lo <= 0 THEN '' WHEN lo = hi THEN format('{:,}', lo) || '원' ELSE format('{:,}', lo) || '~' || format('{:,}', hi) || '원' END AS range_text
    FROM (SELECT *, CAST(trunc(l_extendedprice * 10) AS BIGINT) - 20000 AS lo,
                 CAST(trunc(l_extendedprice * 10) AS BIGINT) - 20000 + CAST(l_linenumber % 3 AS BIGINT) AS hi FROM lineitem)""")
def _(t):
    lo = (F.col("l_extendedprice") * 10).cast("bigint") - 20000
    hi = lo + F.col("l_linenumber") % 3
    return t.wide("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", N.group_thousands(lo).alias("low_text"),
                             N.krw_range_text(lo, hi).alias("range_text"))


@query("n07_unit_counts", "SELECT o_orderkey, CASE WHEN o_custkey > 0 THEN CAST(o_custkey AS INT) END AS units FROM orders")
def _(t):
    return t.orders.select("o_orderkey", N.unit_count(F.concat(F.lit("공급 3동 "), F.format_number("o_custkey", 0), F.lit(" 호"))).alias("units"))


@query("n09_sum_known", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey + o_orderkey END AS total FROM orders""")
def _(t):
    a = F.when((F.col("o_orderkey") % 2 == 0) | (F.col("o_orderkey") % 3 != 0), F.col("o_custkey"))
    b = F.when((F.col("o_orderkey") % 2 != 0) & (F.col("o_orderkey") % 3 != 0), F.col("o_orderkey"))
    return t.orders.select("o_orderkey", N.sum_known(a, b).alias("total"))


@query("d01_compact_dates", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' END AS starts,
           CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 23:59:59' END AS ends FROM orders""")
def _(t):
    raw = F.when(F.col("o_orderkey") % 5 == 0, F.lit("2024133")).otherwise(F.date_format("o_orderdate", " yyyyMMdd "))
    show = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    return t.orders.select("o_orderkey", show(D.compact_date(raw)).alias("starts"), show(D.compact_date(raw, True)).alias("ends"))


@query("d02_d03_date_parts", """
    SELECT o_orderkey, CASE WHEN month(o_orderdate) + o_orderkey % 2 > 12 OR year(o_orderdate) < 2000 THEN ''
             ELSE strftime(make_timestamp(year(o_orderdate), month(o_orderdate) + o_orderkey % 2, 5, CASE WHEN o_orderkey % 3 = 0 THEN 10 ELSE 23 END,
               CASE WHEN o_orderkey % 3 = 0 THEN 30 ELSE 59 END, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 59 END), '%Y-%m-%d %H:%M:%S') END AS ends
    FROM orders""")
def _(t):
    y = F.year("o_orderdate")
    year = F.when(y >= 2000, F.lpad((y - 2000).cast("string"), 2, "0")).otherwise("x")
    month = (F.month("o_orderdate") + F.col("o_orderkey") % 2).cast("string")
    timed = F.col("o_orderkey") % 3 == 0
    ends = D.parts_to_timestamp(year, month, F.lit("5"), F.when(timed, "10").otherwise(""), F.when(timed, "30").otherwise(""), True)
    return t.orders.select("o_orderkey", F.coalesce(F.date_format(ends, "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias("ends"))


@query("d04_d05_days_and_iso", """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE (CAST(ts AS DATE) = CAST(ts + INTERVAL '6' HOUR AS DATE)) END AS same_day,
           strftime(ts, '%Y-%m-%d') AS iso_day, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+09:00' AS iso_time FROM events""")
def _(t):
    other = F.when(F.col("event_id") % 3 != 0, F.expr("ts + INTERVAL '6' HOUR"))
    seoul = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00"))
    return t.events.select("event_id", D.same_day("ts", other).alias("same_day"), D.iso_date("ts").alias("iso_day"), seoul.alias("iso_time"))


@query("js1_js2_json_payloads", """
    SELECT event_id, '{"source":"' || event_type || '"' || CASE WHEN value > 50 THEN ',"user":' || CAST(user_id AS STRING) ELSE '' END || '}' AS payload,
           event_type = 'click' AS is_click, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def _(t):
    payload = P.json_payload(source=F.col("event_type"), user=F.when(F.col("value") > 50, F.col("user_id")))
    return t.events.select("event_id", payload.alias("payload"), P.json_field_is(payload, "source", "click").alias("is_click"),
                           F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("js3_row_maps", """
    SELECT p_partkey, p_brand AS brand, CAST(p_size AS STRING) AS col_3, p_type AS repeated FROM part""")
def _(t):
    m = P.row_map(F.array(F.lit("brand"), F.lit("kind"), F.lit(" "), F.lit("kind")),
                  F.array("p_brand", "p_name", F.col("p_size").cast("string"), "p_type"))
    d = t.part.select("p_partkey", m.alias("m"))
    return d.select("p_partkey", F.col("m")["brand"].alias("brand"), F.col("m")["col_3"].alias("col_3"), F.col("m")["kind"].alias("repeated"))


@query("js4_response_text", """
    SELECT conv_id, turn, md5(CASE WHEN turn % 2 = 0 THEN text ELSE role || text END) AS answer FROM conversations""")
def _(t):
    direct = F.to_json(F.struct(F.col("text").alias("output_text")))
    nested = F.to_json(F.struct(F.lit(" ").alias("output_text"), F.array(
        F.struct(F.array(F.struct(F.lit("").alias("text"))).alias("content")),
        F.struct(F.array(F.struct(F.concat("role", "text").alias("text"))).alias("content"))).alias("output")))
    body = F.when(F.col("turn") % 2 == 0, direct).otherwise(nested)
    return t.conversations.select("conv_id", "turn", F.md5(P.response_text(body)).alias("answer"))


@query("h01_h02_hashes", """
    SELECT doc_id, sha256(text) AS input_hash, md5(coalesce(CASE WHEN lang = 'en' THEN NULL ELSE text END, '')) AS identity FROM documents""")
def _(t):
    return t.wide("documents").select("doc_id", P.provenance_hash("text").alias("input_hash"),
                              P.identity_key(F.when(F.col("lang") != "en", F.col("text"))).alias("identity"))
