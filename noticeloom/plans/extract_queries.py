"""Table rows, sheets, offerings, rent summaries and schedules read from text.

The tables hold no housing texts, so each row of a given table is rendered into
one document and read back; the SQL counterpart states the rows directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import text as T
from noticeloom.operators import offerings as O
from noticeloom.operators import rents, reports, schedules, sheets, tables
from noticeloom.plans.registry import query
from noticeloom.plans.source_queries import C, K, L, text

KEY = "o_orderkey"


def won(c):
    return F.format_number(c, 0)


def _docs(t, body):
    return t.wide("orders").select(KEY, T.object_span(F.col(KEY).cast("string")).alias("source_span"), body.alias("raw_text"))


def _rows(t, body, rules, *names):
    """Table rows of one document per order, with the named content."""
    out = tables.extract_rows(_docs(t, body), rules)
    scanned = ["raw_text"] if any(isinstance(r, tables.ScanRule) for r in rules) and len(rules) == 1 else []
    return out.select(KEY, "table", "row_no", "source_span", *scanned, *[F.col("content")[n].alias(n) for n in names])


_O = "(SELECT *, CAST(o_orderkey AS STRING) AS k, CAST(o_custkey AS STRING) AS c, format('{:,}', o_custkey + 1000) AS m FROM orders)"
_SPAN = "'object://' || k || '#table={0}&row=' || CAST(row_no AS STRING) AS source_span"


def _m():
    return won(C() + 1000)


@query("g00_g01_unit_conditions", f"""
    SELECT o_orderkey, 'unit_conditions' AS "table", row_no, {_SPAN.format('unit_conditions')}, CASE WHEN row_no < 3 THEN '중구' ELSE '은평구' END AS district,
           CASE WHEN row_no < 3 THEN '서울특별시 중구 다동 ' || c || '-2' ELSE '' END AS address, CAST(CASE row_no WHEN 2 THEN 2 ELSE 1 END AS STRING) AS list_no,
           CAST(300 + row_no AS STRING) AS unit_no, c || '.5' AS exclusive_area_m2, m AS deposit_text, CASE row_no WHEN 3 THEN '9,000' ELSE '8,000' END AS monthly_rent_text
    FROM {_O}, (VALUES (1), (2), (3)) AS v(row_no)""")
def _(t):
    row = lambda n, unit, rent: text(f" {n} {unit} ", C(), ".5 40.0 ", _m(), f" {rent} 2,000 3,000")
    body = text("목록 서울특별시 중구 다동 ", C(), "-2 3 호, 서울특별시 중구 무교동 9 3 호\n호실별 규모 및 임대조건 구분", row(7, 999, "1"), "\n중구", row(1, 301, "8,000"), row(2, 302, "8,000"),
                " 은평구", row(1, 303, "9,000"), " 기타사항 강남구", row(1, 304, "1"))
    return _rows(t, body, tables.DEFAULT_RULES, "district", "address", "list_no", "unit_no", "exclusive_area_m2", "deposit_text", "monthly_rent_text")


@query("g01_carried_rows_in_prose", """
    WITH c AS (SELECT doc_id, trim(regexp_replace(translate(text, chr(1) || chr(2), ''), '%s+', ' ', 'g')) AS t FROM documents),
    m AS (SELECT doc_id, ms, unnest(generate_series(1, len(ms))) AS i FROM (SELECT doc_id, regexp_extract_all(t, '(?:([A-Z][a-z]+) )?([a-z]+ed) ([a-z]+)', 0) AS ms FROM c)),
    r AS (SELECT doc_id, i, ms[i] AS raw, nullif(regexp_extract(ms[i], '(?:([A-Z][a-z]+) )?([a-z]+ed) ([a-z]+)', 1), '') AS head,
                 regexp_extract(ms[i], '(?:([A-Z][a-z]+) )?([a-z]+ed) ([a-z]+)', 2) AS word FROM m),
    f AS (SELECT *, last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM r)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS row_no, carried AS head, word FROM f WHERE carried IS NOT NULL""" % fixed.WS)
def _(t):
    pattern = "(?:([A-Z][a-z]+) )?([a-z]+ed) ([a-z]+)"
    whole = lambda text_col: tables.pattern_rows(("", ""), pattern, {"word": 2}, "prose", carried=("head", 1))(text_col)
    rule = tables.TableRule("prose", (), whole)
    docs = t.wide("documents").select("doc_id", F.col("text").alias("raw_text"), F.col("source").alias("source_span"))
    return tables.extract_rows(docs, (rule,)).select("doc_id", "row_no", F.col("content")["head"].alias("head"), F.col("content")["word"].alias("word"))


@query("g02_vacancies", f"""
    SELECT o_orderkey, 'vacancy' AS "table", row_no, {_SPAN.format('vacancy')}, '들꽃' || c AS housing_name, '서울시 중구 남대문로' || c || '길 3' AS address,
           CAST(100 + row_no AS STRING) || '호' AS unit_no, c || '.5' AS exclusive_area_m2, m AS deposit_text, '7,000' AS monthly_rent_text FROM {_O}, (VALUES (1), (2)) AS v(row_no)""")
def _(t):
    row = lambda unit: text(" 들꽃", C(), f" {unit} 호 ", C(), ".5 ㎡ 50 ㎡ 1.5 룸 ", _m(), " 7,000 협의")
    body = text("( 서울시 중구 남대문로 ", C(), " 길 3 ) 공실 정보 주택", row(101), row(102), " 임대 기간", row(103))
    return _rows(t, body, (tables.VACANCY,), "housing_name", "address", "unit_no", "exclusive_area_m2", "deposit_text", "monthly_rent_text")


@query("g03_shared_prices", f"""
    SELECT o_orderkey, 'dure_rent_options' AS "table", row_no, {_SPAN.format('dure_rent_options')}, CAST(200 + row_no AS STRING) AS unit_no, c || '.25' AS exclusive_area_m2,
           m || ' 원' AS deposit_text, '4,000 원' AS monthly_rent_text FROM {_O}, (VALUES (1), (2)) AS v(row_no) WHERE o_orderkey % 4 <> 0""")
def _(t):
    last = F.when(K() % 4 == 0, "").otherwise(" 4,000 원")
    body = text("휘경마을 두레주택 임대보증금 및 월임대료 ", _m(), " 원 2,000 원 3,000 원", last, " x201 1.0 호 201 ", C(), ".25 202 ", C(), ".25 임대기간 203 ", C())
    return _rows(t, body, (tables.SHARED_PRICE,), "unit_no", "exclusive_area_m2", "deposit_text", "monthly_rent_text")


@query("g04_group_blocks", f"""
    SELECT o_orderkey, 'chungshin_theater_dure_gender_supply' AS "table", row_no, {_SPAN.format('chungshin_theater_dure_gender_supply')},
           '서울특별시 종로구 충신동 1-' || c AS address, CASE row_no WHEN 1 THEN '남성' ELSE '여성' END AS gender_requirement, CASE row_no WHEN 1 THEN c ELSE '1' END AS supply_count,
           m || '원' AS deposit_text, CASE row_no WHEN 1 THEN format('{{:,}}', least(o_custkey + 500, 3000)) || CASE WHEN o_custkey = 2500 THEN '' ELSE '~' || format('{{:,}}', greatest(o_custkey + 500, 3000)) END || '원' ELSE '9,000원' END AS monthly_rent_text
    FROM {_O}, (VALUES (1), (2)) AS v(row_no)""")
def _(t):
    body = text("충신동 연극인 두레주택 금회 공급대상 4 호점 종로구 충신동 1-", C(), " ", C(), " 호 101 10.5 공급 남성 5 호점 종로구 충신동 1-", C(), " 공급 나 . 임대보증금 ",
                "여성은 자동으로 5 호점 (호점 내 호실은 선택 불가) 임대보증금 및 월임대료 4 호점 종로구 충신동 1-", C(), " 101 10.5 ", _m(), " ", won(C() + 500), " 102 10.7 ", _m(), " 3,000",
                " 5 호점 종로구 충신동 1-", C(), " 101 7.5 ", _m(), " 9,000 남성은 102 7.5 1,000 1 ○ 임대보증금")
    return _rows(t, body, (tables.GROUPS,), "address", "gender_requirement", "supply_count", "deposit_text", "monthly_rent_text")


@query("g05_type_groups", f"""
    SELECT o_orderkey, 'magok_challenge_house_supply' AS "table", row_no, {_SPAN.format('magok_challenge_house_supply')},
           CASE row_no WHEN 1 THEN '마곡 도전숙 21㎡형' ELSE '마곡 도전숙 24㎡형 주거약자' END AS application_unit_label, CASE row_no WHEN 1 THEN '마곡 도전숙 21㎡형' ELSE '마곡 도전숙 24㎡형 주거약자' END AS raw_text,
           CASE row_no WHEN 1 THEN CAST(o_custkey + o_custkey + 7 AS STRING) ELSE c END AS supply_count, CASE row_no WHEN 1 THEN m ELSE '8,000' END || ',000원' AS deposit_text,
           CASE row_no WHEN 1 THEN '1,500원' ELSE '2,500원' END AS monthly_rent_text,
           CASE row_no WHEN 1 THEN '[{{"unit_type":"A형","supply_count":"' || c || '","exclusive_area_m2":"21.42","deposit_text":"' || m || ',000원","monthly_rent_text":"1,500원"}},'
               || '{{"unit_type":"A1형","supply_count":"7","exclusive_area_m2":"21.46","deposit_text":"' || m || ',000원","monthly_rent_text":"1,500원"}},'
               || '{{"unit_type":"B형","supply_count":"' || c || '","exclusive_area_m2":"21.1","deposit_text":"9,000,000원","monthly_rent_text":"9,999원"}}]'
               ELSE '[{{"unit_type":"C형","supply_count":"' || c || '","exclusive_area_m2":"24.3","deposit_text":"8,000,000원","monthly_rent_text":"2,500원"}}]' END AS unit_rows
    FROM {_O}, (VALUES (1), (2)) AS v(row_no) WHERE row_no = 1 OR o_custkey > 0""")
def _(t):
    body = text("마곡 도전숙 공급현황 공급유형별 면적 및 임대료 공급유형 주택유형 21㎡형 A형 ", C(), " ", _m(), " 1,500 21.42 17.5 A1형 7 21.46 (24㎡형) C형 (주거약자용) ", C(), " 8,000 2,500 24.3 22㎡형 D형 3 22.1",
                " 21㎡형 B형 ", C(), " 9,000 9,999 21.1 세대 내 옵션 23㎡형 E형 4 1,000 2,000 23.5")
    return _rows(t, body, (tables.TYPES,), "application_unit_label", "supply_count", "deposit_text", "monthly_rent_text", "unit_rows")


@query("g06_gender_expansion", f"""
    SELECT o_orderkey, 'hope_housing_supply' AS "table", row_no, {_SPAN.format('hope_housing_supply')}, CASE row_no WHEN 1 THEN '내발산 공공기숙사' ELSE '정릉 희망하우징' END AS housing_name,
           CASE row_no WHEN 2 THEN '남성' ELSE '여성' END AS gender_requirement, CASE row_no WHEN 2 THEN '3' ELSE c END AS supply_count, CASE row_no WHEN 1 THEN '' ELSE m || '원' END AS deposit_text,
           CASE row_no WHEN 1 THEN '12,000원' ELSE '' END AS dormitory_fee_text, CASE row_no WHEN 1 THEN '서울특별시 강서구 수명로 ' || c ELSE '' END AS address FROM {_O}, (VALUES (1), (2), (3)) AS v(row_no)""")
def _(t):
    body = text("희망하우징 공급대상 내발산공공기숙사 원룸형 1인실(일반) 22.3㎡ 여성", C(), " 정릉 희망하우징 원룸형 1인실 15.2㎡ 남성3 여성", C(),
                " 내발산 공공기숙사 · 주소 : 서울특별시 강서구 수명로 ", C(), " 주택명 내발산 공공기숙사 - - 12,000원 정릉 희망하우징 1원 2원 3원 정릉희망하우징 ", _m(), "원 5,000원 - 끝")
    return _rows(t, body, (tables.HOPE,), "housing_name", "gender_requirement", "supply_count", "deposit_text", "dormitory_fee_text", "address")


@query("g07_program_summary", f"""
    SELECT o_orderkey, 'jeonse_lease_support' AS "table", row_no, {_SPAN.format('jeonse_lease_support')}, c AS supply_count,
           '보증금한도액 ' || format('{{:,}}', CAST(greatest(e * 100000000 + o_custkey * 10000, 200000000) AS BIGINT)) || '원' AS jeonse_deposit_text,
           CASE WHEN s = 0 THEN '' ELSE '입주자부담금 ' || format('{{:,}}', CAST(s * 2 // 10 AS BIGINT)) || '원' END AS contract_deposit_text,
           CASE WHEN s = 0 THEN '' ELSE '최대지원금액 ' || format('{{:,}}', CAST(s * 8 // 10 AS BIGINT)) || '원' END AS balance_payment_text
    FROM (SELECT *, CASE WHEN e * 100000000 + o_custkey * 10000 > 0 THEN e * 100000000 + o_custkey * 10000 ELSE 200000000 END AS s, 1 AS row_no FROM (SELECT *, CAST(o_orderkey % 20 AS BIGINT) AS e FROM {_O}))""")
def _(t):
    body = text("전세임대형 든든주택 서울특별시 전 지역 공급호수 : ", won(C()), "호 지원금액 ", K() % 20, "억 ", won(C()), "만원, 2�원 한도 99억원 월 임대료 29억원")
    return _rows(t, body, (tables.SUPPORT,), "supply_count", "jeonse_deposit_text", "contract_deposit_text", "balance_payment_text")


@query("g08_price_table", f"""
    SELECT o_orderkey, 'long_term_jeonse' AS "table", row_no, {_SPAN.format('long_term_jeonse')}, CASE WHEN row_no < 4 THEN '송파구' WHEN row_no < 6 THEN '중구' ELSE '노원구' END AS district,
           CASE row_no WHEN 4 THEN '숲속' WHEN 5 THEN '45 ' || c || ' ' || m || ' 1,000' WHEN 6 THEN '45 ' || c || ' ' || m || ' 1,000' ELSE '푸른 단지' || c END AS housing_name,
           CASE row_no WHEN 3 THEN '84.5' WHEN 4 THEN '74' WHEN 5 THEN '74' WHEN 6 THEN '74' ELSE '59' END AS exclusive_area_m2,
           CASE row_no WHEN 1 THEN '일반' WHEN 2 THEN '주거약자' WHEN 5 THEN '우선' WHEN 6 THEN '일반' ELSE '' END AS application_category, c AS supply_count, CASE row_no WHEN 1 THEN '4' ELSE '' END AS reserved_count,
           m AS jeonse_deposit_text, CASE WHEN row_no IN (2, 6) THEN '지역난방' ELSE '개별난방' END AS heating_method,
           CASE row_no WHEN 1 THEN '59 일반 ' || c || ' (x) 4 ' WHEN 2 THEN '주거약자 ' || c || ' ' WHEN 3 THEN '84.5 ' || c || ' ' WHEN 4 THEN '74 ' || c || ' ' WHEN 5 THEN '우선 ' || c || ' ' ELSE '[일반] ' || c || ' ' END
               || m || ' 1,000 9,000 59.9 25.1 ' || CASE row_no WHEN 2 THEN '지역 난방' WHEN 6 THEN '지역난방.' ELSE '개별난방' END AS raw_text
    FROM {_O}, (VALUES (1), (2), (3), (4), (5), (6)) AS v(row_no)""")
def _(t):
    """Rows before a district and rows without three amounts are none: they hand no area on, and their tokens stay in reach of a name."""
    row = lambda head, extra, heat: text(f" {head} ", C(), f" {extra}", _m(), " 1,000 9,000 59.9 25.1 ", heat)
    body = text("자치구 단지명 모집 호수 전세금액", row("49", "", "개별난방"), " 송파구 푸른, 단지", C(), row("59 일반", "(x) 4 ", "개별난방"), row("주거약자", "", "지역 난방"), row("84.5", "", "개별난방"),
                " 중구 숲속", row("74", "", "개별난방"), " 45 ", C(), " ", _m(), " 1,000", row("우선", "", "개별난방"), " 노원구 계약금", row("[일반]", "", "지역난방."))
    return _rows(t, body, (tables.PRICE_TABLE,), "district", "housing_name", "exclusive_area_m2", "application_category", "supply_count", "reserved_count", "jeonse_deposit_text", "heating_method")


@query("g13_table_row_offerings", f"""
    SELECT o_orderkey, row_no, '푸른 단지' || c || ' ' || CASE row_no WHEN 1 THEN '59 일반' ELSE '59 주거약자' END AS application_unit_label, '송파구' AS district, 59.0 AS exclusive_area_m2,
           CAST(o_custkey AS INT) AS supply_count, CAST(o_custkey + 1000 AS BIGINT) * 1000 AS jeonse_deposit_krw, 9000000 AS balance_payment_krw, 0.78 AS confidence FROM {_O}, (VALUES (1), (2)) AS v(row_no)""")
def _(t):
    row = lambda head: text(f" {head} ", C(), " ", _m(), " 1,000 9,000 개별난방")
    rows = tables.extract_rows(_docs(t, text("모집 호수 전세금액 송파구 푸른 단지", C(), row("59 일반"), row("주거약자"))), (tables.PRICE_TABLE,))
    return O.table_row_offerings(rows, [KEY, "row_no"]).select(KEY, "row_no", "application_unit_label", "district", "exclusive_area_m2", "supply_count",
                                                              "jeonse_deposit_krw", "balance_payment_krw", "confidence")


# --- sheets: an order is a sheet row, a customer group is a sheet ------------------------------------------------


def _sheet_rows(t):
    valid = F.array(L("연번"), L("주택명"), L("호 수"), L("전용면적(㎡)"), L("임대보증금 및 임대료"), L(""), L("전세금액(천원)"), L("잔금"))
    other = F.array(L("호수"), L("타입"), L("보증금"), L("월임대료"), L("공급호수"), L("단지명"))
    applicant = F.array(L("접수번호"), L("성명"), L("호수"), L("전용면적"))
    data = F.array(F.when(K() % 7 == 0, "").otherwise(text(K())), text("단지 ", C()), F.when(K() % 3 == 0, " ").otherwise(text(" ", K() % 900, "  호")), text(C(), ".50"), won(C() + 1000), won(K() + 1), won(C()), L("5"))
    cells = (F.when(K() % 211 == 5, valid).when(K() % 211 == 77, other).when(K() % 211 == 150, applicant).when(K() % 17 == 0, F.array(L(" "), L(""))).otherwise(data))
    return t.wide("orders").select((C() % 20).alias("sheet"), K().alias("row_no"), cells.alias("cells"), T.sheet_span(L("k"), (C() % 20).cast("string"), K()).alias("source_span"))


_SHEET = """WITH r AS (SELECT o_custkey % 20 AS sheet, o_orderkey AS row_no, o_custkey AS c, CASE WHEN o_orderkey % 211 IN (5, 77, 150) THEN o_orderkey END AS mark, o_orderkey % 17 = 0 AS blank FROM orders),
    f AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header_row FROM r)"""


@query("g09_header_roles", """
    SELECT sheet, row_no, row_no % 211 = 150 AS is_applicant, row_no % 211 IN (5, 77) AS is_header,
           CASE row_no % 211 WHEN 5 THEN 'list_no,housing_name,unit_no,exclusive_area_m2,deposit,,jeonse_deposit,balance_payment' WHEN 77 THEN 'unit_no,unit_type,deposit,monthly_rent,supply_count,housing_name' END AS roles
    FROM (SELECT o_custkey % 20 AS sheet, o_orderkey AS row_no FROM orders) WHERE row_no % 211 IN (5, 77, 150)""")
def _(t):
    h = sheets.header_columns(_sheet_rows(t))
    return h.where("is_header OR is_applicant").select("sheet", "row_no", "is_applicant", "is_header", F.when(F.col("is_header"), F.array_join("roles", ",")).alias("roles"))


@query("g10_w02_header_fill_down", _SHEET + """
    SELECT sheet, row_no, header_row FROM f WHERE mark IS NULL AND NOT blank AND header_row % 211 IN (5, 77)""")
def _(t):
    return sheets.with_headers(_sheet_rows(t), ["sheet"]).select("sheet", "row_no", "header_row")


@query("g11_sheet_offerings", _SHEET + """
    SELECT sheet, row_no AS source_row, CAST(row_no % 900 AS STRING) || ' 호' AS unit_no, CAST(c AS DOUBLE) + 0.5 AS exclusive_area_m2, c + 1000 AS deposit_krw,
           format('{:,}', row_no + 1) AS monthly_rent_text, row_no + 1 AS monthly_rent_krw, c * 1000 AS jeonse_deposit_krw, 5000 AS balance_payment_krw, 1 AS supply_count, '단지 ' || CAST(c AS STRING) AS raw_name, CAST(row_no % 900 AS STRING) || ' 호 ' || CAST(c AS STRING) || '.5㎡' AS label_end
    FROM f WHERE mark IS NULL AND NOT blank AND header_row % 211 = 5 AND row_no % 3 <> 0
    UNION ALL SELECT sheet, row_no, CASE WHEN row_no % 7 = 0 THEN '' ELSE CAST(row_no AS STRING) END, NULL, CASE WHEN row_no % 3 > 0 AND row_no % 900 > 0 THEN row_no % 900 END, CAST(c AS STRING) || '.50', c, NULL, NULL, c + 1000, NULL, CASE WHEN row_no % 7 = 0 THEN '' ELSE CAST(row_no AS STRING) END
    FROM f WHERE mark IS NULL AND NOT blank AND header_row % 211 = 77""")
def _(t):
    rows = sheets.sheet_offerings(_sheet_rows(t), ["sheet"])
    return rows.select(
        "sheet", "source_row", "unit_no", "exclusive_area_m2", "deposit_krw", "monthly_rent_text", "monthly_rent_krw", "jeonse_deposit_krw", "balance_payment_krw", "supply_count",
        F.col("raw_row")["주택명"].alias("raw_name"), F.regexp_replace("application_unit_label", "^(?:단지 [0-9]+|[0-9,]+) ?", "").alias("label_end"))


# --- single-unit texts, API items, repair output -----------------------------------------------------------------


def _unit_texts(t):
    values = text(" ", C() % 900 + 1, "\n호\n전용\n공용\n", C(), ".25\n면적\n", _m(), "\n", won(K() + 1), "\n비고\n입주가능일")
    listed = text("공급주택\n서울시\n중구\n가온\n로\n", C(), "\n길\n", C() % 900 + 1, "\n호\n[공급대상]\n청년\n임대료:", values)
    form = text("주소\n옛\n주소\n서울시\n중구\n가온\n로\n", C(), "\n길\n공급호실\n임대료", values)
    return _docs(t, F.when(K() % 3 == 0, listed).when(K() % 3 == 1, form).otherwise(F.concat(L("임대료 입주가능일 "), C().cast("string"))))


@query("g12_unit_texts", f"""
    SELECT o_orderkey, '서울시 중구 가온로' || c || '길' AS address, '중구' AS district, u || '호' AS unit_no, u || '호 ' || c || '.25㎡' AS application_unit_label,
           CAST(o_custkey + 0.25 AS DOUBLE) AS exclusive_area_m2, CAST(o_custkey + 1000 AS BIGINT) AS deposit_krw, o_orderkey + 1 AS monthly_rent_krw,
           CASE WHEN o_orderkey % 3 = 0 THEN 'pdf_supply_housing_table' ELSE 'pdf_application_form_table' END AS layout
    FROM (SELECT *, CAST(o_custkey % 900 + 1 AS STRING) AS u FROM {_O}) WHERE o_orderkey % 3 < 2""")
def _(t):
    return O.unit_text_offerings(_unit_texts(t), [KEY]).select(KEY, "address", "district", "unit_no", "application_unit_label", "exclusive_area_m2", "deposit_krw", "monthly_rent_krw", "layout")


def _items(t):
    return t.wide("orders").select(
        KEY, text(K()).alias("notice_id"), (C() % 3).cast("int").alias("house_sn"), text("단지 ", C()).alias("complex_name"), L("국민임대").alias("supply_type"),
        F.when(C() % 2 == 0, "아파트").otherwise("").alias("house_type"), F.when(C() % 4 > 0, (C() % 4).cast("int")).alias("supply_count"), L(" 서울 ").alias("province"), L("").alias("city"),
        L("a").alias("address"), L("d").alias("legal_dong"), L("u").alias("detail_url"), L("s").alias("source_url"), L("h").alias("heating_method"), C().alias("deposit_krw"),
        K().alias("monthly_rent_krw"), F.when(C() % 5 == 0, C()).alias("contract_payment_krw"), F.when(K() % 2 == 0, C()).alias("interim_payment_krw"), F.when(K() % 3 == 0, K()).alias("balance_payment_krw"),
        L("보증금").alias("deposit_condition_text"), F.when(K() % 4 == 0, " ").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("application_begin"),
        F.when(K() % 8 == 0, "").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("application_end"))


@query("g14_item_offerings", f"""
    SELECT o_orderkey, '단지 ' || c || ' 국민임대' || CASE WHEN o_custkey % 2 = 0 THEN ' 아파트' ELSE '' END || CASE WHEN o_custkey % 4 > 0 THEN ' ' || CAST(o_custkey % 4 AS STRING) || '호' ELSE '' END AS application_unit_label,
           CASE WHEN o_custkey % 3 > 0 THEN CAST(o_custkey % 3 AS STRING) ELSE '' END AS list_no, '서울' AS district, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 THEN o_custkey + o_orderkey WHEN o_orderkey % 2 = 0 THEN o_custkey
             WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS balance_payment_krw, 'myhome://rsdt/' || k AS source_span,
           '{{"source":"myhome_api","pblanc_id":"' || k || '","house_sn":' || CAST(o_custkey % 3 AS STRING) || ',"detail_url":"u","source_url":"s","deposit_condition_text":"보증금"'
             || CASE WHEN o_orderkey % 2 = 0 THEN ',"interim_payment_krw":' || c ELSE '' END || '}}' AS raw_row FROM {_O}""")
def _(t):
    return O.item_offerings(_items(t), [KEY], T.api_span(L("rsdt"), "notice_id")).select(
        KEY, "application_unit_label", "list_no", "district", "balance_payment_krw", "source_span", "raw_row")


@query("g15_item_schedules", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE d || ' 00:00:00' END AS starts, CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE d || ' 23:59:59' END AS ends,
           'myhome://rsdt/' || CAST(o_orderkey AS STRING) || '#schedule=application' AS source_span FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders) WHERE o_orderkey % 8 <> 0""")
def _(t):
    show = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), L(""))
    return O.item_schedules(_items(t), [KEY], T.api_span(L("rsdt"), "notice_id")).select(KEY, show("starts_at").alias("starts"), show("ends_at").alias("ends"), "source_span")


@query("g20_repair_output", """
    SELECT o_orderkey, n AS position, CASE n WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' || CAST(o_custkey AS STRING) END AS application_unit_label,
           CASE n WHEN 0 THEN 'object://' || CAST(o_orderkey AS STRING) || '#llm_item=1' WHEN 1 THEN 'x#p=1' ELSE 'object://' || CAST(o_orderkey AS STRING) || '#llm_item=3' END AS source_span, o_custkey AS deposit_krw
    FROM orders, (VALUES (0), (1), (3)) AS v(n)""")
def _(t):
    item = lambda label, span: F.struct(
        label.alias("application_unit_label"), L("h").alias("housing_name"), L(None).cast("string").alias("unit_no"), L(1.5).alias("exclusive_area_m2"), L(1).alias("supply_count"), C().alias("deposit_krw"),
        C().alias("monthly_rent_krw"), L(None).cast("bigint").alias("jeonse_deposit_krw"), L(None).cast("bigint").alias("dormitory_fee_krw"), L("").alias("gender_requirement"), L(None).cast("int").alias("source_page"),
        span.alias("source_span"), L(0.5).alias("confidence"), L("e").alias("raw_evidence"))
    outputs = t.wide("orders").select(KEY, T.object_span(K().cast("string")).alias("source_span"), F.array(
        item(L(" A "), L("")), item(L("B"), L("x#p=1")), item(L(" "), L(" ")), item(text("C", C()), L(None).cast("string"))).alias("offerings"))
    return O.repair_offerings(outputs, [KEY]).select(KEY, "position", "application_unit_label", "source_span", "deposit_krw")


@query("g21_u01_kind_routing", f"""
    SELECT o_orderkey, unit_no FROM (SELECT o_orderkey, CAST(o_custkey % 900 + 1 AS STRING) || '호' AS unit_no FROM orders WHERE o_orderkey % 3 < 2 AND o_custkey % 2 = 0
      UNION ALL SELECT o_orderkey, CAST(100 + n AS STRING) || '호' FROM orders, (VALUES (1), (2)) AS v(n) WHERE o_custkey % 4 < 2)""")
def _(t):
    vacancy = lambda unit: text(" 들꽃", f" {unit} 호 30 ㎡ 50 ㎡ 1 룸 5,000 7,000")
    docs = _unit_texts(t).join(t.orders.select(KEY, "o_custkey"), KEY).withColumn(
        "kind", F.when(F.col("o_custkey") % 4 == 0, "notice_pdf").when(F.col("o_custkey") % 4 == 1, "notice_hwp").when(F.col("o_custkey") % 4 == 2, "form").otherwise("unsupported"))
    with_table = docs.withColumn("raw_text", F.concat("raw_text", L(" 공실 정보"), vacancy(101), vacancy(102)))
    unit = lambda a: O.unit_text_offerings(a, [KEY]).select(KEY, "unit_no")
    table = lambda a: O.table_row_offerings(tables.extract_rows(a.select(KEY, "source_span", "raw_text"), (tables.VACANCY,)), [KEY]).select(KEY, "unit_no")
    return O.route_by_kind(with_table, "kind", {unit: ("notice_pdf", "form"), table: ("notice_pdf", "notice_hwp")})


# --- the extraction report: every document is a file, some with tables or a single unit below their text -----------
def _files(t):
    vacancy = lambda unit: text(f" 들꽃 {unit} 호 30.5 ㎡ 50 ㎡ 1 룸 5,000 7,000")
    doc = F.col("doc_id")
    unit = text("\n공급주택\n서울시\n중구\n가온\n로\n", doc, "\n길\n", doc % 900 + 1, "\n호\n[공급대상]\n청년\n임대료: ", doc % 900 + 1, "\n호\n전용\n공용\n20.25\n면적\n8,000\n9,000\n비고\n입주가능일")
    body = F.concat("text", L("\n"), F.when(doc % 3 == 0, F.concat(L(" 공실 정보"), vacancy(101), vacancy(102), L(" 임대 기간"))).otherwise(""),
                    F.when(doc % 5 == 0, text(" 전세금액 모집 호수 중구 숲속 59 ", doc % 9, " 100,000 10,000 90,000 개별난방")).otherwise(""), F.when(doc % 7 == 0, unit).otherwise(""))
    kind = F.when(doc % 11 == 0, "form").when(doc % 4 == 3, "notice_hwp").otherwise("notice_pdf")
    return t.wide("documents").select(F.concat(L("f"), doc.cast("string")).alias("file"), kind.alias("kind"), T.object_span(doc.cast("string")).alias("source_span"), body.alias("raw_text"))


_FILES = """
    WITH d AS (SELECT doc_id, 'f' || CAST(doc_id AS STRING) AS file, CASE WHEN doc_id % 11 = 0 THEN 'form' WHEN doc_id % 4 = 3 THEN 'notice_hwp' ELSE 'notice_pdf' END AS kind FROM documents),
    r AS (SELECT file, kind, doc_id, 'vacancy' AS tab, n FROM d, (VALUES (1), (2)) AS v(n) WHERE doc_id % 3 = 0 UNION ALL SELECT file, kind, doc_id, 'long_term_jeonse', 1 FROM d WHERE doc_id % 5 = 0),
    o AS (SELECT file, doc_id, tab, n FROM r WHERE kind <> 'form' UNION ALL SELECT file, doc_id, 'unit', 0 FROM d WHERE kind = 'notice_pdf' AND doc_id % 7 = 0)"""


@query("q05_a04_u01_file_report", _FILES + """
    SELECT file, count(*) AS files, CAST(sum(1 + a) AS BIGINT) AS artifacts, CAST(sum(f) AS BIGINT) AS offerings
    FROM (SELECT d.file, (SELECT count(*) FROM r WHERE r.file = d.file) AS a, (SELECT count(*) FROM o WHERE o.file = d.file) AS f FROM d) GROUP BY ROLLUP (file)""")
def _(t):
    return reports.extraction_report(_files(t), "file").totals


@query("q05_report_offerings", _FILES + """
    SELECT file, CASE tab WHEN 'vacancy' THEN '들꽃 ' || CAST(100 + n AS STRING) || '호 30.5㎡' WHEN 'unit' THEN CAST(doc_id % 900 + 1 AS STRING) || '호 20.25㎡' ELSE '숲속 59' END AS application_unit_label,
           CASE tab WHEN 'vacancy' THEN CAST(100 + n AS STRING) || '호' WHEN 'unit' THEN CAST(doc_id % 900 + 1 AS STRING) || '호' ELSE '' END AS unit_no,
           CASE tab WHEN 'vacancy' THEN 30.5 WHEN 'unit' THEN 20.25 ELSE 59.0 END AS exclusive_area_m2, CASE tab WHEN 'long_term_jeonse' THEN doc_id % 9 ELSE 1 END AS supply_count,
           CASE tab WHEN 'vacancy' THEN 5000 WHEN 'unit' THEN 8000 END AS deposit_krw, CASE tab WHEN 'vacancy' THEN 7000 WHEN 'unit' THEN 9000 END AS monthly_rent_krw,
           CASE tab WHEN 'long_term_jeonse' THEN 100000000 END AS jeonse_deposit_krw,
           'object://' || CAST(doc_id AS STRING) || CASE tab WHEN 'unit' THEN '' ELSE '#table=' || tab || '&row=' || CAST(n AS STRING) END AS source_span FROM o""")
def _(t):
    return reports.extraction_report(_files(t), "file").offerings.select(
        "file", "application_unit_label", "unit_no", "exclusive_area_m2", "supply_count", "deposit_krw", "monthly_rent_krw", "jeonse_deposit_krw", "source_span")


# --- rent summaries and schedules ----------------------------------------------------------------------------------


@query("g16_rent_summary", f"""
    SELECT o_orderkey, CASE WHEN o_custkey = 1 THEN '1,001원' ELSE format('{{:,}}', least(o_custkey + 1000, 1001)) || '~' || format('{{:,}}', greatest(o_custkey + 1000, 1001)) || '원' END AS deposit_text,
           CASE WHEN o_custkey = 1 THEN 1001 END AS deposit_krw, '7,000원' AS monthly_rent_text, 7000 AS monthly_rent_krw FROM {_O} WHERE o_orderkey % 5 > 0""")
def _(t):
    four = F.when(K() % 2 == 0, text("\n10\n2,222\n3,333\n")).otherwise("\n")
    head = F.when(K() % 5 == 0, L("임대조건 안내\n")).otherwise(text("임대조건\n구분\n보증금\n월 임대료\n", F.when(K() % 2 == 0, "계약금 잔금\n").otherwise("")))
    stop = F.when(K() % 3 == 0, "■").when(K() % 3 == 1, "-\n12\n-").otherwise("")
    body = text(head, _m(), four, "7,000\n 비고 \n1,001", four, "7,000\n9,999\n", stop, F.when(K() % 3 == 2, "").otherwise("\n8,888\n8,888\n8,888"))
    return rents.rent_summary(t.wide("orders").select(KEY, body.alias("text")), "text", [KEY])


def _schedule_docs(t):
    day = F.date_format("o_orderdate", "yyyy. M. d")
    range_text = text("안내 신청접수 : ", day, ".(월) 09:30 ~ ", day, " (화) 끝. 접수기간 2024년 13월 1일 ~ 2024.1.2. ")
    table = text("공급절차 및 일정 모집공고 ▶ 신청접수 ▶ 당첨자 발표 ▶ 신청접수(2차) ‘", F.date_format("o_orderdate", "yy. M. d"), " ‘24.3.", K() % 9 + 1, "(월)~3.", K() % 9 + 11, " 18:00 '24.5.1 ※ 24.9.9 ")
    kind = F.when(K() % 4 == 0, "pdf_text").when(K() % 4 == 1, "html_preview").when(K() % 4 == 2, "hwpx_text").otherwise("hwp_text")
    return t.wide("orders").select(KEY, kind.alias("artifact_type"), T.object_span(K().cast("string")).alias("source_span"), F.when(K() % 3 == 0, range_text).when(K() % 3 == 1, table).otherwise(F.concat(range_text, table)).alias("raw_text"))


_SCHEDULES = """
    WITH d AS (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 9 + 1 AS a FROM orders WHERE o_orderkey % 4 < 3),
    s AS (SELECT o_orderkey, 'range' AS how, day || ' 09:30:00' AS starts, day || ' 23:59:59' AS ends, '신청접수' AS label, 0.86 AS confidence FROM d WHERE o_orderkey % 3 <> 1
          UNION ALL SELECT o_orderkey, 'table', '2024-03-' || lpad(CAST(a AS STRING), 2, '0') || ' 00:00:00', '2024-03-' || CAST(a + 10 AS STRING) || ' 18:00:00', '신청접수', 0.82 FROM d WHERE o_orderkey % 3 <> 0)"""


@query("g17_g18_text_schedules", _SCHEDULES + """
    SELECT o_orderkey, starts, ends, label, confidence, 'object://' || CAST(o_orderkey AS STRING) || '#schedule=application' AS source_span FROM s""")
def _(t):
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return schedules.text_schedules(_schedule_docs(t), [KEY]).select(KEY, show("starts_at").alias("starts"), show("ends_at").alias("ends"), "label", "confidence", "source_span")


@query("g19_schedule_dedupe", _SCHEDULES + """
    SELECT substr(starts, 1, 10) AS day, confidence, min(o_orderkey) AS o_orderkey FROM s GROUP BY how, starts, confidence""")
def _(t):
    found = schedules.text_schedules(_schedule_docs(t), [KEY])
    return schedules.dedupe_schedules(found, [], [F.col(KEY), F.col("position")]).select(F.date_format("starts_at", "yyyy-MM-dd").alias("day"), "confidence", KEY)


@query("g00_dispatcher", """
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'vacancy' ELSE 'jeonse_lease_support' END AS "table", count(*) AS rows
    FROM orders, (VALUES (1), (2)) AS v(n) WHERE o_orderkey % 3 = 0 OR (o_orderkey % 3 = 1 AND n = 1) GROUP BY 1, 2
    UNION ALL SELECT o_orderkey, 'jeonse_lease_support', 1 FROM orders WHERE o_orderkey % 9 = 0""")
def _(t):
    """Every rule over every document; a document may hold several tables or none."""
    vacancy = text("공실 정보 들꽃 101 호 30 ㎡ 50 ㎡ 1 룸 5,000 7,000 들꽃 102 호 30 ㎡ 50 ㎡ 1 룸 5,000 ", won(C()))
    support = text("전세임대형 든든주택 공급호수 : ", C(), "호 지원금액 2억원")
    body = F.when(K() % 9 == 0, F.concat(support, L(" "), vacancy)).when(K() % 3 == 0, vacancy).when(K() % 3 == 1, support).otherwise(F.concat(L("공고 "), C().cast("string")))
    rows = tables.extract_rows(_docs(t, body), tables.DEFAULT_RULES)
    return rows.groupBy(KEY, "table").agg(F.count(L(1)).alias("rows"))
