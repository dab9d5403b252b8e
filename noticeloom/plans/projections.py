"""Projections of the given tables onto the notice model.

Each is plain SQL that Spark and other engines read the same way, so the same
text feeds a query and its counterpart. ``{name}`` stands for a given table.
"""

HASH_ID = {
    "spark": "CAST(conv(substr(md5({0}), 1, 15), 16, 10) AS BIGINT)",
    "ansi": "CAST('0x' || substr(md5({0}), 1, 15) AS BIGINT)",
}

_LINE_KEY = ("CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) "
             "|| '-' || CAST(l_suppkey AS STRING)")

PROJECTIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "notices": (("orders",), """
        SELECT o_orderkey AS id, o_orderpriority AS agency, 'rental' AS board_kind, CAST(o_orderkey AS STRING) AS seq,
               'Notice ' || o_orderpriority || CASE WHEN o_custkey % 7 = 0 THEN ' 결과' ELSE '' END AS title,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS posted_at,
               CASE WHEN o_orderstatus = 'P' THEN 'rejected' ELSE 'recruitment' END AS category
        FROM {orders}"""),
    "offerings": (("lineitem", "part"), """
        SELECT <<hash>> AS id, l_orderkey AS notice_id,
               CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_suppkey % 3 END AS attachment_id,
               CASE WHEN l_returnflag = 'N' THEN 'myhome' ELSE 'board' END AS source,
               CASE WHEN l_tax > 0.075 THEN NULL ELSE l_partkey END AS source_artifact_id,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS source_row,
               CASE WHEN l_suppkey % 17 = 0 THEN ' ' WHEN l_suppkey % 13 = 0 THEN 'file://x'
                    WHEN l_returnflag = 'N' THEN 'myhome://lt/' || CAST(l_orderkey AS STRING)
                    ELSE 'object://k/' || CAST(l_orderkey AS STRING) END AS source_span,
               CASE WHEN p_brand = 'Brand#2' THEN '' WHEN p_brand = 'Brand#3' THEN p_type || '�' ELSE p_type END
                   AS application_unit_label,
               CASE WHEN p_brand = 'Brand#5' THEN p_name ELSE '' END AS housing_name,
               CASE WHEN p_brand = 'Brand#6' THEN p_name ELSE '' END AS complex_name,
               CASE WHEN l_quantity > 20 THEN CAST(l_linenumber AS STRING) END AS unit_no,
               CASE WHEN l_linenumber % 2 = 0 THEN '1' ELSE '' END AS list_no,
               CASE WHEN l_quantity < 10 THEN NULL ELSE CAST(l_quantity AS INT) END AS supply_count,
               CASE WHEN p_size < 9 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS exclusive_area_m2,
               CASE WHEN p_size = 3 THEN 'shared' ELSE '' END AS occupancy_type,
               CASE WHEN l_discount > 0.055 THEN NULL ELSE CAST(floor(l_extendedprice * 100) AS BIGINT) END AS deposit_krw,
               CASE WHEN l_tax < 0.015 THEN 0 ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS monthly_rent_krw,
               CASE WHEN l_discount > 0.095 THEN CAST(floor(l_extendedprice * 200) AS BIGINT) END AS jeonse_deposit_krw,
               CASE WHEN p_size = 3 THEN CAST(120000 AS BIGINT) END AS dormitory_fee_krw,
               CASE WHEN l_suppkey % 5 = 0 THEN CAST(floor(l_extendedprice) AS BIGINT) END AS contract_deposit_krw,
               CASE WHEN l_suppkey % 4 = 0 THEN CAST(floor(l_extendedprice) AS BIGINT) END AS balance_payment_krw,
               CASE WHEN l_linenumber = 3 THEN '자세한 사항 참조' WHEN l_linenumber = 4 THEN 'deposit' ELSE '' END AS deposit_text,
               CASE WHEN l_linenumber IN (3, 4) THEN 'rent' ELSE '' END AS monthly_rent_text
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey"""),
    "visited_notices": (("events",), """
        SELECT user_id AS id, 'A' || CAST(user_id % 3 AS STRING) AS agency, 'events' AS board_kind,
               CAST(user_id AS STRING) AS seq, 'User ' || CAST(user_id AS STRING) AS title
        FROM {events} GROUP BY user_id"""),
    "visited_offerings": (("events",), """
        SELECT event_id AS id, user_id AS notice_id, CASE WHEN value > 40 THEN 'approved' ELSE 'rejected' END AS qa_status
        FROM {events} WHERE event_type = 'error'"""),
    "visited_schedules": (("events",), """
        SELECT event_id AS id, user_id AS notice_id,
               CASE WHEN event_type = 'view' THEN 'application' ELSE 'contract' END AS schedule_type,
               CASE WHEN value < 3 THEN NULL ELSE ts END AS starts_at,
               ts + CAST(floor(value) AS INT) * 10 * INTERVAL '1' MINUTE AS ends_at
        FROM {events} WHERE event_type IN ('view', 'signup') AND user_id % 9 <> 0"""),
    "visited_applications": (("events",), """
        SELECT event_id AS id, user_id AS notice_id,
               CASE WHEN event_type = 'click' THEN '청약중' WHEN event_type = 'purchase' THEN CASE WHEN event_id % 3 = 0 THEN ' 접수예정 ' ELSE '접수예정' END ELSE '마감' END AS status
        FROM {events} WHERE event_type IN ('click', 'purchase', 'signup') AND value > 120"""),
    "list_rows": (("events",), """
        SELECT event_id % 5 AS board, event_id AS seq, CAST(floor(event_id / 100) AS BIGINT) AS page, event_id AS position,
               event_type || ' Notice ' || CAST(user_id AS STRING) || ' (' || CAST(event_id % 7 AS STRING) || '.)' AS title,
               CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS posted_at
        FROM {events}"""),
    "collected_rows": (("events",), """
        SELECT event_id AS position, 'A' || CAST(user_id % 3 AS STRING) AS agency, 'events' AS board_kind, CAST(user_id AS STRING) AS seq,
               'Notice ' || CAST(user_id AS STRING) || CASE WHEN user_id % 5 = 0 THEN ' 입주자 모집공고' WHEN user_id % 5 < 3 THEN ' 당첨자 발표' ELSE '' END
                   || CASE WHEN value > 120 THEN ' v2' ELSE '' END AS title,
               CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN DATE '2024-03-01' ELSE DATE '2024-02-01' END AS posted_at,
               TIMESTAMP '2024-01-01 00:00:00' + (ts - TIMESTAMP '2024-01-01 00:00:00') * 4 AS collected_at,
               CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' AND event_id % 17 > 0 THEN 1 WHEN ts < TIMESTAMP '2024-01-21 00:00:00' AND event_id % 17 > 0 THEN 2 ELSE 3 END AS landing
        FROM {events}"""),
}


def render(name: str, dialect: str) -> tuple[tuple[str, ...], str]:
    sources, sql = PROJECTIONS[name]
    return sources, sql.replace("<<hash>>", HASH_ID[dialect].format(_LINE_KEY))
