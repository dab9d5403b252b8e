"""Token scanners: what is accepted, how far they look ahead, and what rows hand on."""

import json

from noticeloom.operators.scanners import PRICE_TABLE, TYPES
from noticeloom.operators.tables import extract_rows


def prices(text):
    return [(raw, c["district"], c["housing_name"], c["exclusive_area_m2"], c["application_category"], c["supply_count"], c["reserved_count"], c["jeonse_deposit_text"],
             c["heating_method"]) for raw, c in PRICE_TABLE.scan(text)]


ROW = "3 100,000 10,000 90,000 개별난방"


def test_raw_text_keeps_the_tokens_as_written():
    assert prices(f"중구 푸른, (마을) 59 [일반] {ROW}.") == [
        (f"59 [일반] {ROW}.", "중구", "푸른 마을", "59", "일반", "3", "", "100,000", "개별난방")]


def test_only_accepted_rows_hand_on():
    # no district: no row, and its area is not carried to the row that has none
    assert prices(f"49 {ROW} 중구 숲속 일반 {ROW}") == []
    # no name yet: no row; its tokens are within reach of the next name
    assert [r[2:4] for r in prices(f"중구 59 {ROW} 84 {ROW}")] == [("59 3 100,000 10,000 90,000 개별난방", "84")]
    # a category row takes name and area of the last accepted row, also across districts
    assert [r[1:5] for r in prices(f"중구 숲속 59 {ROW} 구로구 주거약자 {ROW}")] == [("중구", "숲속", "59", ""), ("구로구", "숲속", "59", "주거약자")]


def test_look_ahead_ends():
    assert len(prices("중구 숲속 59 3 a b c 100,000 10,000 90,000 개별난방")) == 1
    assert prices("중구 숲속 59 3 a b c d 100,000 10,000 90,000 개별난방") == []
    assert [r[8] for r in prices("중구 숲속 59 3 1,000 2,000 3,000 1 2 3 4 5 6 7 8 지역 난방")] == ["지역난방"]
    assert prices("중구 숲속 59 3 1,000 2,000 3,000 1 2 3 4 5 6 7 8 9 지역 난방") == []
    assert prices("중구 숲속 59 3 1,000 2,000 3,000 1 2 개별") == []
    assert prices("중구 숲속 59 3 1,000 2,000") == []


def test_reserved_counts_and_areas():
    assert [r[5:7] for r in prices("중구 숲속 59 - x (4) 1,000 2,000 3,000 개별난방")] == [("-", "4")]
    assert [r[5:7] for r in prices("중구 숲속 59 7 4 1,000 2,000 3,000 개별난방")] == [("7", "")]
    assert [r[3] for r in prices(f"중구 숲속 60 {ROW} 12.34 {ROW}")] == ["12.34"]


def types(body):
    return [(raw, c["supply_count"], c["deposit_text"], c["monthly_rent_text"], json.loads(c["unit_rows"])) for raw, c in TYPES.scan(f"x 공급유형 주택유형 {body} 세대 내 옵션 23㎡형 E형 4 1,000 2,000 23.5")]


def test_prices_hold_until_the_next_pair_or_type():
    got = types("21㎡형 A형 2 1,000 2,000 21.4 B형 3 21.5 C형 9 5,000 6,000 x D형 1 21.6 22㎡형 A형 1 22.1")
    assert [(g[0], g[1], g[2]) for g in got] == [("마곡 도전숙 21㎡형", "6", "1,000,000원")]
    assert [u["deposit_text"] for u in got[0][4]] == ["1,000,000원", "1,000,000원", "5,000,000원"]


def test_types_come_in_the_order_of_their_first_row():
    got = types("22㎡형 A형 2 1,000 2,000 22.4 21㎡형 A형 (주거약자용) 1 3,000 4,000 21.4 22㎡형 B형 5 9,000 9,000 22.5")
    assert [(g[0], g[1], g[2]) for g in got] == [("마곡 도전숙 22㎡형", "7", "1,000,000원"), ("마곡 도전숙 21㎡형 주거약자", "1", "3,000,000원")]
    assert types("21㎡형 A형 - 1,000 2,000 21.4 B형 0 1,000 2,000 21.4 C형 " + "9" * 5000 + " 1,000 2,000 21.4") == []


def test_texts_behind_gates_and_odd_rows(spark):
    rows = [(1, f"전세금액 모집 호수 중구 숲속 59 {ROW}", "object://a"), (2, None, "object://b"), (3, "", None), (4, f"전세금액 모집 중구 숲속 59 {ROW}", "object://d"), (1, f"전세금액 모집 호수 중구 숲속 59 {ROW}", None),
            (5, "전세금액 모집 호수 " + "중구 x " * 50_000 + f"59 {ROW}", "object://e")]
    df = spark.createDataFrame([(i, t, s, "own") for i, t, s in rows], "id long, raw_text string, source_span string, extra string")
    got = sorted((r["id"], r["source_span"] or "", r["row_no"], r["extra"]) for r in extract_rows(df, (PRICE_TABLE, TYPES)).collect())
    assert [g[0] for g in got] == [1, 1, 5] and got[1][1] == "object://a#table=long_term_jeonse&row=1" and got[2][3] == "own"
    assert extract_rows(df.limit(0), (PRICE_TABLE,)).collect() == []
