
from pyspark.sql import functions as F

from noticeloom.operators import offerings, rents, schedules, sheets
from noticeloom.sources.artifacts import sheet_rows


def test_sheet_headers_block_scale_and_merge(spark):
    rows = [["연번", "주택명", "호 수", "전용면적(㎡)", "임대보증금 및 월임대료", "", "전세금액(천원)", "계약금"],
            ["1", "푸른집", " 101 ", "29.50", "1,000,000", "20,000", "300", "30"], ["", " "], ["접수번호", "성명", "호수", "전용면적"], ["9", "홍", "5", "1"],
            ["공급호수", "타입", "보증금", "임대료"], ["3", "A", "5,000", "70"], ["", "B", "1", "2"]]
    df = spark.createDataFrame([("k", "s1", rows)], "object_key string, sheet string, rows array<array<string>>")
    got = sheets.sheet_offerings(sheet_rows(df, "object_key", "sheet", "rows"), ["object_key", "sheet"]).orderBy("source_row").collect()
    assert [(r.source_row, r.unit_no, r.supply_count, r.deposit_krw, r.monthly_rent_text, r.jeonse_deposit_krw, r.contract_deposit_krw) for r in got] == [
        (2, "101", 1, 1000000, "20,000", 300000, 30000), (7, "", 3, 5000, "70", None, None)]
    assert got[0].application_unit_label == "푸른집 101 29.5㎡"
    assert got[0].source_span == "object://k#sheet=s1&row=2"
    assert got[0].raw_row["주택명"] == "푸른집" and got[0].raw_row["col_6"] == "20,000"


def periods(spark, *texts):
    df = spark.createDataFrame([(i, "pdf_text", f"object://{i}", t) for i, t in enumerate(texts)], "id int, artifact_type string, source_span string, raw_text string")
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    rows = schedules.text_schedules(df, ["id"]).orderBy("id", "position").select("id", "label", show("starts_at"), show("ends_at"))
    return [tuple(r) for r in rows.collect()]


def test_schedules_in_text(spark):
    got = periods(spark, "청약신청 접수기간 : 2026.5.7.(목) 10:00 부터 ~ 2026년 5월 9일(토) 17:30, 접수기간 2026.13.1 ~ 2026.13.2",
                  "■ 공급일정 공고 ▶ 신청접수 ➤ 발표 ‘26.4.1 26.4.3(금)~4.8 '26.5.1 ※ 참고 27.1.1", "신청접수 2026. �. 1 ~ 2026.2.3")
    assert got == [(0, "청약신청 접수기간", "2026-05-07 10:00:00", "2026-05-09 17:30:00"), (1, "신청접수", "2026-04-03 00:00:00", "2026-04-08 23:59:59")]


def test_rent_summary_single_value_and_range(spark):
    one = "임대조건\n구분\n보증금\n월 임대료\n5,000\n70,000\n■\n9,999\n1,111"
    four = "임대조건\n보증금 계약금 잔금 임대료\n1,000\n100\n900\n2,000\n3,000\n300\n2,700\n2,000\n4,000"
    df = spark.createDataFrame([(1, one), (2, four.replace("\n100\n", "\n1,00\n1,100\n")), (3, "임대조건\n없음")], "id int, t string")
    got = rents.rent_summary(df, "t", ["id"]).orderBy("id").collect()
    assert tuple(got[0]) == (1, "5,000원", 5000, "70,000원", 70000)
    assert [r.id for r in got] == [1, 2]


def test_repair_spans(spark):
    item = "application_unit_label string, housing_name string, unit_no string, exclusive_area_m2 double, supply_count int, deposit_krw long, monthly_rent_krw long, " \
           "jeonse_deposit_krw long, dormitory_fee_krw long, gender_requirement string, source_page int, source_span string, confidence double, raw_evidence string"
    make = lambda label, span: (label, "", None, None, None, None, None, None, None, "", None, span, .5, "e")
    df = spark.createDataFrame([("object://k#p=1", [make("A", ""), make(" ", ""), make("C", "other"), make("D", None)])], f"source_span string, offerings array<struct<{', '.join(f.replace(' ', ':', 1) for f in item.split(', '))}>>")
    rows = offerings.repair_offerings(df, []).orderBy("position").collect()
    assert [(r.application_unit_label, r.source_span) for r in rows] == [("A", "object://k#p=1&llm_item=1"), ("C", "other"), ("D", "object://k#p=1&llm_item=3")]
