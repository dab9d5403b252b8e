from pyspark.sql import functions as F

from noticeloom.functions import dates as D
from noticeloom.functions import numbers as N
from noticeloom.functions import payload as P
from noticeloom.functions import text as T
from noticeloom.operators import classify, predicates


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def L(v):
    return F.lit(v)


def test_white_space_is_unicode(spark):
    assert one(spark, T.collapse_ws(L("  a　 b\n")), T.trim_ws(L(" x y　"))) == ("a b", "x y")


def test_title_keys_pad_dates(spark):
    assert one(spark, T.title_key_plain(L("모집 공고 (2026.4.9)")), T.title_key_plain(L("모집공고(2026.04.09.)"))) == ("모집공고20260409",) * 2
    assert one(spark, T.title_key_strict(L("[정정] A-1, 모집~공고!"))) == ("정정a1모집공고",)


def test_numbers_cut_and_scale(spark):
    assert one(spark, N.first_int(L("약 1,234.9호")), N.first_krw(L("12.7")), N.first_int(L("없음")), N.money_with_unit(L("1,000"), L("(천 원)"))) == (1234, 12, None, 1000000)
    assert one(spark, N.area_text(L(30.0)), N.area_text(L(29.5)), N.area_text(L(10.0 / 3))) == ("30㎡", "29.5㎡", "3.33㎡")
    assert one(spark, N.krw_range_text(L(0), L(5)), N.krw_range_text(L(1000), L(1000)), N.krw_range_text(L(999), L(1000))) == ("", "1,000원", "999~1,000원")
    assert one(spark, N.korean_amounts(L("31억원 30억 5만원 1�2만")))[0] == [3000050000, 100020000]


def test_dates_that_do_not_exist_are_null(spark):
    parts = lambda *a, **k: D.iso_timestamp(D.parts_to_timestamp(*[L(x) for x in a], **k))
    assert one(spark, parts("2026", "13", "1", "", ""), parts("2026", "2", "30", "", "")) == ("", "")
    assert one(spark, parts("26", "5", "2", "", "", end_of_day=True), parts("26", "5", "2", "9", "30", end_of_day=True)) == (
        "2026-05-02T23:59:59+09:00", "2026-05-02T09:30:00+09:00")
    assert one(spark, D.iso_timestamp(D.compact_date(L("20260522"), True)), D.iso_timestamp(D.compact_date(L("2026522")))) == ("2026-05-22T23:59:59+09:00", "")


def test_rent_conditions_keep_last_label_and_drop_references(spark):
    assert tuple(one(spark, T.rent_conditions(L("자세한 사항 - 임대보증금 1 - 임대보증금 2 - 임대료 3")))[0]) == ("임대보증금 2", "임대료 3")
    assert tuple(one(spark, T.rent_conditions(L("임대보증금 및 시세의 30%")))[0]) == ("임대보증금 및 시세의 30%", "")


def test_row_map_and_response_text(spark):
    assert one(spark, P.row_map(F.array(L("a"), L("a")), F.array(L("1"), L("2"), L("3"))))[0] == {"a": "2", "col_3": "3"}
    assert one(spark, P.response_text(L('{"output":[{"content":[{"text":""}]},{"content":[{"text":"x"}]}]}')), P.response_text(L("{bad"))) == ("x", None)


def test_notice_rules_reject_before_accept(spark):
    c = lambda t, b="": classify.notice_category(L(t), L(b))
    assert one(spark, c("입주자 모집 당첨자 발표"), c("추가모집"), c("안내", "입주자 모집"), c("입주자 모집", "시스템 점검"), c("안내")) == (
        "rejected", "recruitment", "recruitment", "rejected", "unknown")


def test_attachment_rules(spark):
    k = lambda n: classify.attachment_kind(L(n))
    assert one(spark, k("동호 목록.XLSX"), k("예비자 명단.pdf"), k("공고문.hwpx"), k("모집일정.pdf"), k("그림.png"), k("a.xlsx")) == (
        "offering_list_xlsx", "applicant_or_winner_file", "notice_hwp", "schedule_pdf", "unsupported", "unsupported")


def test_predicates(spark):
    assert one(spark, predicates.agency_is(L(" lh "), "LH"), predicates.agency_is(L("x"), " "), predicates.is_clean_text(L("a�"))) == (True, True, False)
