import datetime as dt

from pyspark.sql import functions as F

from noticeloom.operators import quality
from noticeloom.plans import pipeline, serve

BOARD = "agency string, board_kind string, "


def list_page(*rows):
    cells = "".join(f"<tr><td>1</td><td><a onclick=\"getDetailView('{seq}')\">{title}</a></td><td>팀</td><td>{day}</td><td>1</td></tr>" for seq, title, day in rows)
    return f"<table id='listTb'><tbody>{cells}</tbody></table>"


def test_board_run(spark):
    lists = spark.createDataFrame([
        ("SH", "rental", 1, list_page(("9", "새 모집공고", "2026-05-20"), ("8", "당첨자 발표", "2026-05-19"), ("7", "아는 모집공고", "2026-05-18"), ("6", "안내", "2026-05-17"))),
        ("SH", "rental", 2, list_page(("5", "오래된 공고", "2026-01-02"), ("4", "청년 모집공고", "2026-01-01"))),
        ("SH", "rental", 3, list_page(("3", "쪽 넘어 모집공고", "2026-05-01")))], BOARD + "page int, html string")
    page = lambda seq, title, body: ("SH", "rental", seq, f"<table><caption>{title}</caption></table><div class='cont'>{body}</div>")
    details = spark.createDataFrame([page("9", "새 모집공고", ""), page("8", "당첨자 발표", ""), page("6", "안내", "입주자 모집"), page("4", "", "")], BOARD + "seq string, html string")
    known = spark.createDataFrame([("SH", "rental", "7")], BOARD + "seq string")
    cache = spark.createDataFrame([], BOARD + "seq string, status string, list_title_hash string, posted_at date, expires_at timestamp")
    apps = spark.createDataFrame([("청년 모집 공고", "청약중"), ("닫힌 공고", "마감")], "title string, status string")
    now = F.lit("2026-05-22 12:00:00").cast("timestamp")
    run = pipeline.board_run(lists, details, known, cache, apps, now, F.lit(dt.date(2026, 4, 22)))
    got = {r.seq: r.outcome for r in run.decided.collect()}
    assert got == {"9": "detail", "8": "detail", "7": "skipped_known", "6": "detail", "5": "skipped_old", "4": "detail"}
    assert sorted(r.seq for r in run.candidates.collect()) == ["4", "9"]
    assert [r.seq for r in run.refused.collect()] == ["6"]
    assert [(r.seq, r.category) for r in run.rejected.collect()] == [("8", "rejected")]


def test_extract_then_approve(spark):
    texts = spark.createDataFrame([
        (1, 10, "notice_pdf", "pdf_text", "object://a", "공실 정보 들꽃 101 호 25 ㎡ 40 ㎡ 1 룸 90,000 2,100 들꽃 102 호 25 ㎡ 40 ㎡ 1 룸 90,000 2,100 임대 기간 신청기간 : 2026.5.1 ~ 2026.5.9"),
        (1, 11, "application_form", "pdf_text", "object://b", "공실 정보 들꽃 103 호 25 ㎡ 40 ㎡ 1 룸 90,000 2,100 신청기간 : 2026.5.1 ~ 2026.5.9")],
        "notice_id long, attachment_id long, kind string, artifact_type string, source_span string, raw_text string")
    sheet = spark.createDataFrame([(1, 12, "s", 1, ["호수", "전용면적", "보증금", "월임대료"], "object://c#row=1"), (1, 12, "s", 2, ["201", "30.5", "1,000", "20"], "object://c#row=2")],
                                  "notice_id long, attachment_id long, sheet string, row_no int, cells array<string>, source_span string")
    found = pipeline.extract_attachments(texts, sheet)
    assert found.schedules.count() == 1
    rows = found.offerings.withColumn("id", F.xxhash64("source_span")).withColumn("source", F.lit("board")).withColumn("source_artifact_id", F.lit(1).cast("bigint"))
    notices = spark.createDataFrame([(1, "recruitment")], "id long, category string")
    served = serve.offerings(quality.promote(rows, notices))
    assert sorted(r.unit_no for r in served.collect()) == ["101호", "102호", "201"]


def test_api_run(spark):
    item = '{"pblancId":"P%d","houseSn":1,"suplyInsttNm":"%s","hsmpNm":"단지","suplyTyNm":"매입임대","pcUrl":"http://d","sumSuplyCo":%d}'
    body = '{"response":{"header":{"resultCode":"00"},"body":{"totalCount":3,"item":[' + ",".join([item % (1, "LH", 0), item % (2, "lh ", 5), item % (3, "X", 5)]) + "]}}}"
    responses = spark.createDataFrame([(1, body), (2, "oops")], "page int, body string")
    details = spark.createDataFrame([("P1:1", "<table><tr><th>공급호수</th><td>총 7호</td></tr><tr><th>임대조건</th><td>- 임대보증금 : 5만원 - 월임대료 : 1만원</td></tr></table>"),
                                     ("P2:1", "<a href=\"javascript:fnDownFile('77','1')\">공고문.pdf</a>")], "item_seq string, html string")
    files = spark.createDataFrame([("P1:1", "임대조건\n보증금\n월 임대료\n5,000\n70,000\n5,000\n70,000"), ("P2:1", "임대조건\n보증금\n월 임대료\n5,000\n70,000\n5,000\n70,000")], "item_seq string, raw_text string")
    run = pipeline.api_run(responses, details, files, "rsdt", "LH")
    got = {r.item_seq: (r.supply_count, r.deposit_text, r.monthly_rent_text, r.deposit_krw) for r in run.offerings.collect()}
    assert got == {"P1:1": (7, "임대보증금 : 5만원", "월임대료 : 1만원", None), "P2:1": (5, "5,000원", "70,000원", 5000)}
    assert run.bad_pages.count() == 1 and run.schedules.count() == 0
