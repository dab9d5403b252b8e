import datetime as dt

from pyspark.sql import functions as F

from noticeloom.sources import api, pages
from noticeloom.operators import offerings
from noticeloom.functions import text as T


def frame(spark, html):
    return spark.createDataFrame([(1, html)], "page int, html string")


def test_list_rows(spark):
    html = """<table id='listTb'><thead><tr><th>no</th></tr></thead><tbody>
      <tr><td>2</td><td><a href="#" onclick="getDetailView('123')">NEW 모집  공고 &amp; 안내</a></td><td>임대팀</td><td>2026-05-01</td><td>1,234</td></tr>
      <tr><td>1</td><td><a href="javascript:getDetailView(77)">결과<span class="icoNew"></span></a></td><td></td><td>-</td><td>x</td></tr>
      <tr><td colspan="5">none</td></tr></tbody></table>"""
    got = [tuple(r) for r in pages.list_rows(frame(spark, html)).orderBy("position").select("seq", "title", "department", "posted_at", "view_count", "is_new").collect()]
    assert got == [("123", "모집 공고 & 안내", "임대팀", dt.date(2026, 5, 1), 1234, True), ("77", "결과", "", None, 0, True)]


def test_detail_and_attachments(spark):
    html = """<table class="detailTable"><caption>본문 제목</caption><tr><th>작성일</th><td>2026-05-02</td></tr></table><ul><li>조회수 : 1,005</li></ul>
      <div class="cont">첫줄<br>둘째</div><script>initParam.downList = [{"brdId":"b","seq":"9","fileSeq":"1","filename":"a.pdf"},{"brdId":"b","seq":"9","fileSeq":"2","oriFileNm":"b.hwp"}];</script>
      <a href="/htmlConverter.do?brd_id=b&seq=9&file_seq=2">미리보기</a>"""
    r = pages.detail_fields(frame(spark, html)).first()
    assert (r.title, r.body_text, r.view_count, r.posted_at) == ("본문 제목", "첫줄 둘째", 1005, dt.date(2026, 5, 2))
    files = pages.attachments_with_previews(frame(spark, html)).orderBy("position").collect()
    assert [(f.fileSeq, f.preview_path) for f in files] == [("1", ""), ("2", "/htmlConverter.do?brd_id=b&seq=9&file_seq=2")]


def test_visible_text(spark):
    r = pages.visible_text_artifacts(frame(spark, "<p>가<script>x<y</script> 나</p><!-- z --><style>p{}</style><noscript>n</noscript>")).first()
    assert (r.raw_text, r.chars) == ("가 나", 3)


def test_api_to_offering_and_schedule(spark):
    body = '{"response":{"header":{"resultCode":"00"},"body":{"totalCount":"1","item":{"pblancId":"P1","houseSn":2,"hsmpNm":"푸른","suplyTyNm":"국민임대","suplyHoCo":"총 12호","rentGtn":"1,000","mtRntchrg":0,"beginDe":"20260501","endDe":""}}}}'
    bad = '{"response":{"header":{"resultCode":"30","resultMsg":"key"},"body":{}}}'
    df = spark.createDataFrame([(1, body), (2, bad), (3, "<xml/>")], "page int, body string")
    parsed = api.parse_pages(df)
    assert sorted(r.page for r in api.bad_pages(parsed).collect()) == [2, 3]
    items = api.project_items(api.page_items(parsed, ["page"]), ["page"])
    span = T.api_span(F.lit("rsdt"), "item_seq")
    o = offerings.item_offerings(items, ["page"], span).first()
    assert (o.application_unit_label, o.list_no, o.deposit_krw, o.monthly_rent_krw, o.supply_count, o.source_span) == ("푸른 국민임대 12호", "2", 1000, None, 12, "myhome://rsdt/P1/2")
    s = offerings.item_schedules(items, ["page"], span).first()
    assert s.ends_at is None and s.date_text == "20260501~" and s.source_span.endswith("#schedule=application")


def test_page_expectations(spark):
    f = lambda *a: spark.range(1).select(F.lit(api.expected_pages(*a))).first()[0]
    L = lambda n: F.lit(n).cast("bigint")
    assert [f(L(401), L(200), True, 1), f(L(0), L(200), True, 4), f(L(401), L(200), False, 0)] == [3, 4, 1]


def test_nested_open_and_commented_markup(spark):
    html = """<!-- <table id='listTb'><tr><td>no</td></tr></table> --><table id=listTb><thead><tr><td>1<td>2<td>3<td>4<td>5</thead>
      <tr><td>2<td><a onclick="getDetailView('5')">a&middot;&#44032;<table><tr><td>in</td></tr></table></a><td>t<td>2026-05-01<td>7
      <tr><td>1</td><td><div><a href="x">first</a><a onclick=getDetailView(9)>second</a></div></td><td></td><td></td><td></td></tr></table>"""
    got = [tuple(r) for r in pages.list_rows(frame(spark, html)).select("seq", "title", "department", "view_count").collect()]
    assert got == [("5", "a·가in", "in", 0)]  # cells of a table inside a cell count as cells of the outer row too
    detail = """<!--<div class=cont>x</div>--><section class="view cont">one<div>two<div>three</div></div> four &copy; &#x41;</section><div class=cont>other</div>
      <ul><li>조회수 : 3<li>등록일 : 2026-05-02</ul><div class="detailTable"><table><caption>Cap<tr><th>작성자<td>x</table></div>"""
    r = pages.detail_fields(frame(spark, detail)).first()
    assert (r.title, r.body_text, r.view_count, r.posted_at) == ("Cap", "onetwothree four © A", 3, dt.date(2026, 5, 2))


def test_application_link_and_file_links(spark):
    row = "<tr><td>1<td><a onclick='other()'>x</a><a onclick=\"userSsnCheck('C','N','01','R','Y','','')\">&lt;Title&gt;</a><td>1,200<td>2026-05-01<td>청약중"
    r = pages.application_rows(frame(spark, f"<table>{row}</table>")).first()
    assert (r.recruit_code, r.title, r.supply_count, r.posted_at) == ("C", "<Title>", 1200, dt.date(2026, 5, 1))
    html = """<a onclick="fnDownFile('A','1')">no</a><a href="javascript:fnDownFile('B', '2')">b.pdf</a><table><tr><th>임대기간<td>3년<tr><th>임대기간<td><div>4<div>년</div></div></table>"""
    got = pages.label_value_columns(frame(spark, html)).first()
    assert [(f.file_id, f.file_sn, f.filename) for f in got.notice_files] == [("B", "2", "b.pdf")] and got.lease_period_text == "4년"


def parse(html, *fields):
    from noticeloom.sources.markup import FIELDS, PageParser

    parser = PageParser("cont", "detailTable", "icoNew")
    parser.feed(html)
    return parser.result(fields or tuple(FIELDS))


def test_implied_ends_as_browsers_have_them():
    assert parse("<p class=cont>a<p>b")["body"] == "a" and parse("<p class=cont>a<b>x</b><div>b</div>")["body"] == "ax"
    assert [(k["href"], k["text"]) for k in parse("<a href=1>a<a href=2>b</a>c</a>")["links"]] == [("1", "a"), ("2", "b")]
    assert parse("<dl><dt>a<dd class=cont>b<dt>c</dl>")["body"] == "b" and parse("<select><option class=cont>a<option>b</select>")["body"] == "a"
    assert parse("<ul><li>a<ul><li>b</ul>c<li>d</ul>")["items"] == ["abc", "b", "d"]
    page = parse("<table id=t><tr><td>1<p>x<td>2</div></span><tr><td><a href=k>3<table><tr><th>h<td>4</table>5</a></table>6</td>")
    assert [[c["text"] for c in r["cells"]] for r in page["rows"]] == [["1x", "2"], ["3h45", "4"], ["4"]] and page["rows"][1]["heads"] == ["h"]
    assert page["rows"][2]["tables"] == ["t", ""] and page["links"][0]["text"] == "3h45" and page["last_cell"] == "4"
    assert parse("", "rows", "visible") == {"rows": [], "visible": ""}


def test_open_elements_cost_no_search():
    import time

    pages = ["<p>x" * 20_000, "<a>x" * 20_000, "<div>x" * 20_000 + "</b></td></tr>" * 20_000, "<table><tr>" + "<td><span>x" * 20_000, "<li>x" * 20_000,
             "<table><tr><td>" + "<span>" * 20_000 + "</div></section></li>" * 20_000]
    for page in pages:
        best = []
        for _ in range(3):
            start = time.process_time()
            parse(page)
            best.append(time.process_time() - start)
        assert min(best) < 2  # a search through open elements takes minutes


def test_preview_links_come_from_elements(spark):
    html = """<!-- <a href="/htmlConverter.do?brd_id=b&seq=9&file_seq=1">no</a> --><script>initParam.downList = [{"brdId":"b","seq":"9","fileSeq":"1","filename":"a.pdf"},{"brdId":"b","seq":"9","fileSeq":"2","filename":"b.pdf"}];</script>
      <a title='x>y' href='/htmlConverter.do?brd_id=b&amp;seq=9&#38;file_seq=2'>view</a>"""
    files = pages.attachments_with_previews(frame(spark, html)).orderBy("position").collect()
    assert [(f.fileSeq, f.preview_path) for f in files] == [("1", ""), ("2", "/htmlConverter.do?brd_id=b&seq=9&file_seq=2")]


def test_tokens_of_all_kinds():
    page = parse("""<!DOCTYPE html><?x y><!-- <td> --><TITLE>a &lt; b <td></title><script>if (a</b>&amp;&&"</script >x<style>p > q</style>
      <table ID=listTb class='x detailTable'><tr><td><a HREF="?a=1&amp;b=2" href=no onclick='f("x>y")' data-x=it's>l&eacute;k</a> 1 < 2 </ ><br/>3<div/>4<td nowrap>5</table><textarea>&amp;<b></textarea><a href=k""")
    assert page["visible"].split() == ["a", "<", "b", "<td>x", "lék", "1", "<", "2", "345&<b>"]
    assert page["rows"] == [{"tables": ["listTb"], "in_body": True, "heads": [], "cells": [
        {"text": "lék 1 < 2 34", "links": [{"href": "?a=1&b=2", "onclick": 'f("x>y")', "text": "lék", "marked": False}]}, {"text": "5", "links": []}]}]
    assert [k["href"] for k in page["links"]] == ["?a=1&b=2", "k"]


def test_rows_of_texts_and_links_are_read_with_one_pattern(monkeypatch):
    """Equal to reading them tag by tag, whatever stands around and inside them; their elements are not opened one by one."""
    import random
    import re

    from noticeloom.sources import markup

    row = ["<tr>", "<td>", "t", "</td>", "<td>", "<a href=1>", "l", "</a>", "x", "</td>", "<th>", "h", "</th>", " ", "</tr>"]
    odd = ["<table id=t>", "<table class=detailTable>", "</table>", "<TR x='1'>", "</tr >", "<td class='t'>", "<td class=cont>", "<td class='&#99;ont'>", "<td/>", "<td nowrap x=a/b>", "</TD\n>",
           "<th class=icoNew>", "<a href=\"x?a=1&amp;b\" onclick='f(1)'>", "<a x=\"y>z\">", "<a q'r=\"s'>", "<a>", "</a>", "<thead>", "</thead>", "<tbody>", "<caption>", "</caption>", "<p>",
           "<li>", "<noscript>", "</noscript>", "<script>", "</script>", "<br>", "<span class=icoNew>", "</span>", "a &lt; b", "1 < 2", "\"", "'", "<!-- x -->", "\n"]
    rng, plain, hits = random.Random(7), markup._ROW, 0
    for _ in range(1500):
        parts = []
        for _ in range(rng.randrange(1, 8)):
            part = list(row) if rng.random() < 0.6 else rng.sample(odd, rng.randrange(1, 5))
            for _ in range(rng.choice([0, 0, 1, 2])):
                part[rng.randrange(len(part))] = rng.choice(odd + row)
            parts += part
        html = "".join(parts)
        monkeypatch.setattr(markup, "_ROW", plain)
        fast, hits = parse(html), hits + bool(plain.search(html))
        monkeypatch.setattr(markup, "_ROW", re.compile("(?!)"))
        assert fast == parse(html), html
    assert hits > 500
    opened, start = [], markup.PageParser._start
    monkeypatch.setattr(markup, "_ROW", plain)
    monkeypatch.setattr(markup.PageParser, "_start", lambda self, tag, attributes: opened.append(tag) or start(self, tag, attributes))
    assert len(parse("<table>" + "".join(row) * 50 + "</table>")["rows"]) == 50 and opened == ["table"]
    open_rows = "<table>" + "<tr><td>x" * 20_000
    assert len(parse(open_rows)["rows"]) == 20_000


def test_application_rows_of_other_shapes(spark):
    call = lambda *a: "<a onclick=\"userSsnCheck(" + ",".join(f"'{x}'" for x in a) + ")\">  link\n text </a>"
    row = lambda link, *more: f"<tr><td>1</td><td>{link}</td>" + "".join(f"<td>{x}</td>" for x in more) + "</tr>"
    html = "<table>" + row(call("A", "N", " ", "R", "Y", "", " \u3000"), "1,200", "2026-05-01", " [청약중] ") + row(call("A", "N"), "1", "-", "청약중") + row("x", "1") + row("x", "1", "-", "청약중") \
        + row(call("B", "N", "04 ", "R", "Y", "", " t  u "), "x", "-", "접수예정") + row(call("C", "N", "04", "R", "Y", "", "t"), "1", "-", "마감") + "</table>"
    rows = pages.application_rows(spark.createDataFrame([(1, html, " 09 "), (2, None, "")], "page int, html string, own string"), page_key=("page",), supply_type="own").orderBy("position")
    got = [tuple(r) for r in rows.select("position", "recruit_code", "supply_type", "title", "supply_count", "posted_at", "status").collect()]
    assert got == [(0, "A", "09", "link text", 1200, dt.date(2026, 5, 1), "청약중"), (4, "B", "04", "t  u", None, None, "접수예정")]
