"""Landed HTML pages to rows: list rows, detail fields, embedded JSON, links, status lists.

One page is one row, so all of this is per-row work without a shuffle. ``markup`` parses
pages to nested columns in Arrow batches; the rules are expressions over these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import text as T
from noticeloom.operators.dedupe import first_row
from noticeloom.operators.staging import explode_rows, hold
from noticeloom.sources import markup


def elements(c, tag: str) -> Column:
    """Inner markup of every such element."""
    return F.regexp_extract_all(T._col(c), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))


def attribute(c, name: str) -> Column:
    """Value of an attribute in the first tag of a fragment that has it."""
    double = F.regexp_extract(T._col(c), rf'(?is)\b{name}\s*=\s*"([^"]*)"', 1)
    single = F.regexp_extract(T._col(c), rf"(?is)\b{name}\s*=\s*'([^']*)'", 1)
    return T.unescape(T.first_non_empty(double, single))


def first_of(array: Column) -> Column:
    return F.coalesce(F.get(array, F.lit(0)), F.lit(""))


def with_page(pages: DataFrame, html: str, *fields: str, body_class: str = fixed.BODY_CLASS) -> DataFrame:
    """The page columns without the markup, and the wanted fields of the parsed page as ``_p``."""
    keep = [c for c in pages.columns if c != html]
    return hold(pages, _p=markup.parsed(T._col(html), body_class, fixed.DETAIL_TABLE_CLASS, fields)).select(*keep, "_p")


def list_rows(pages: DataFrame, html: str = "html", table_id: str | None = fixed.LIST_TABLE_ID, min_cells: int = 5,
              seq_pattern: str = fixed.SEQ_LINK) -> DataFrame:
    """One row per listed notice, with its position on the page.

    Rows of the body of the table with that id count, also of tables inside it. Rows with
    too few cells or without a sequence number are dropped. All other page columns are kept.
    """
    keep = [c for c in pages.columns if c != html]
    inside = F.filter("_p.rows", lambda r: r["in_body"] & F.array_contains(r["tables"], table_id)) if table_id else F.col("_p.rows")
    rows = explode_rows(with_page(pages, html, "rows"), keep, inside, "position", "_row").where(F.size("_row.cells") >= min_cells)
    cell = lambda i: F.coalesce(T.collapse_ws(F.col("_row.cells")[i]["text"]), F.lit(""))
    cells = rows.withColumn("_link", F.get(F.col("_row.cells")[1]["links"], F.lit(0)))
    link_text = F.coalesce("_link.text", F.lit(""))
    seq = F.coalesce(T.first_non_empty(F.regexp_extract("_link.onclick", seq_pattern, 1), F.regexp_extract("_link.href", seq_pattern, 1)), F.lit(""))
    return (
        hold(cells, seq=seq).where(F.col("seq") != "").select(
            *keep, "position", "seq",
            T.strip_marker(T.collapse_ws(link_text)).alias("title"),
            cell(2).alias("department"),
            F.to_date(F.try_to_timestamp(cell(3), F.lit("yyyy-MM-dd"))).alias("posted_at"),
            F.coalesce(F.replace(cell(4), F.lit(","), F.lit("")).try_cast("int"), F.lit(0)).alias("view_count"),
            (F.col("_link.marked") | link_text.contains("NEW")).alias("is_new")))


def labelled_value(label: str) -> Column:
    """Text of the first cell in the first table row headed by the label."""
    rows = F.filter("_p.rows", lambda r: F.exists(r["heads"], lambda h: T.collapse_ws(h) == label))
    return F.coalesce(T.collapse_ws(F.get(F.get(rows, F.lit(0))["cells"], F.lit(0))["text"]), F.lit(""))


def inline_value(label: str) -> Column:
    """Value of the first list item written as ``label: value``."""
    marks = tuple(label + colon for colon in (" :", ":", "："))
    items = F.transform("_p.items", T.collapse_ws)

    def starts(item):
        hit = F.lit(False)
        for mark in marks:
            hit = hit | item.startswith(mark)
        return hit

    return F.trim(F.regexp_replace(first_of(F.filter(items, starts)), rf"^{label} ?[:：]", ""))


def detail_fields(pages: DataFrame, html: str = "html", title_label: str = fixed.LABEL_TITLE,
                  views_label: str = fixed.LABEL_VIEWS, posted_label: str = fixed.LABEL_POSTED,
                  posted_inline: str = fixed.LABEL_POSTED_INLINE, body_class: str = fixed.BODY_CLASS) -> DataFrame:
    """Title by five-step fallback, body, views and posted date of a detail page."""
    keep = [c for c in pages.columns if c != html]
    broken = pages.select(*keep, T.normalize_breaks(html).alias(html))
    page = with_page(broken, html, "rows", "items", "body", "table_caption", "table_head", "caption", "head", "last_cell", body_class=body_class)
    clean = lambda c: F.coalesce(T.collapse_ws(c), F.lit(""))
    title = T.first_non_empty(labelled_value(title_label), clean("_p.table_caption"), clean("_p.table_head"), clean("_p.caption"), clean("_p.head"))
    body = T.first_non_empty(clean("_p.body"), clean("_p.last_cell"))
    views = T.first_non_empty(labelled_value(views_label), inline_value(views_label))
    posted = T.first_non_empty(labelled_value(posted_label), inline_value(posted_inline))
    return page.select(
        *keep, title.alias("title"), body.alias("body_text"),
        F.coalesce(F.replace(views, F.lit(","), F.lit("")).try_cast("int"), F.lit(0)).alias("view_count"),
        F.to_date(F.try_to_timestamp(posted, F.lit("yyyy-MM-dd"))).alias("posted_at"))


def embedded_rows(pages: DataFrame, html: str = "html", pattern: str = fixed.PAGE_JSON_ARRAY,
                  schema: str = fixed.ATTACHMENT_SCHEMA) -> DataFrame:
    """Rows of a JSON array that a page script assigns; malformed arrays give none."""
    keep = [c for c in pages.columns if c != html]
    array = F.from_json(F.regexp_extract(T._col(html), pattern, 1), schema)
    return explode_rows(pages, keep, array, "position", "_item").select(*keep, "position", "_item.*")


def preview_links(links: Column) -> Column:
    """Preview links among the links of a parsed page: array of (brd_id, seq, file_seq, href)."""
    hrefs = F.filter(F.transform(links, lambda a: a["href"]), lambda h: h.contains(fixed.PREVIEW_PATH) & h.rlike(fixed.PREVIEW_LINK))
    part = lambda h, i: F.regexp_extract(h, fixed.PREVIEW_LINK, i)
    return F.transform(hrefs, lambda h: F.struct(part(h, 1).alias("brd_id"), part(h, 2).alias("seq"),
                                                 part(h, 3).alias("file_seq"), h.alias("href")))


def attachments_with_previews(pages: DataFrame, html: str = "html") -> DataFrame:
    """Attachment rows of a page with the preview link that carries their key."""
    marked = with_page(pages.withColumn("_html", F.col(html)), html, "links").withColumn("_links", preview_links(F.col("_p.links"))).drop("_p")
    rows = embedded_rows(marked, "_html")
    hit = F.filter("_links", lambda k: (k["brd_id"] == F.col("brdId")) & (k["seq"] == F.col("seq"))
                   & (k["file_seq"] == F.col("fileSeq")))
    return rows.withColumn("preview_path", F.coalesce(F.get(F.reverse(hit), F.lit(0))["href"], F.lit(""))).drop("_links")


def call_arguments(call, name_pattern: str = fixed.APPLICATION_CALL) -> Column:
    """Argument list of a script call; commas inside quotes do not separate."""
    raw = F.regexp_extract(T._col(call), name_pattern, 1)
    parts = F.regexp_extract_all(F.concat(raw, F.lit(",")), F.lit(r"((?:[^,']|'[^']*')*),"), F.lit(1))
    return F.when(T._col(call).rlike(name_pattern), F.transform(parts, lambda p: T.trim_ws(F.replace(p, F.lit("'"), F.lit("")))))


def application_rows(pages: DataFrame, html: str = "html", page_key: tuple[str, ...] = (),
                     supply_type: str | None = None) -> DataFrame:
    """Application-status rows; the first row per (code, status) on a page is kept."""
    keep = [c for c in pages.columns if c != html]
    rows = explode_rows(with_page(pages, html, "cells"), keep, F.col("_p.cells"), "position", "_row").where(F.size("_row.cells") >= 5)
    cell = lambda i: F.coalesce(T.collapse_ws(F.get("_row.cells", F.lit(i))["text"]), F.lit(""))
    calls = F.filter(F.col("_row.cells")[1]["links"], lambda k: k["onclick"].contains(fixed.APPLICATION_CALL.split("\\")[0]))
    rows = rows.withColumn("_link", F.get(calls, F.lit(0)))
    rows = hold(rows, _args=call_arguments("_link.onclick"), _status=cell(4)).where(F.size("_args") >= 7)
    status_text = F.col("_status")
    arg = lambda i: F.element_at("_args", i)
    out = rows.select(  # arguments and collapsed texts have no white space at their ends
        *keep, "position", arg(1).alias("recruit_code"),
        T.first_non_empty(arg(3), T.trim_ws(supply_type) if supply_type else F.lit("")).alias("supply_type"),
        arg(4).alias("recruit_type"), arg(5).alias("no_house_flag"), arg(6).alias("region_priority"),
        F.coalesce(F.nullif(arg(7), F.lit("")), T.collapse_ws("_link.text"), F.lit("")).alias("title"),
        F.replace(cell(2), F.lit(","), F.lit("")).try_cast("int").alias("supply_count"),
        F.to_date(F.try_to_timestamp(cell(3), F.lit("yyyy-MM-dd"))).alias("posted_at"),
        F.when(status_text.contains(fixed.APP_OPEN), fixed.APP_OPEN)
        .when(status_text.contains(fixed.APP_PENDING), fixed.APP_PENDING).alias("status"),
    ).where(F.col("status").isNotNull() & (F.col("recruit_code") != ""))
    return first_row(out, [*page_key, "recruit_code", "status"], [F.col("position")])


def label_value_columns(pages: DataFrame, html: str = "html",
                        labels: tuple[tuple[str, str], ...] = fixed.DETAIL_LABELS) -> DataFrame:
    """Heading/cell pairs of a page as named columns; the last filled pair of a label wins.

    Also returns the file references found in links.
    """
    keep = [c for c in pages.columns if c != html]
    clean = lambda c: F.coalesce(T.collapse_ws(c), F.lit(""))
    pairs = F.filter(F.transform("_p.rows", lambda r: F.struct(clean(F.get(r["heads"], F.lit(0))).alias("label"), clean(F.get(r["cells"], F.lit(0))["text"]).alias("value"))),
                     lambda p: (p["label"] != "") & (p["value"] != ""))
    links = F.filter(F.transform("_p.links", lambda a: F.struct(
        F.regexp_extract(a["href"], fixed.NOTICE_FILE_CALL, 1).alias("file_id"), F.regexp_extract(a["href"], fixed.NOTICE_FILE_CALL, 2).alias("file_sn"),
        clean(a["text"]).alias("filename"))), lambda f: f["file_id"] != "")
    staged = hold(with_page(pages, html, "rows", "links"), _pairs=pairs, notice_files=links).select(*keep, "_pairs", "notice_files")
    value = lambda label: F.coalesce(F.get(F.reverse(F.filter("_pairs", lambda p: p["label"] == label)), F.lit(0))["value"],
                                     F.lit(""))
    return staged.select(*keep, *[value(label).alias(name) for name, label in labels], "notice_files")


def visible_text_artifacts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Visible text of each page and its length in characters."""
    keep = [c for c in pages.columns if c != html]
    return (hold(with_page(pages, html, "visible"), raw_text=F.coalesce(T.collapse_ws("_p.visible"), F.lit(""))).select(*keep, "raw_text")
            .withColumn("chars", F.length("raw_text").cast("bigint")))
