"""Landed HTML to nested columns, by a real parser.

Only the parsing is done here, in Arrow batches: rows with their cells and links, list
items, captions and texts, as far as a caller asks for them. Which of them mean what is
decided by expressions in ``pages``. Optional end tags are implied as browsers do, elements
may nest, comments are no text, and all character references are decoded.

Rows of which all cells hold nothing but text and links are most of what list pages have. They are read with one pattern
a row, to the same records, without opening and closing their elements one by one.

The work is linear in the page and in what comes out: open elements are counted per
border (table, cell, caption), so no tag searches the elements that stay open, and texts
are ranges of one joined text. Cells of tables inside cells count for every row around
them, so nested tables come out once per depth.
"""

from __future__ import annotations

import gc
import re
from collections import defaultdict
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_LINK = "struct<href:string,onclick:string,text:string,marked:boolean>"
_CELL = f"struct<text:string,links:array<{_LINK}>>"
_CALL_CELL = "struct<text:string,links:array<struct<onclick:string,text:string>>>"
FIELDS = {
    "rows": f"array<struct<tables:array<string>,in_body:boolean,heads:array<string>,cells:array<{_CELL}>>>", "cells": f"array<struct<cells:array<{_CALL_CELL}>>>",
    "items": "array<string>", "links": f"array<{_LINK}>",
    **dict.fromkeys(("body", "table_caption", "table_head", "caption", "head", "last_cell", "visible"), "string")}

_NAME, _REST = r"[a-zA-Z][^\s/>]*+", r"(?:[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+|[\s/=]++)*+"
#: Comment or declaration; end tag; start tag with its attributes. What is not closed ends with the page.
_TOKEN = re.compile(rf"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|</({_NAME})[^>]*+(?:>|\Z)|<({_NAME})({_REST})(?:>|\Z)|</[^a-zA-Z][^>]*+(?:>|\Z)", re.S)
#: Attributes as they are mostly written; then a row of which all cells hold text and links only: its cells, and the text after
#: them. No such match reaches beyond the next tag of another kind, so what is read twice is bounded.
_PLAIN = r"(?:\s++[\w-]++(?:\s*+=\s*+(?:\"[^\"<>]*+\"|'[^'<>]*+'|[^\s\"'<>=`/]++))?+)*+\s*+"
_INNER = rf"(?:[^<]++|<a{_PLAIN}>[^<]*+</a\s*+>)*+"
_ROW = re.compile(rf"<tr{_PLAIN}>((?:[^<]*+(?:<td{_PLAIN}>{_INNER}</td\s*+>|<th{_PLAIN}>{_INNER}</th\s*+>))*+)([^<]*+)</tr\s*+>", re.I)
_CELL_PARTS = re.compile(rf"([^<]*+)<t([dh]){_PLAIN}>({_INNER})</t[dh]\s*+>", re.I)
_INNER_PARTS = re.compile(rf"([^<]++)|<a({_PLAIN})>([^<]*+)</a\s*+>", re.I)
_ATTRIBUTE = re.compile(r"([^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
#: Elements whose content is text up to their end tag, and those of them in which references are decoded.
_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in ("script", "style", "textarea", "title")}
_DECODED = frozenset(("textarea", "title"))

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CELLS = frozenset(("td", "th"))
_SECTIONS = frozenset(("tbody", "thead", "tfoot"))
_HIDDEN = frozenset(("script", "style", "noscript"))
#: An end tag does not reach beyond these, unless it belongs to a table's structure.
_BORDERS = frozenset(("table", "td", "th", "caption"))
_STRUCTURE = _SECTIONS | {"tr", "table"}
_ROW_PARTS = _SECTIONS | {"tr", "colgroup"}
#: Items and the lists they belong to: an item ends the open item of its own list.
_LISTS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "ul": (), "ol": (), "dl": (), "select": ()}
#: Start tags before which an open paragraph ends.
_BLOCKS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Start tags that may end open elements.
_ENDING = _BLOCKS | _CELLS | _SECTIONS | {"tr"} | _LISTS.keys()


def _attributes(rest: str) -> dict[str, str]:
    attributes = {}
    for name, double, single, bare in _ATTRIBUTE.findall(rest) if rest else ():
        value = double or single or bare
        attributes.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return attributes


class _Open:
    __slots__ = ("tag", "scope", "begin", "spans", "link", "cited")

    def __init__(self, tag, scope, begin):
        self.tag, self.scope, self.begin, self.spans, self.link, self.cited = tag, scope, begin, [], None, False


class _Scope:
    """What is open between a border and the next one inside it."""

    __slots__ = ("at", "tag", "open", "lists", "anchor")

    def __init__(self, at, tag):
        self.at, self.tag, self.open, self.lists, self.anchor = at, tag, defaultdict(int), [], None


class PageParser:
    """Notes where records begin and end among the pieces of text; ``result`` cuts the texts."""

    def __init__(self, body_class: str, table_class: str, mark_class: str):
        self.body_class, self.table_class, self.mark_class = body_class, table_class, mark_class
        self.pieces, self.visible, self.stack, self.hidden = [], [], [], 0
        self.scopes = [_Scope(-1, "")]
        self.rows_open, self.cells_open, self.anchors_open, self.tables_open, self.parts_open = [], [], [], [], []
        self.heads_open = self.cited_open = 0
        self.rows, self.items, self.links, self.single = [], [], [], {}

    def feed(self, html: str) -> None:
        """Read a whole page."""
        at, search = 0, _TOKEN.search
        while token := search(html, at):
            if token.start() > at:
                self._data(html[at:token.start()])
            at = token.end()
            if token[2]:
                tag, rest = token[2].lower(), token[3]
                if tag == "tr" and (row := _ROW.match(html, token.start())) and not self._classed(row[0]):
                    self._row(row[1], row[2])
                    at = row.end()
                    continue
                self._start(tag, _attributes(rest))
                if rest.endswith("/") and tag not in _VOID:
                    self._end(tag)
                elif tag in _RAW:
                    end = _RAW[tag].search(html, at)
                    stop = end.start() if end else len(html)
                    if stop > at:
                        self._data(html[at:stop], tag in _DECODED)
                    at = stop
            elif token[1]:
                self._end(token[1].lower())
        if at < len(html):
            self._data(html[at:])

    def _classed(self, markup: str) -> bool:
        """Whether an element may be of a class that has a meaning."""
        return (self.body_class in markup or self.table_class in markup or self.mark_class in markup
                or "&" in markup and "class" in markup.lower())

    def _row(self, cells: str, tail: str) -> None:
        """A whole row of cells with text and links: the records and pieces that its elements would give one by one."""
        scope, pieces, links, outer = self.scopes[-1], self.pieces, self.links, self.cells_open
        if scope.open["tr"] or scope.tag in ("td", "th", "caption"):
            self._imply("tr")
        row, first = self._new_row(), len(pieces)
        rows = [*self.rows_open, row]
        for before, kind, inner in _CELL_PARTS.findall(cells):
            if before:
                pieces.append(unescape(before) if "&" in before else before)
            begin, own = len(pieces), []
            if "<" in inner:
                for text, rest, label in _INNER_PARTS.findall(inner):
                    if text:
                        pieces.append(unescape(text) if "&" in text else text)
                        continue
                    span, attributes = [len(pieces), None], _attributes(rest)
                    if label:
                        pieces.append(unescape(label) if "&" in label else label)
                    span[1] = len(pieces)
                    own.append({"href": attributes.get("href", ""), "onclick": attributes.get("onclick", ""), "text": span, "marked": False})
                links += own
                for cell in outer:
                    cell["links"] += own
            elif inner:
                pieces.append(unescape(inner) if "&" in inner else inner)
            if kind in "dD":
                cell = {"text": [begin, len(pieces)], "links": own}
                for r in rows:
                    r["cells"].append(cell)
            else:
                self._headed(rows, "th", begin, len(pieces))
        if tail:
            pieces.append(unescape(tail) if "&" in tail else tail)
        if not self.hidden:
            self.visible += pieces[first:]

    def _data(self, text: str, decoded: bool = True) -> None:
        text = unescape(text) if decoded and "&" in text else text
        self.pieces.append(text)
        if not self.hidden:
            self.visible.append(text)

    def _start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in _ENDING:
            self._imply(tag)
        classes = attributes["class"].split() if "class" in attributes else ()
        if self.mark_class in classes:
            for link in self.anchors_open:
                link["marked"] = True
        if tag in _VOID:
            return
        scope = self.scopes[-1]
        o = _Open(tag, scope, len(self.pieces))
        self._open_record(o, attributes, classes)
        scope.open[tag] += 1
        if tag in _LISTS:
            scope.lists.append(tag)
        self.stack.append(o)
        if tag in _BORDERS:
            self.scopes.append(_Scope(len(self.stack) - 1, tag))

    def _imply(self, tag):
        """Close what a start tag ends."""
        if tag in _BLOCKS and self.scopes[-1].open["p"]:
            self._close_to("p")
        if tag in _CELLS:
            while self.scopes[-1].tag in ("td", "th", "caption") and not self.scopes[-1].open["tr"]:
                self._close_down_to(self.scopes[-1].at)
        elif tag == "tr" or tag in _SECTIONS:
            ended = ("tr",) if tag == "tr" else _ROW_PARTS
            while True:
                scope = self.scopes[-1]
                if any(scope.open[t] for t in ended):
                    self._close_to(*ended)
                elif scope.tag in ("td", "th", "caption"):
                    self._close_down_to(scope.at)
                else:
                    break
        elif tag in _LISTS and (lists := self.scopes[-1].lists) and lists[-1] in _LISTS[tag]:
            self._close_to(lists[-1])

    def _open_record(self, o, attributes, classes):
        tag, span = o.tag, [o.begin, None]
        if classes:
            if self.body_class in classes and "body" not in self.single:
                self.single["body"] = span
                o.spans.append(span)
            if self.table_class in classes:
                o.cited = True
                self.cited_open += 1
        if tag == "tr":
            self.rows_open.append(self._new_row())
        elif tag == "td":
            cell = {"text": span, "links": []}
            for row in self.rows_open:
                row["cells"].append(cell)
            self.cells_open.append(cell)
            o.spans.append(span)
        elif tag == "a":
            self._end_anchor(o.scope)  # a link inside a link ends the outer one
            o.link = {"href": attributes.get("href", ""), "onclick": attributes.get("onclick", ""), "text": span, "marked": False}
            self.links.append(o.link)
            for cell in self.cells_open:
                cell["links"].append(o.link)
            self.anchors_open.append(o.link)
            o.scope.anchor = o.link
        elif tag == "li":
            self.items.append(span)
            o.spans.append(span)
        elif tag in _SECTIONS or tag == "table":
            self.parts_open.append(tag)
            self.heads_open += tag == "thead"
            if tag == "table":
                self.tables_open.append(attributes.get("id", ""))
        elif tag in _HIDDEN:
            self.hidden += 1

    def _new_row(self):
        row = {"tables": list(self.tables_open), "in_body": not self.parts_open or self.parts_open[-1] in ("tbody", "table"), "heads": [], "cells": []}
        self.rows.append(row)
        return row

    def _headed(self, rows, tag, begin, end):
        """Note a heading cell for the rows around it, and the first caption or head."""
        if tag == "th":
            for row in rows:
                row["heads"].append([begin, end])
        if tag == "caption" or self.heads_open:
            name = "caption" if tag == "caption" else "head"
            self.single.setdefault(name, [begin, end])
            if self.cited_open:
                self.single.setdefault(f"table_{name}", [begin, end])

    def _end(self, tag):
        if tag not in _STRUCTURE:
            if self.scopes[-1].open[tag]:
                self._close_to(tag)
            elif self.scopes[-1].tag == tag:
                self._close_down_to(self.scopes[-1].at)
            return
        for scope in reversed(self.scopes):  # cells and captions end with their row, section or table
            if scope.open[tag]:
                self._close_to(tag)
                return
            if scope.tag == "table":
                if tag == "table":
                    self._close_down_to(scope.at)
                return

    def _close_to(self, *tags):
        """Close down to the topmost element with one of the tags, which is known to be open."""
        i = len(self.stack) - 1
        while self.stack[i].tag not in tags:
            i -= 1
        self._close_down_to(i)

    def _close_down_to(self, i):
        while len(self.stack) > max(i, 0):
            self._close(self.stack.pop())

    def _end_anchor(self, scope):
        if scope.anchor is not None:
            scope.anchor["text"][1] = len(self.pieces)
            self.anchors_open.remove(scope.anchor)
            scope.anchor = None

    def _close(self, o):
        tag, end = o.tag, len(self.pieces)
        if tag in _BORDERS:
            self._end_anchor(self.scopes.pop())
        o.scope.open[tag] -= 1
        if tag in _LISTS:
            o.scope.lists.pop()
        self.cited_open -= o.cited
        for span in o.spans:
            span[1] = end
        if tag == "tr":
            self.rows_open.pop()
        elif tag == "td":
            self.cells_open.pop()
        elif tag == "a":
            if o.scope.anchor is o.link:
                self._end_anchor(o.scope)
        elif tag in _SECTIONS or tag == "table":
            self.parts_open.pop()
            self.heads_open -= tag == "thead"
            if tag == "table":
                self.tables_open.pop()
        elif tag in _HIDDEN:
            self.hidden -= 1
        elif tag in ("th", "caption"):
            self._headed(self.rows_open, tag, o.begin, end)

    def result(self, fields) -> dict:
        self._close_down_to(0)
        whole, at = "".join(self.pieces), [0, *accumulate(map(len, self.pieces))]
        cut = lambda span: whole[at[span[0]]:at[span[1]]] if span else None
        out = {name: cut(self.single.get(name)) for name in fields if FIELDS[name] == "string"}
        if not {"links", "rows", "cells"}.isdisjoint(fields):
            for link in self.links:
                link["text"] = cut(link["text"])
        if "links" in fields:
            out["links"] = self.links
        if "last_cell" in fields:
            out["last_cell"] = cut(next((row["cells"][-1]["text"] for row in reversed(self.rows) if row["cells"]), None))
        if "rows" in fields or "cells" in fields:
            cells = [[{"text": whole[at[(span := c["text"])[0]]:at[span[1]]], "links": c["links"]} for c in row["cells"]] for row in self.rows]
        if "rows" in fields:
            out["rows"] = [{**row, "heads": [whole[at[i]:at[j]] for i, j in row["heads"]], "cells": c} for row, c in zip(self.rows, cells)]
        if "cells" in fields:  # the rows for callers that need no more of them; the shape leaves out what links have besides
            out["cells"] = [{"cells": c} for c in cells]
        if "items" in fields:
            out["items"] = [cut(i) for i in self.items]
        if "visible" in fields:
            out["visible"] = "".join(self.visible)
        return out


def parsed(html: Column, body_class: str, table_class: str, fields: tuple[str, ...] = tuple(FIELDS), mark_class: str = "icoNew") -> Column:
    """The page as one struct with the wanted ``FIELDS``; null for null."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    shape = "struct<" + ",".join(f"{name}:{FIELDS[name]}" for name in fields) + ">"
    kind = to_arrow_type(_parse_datatype_string(shape))

    @F.arrow_udf(shape)
    def parse(pages: pa.Array) -> pa.Array:
        out, collects = [], gc.isenabled()
        gc.disable()  # pages make many records and no cycles
        try:
            for page in pages.to_pylist():
                if page is None:
                    out.append(None)
                    continue
                parser = PageParser(body_class, table_class, mark_class)
                parser.feed(page)
                out.append(parser.result(fields))
            return pa.array(out, kind)
        finally:
            if collects:
                gc.enable()

    return parse(html)
