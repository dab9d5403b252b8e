"""String functions as column expressions. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeloom import fixed


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def collapse_ws(c) -> Column:
    """Runs of any Unicode white space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(_col(c), fixed.WS + "+", " "))


def trim_ws(c) -> Column:
    """Trim Unicode white space (``F.trim`` removes plain spaces only)."""
    return F.regexp_replace(_col(c), f"^{fixed.WS}+|{fixed.WS}+$", "")


def is_blank(c) -> Column:
    return F.coalesce(trim_ws(c), F.lit("")) == ""


def strip_marker(c, marker: str = "NEW") -> Column:
    """Remove a marker word at the start or end of a cleaned title."""
    return F.trim(F.regexp_replace(collapse_ws(c), f"^{marker}|{marker}$", ""))


def _compact_dates(c: Column) -> Column:
    """``Y.M.D`` → ``Y.MM.DD`` so that both spellings of a date give one key."""
    padded_month = F.regexp_replace(c, r"(^|[^0-9])([0-9]{4})\.([0-9])\.", r"$1$2.0$3.")
    return F.regexp_replace(padded_month, r"([0-9]{4}\.[0-9]{2})\.([0-9])([^0-9]|$)", r"$1.0$2$3")


def title_key_plain(c) -> Column:
    """Title key that drops spaces, dots and parentheses only."""
    return F.translate(_compact_dates(F.lower(trim_ws(c))), " .()", "")


def title_key_strict(c) -> Column:
    """Title key that drops all white space, punctuation and symbols."""
    return F.regexp_replace(_compact_dates(F.lower(trim_ws(c))), r"[\s\p{P}\p{S}]+", "")


def title_hash(c) -> Column:
    return F.sha2(title_key_plain(c), 256)


def header_key(c) -> Column:
    return F.translate(trim_ws(c), " \n\t()[]", "")


def first_non_blank(*cols) -> Column:
    """First value that is not blank, trimmed; ``''`` when there is none."""
    return F.coalesce(*[F.nullif(trim_ws(c), F.lit("")) for c in cols], F.lit(""))


def first_non_empty(*cols) -> Column:
    """First value that is not ``''``, as it is."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cols], F.lit(""))


def join_non_blank(*cols, sep: str = " ") -> Column:
    parts = F.array(*[trim_ws(c) for c in cols])
    return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), sep)


def contains_any(c, words: Iterable[str]) -> Column:
    c = _col(c)
    found = F.lit(False)
    for word in words:
        found = found | c.contains(word)
    return F.coalesce(found, F.lit(False))


def contains_all(c, words: Iterable[str]) -> Column:
    c = _col(c)
    found = F.lit(True)
    for word in words:
        found = found & c.contains(word)
    return F.coalesce(found, F.lit(False))


def first_keyword(c, pairs: Iterable[tuple[str, str]], default: str = "") -> Column:
    """Value of the first word found, in the order given."""
    out = None
    for word, value in pairs:
        hit = _col(c).contains(word)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out.otherwise(F.lit(default))


def district_of(address, endings: Iterable[str] = fixed.DISTRICT_ENDINGS) -> Column:
    """First token of an address that ends like a district."""
    tokens = F.split(collapse_ws(address), " ")

    def ends(token):
        hit = F.lit(False)
        for ending in endings:
            hit = hit | token.endswith(ending)
        return hit

    return F.coalesce(F.get(F.filter(tokens, ends), F.lit(0)), F.lit(""))


def join_branch_roads(c, loose: bool = False) -> Column:
    """Glue a branch-road number to its road name."""
    if loose:
        return F.regexp_replace(collapse_ws(c), fixed.BRANCH_ROAD_LOOSE, r"$1$2길")
    return F.regexp_replace(_col(c), fixed.BRANCH_ROAD, r"$1$2")


def assemble_address(tokens: Column, glued: Iterable[str] = fixed.ADDRESS_GLUED,
                     spaced_after: Iterable[str] = fixed.ADDRESS_SPACED_AFTER) -> Column:
    """Join address tokens; a space goes in only where the neighbours call for one."""
    glued, spaced_after = tuple(glued), tuple(spaced_after)

    def piece(token, i):
        before = F.get(tokens, i - 1)
        spaced = before.rlike("[0-9]")
        for ending in spaced_after:
            spaced = spaced | before.endswith(ending)
        spaced = spaced & ~token.isin(*glued) & (i > 0)
        return F.concat(F.when(F.coalesce(spaced, F.lit(False)), " ").otherwise(""), token)

    return join_branch_roads(F.trim(F.array_join(F.transform(tokens, piece), "")))


def section_between(text, start: str, end: str = "") -> Column:
    """From the first ``start`` up to the next ``end``; without an end, the rest; ``''`` without a start."""
    text = _col(text)
    at = F.instr(text, start)
    section = F.substring(text, at, F.length(text))
    if end:
        stop = F.instr(section, end)
        section = F.when(stop > 1, F.substring(section, F.lit(1), stop - 1)).otherwise(section)
    return F.when(at > 0, section).otherwise(F.lit(""))


def tokens(text, trim_chars: str = fixed.TOKEN_TRIM) -> Column:
    """White-space tokens with bracket and colon characters trimmed, empties dropped."""
    raw = F.split(collapse_ws(text), " ")
    return F.filter(F.transform(raw, lambda t: F.btrim(t, F.lit(trim_chars))), lambda t: t != "")


def clean_token(c) -> Column:
    return F.btrim(_col(c), F.lit(fixed.CELL_TOKEN_TRIM))


def token_index(tokens_col: Column, word: str) -> Column:
    """1-based position of the first such token, 0 when absent."""
    return F.array_position(tokens_col, word).cast("int")


def last_token_before(tokens_col: Column, word: str, before: Column) -> Column:
    """1-based position of the nearest such token left of ``before``, 0 when absent."""
    head = F.reverse(F.slice(tokens_col, 1, F.greatest(before - 1, F.lit(0))))
    back = F.array_position(head, word).cast("int")
    return F.when((before > 0) & (back > 0), before - back).otherwise(F.lit(0))


def slice_tokens(tokens_col: Column, start: Column, stop: Column) -> Column:
    """Tokens at positions ``start`` .. ``stop - 1`` (1-based)."""
    safe = F.greatest(start, F.lit(1))
    return F.slice(tokens_col, safe, F.greatest(stop - safe, F.lit(0)))


# --- evidence spans
def object_span(key) -> Column:
    key = trim_ws(key)
    return F.when(key == "", F.lit("")).otherwise(F.concat(F.lit(fixed.OBJECT_SCHEME), key))


def sheet_span(object_key, sheet, row) -> Column:
    return F.concat(object_span(object_key), F.lit("#sheet="), F.url_encode(_col(sheet)), F.lit("&row="),
                    _col(row).cast("string"))


def table_span(span, table, row) -> Column:
    return F.concat(_col(span), F.lit("#table="), _col(table), F.lit("&row="), _col(row).cast("string"))


def schedule_span(span, kind: str = "application") -> Column:
    return F.concat(_col(span), F.lit(f"#schedule={kind}"))


def api_span(endpoint, item_seq) -> Column:
    return F.concat(F.lit(fixed.API_SCHEME), _col(endpoint), F.lit("/"), F.replace(_col(item_seq), F.lit(":"), F.lit("/")))


def item_span(span, ordinal) -> Column:
    """Suffix that keeps items of one repeated span apart."""
    joiner = F.when(_col(span).contains("#"), "&").otherwise("#")
    return F.concat(_col(span), joiner, F.lit("llm_item="), _col(ordinal).cast("string"))


def base_span(span, marker: str = "#schedule=") -> Column:
    return F.substring_index(_col(span), marker, 1)


# --- names, secrets, parameters


def sanitize_filename(name, fallback: str = "attachment.bin") -> Column:
    base = F.regexp_extract(trim_ws(name), r"([^/]*)/*$", 1)
    base = F.when((base == "") | (base == "."), F.lit(fallback)).otherwise(base)
    return F.left(F.regexp_replace(base, fixed.UNSAFE_KEY_CHARS, "_"), F.lit(fixed.FILENAME_MAX_CHARS))


def file_extension(name) -> Column:
    return F.lower(F.regexp_extract(trim_ws(name), r"\.([^./]*)$", 1))


def media_type(content_type) -> Column:
    """Media type without parameters, lowercased."""
    return F.lower(trim_ws(F.substring_index(_col(content_type), ";", 1)))


def redact(text, secret: Column) -> Column:
    """Hide a secret in its raw and its URL-encoded form."""
    secret = trim_ws(secret)
    mark = F.lit(fixed.REDACTION_MARK)
    hidden = F.replace(F.replace(_col(text), secret, mark), F.url_encode(secret), mark)
    return F.when(secret == "", _col(text)).otherwise(hidden)


def truncate_marked(c, limit: int = fixed.REPAIR_CHARS, mark: str = fixed.TRUNCATION_MARK) -> Column:
    c = _col(c)
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit(mark))).otherwise(c)


def split_csv(c) -> Column:
    return F.filter(F.transform(F.split(_col(c), ","), trim_ws), lambda x: x != "")


def canonical_name(c, names: Iterable[str]) -> Column:
    """Official spelling for a name written with other spacing."""
    text = collapse_ws(c)
    key = F.replace(text, F.lit(" "), F.lit(""))
    table = F.create_map(*[F.lit(x) for name in names for x in (name.replace(" ", ""), name)])
    return F.coalesce(F.get(F.array(F.try_element_at(table, key)), F.lit(0)), text)


def rent_conditions(c) -> Column:
    """Condition text → struct(deposit, monthly).

    Parts are separated by dashes. The last labelled part of each kind wins; a
    part that names both fills both, if no labelled part came before it.
    """
    parts = F.filter(
        F.transform(F.split(_col(c), "-"), lambda p: collapse_ws(F.ltrim(p, F.lit("•* ")))),
        lambda p: (p != "") & ~contains_any(p, fixed.REFERENCE_ONLY_PHRASES))

    def is_deposit(p):
        return p.startswith(fixed.LABEL_DEPOSIT)

    def is_rent(p):
        return p.startswith(fixed.LABEL_RENT[0]) | p.startswith(fixed.LABEL_RENT[1])

    def is_both(p):
        return contains_all(p, fixed.COMBINED_RENT_WORDS) | contains_any(p, fixed.COMBINED_RENT_PHRASES)

    leading = F.get(F.filter(parts, lambda p: is_deposit(p) | is_rent(p) | is_both(p)), F.lit(0))
    shared = F.when(~is_deposit(leading) & ~is_rent(leading), leading)
    last = lambda test: F.get(F.reverse(F.filter(parts, test)), F.lit(0))
    return F.struct(F.coalesce(last(is_deposit), shared, F.lit("")).alias("deposit"),
                    F.coalesce(last(lambda p: is_rent(p) & ~is_deposit(p)), shared, F.lit("")).alias("monthly"))


# --- markup
_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def unescape(c) -> Column:
    c = _col(c)
    for name, char in _ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def inner_text(c) -> Column:
    """Text of a markup fragment: tags dropped, common entities decoded, space collapsed."""
    return collapse_ws(unescape(F.regexp_replace(_col(c), r"<[^>]*>", "")))


def normalize_breaks(c) -> Column:
    return F.regexp_replace(_col(c), r"<(?:br|BR) ?/?>", " ")
