"""JSON payloads, row maps and provenance hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeloom.functions.arrays import let
from noticeloom.functions.text import _col, trim_ws


def json_payload(**fields) -> Column:
    """JSON object of the non-null fields; ``{}`` when there are none."""
    return F.to_json(F.struct(*[_col(v).alias(k) for k, v in fields.items()]))


def blank_to_null(c) -> Column:
    return F.nullif(trim_ws(c), F.lit(""))


def json_or_empty(c) -> Column:
    return F.coalesce(F.nullif(trim_ws(c), F.lit("")), F.lit("{}"))


def json_field_is(payload, field: str, value: str) -> Column:
    return F.coalesce(F.get_json_object(_col(payload), f"$.{field}") == value, F.lit(False))


def row_map(labels: Column, cells: Column) -> Column:
    """Header label (or ``col_n``) → cell; a repeated label keeps the last cell."""
    pairs = F.transform(cells, lambda cell, i: F.struct(
        F.coalesce(F.nullif(trim_ws(F.get(labels, i)), F.lit("")),
                   F.concat(F.lit("col_"), (i + 1).cast("string"))).alias("key"), cell.alias("value"), i.alias("at")))

    def last_of_each(rows):
        repeated = lambda p: F.exists(rows, lambda q: (q["key"] == p["key"]) & (q["at"] > p["at"]))
        return F.transform(F.filter(rows, lambda p: ~repeated(p)), lambda p: F.struct(p["key"], p["value"]))

    return F.map_from_entries(let(pairs, last_of_each))


def response_text(payload) -> Column:
    """Text of a structured-output response: the direct field, else the first nested text."""
    v = F.try_parse_json(_col(payload))
    direct = F.try_variant_get(v, "$.output_text", "string")
    outputs = F.coalesce(F.try_variant_get(v, "$.output", "array<variant>"), F.array().cast("array<variant>"))
    nested = F.flatten(F.transform(outputs, lambda o: F.coalesce(
        F.try_variant_get(o, "$.content", "array<variant>"), F.array().cast("array<variant>"))))
    texts = F.filter(F.transform(nested, lambda c: F.try_variant_get(c, "$.text", "string")),
                     lambda t: t.isNotNull() & (trim_ws(t) != ""))
    return F.coalesce(F.when(trim_ws(direct) != "", direct), F.get(texts, F.lit(0)))


def provenance_hash(c) -> Column:
    return F.sha2(_col(c), 256)


def identity_key(c) -> Column:
    """Fixed-width key of a possibly long or missing text."""
    return F.md5(F.coalesce(_col(c), F.lit("")))
