"""API responses to items: envelope flattening, loose typing, page completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import numbers as N
from noticeloom.functions import text as T
from noticeloom.functions.payload import json_payload
from noticeloom.operators.staging import explode_rows, hold


def parse_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Add the envelope's result code, message, total count and items, and whether the page is bad.

    ``item`` may be an array, one object or null; the total may be text or a number.
    """
    v = F.try_parse_json(F.col(body))
    staged = hold(pages, _v=v)
    item = F.try_variant_get("_v", "$.response.body.item", "variant")
    kind = F.coalesce(F.schema_of_variant(item), F.lit("VOID"))
    none = F.array().cast("array<variant>")
    items = (F.when(kind.startswith("ARRAY"), F.try_variant_get("_v", "$.response.body.item", "array<variant>"))
             .when(kind.startswith("OBJECT"), F.array(item)).otherwise(none))
    code = F.coalesce(F.try_variant_get("_v", "$.response.header.resultCode", "string"), F.lit(""))
    return hold(
        staged, result_code=code, result_message=F.try_variant_get("_v", "$.response.header.resultMsg", "string"),
        total_count=F.coalesce(N.plain_long(F.try_variant_get("_v", "$.response.body.totalCount", "string")), F.lit(0).cast("bigint")),
        _items=F.coalesce(items, none), is_bad=F.col("_v").isNull() | ~code.isin("", fixed.API_OK_CODE)).drop("_v")


def bad_pages(parsed: DataFrame) -> DataFrame:
    """Side output: pages that did not parse or carry an error code."""
    return parsed.where("is_bad").drop("_items")


def page_items(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """One row per item of the good pages, with its position on the page."""
    return explode_rows(parsed.where(~F.col("is_bad")), keep, "_items", "position", "item")


def loose_text(item: Column, field: str) -> Column:
    """Text of a field that may be text or a number; ``''`` for anything else."""
    kind = F.schema_of_variant(F.try_variant_get(item, f"$.{field}", "variant"))
    value = F.try_variant_get(item, f"$.{field}", "string")
    number = F.regexp_replace(value, r"\.0+$", "")
    return F.coalesce(F.when(kind == "STRING", T.trim_ws(value))
                      .when(kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE", "FLOAT"), number), F.lit(""))


def loose_long(item: Column, field: str) -> Column:
    """Whole number of a field: numbers are cut, texts must be whole once commas are gone."""
    kind = F.schema_of_variant(F.try_variant_get(item, f"$.{field}", "variant"))
    value = F.try_variant_get(item, f"$.{field}", "string")
    return F.when(kind == "STRING", N.plain_long(T.trim_ws(value))).otherwise(value.try_cast("double").try_cast("bigint"))


def project_items(items: DataFrame, keep: list[str], item: str = "item", fields=fixed.API_FIELDS) -> DataFrame:
    """Typed columns of the items. Money is null unless positive; the supply count
    falls back to the count written in words."""
    v = F.col(item)
    readers = {
        "text": lambda f: loose_text(v, f),
        "int0": lambda f: F.coalesce(loose_long(v, f).try_cast("int"), F.lit(0)),
        "money": lambda f: N.positive(loose_long(v, f)),
    }
    out = items.select(*keep, v.alias("_item"), *[readers[how](field).alias(name) for name, field, how in fields])
    count = F.coalesce(N.positive(loose_long(F.col("_item"), fixed.API_SUM_COUNT_FIELD).try_cast("int")),
                       N.unit_count("supply_count_text"))
    return (out.withColumn("supply_count", count).withColumn("raw_json", F.to_json("_item")).drop("_item")
            .withColumn("item_seq", item_seq("notice_id", "house_sn")))


def item_seq(notice_id, house_sn) -> Column:
    notice_id, house_sn = T.trim_ws(notice_id), T._col(house_sn)
    return F.when(house_sn <= 0, notice_id).otherwise(F.concat(notice_id, F.lit(":"), house_sn.cast("string")))


def expected_pages(total: Column, page_rows: Column, all_pages: bool, requested: int) -> Column:
    """Pages to fetch: enough for the total, or the number asked for when that is unknown."""
    asked = max(requested, 1)
    if not all_pages:
        return F.lit(asked)
    known = (total > 0) & (page_rows > 0)
    return F.when(known, N.idiv(total + page_rows - 1, page_rows)).otherwise(F.lit(asked)).cast("int")


def missing_pages(landed: DataFrame, keys: list[str], page: str, total: str, page_rows: int,
                  all_pages: bool = True, requested: int = 1) -> DataFrame:
    """Pages that should have landed and did not."""
    wanted = (landed.groupBy(*keys).agg(F.max(total).alias("_total"))
              .select(*keys, F.explode(F.sequence(
                  F.lit(1), expected_pages(F.col("_total"), F.lit(page_rows), all_pages, requested))).alias(page)))
    have = landed.select(*keys, F.col(page).cast("int").alias(page)).distinct()
    return wanted.join(have, [*keys, page], "left_anti")


def item_artifacts(items: DataFrame, endpoint: str) -> DataFrame:
    """Evidence rows for API items."""
    return items.select(
        F.lit(fixed.ART_API_ITEM).alias("artifact_type"), F.lit(fixed.STATUS_EXTRACTED).alias("status"),
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"), F.col("title").alias("raw_text"),
        F.col("raw_json").alias("content_json"), T.api_span(F.lit(endpoint), "item_seq").alias("source_span"),
        F.lit(fixed.CONF_TEXT).alias("confidence"))


def detail_payload(detail_url="detail_url") -> Column:
    """Detail fields as JSON, blank ones left out."""
    blank = lambda c: F.nullif(T.trim_ws(c), F.lit(""))
    return json_payload(
        detail_url=F.col(detail_url), supply_count=F.col("supply_count"),
        **{name: blank(name) for name, _ in fixed.DETAIL_LABELS},
        deposit_condition_text=blank("deposit_condition_text"),
        monthly_rent_condition_text=blank("monthly_rent_condition_text"))


def detail_columns(labelled: DataFrame) -> DataFrame:
    """Derived columns of a structured detail page: count and the two rent conditions."""
    conditions = T.rent_conditions("rent_condition_text")
    return (labelled.withColumn("supply_count", N.unit_count("supply_count_text"))
            .withColumn("deposit_condition_text", conditions["deposit"])
            .withColumn("monthly_rent_condition_text", conditions["monthly"]))
