"""Artifacts to offerings: single-unit texts, table rows, API items, repair output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import numbers as N
from noticeloom.functions import text as T
from noticeloom.functions.dates import compact_date
from noticeloom.functions.payload import json_payload
from noticeloom.operators.staging import explode_rows, hold


def unit_text_offerings(artifacts: DataFrame, keep: list[str], text: str = "raw_text", span: str = "source_span",
                        marks=fixed.UNIT_TEXT_MARKS, form_marks=fixed.FORM_TEXT_MARKS,
                        unit_suffix: str = fixed.UNIT_SUFFIX, min_values: int = fixed.UNIT_TEXT_VALUES) -> DataFrame:
    """One offering per text that lists a single unit as one token per line.

    Two layouts: ordered markers around address and values, or an application
    form. The values stand between the third and the fourth marker; texts that lack
    one of these are not cut into tokens.
    """
    df = hold(artifacts.where(T.contains_all(text, (marks[2], marks[3]))), _t=T.tokens(text)).select(*keep, span, "_t")
    pos = lambda word: T.token_index(F.col("_t"), word)
    df = hold(df, _a=pos(marks[0]), _b=pos(marks[1]), _v=pos(marks[2]), _e=pos(marks[3]), _room=pos(form_marks[1]))
    df = df.where((F.col("_v") > 0) & (F.col("_e") - F.col("_v") > min_values))
    df = hold(df, _addr=T.last_token_before(F.col("_t"), form_marks[0], F.col("_room")),
              _values=T.slice_tokens(F.col("_t"), F.col("_v") + 1, F.col("_e")))
    has_suffix = F.get("_values", F.lit(1)) == unit_suffix
    df = hold(df, _unit=F.concat(F.get("_values", F.lit(0)), F.when(has_suffix, unit_suffix).otherwise("")),
              _off=F.when(has_suffix, 2).otherwise(0))
    first_layout = (F.col("_a") > 0) & (F.col("_a") < F.col("_b")) & (F.col("_b") < F.col("_v"))
    form_layout = (F.col("_addr") > 0) & (F.col("_room") > F.col("_addr"))
    listed = T.slice_tokens(F.col("_t"), F.col("_a") + 1, F.col("_b"))
    n = F.size(listed)
    ends_with_unit = (n >= 2) & (F.get(listed, n - 1) == unit_suffix) & (
        F.concat(F.get(listed, n - 2), F.lit(unit_suffix)) == F.col("_unit"))
    listed = F.when(ends_with_unit, F.slice(listed, F.lit(1), F.greatest(n - 2, F.lit(0)))).otherwise(listed)
    on_form = T.slice_tokens(F.col("_t"), F.col("_addr") + 1, F.col("_room"))
    df = hold(df.where(first_layout | form_layout), _street=F.when(first_layout, listed).otherwise(on_form))
    df = hold(df, address=T.assemble_address(F.col("_street")))
    value = lambda i: F.get("_values", F.col("_off") + i)
    df = df.where(F.size("_values") >= F.col("_off") + 6)
    area = N.first_float(value(2))
    return df.select(
        *keep, "address", T.district_of("address").alias("district"), F.col("_unit").alias("unit_no"),
        N.unit_label(F.lit(""), F.col("_unit"), area, F.lit(""), F.lit("")).alias("application_unit_label"),
        F.lit(1).alias("supply_count"), area.alias("exclusive_area_m2"), value(4).alias("deposit_text"),
        N.first_krw(value(4)).alias("deposit_krw"), value(5).alias("monthly_rent_text"),
        N.first_krw(value(5)).alias("monthly_rent_krw"), span,
        F.when(first_layout, "pdf_supply_housing_table").otherwise("pdf_application_form_table").alias("layout"),
        F.lit(fixed.CONF_TEXT_UNIT).alias("confidence"))


def table_row_offerings(rows: DataFrame, keep: list[str], content: str = "content", span: str = "source_span") -> DataFrame:
    """Table rows (text map) → offerings; the district defaults to the address's,
    a unit without a count counts as one."""
    get = lambda k: F.coalesce(F.try_element_at(F.col(content), F.lit(k)), F.lit(""))
    unit, area = get("unit_no"), N.first_float(get("exclusive_area_m2"))
    count = N.first_int(get("supply_count"))
    money = lambda k: N.money_with_unit(get(k), get("money_unit"))
    texts = ("supply_method", "supply_category", "list_no", "address", "housing_name", "deposit_text",
             "jeonse_deposit_text", "monthly_rent_text", "gender_requirement", "occupancy_type", "heating_method",
             "move_in_start_text")
    rows = hold(rows, _label=T.first_non_blank(get("application_unit_label"), N.unit_label(
        get("housing_name"), unit, area, get("application_category"), get("gender_requirement"))), _unit=unit, _count=count)
    rows = rows.where((F.col("_label") != "") | (F.col("_unit") != "") | F.col("_count").isNotNull())
    unit, count = F.col("_unit"), F.col("_count")
    return rows.select(
        *keep, F.col("_label").alias("application_unit_label"),
        get("application_category").alias("application_category"),
        F.when(get("district") != "", get("district")).otherwise(T.district_of(get("address"))).alias("district"),
        get("housing_name").alias("complex_name"), unit.alias("unit_no"), area.alias("exclusive_area_m2"),
        *[get(t).alias(t) for t in texts],
        N.first_krw(get("deposit_text")).alias("deposit_krw"), money("jeonse_deposit_text").alias("jeonse_deposit_krw"),
        money("contract_deposit_text").alias("contract_deposit_krw"),
        money("balance_payment_text").alias("balance_payment_krw"),
        N.first_krw(get("monthly_rent_text")).alias("monthly_rent_krw"),
        F.when(count.isNull() & (unit != ""), 1).otherwise(count).alias("supply_count"),
        N.first_int(get("reserved_count")).alias("reserved_count"),
        N.first_int(get("capacity_persons")).alias("capacity_persons"),
        N.first_krw(get("dormitory_fee_text")).alias("dormitory_fee_krw"),
        F.col(span).alias("source_span"), F.to_json(F.col(content)).alias("raw_row"), F.col("confidence"))


def item_offerings(items: DataFrame, keep: list[str], span: Column) -> DataFrame:
    """API items (after any enrichment) → offerings."""
    text_of = lambda c: F.col(c) if c in items.columns else F.lit("")
    extras = ("supply_count_text", "target_house_info_text", "support_limit_text", "rent_condition_text",
              "deposit_condition_text", "monthly_rent_condition_text", "lease_period_text")
    raw = json_payload(source=F.lit("myhome_api"), pblanc_id=F.col("notice_id"), house_sn=F.col("house_sn"),
                       detail_url=F.col("detail_url"), source_url=F.col("source_url"),
                       **{e: F.nullif(T.trim_ws(text_of(e)), F.lit("")) for e in extras},
                       interim_payment_krw=F.col("interim_payment_krw"))
    counted = F.when(F.col("supply_count") > 0, F.concat(F.col("supply_count").cast("string"), F.lit("호"))).otherwise("")
    return items.select(
        *keep, T.join_non_blank("complex_name", "supply_type", "house_type", counted).alias("application_unit_label"),
        F.col("supply_type").alias("supply_category"),
        F.when(F.col("house_sn") > 0, F.col("house_sn").cast("string")).otherwise("").alias("list_no"),
        T.join_non_blank("province", "city").alias("district"), "address", "legal_dong",
        F.col("complex_name").alias("housing_name"), "complex_name", F.col("house_type").alias("unit_type"),
        text_of("deposit_condition_text").alias("deposit_text"), "deposit_krw",
        F.col("contract_payment_krw").alias("contract_deposit_krw"),
        N.sum_known("interim_payment_krw", "balance_payment_krw").alias("balance_payment_krw"),
        text_of("monthly_rent_condition_text").alias("monthly_rent_text"), "monthly_rent_krw", "supply_count",
        "heating_method", span.alias("source_span"), raw.alias("raw_row"),
        F.lit(fixed.CONF_API_OFFERING).alias("confidence"))


def item_schedules(items: DataFrame, keep: list[str], span: Column, begin: str = "application_begin",
                   end: str = "application_end") -> DataFrame:
    """Application period of API items; one known bound is enough."""
    return items.select(
        *keep, F.lit("application").alias("schedule_type"), F.lit(fixed.APPLY_LABEL).alias("label"),
        compact_date(begin).alias("starts_at"), compact_date(end, end_of_day=True).alias("ends_at"),
        F.trim(F.concat(F.col(begin), F.lit("~"), F.col(end))).alias("date_text"), F.lit(fixed.API_SOURCE).alias("channel"),
        F.trim(F.concat_ws(" ", begin, end)).alias("source_text"), T.schedule_span(span).alias("source_span"),
        F.lit(fixed.CONF_API_SCHEDULE).alias("confidence"),
    ).where(F.col("starts_at").isNotNull() | F.col("ends_at").isNotNull())


def repair_offerings(outputs: DataFrame, keep: list[str], span: str = "source_span", items: str = "offerings") -> DataFrame:
    """Repair output → offerings.

    An item without a span takes the output's. Items that share a span get an
    ordinal suffix, counted over all items of the output, dropped ones included.
    All items of an output sit in one row, so the counting needs no shuffle.
    """
    own = lambda x: F.coalesce(F.nullif(T.trim_ws(x["source_span"]), F.lit("")), T.trim_ws(span))
    staged = hold(outputs.withColumn("_items", F.col(items)), _spans=F.transform(items, own))
    rows = explode_rows(staged, [*keep, "_spans"], "_items", "_at", "_i")
    rows = hold(rows, _span=F.get("_spans", F.col("_at")))
    same = lambda upto: F.size(F.filter(upto, lambda s: s == F.col("_span")))
    rows = hold(rows, _total=same(F.col("_spans")), _ord=same(F.slice("_spans", F.lit(1), F.col("_at") + 1)))
    final = F.when((F.col("_total") > 1) & (F.col("_span") != ""), T.item_span("_span", "_ord")).otherwise(F.col("_span"))
    text_of = lambda f: F.coalesce(T.trim_ws(F.col(f"_i.{f}")), F.lit(""))
    return rows.select(
        *keep, F.col("_at").alias("position"), text_of("application_unit_label").alias("application_unit_label"),
        text_of("housing_name").alias("housing_name"), text_of("unit_no").alias("unit_no"),
        *[F.col(f"_i.{f}").alias(f) for f in ("exclusive_area_m2", "supply_count", "deposit_krw", "monthly_rent_krw",
                                              "jeonse_deposit_krw", "dormitory_fee_krw")],
        text_of("gender_requirement").alias("gender_requirement"),
        F.coalesce(F.col("_i.source_page"), F.lit(0)).alias("source_page"), final.alias("source_span"),
        json_payload(source=F.lit("llm_repair"), raw_evidence=F.col("_i.raw_evidence")).alias("raw_row"),
        F.col("_i.confidence").alias("confidence"),
    ).where((F.col("application_unit_label") != "") & (F.col("source_span") != ""))


def route_by_kind(artifacts: DataFrame, kind: str, generators: dict) -> DataFrame:
    """Run for each attachment kind the generators meant for it and put the rows together.

    ``generators``: generator → attachment kinds.
    """
    parts = [make(artifacts.where(F.col(kind).isin(*kinds))) for make, kinds in generators.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
