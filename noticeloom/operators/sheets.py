"""Sheet rows to offerings: header roles, headers carried down, merged rent cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import numbers as N
from noticeloom.functions import text as T
from noticeloom.functions.payload import row_map
from noticeloom.functions.arrays import let
from noticeloom.operators.dedupe import fill_down
from noticeloom.operators.staging import hold
from noticeloom.sources.artifacts import clean_cells


def header_role(cell: Column, roles=fixed.HEADER_ROLES) -> Column:
    """Role a header cell names, ``''`` for none; the first rule that fits wins."""
    return let(T.header_key(cell), lambda key: _role_of(key, roles))


def _role_of(key: Column, roles) -> Column:
    out = None
    for role, exact, words in roles:
        hit = T.contains_any(key, words)
        if exact:
            hit = hit | key.isin(*exact)
        out = F.when(hit, role) if out is None else out.when(hit, role)
    return out.otherwise("")


def header_columns(rows: DataFrame, cells: str = "cells", roles=fixed.HEADER_ROLES, counting=fixed.HEADER_COUNTING,
                   describing=fixed.HEADER_DESCRIBING, blocked_words=fixed.APPLICANT_WORDS) -> DataFrame:
    """Add ``roles`` (per cell), ``is_applicant`` and ``is_header`` (a valid one)."""
    has = lambda names: F.arrays_overlap("roles", F.array(*[F.lit(n) for n in names]))
    none = F.array().cast("array<string>")
    joined = hold(rows, _joined=T.header_key(F.array_join(cells, " ")))
    # A row without a counting and a describing word is no header: look at the whole row before its cells.
    words_of = lambda names: [w for role, exact, words in roles if role in names for w in (*exact, *words)]
    maybe = T.contains_any("_joined", words_of(counting)) & T.contains_any("_joined", words_of(describing))
    staged = hold(joined, is_applicant=T.contains_any("_joined", blocked_words), _maybe=maybe).drop("_joined")
    named = F.when(~F.col("is_applicant") & F.col("_maybe"), F.transform(cells, lambda c: header_role(c, roles))).otherwise(none)
    staged = hold(staged, roles=named).drop("_maybe")
    return hold(staged, is_header=~F.col("is_applicant") & has(counting) & has(describing))


def with_headers(rows: DataFrame, sheet_keys: list[str], row_no: str = "row_no", cells: str = "cells",
                 **rules) -> DataFrame:
    """Data rows with the header in force.

    Only the header's row number is carried down, over blocks of rows, so a sheet
    of any size is spread over tasks; the header cells then come from a join with
    the header rows, unique per (sheet, row). An applicant header is a header in
    force too: it blocks the rows below it until a valid one appears.
    """
    marked = header_columns(rows.withColumn(cells, clean_cells(F.col(cells))), cells, **rules)
    is_mark = F.col("is_header") | F.col("is_applicant")
    marked = marked.withColumn("_mark", F.when(is_mark, F.col(row_no)))
    headers = marked.where("is_header").select(
        *sheet_keys, F.col(row_no).alias("header_row"), F.col(cells).alias("labels"), _last_positions().alias("header_at"))
    placed = fill_down(marked.drop("roles", "is_header", "is_applicant"), sheet_keys, row_no, "_mark", "header_row")
    data = placed.where(F.col("_mark").isNull() & F.col("header_row").isNotNull()
                        & F.exists(cells, lambda c: ~T.is_blank(c))).drop("_mark")
    return data.join(headers, [*sheet_keys, "header_row"])


def _last_positions() -> Column:
    """Role → 0-based position of the last cell that names it."""
    named = F.filter(F.transform("roles", lambda r, i: F.struct(r.alias("role"), i.alias("at"))), lambda x: x["role"] != "")
    last = F.filter(named, lambda x: ~F.exists(named, lambda y: (y["role"] == x["role"]) & (y["at"] > x["at"])))
    return F.map_from_entries(last)


def cell(role: str, cells: str = "cells") -> Column:
    """Cell below the last header cell of that role, ``''`` when there is none."""
    return _cell_at(_position(role), cells)


def _position(role: str) -> Column:
    return F.try_element_at("header_at", F.lit(role))


def _cell_at(index: Column, array: str) -> Column:
    return F.coalesce(F.get(F.col(array), index), F.lit(""))


def sheet_offerings(rows: DataFrame, sheet_keys: list[str], row_no: str = "row_no", span: str = "source_span",
                    cells: str = "cells", **rules) -> DataFrame:
    """Offerings of sheet rows. Rows with neither a unit nor a count are dropped."""
    data = with_headers(rows, sheet_keys, row_no, cells, **rules)
    get = lambda role: cell(role, cells)
    label = lambda role: _cell_at(_position(role), "labels")
    all_labels = F.array_join("labels", " ")
    rent = get("monthly_rent")
    merged = (rent == "") & T.header_key(label("deposit")).contains(fixed.MERGED_RENT_WORD)
    count = N.first_int(get("supply_count"))
    staged = hold(
        data, _rent=F.when(merged, _cell_at(_position("deposit") + 1, cells)).otherwise(rent), _unit=get("unit_no"),
        _area=N.first_float(get("exclusive_area_m2")), _count=count,
        _category=T.first_non_blank(get("application_category"), get("supply_category")))
    staged = staged.where((F.col("_unit") != "") | F.col("_count").isNotNull())
    count = F.col("_count")
    return staged.select(
        *sheet_keys, F.col(row_no).alias("source_row"), F.col(span).alias("source_span"),
        T.first_non_blank(get("application_unit_label"), N.unit_label(
            get("housing_name"), F.col("_unit"), F.col("_area"), F.col("_category"), get("gender_requirement"))
        ).alias("application_unit_label"),
        get("supply_method").alias("supply_method"), F.col("_category").alias("application_category"),
        get("supply_category").alias("supply_category"), get("list_no").alias("list_no"),
        get("district").alias("district"), get("address").alias("address"), get("legal_dong").alias("legal_dong"),
        get("address_detail").alias("address_detail"), get("housing_name").alias("housing_name"),
        get("housing_name").alias("complex_name"), get("building_name").alias("building_name"),
        F.col("_unit").alias("unit_no"), N.first_int(get("floor_no")).alias("floor_no"),
        get("unit_type").alias("unit_type"), get("structure_type").alias("structure_type"),
        F.col("_area").alias("exclusive_area_m2"), N.first_float(get("area_pyeong")).alias("area_pyeong"),
        get("deposit").alias("deposit_text"), N.first_krw(get("deposit")).alias("deposit_krw"),
        get("jeonse_deposit").alias("jeonse_deposit_text"),
        N.money_with_unit(get("jeonse_deposit"), label("jeonse_deposit")).alias("jeonse_deposit_krw"),
        N.money_with_unit(get("contract_deposit"), all_labels).alias("contract_deposit_krw"),
        N.money_with_unit(get("balance_payment"), all_labels).alias("balance_payment_krw"),
        F.col("_rent").alias("monthly_rent_text"), N.first_krw("_rent").alias("monthly_rent_krw"),
        F.when((F.col("_unit") != "") & count.isNull(), 1).otherwise(count).alias("supply_count"),
        N.first_int(get("reserved_count")).alias("reserved_count"),
        get("gender_requirement").alias("gender_requirement"), get("occupancy_type").alias("occupancy_type"),
        N.first_int(get("capacity_persons")).alias("capacity_persons"),
        N.first_krw(get("dormitory_fee")).alias("dormitory_fee_krw"), get("heating_method").alias("heating_method"),
        get("move_in_start_text").alias("move_in_start_text"), get("direction").alias("direction"),
        get("status").alias("status"), row_map(F.col("labels"), F.col(cells)).alias("raw_row"),
        F.lit(fixed.CONF_SHEET_ROW).alias("confidence"))
