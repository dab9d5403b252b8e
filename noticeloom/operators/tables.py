"""Table rows found in document text.

A rule turns one text into an array of (raw_text, content) rows with column
expressions, behind a cheap gate of required phrases. ``extract_rows`` applies
any set of such rules in a single pass: no shuffle, no Python workers, and the row
number of a table comes from the array position. Rules that scan from token to token
(``scanners``) run in Arrow batches, on the texts that pass their gates alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructType

from noticeloom import fixed
from noticeloom.functions import numbers as N
from noticeloom.functions import text as T
from noticeloom.functions.arrays import at, carry_forward, g, last, let, match_all, printable, scan
from noticeloom.operators.scanners import PRICE_TABLE, TYPES, ScanRule
from noticeloom.operators.staging import explode_rows, hold

ROW = "struct<raw_text:string,content:map<string,string>>"


@dataclass(frozen=True)
class TableRule:
    table: str
    gates: tuple[str, ...]
    rows: Callable[[Column], Column]


def row(raw: Column, **content) -> Column:
    """One extracted row; values are text."""
    pairs = [x for k, v in content.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v))]
    return F.struct(raw.alias("raw_text"), F.create_map(*pairs).alias("content"))


def compact_text(c) -> Column:
    return T.collapse_ws(printable(T._col(c)))


def extract_rows(artifacts: DataFrame, rules: tuple[TableRule | ScanRule, ...], text: str = "raw_text",
                 span: str = "source_span") -> DataFrame:
    """All table rows of all artifacts, with their own span and row number."""
    keep = [c for c in artifacts.columns if c not in (text, span)]
    staged = hold(artifacts, _t=compact_text(text)).select(*keep, span, "_t")
    scans = tuple(r for r in rules if isinstance(r, ScanRule))
    plain = tuple(r for r in rules if isinstance(r, TableRule))
    parts = [_expression_rows(staged, plain, [*keep, span])] if plain or not scans else []
    parts += [_scanned_rows(staged, scans, [*keep, span])] if scans else []
    return reduce(DataFrame.unionByName, parts).select(
        *keep, "table", "row_no", "raw_text", "content", T.table_span(span, "table", F.col("row_no")).alias(span),
        F.lit(fixed.ART_TABLE_ROW).alias("artifact_type"), F.lit(fixed.STATUS_EXTRACTED).alias("status"),
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"), F.lit(fixed.CONF_TABLE_ROW).alias("confidence"))


def _expression_rows(staged: DataFrame, rules: tuple[TableRule, ...], keep: list[str]) -> DataFrame:
    none = F.array().cast(f"array<{ROW}>")
    per_rule = F.array(*[
        F.struct(F.lit(r.table).alias("table"),
                 F.when(T.contains_all("_t", r.gates), F.coalesce(r.rows(F.col("_t")), none)).otherwise(none).alias("rows"))
        for r in rules])
    tables = staged.select(*keep, F.inline_outer(per_rule)).where(F.size("rows") > 0)
    rows = explode_rows(tables, [*keep, "table"], "rows", "_at", "_row")
    return rows.select(*keep, "table", (F.col("_at") + 1).alias("row_no"), "_row.raw_text", "_row.content")


def _scanned_rows(staged: DataFrame, rules: tuple[ScanRule, ...], keep: list[str]) -> DataFrame:
    gates = [T.contains_all("_t", r.gates) for r in rules]
    gated = staged.withColumn("_open", F.array(*gates)).where(reduce(Column.__or__, gates))

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                found = [(i, rule.table, n, raw, list(content.items()))
                         for i, (text, opened) in enumerate(zip(part.column("_t").to_pylist(), part.column("_open").to_pylist()))
                         for rule, is_open in zip(rules, opened) if is_open
                         for n, (raw, content) in enumerate(rule.scan(text), 1)]
                columns = list(zip(*found)) or [()] * 5
                kept = part.take(pa.array(columns[0], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(kept.column(c) for c in keep), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.string()),
                     pa.array(columns[4], pa.map_(pa.string(), pa.string()))], names=[*keep, "table", "row_no", "raw_text", "content"])

    shape = StructType([staged.schema[c] for c in keep]).add("table", "string").add("row_no", "integer").add("raw_text", "string").add("content", MapType(StringType(), StringType()))
    return gated.select(*keep, "_t", "_open").mapInArrow(run, shape)


# --- generic rule: section → pattern → rows → carried head → lookup
def pattern_rows(section: tuple[str, str], pattern: str, fields: dict[str, int], source: str,
                 carried: tuple[str, int] | None = None,
                 lookup: tuple[str, str, Callable[[Column], Column]] | None = None,
                 constants: Callable[[Column], dict[str, Column]] | None = None) -> Callable[[Column], Column]:
    """Rows of a pattern inside a section.

    ``carried``: (field, group) that is filled down; rows before its first value are dropped.
    ``lookup``: (field, from field, text → array of (key, value)); the first value of a key wins.
    """
    def rows(text: Column) -> Column:
        body = T.section_between(text, *section)
        extra = constants(text) if constants else {}
        look = lookup[2](text) if lookup else F.array().cast("array<struct<key:string,value:string>>")

        def build(raws, heads, found):
            def one(raw, i):
                content = {"source": F.lit(source)}
                content.update({name: g(raw, n) for name, n in fields.items()})
                if carried:
                    content[carried[0]] = at(heads, i)
                if lookup:
                    key = content[lookup[1]]
                    hit = F.filter(found, lambda e: e["key"] == key)
                    content[lookup[0]] = F.coalesce(at(F.transform(hit, lambda e: e["value"]), 0), F.lit(""))
                content.update(extra)
                return row(raw["match"], **content)

            built = F.transform(raws, one)
            return F.filter(built, lambda r: r["content"][carried[0]] != "") if carried else built

        last_group = max([*fields.values(), carried[1] if carried else 0])
        return let(scan(body, pattern, last_group), lambda raws: let(look, lambda found: let(
            carry_forward(F.transform(raws, lambda r: g(r, carried[1]))) if carried else F.array(F.lit("")),
            lambda heads: build(raws, heads, found))))

    return rows


def _district_addresses(text: Column) -> Column:
    p = fixed.UNIT_ADDRESS
    return F.transform(scan(text, p, 3), lambda m: F.struct(
        g(m, 1).alias("key"), F.concat_ws(" ", F.lit("서울특별시"), g(m, 1), g(m, 2), g(m, 3)).alias("value")))


UNIT_CONDITIONS = TableRule("unit_conditions", (fixed.UNIT_SECTION[0],), pattern_rows(
    fixed.UNIT_SECTION, fixed.UNIT_ROW,
    {"list_no": 2, "unit_no": 3, "exclusive_area_m2": 4, "supply_area_m2": 5, "deposit_text": 6,
     "monthly_rent_text": 7, "deposit_option_2": 8, "rent_option_2": 9},
    "pdf_table_wiguk_unit_conditions", carried=("district", 1), lookup=("address", "district", _district_addresses)))


def _vacancy(text: Column) -> Column:
    p = fixed.VACANCY_ROW
    address = T.join_branch_roads(F.regexp_extract(text, fixed.VACANCY_ADDRESS, 0), loose=True)
    return let(address, lambda where: F.transform(scan(T.section_between(text, *fixed.VACANCY_SECTION), p, 5), lambda m: row(
        m["match"], source="pdf_table_vacancy", housing_name=g(m, 1), address=where,
        unit_no=F.concat(g(m, 2), F.lit(fixed.UNIT_SUFFIX)), exclusive_area_m2=g(m, 3),
        deposit_text=g(m, 4), monthly_rent_text=g(m, 5))))


VACANCY = TableRule("vacancy", (fixed.VACANCY_SECTION[0],), _vacancy)


def shared_price_rows(section: tuple[str, str], unit_pattern: str, deposit_at: int, rent_at: int,
                      name: str, address: str, source: str, suffix: str = " 원") -> Callable[[Column], Column]:
    """Units of a section that all carry the same two of the section's amounts."""
    def rows(text: Column) -> Column:
        def from_section(body):
            def with_money(money):
                return F.when(F.size(money) > max(deposit_at, rent_at), F.transform(scan(body, unit_pattern, 2), lambda m: row(
                    m["match"], source=source, housing_name=name, address=address, unit_no=g(m, 1),
                    exclusive_area_m2=g(m, 2),
                    deposit_text=F.concat(at(money, deposit_at), F.lit(suffix)),
                    monthly_rent_text=F.concat(at(money, rent_at), F.lit(suffix)))))
            return let(match_all(body, fixed.MONEY), with_money)
        return let(T.first_non_empty(T.section_between(text, *section), text), from_section)
    return rows


SHARED_PRICE = TableRule("dure_rent_options", fixed.SHARED_GATES, shared_price_rows(
    fixed.SHARED_SECTION, fixed.SHARED_UNIT, 0, 3, fixed.SHARED_NAME, fixed.SHARED_ADDRESS, "pdf_table_dure_rent_options"))


@dataclass(frozen=True)
class GroupTable:
    """Blocks that start at a head (group number, lot), hold rent rows, and join supply facts by group."""

    name: str
    head: str
    ends: tuple[str, ...]
    rent_sections: tuple[tuple[str, str], ...]
    supply_sections: tuple[tuple[str, str], ...]
    rent_row: str
    count: str
    address_prefix: str
    auto_gender: tuple[tuple[str, str, tuple[str, ...]], ...]
    source: str
    label_suffix: str = "호점"
    supply_method: str = fixed.GROUP_SUPPLY_METHOD
    occupancy: str = fixed.GROUP_OCCUPANCY


def group_rows(spec: GroupTable) -> Callable[[Column], Column]:
    def section(text, choices):
        return T.first_non_empty(*[T.section_between(text, *c) for c in choices])

    def blocks(body):
        def tidy(b):
            cut = F.trim(b["tail"])
            for end in spec.ends:
                cut = F.trim(F.substring_index(cut, end, 1))
            return let(cut, lambda c: F.struct(
                g(b, 1).alias("key"), F.concat(F.lit(spec.address_prefix), g(b, 2)).alias("address"),
                c.alias("body"), F.concat_ws(" ", b["match"], c).alias("raw")))
        return F.transform(scan(body, spec.head, 2), tidy)

    def supply(text):
        return F.transform(blocks(section(text, spec.supply_sections)), lambda b: F.struct(
            b["key"].alias("key"), b["address"].alias("address"), F.regexp_extract(b["body"], spec.count, 1).alias("count"),
            T.first_keyword(F.regexp_replace(b["body"], spec.count, ""), [(g, g) for g in fixed.GENDERS]).alias("gender")))

    def auto_gender(text, key):
        out = F.lit("")
        for number, gender, phrases in spec.auto_gender:
            out = F.when((key == number) & T.contains_any(text, phrases), gender).otherwise(out)
        return out

    def units(body):
        p = spec.rent_row
        found = F.transform(scan(body, p, 4), lambda m: F.struct(
            g(m, 1).alias("unit_no"), g(m, 2).alias("exclusive_area_m2"), g(m, 3).alias("deposit_text"),
            g(m, 4).alias("monthly_rent_text"), N.plain_long(g(m, 3)).alias("deposit"), N.plain_long(g(m, 4)).alias("rent")))
        return F.filter(found, lambda u: u["deposit"].isNotNull() & u["rent"].isNotNull())

    def rows(text: Column) -> Column:
        def one(b, facts):
            def with_units(rent):
                info = at(F.reverse(F.filter(facts, lambda s: s["key"] == b["key"])), 0)
                gender = T.first_non_blank(info["gender"], auto_gender(text, b["key"]))
                rents = F.transform(rent, lambda u: u["rent"])
                deposit = at(rent, 0)["deposit"]
                shown = F.to_json(F.transform(rent, lambda u: F.struct(
                    u["unit_no"], u["exclusive_area_m2"], u["deposit_text"], u["monthly_rent_text"])))
                return let(gender, lambda g: F.when(F.size(rent) > 0, row(
                    b["raw"], source=spec.source, housing_name=spec.name,
                    address=T.first_non_empty(F.coalesce(info["address"], F.lit("")), b["address"]),
                    supply_method=spec.supply_method, supply_category=spec.supply_method,
                    application_category=g, gender_requirement=g,
                    supply_count=T.first_non_blank(info["count"], F.size(rent).cast("string")),
                    occupancy_type=spec.occupancy, deposit_text=N.krw_range_text(deposit, deposit),
                    monthly_rent_text=N.krw_range_text(F.array_min(rents), F.array_max(rents)),
                    application_unit_label=T.join_non_blank(
                        F.lit(spec.name), F.concat(b["key"], F.lit(spec.label_suffix)), g),
                    unit_rows=shown)))
            return let(units(b["body"]), with_units)
        built = let(supply(text), lambda facts: F.transform(
            blocks(section(text, spec.rent_sections)), lambda b: one(b, facts)))
        return F.filter(built, lambda r: r.isNotNull())
    return rows


GROUPS = TableRule("chungshin_theater_dure_gender_supply", fixed.GROUP_GATES, group_rows(GroupTable(
    fixed.GROUP_NAME, fixed.GROUP_HEAD, fixed.GROUP_ENDS,
    (fixed.GROUP_RENT_SECTION,),
    (fixed.GROUP_SUPPLY_SECTION, fixed.GROUP_SUPPLY_SECTION_ALT),
    fixed.GROUP_RENT_ROW, fixed.GROUP_COUNT, fixed.GROUP_ADDRESS_PREFIX, fixed.GROUP_AUTO_GENDER,
    "pdf_table_chungshin_theater_dure_gender_supply")))


def _hope(text: Column) -> Column:
    """Supply rows opened up per gender, with price and address looked up by canonical name (last wins)."""
    canonical = lambda c: T.canonical_name(c, fixed.HOPE_NAMES)
    addresses = F.transform(scan(text, fixed.HOPE_ADDRESS, 2), lambda m: F.struct(
        canonical(g(m, 1)).alias("key"), F.trim(g(m, 2)).alias("value")))
    prices = F.transform(scan(text, fixed.HOPE_RENT, 4), lambda m: F.struct(
        canonical(g(m, 1)).alias("key"),
        *[F.when(g(m, i) != "-", g(m, i)).otherwise("").alias(n)
          for i, n in ((2, "deposit"), (3, "rent"), (4, "fee"))]))

    def expand(m, where, price):
        name, area = canonical(g(m, 1)), g(m, 3)
        kind = T.collapse_ws(g(m, 2))

        def one(x, who):
            mine = at(F.reverse(F.filter(price, lambda p: p["key"] == who)), 0)
            text_of = lambda f: F.coalesce(mine[f], F.lit(""))
            gender = g(x, 1)
            return row(m["match"], source="pdf_table_hope_housing_supply", housing_name=who,
                       address=F.coalesce(at(F.reverse(F.filter(where, lambda a: a["key"] == who)), 0)["value"], F.lit("")),
                       exclusive_area_m2=area, occupancy_type=kind, gender_requirement=gender,
                       supply_count=g(x, 2),
                       application_unit_label=T.join_non_blank(who, area, gender), deposit_text=text_of("deposit"),
                       monthly_rent_text=text_of("rent"), dormitory_fee_text=text_of("fee"))
        return let(name, lambda who: F.transform(scan(g(m, 4), fixed.HOPE_GENDER, 2), lambda x: one(x, who)))

    return let(addresses, lambda where: let(prices, lambda price: F.flatten(
        F.transform(scan(text, fixed.HOPE_ROW, 4), lambda m: expand(m, where, price)))))


HOPE = TableRule("hope_housing_supply", fixed.HOPE_GATES, _hope)


def _support(text: Column) -> Column:
    """One program row from amounts derived from the support standard."""
    count = F.replace(F.regexp_extract(text, fixed.SUPPORT_COUNT, 1), F.lit(","), F.lit(""))
    where = F.when(text.contains(fixed.SUPPORT_AREA), fixed.SUPPORT_AREA).otherwise(fixed.SUPPORT_AREA_DEFAULT)
    amounts = N.korean_amounts(T.first_non_empty(T.section_between(text, *fixed.SUPPORT_SECTION), text))
    worded = lambda word, v: F.when(v > 0, F.concat(F.lit(word), N.group_thousands(v), F.lit("원"))).otherwise("")

    def build(found):
        standard = N.first_positive(found)
        split = N.support_split(standard)
        limit = F.when(N.largest(found) > 0, N.largest(found)).otherwise(split["guarantee_limit"])
        return F.array(row(
            F.regexp_extract(text, fixed.SUPPORT_COUNT, 0), source="pdf_table_jeonse_lease_support",
            housing_name=fixed.SUPPORT_NAME, address=where, supply_method=fixed.SUPPORT_METHOD, supply_count=count,
            application_unit_label=T.join_non_blank(F.lit(fixed.SUPPORT_NAME), where, F.concat(count, F.lit(fixed.UNIT_SUFFIX))),
            jeonse_deposit_text=worded("보증금한도액 ", limit),
            contract_deposit_text=worded("입주자부담금 ", split["own_part"]),
            balance_payment_text=worded("최대지원금액 ", split["max_support"])))

    return F.when(F.regexp_like(text, F.lit(fixed.SUPPORT_COUNT)), let(amounts, build))


SUPPORT = TableRule("jeonse_lease_support", fixed.SUPPORT_GATES, _support)


DEFAULT_RULES = (UNIT_CONDITIONS, VACANCY, SHARED_PRICE, GROUPS, HOPE, TYPES, SUPPORT, PRICE_TABLE)
