"""Numbers and money read from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions.text import _col, contains_any, join_non_blank


def idiv(a: Column, b) -> Column:
    """Integer division that stays in integers."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def number_text(c) -> Column:
    """First number in a text without its thousands commas; ``''`` when none."""
    return F.replace(F.regexp_extract(_col(c), fixed.NUMBER, 0), F.lit(","), F.lit(""))


def first_int(c) -> Column:
    return F.split_part(number_text(c), F.lit("."), F.lit(1)).try_cast("int")


def first_float(c) -> Column:
    return number_text(c).try_cast("double")


def first_krw(c) -> Column:
    return first_float(c).try_cast("bigint")


def money_with_unit(c, unit_label) -> Column:
    """Amount in won; scaled when the unit label says thousand won."""
    value = first_krw(c)
    return F.when(contains_any(unit_label, fixed.THOUSAND_WON), value * 1000).otherwise(value)


def plain_long(c) -> Column:
    """A whole-number token with commas; null for anything else."""
    return F.replace(_col(c), F.lit(","), F.lit("")).try_cast("bigint")


def korean_amounts(c) -> Column:
    """``n억 m만원`` phrases → array of won amounts, in text order."""
    eok = F.regexp_extract_all(_col(c), F.lit(fixed.KOREAN_MONEY), F.lit(1))
    man = F.regexp_extract_all(_col(c), F.lit(fixed.KOREAN_MONEY), F.lit(2))
    amounts = F.zip_with(
        eok, man,
        lambda e, m: F.when(
            plain_long(e) <= fixed.EOK_MAX,
            plain_long(e) * fixed.EOK + F.coalesce(plain_long(m), F.lit(0).cast("bigint")) * fixed.MAN))
    return F.filter(amounts, lambda a: a.isNotNull())


def group_thousands(value) -> Column:
    return F.format_number(_col(value), 0)


def krw_range_text(low, high) -> Column:
    """``a원`` or ``a~b원``; ``''`` when the low end is missing or not positive."""
    low, high = _col(low), _col(high)
    single = F.concat(group_thousands(low), F.lit("원"))
    both = F.concat(group_thousands(low), F.lit("~"), group_thousands(high), F.lit("원"))
    return (F.when(low.isNull() | (low <= 0), F.lit(""))
            .when(high.isNull() | (high <= 0) | (low == high), single).otherwise(both))


def unit_count(c) -> Column:
    """Count written before the unit word, positive only."""
    value = F.replace(F.regexp_extract(_col(c), fixed.UNIT_COUNT, 1), F.lit(","), F.lit("")).try_cast("int")
    return F.when(value > 0, value)


def area_text(area) -> Column:
    area = _col(area)
    whole = F.concat(area.try_cast("bigint").cast("string"), F.lit("㎡"))
    part = F.concat(F.regexp_replace(F.format_string("%.2f", area), r"\.?0+$", ""), F.lit("㎡"))
    return F.when(area == F.floor(area), whole).when(area.isNotNull(), part)


def sum_known(*cols) -> Column:
    """Sum of the known values; null only when all are null."""
    cols = [_col(c) for c in cols]
    total = F.lit(0).cast("bigint")
    for c in cols:
        total = total + F.coalesce(c, F.lit(0))
    return F.when(F.coalesce(*cols).isNotNull(), total)


def first_positive(amounts: Column) -> Column:
    return F.coalesce(F.get(F.filter(amounts, lambda a: a > 0), F.lit(0)), F.lit(0).cast("bigint"))


def largest(amounts: Column) -> Column:
    return F.greatest(F.coalesce(F.array_max(amounts), F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))


def support_split(standard: Column) -> Column:
    """Shares of a support standard: 8/10 paid, 2/10 own part, 3/2 guarantee limit."""
    return F.struct(idiv(standard * 8, 10).alias("max_support"), idiv(standard * 2, 10).alias("own_part"),
                    idiv(standard * 3, 2).alias("guarantee_limit"))


def positive(c) -> Column:
    return F.when(_col(c) > 0, _col(c))


def unit_label(name, unit, area, category, gender) -> Column:
    """Label a person can apply for: name, unit, area, category, gender."""
    return join_non_blank(name, unit, F.coalesce(area_text(area), F.lit("")), category, gender)
