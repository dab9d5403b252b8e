"""Rent summaries from document text, and rent conversion estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import numbers as N
from noticeloom.functions import text as T
from noticeloom.functions.arrays import at
from noticeloom.operators.staging import hold


def text_lines(c) -> Column:
    return F.filter(F.transform(F.split(T._col(c), "\n"), T.trim_ws), lambda x: x != "")


def rent_summary(df: DataFrame, text: str, keep: list[str], start_word: str = fixed.RENT_START,
                 header_needs=fixed.RENT_HEADER_NEEDS, breakdown_needs=fixed.RENT_BREAKDOWN_NEEDS,
                 stop_line: str = fixed.RENT_STOP_LINE, header_lines: int = fixed.RENT_HEADER_LINES,
                 table_lines: int = fixed.RENT_TABLE_LINES) -> DataFrame:
    """Deposit and rent range of a rent table printed one value per line.

    The table starts at a line with the start word whose next lines name both
    columns. Amounts come in groups of two, or of four when the header splits the
    deposit. A single value is given as text and number, a range as text only.
    """
    lines = hold(df, _l=text_lines(text)).select(*keep, "_l")

    def window(i):
        return F.array_join(F.slice("_l", i + 1, F.lit(header_lines)), " ")

    marks = F.filter(F.transform("_l", lambda line, i: F.when(line.contains(start_word), i)), lambda i: i.isNotNull())
    started = hold(lines, _s=at(F.filter(marks, lambda i: T.contains_all(window(i), header_needs)), 0)).where(
        F.col("_s").isNotNull())
    started = hold(started, _g=F.when(T.contains_all(window(F.col("_s")), breakdown_needs), 4).otherwise(2),
                   _r=F.slice("_l", F.col("_s") + 2, F.lit(table_lines - 1)))
    is_money = lambda line: line.rlike(fixed.RENT_LINE) & (N.plain_long(line) > 0)
    first_money = at(F.filter(F.transform("_r", lambda line, i: F.when(is_money(line), i)), lambda i: i.isNotNull()), 0)
    started = hold(started, _f=first_money).where(F.col("_f").isNotNull())

    def stops(line, i):
        after = F.col("_s") + 1 + i
        page_break = (line == "-") & (at(F.col("_l"), after + 2) == "-") & at(F.col("_l"), after + 1).rlike("^[0-9]+$")
        return F.when((i > F.col("_f")) & ((line == stop_line) | F.coalesce(page_break, F.lit(False))), i)

    stop = at(F.filter(F.transform("_r", stops), lambda i: i.isNotNull()), 0)
    started = hold(started, _stop=stop)
    body = F.slice("_r", F.lit(1), F.coalesce("_stop", F.size("_r")))
    started = hold(started, _m=F.transform(F.filter(body, is_money), N.plain_long))
    groups = N.idiv(F.size("_m"), F.col("_g")).cast("int")
    started = hold(started, _n=groups).where("_n > 0")
    pick = lambda offset: F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda k: at(F.col("_m"), k * F.col("_g") + offset))
    out = hold(started, _d=pick(F.lit(0)), _p=pick(F.col("_g") - 1))

    def summary(values, prefix):
        low, high = F.array_min(values), F.array_max(values)
        return [N.krw_range_text(low, high).alias(f"{prefix}_text"), F.when(low == high, low).alias(f"{prefix}_krw")]

    return out.select(*keep, *summary("_d", "deposit"), *summary("_p", "monthly_rent"))


def amount_range(df: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """Least and greatest amount per key, with the range text."""
    return (df.groupBy(*keys).agg(F.min(amount).alias("low"), F.max(amount).alias("high"))
            .withColumn("range_text", N.krw_range_text("low", "high")))


def conversion_estimates(offerings: DataFrame, rules: DataFrame, keys: list[str], rent: str = "monthly_rent_krw",
                         deposit: str = "deposit_krw") -> DataFrame:
    """Rent turned into deposit as far as a notice's rule allows.

    convertible rent = rent × largest ratio; added deposit = convertible ÷ rent
    unit × deposit per unit; least rent = rent − convertible.
    """
    convertible = F.floor(F.col(rent) * F.col("max_ratio")).cast("bigint")
    joined = offerings.join(rules, keys).where(F.col(rent) > 0).withColumn("convertible_rent_krw", convertible)
    return (joined.withColumn("added_deposit_krw", F.floor(
                F.col("convertible_rent_krw") / F.col("rent_unit_krw") * F.col("deposit_per_unit_krw")).cast("bigint"))
            .withColumn("max_deposit_krw", F.col(deposit) + F.col("added_deposit_krw"))
            .withColumn("min_rent_krw", F.col(rent) - F.col("convertible_rent_krw")))
