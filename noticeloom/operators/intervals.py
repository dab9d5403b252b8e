"""Which intervals contain a moment, as an equi-join.

An interval is filed under the smallest of ``WIDTHS`` that is not shorter than itself, so
it touches one or two time buckets of that width; a moment is looked up in its one bucket
of every width that the intervals of its key have. Only rows that share key, width and
bucket are compared, so a key that holds a third of all rows falls into as many groups as
it has buckets, and each comparison that fails is at most one width away.

Where only a summary per moment is wanted, pairs are not made: their number grows with the
square of a key's rows. ``summarised`` puts each interval together from whole buckets of the
widths ``2 ** k`` and keeps one summary per bucket; only the two ends of an interval, which
fill no smallest bucket, are compared with the moments in it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MINUTE = 60_000_000
#: Bucket widths in microseconds: a minute, eight minutes, about an hour, and so on up to tens of thousands of years.
WIDTHS = tuple(_MINUTE * 8 ** k for k in range(13))


def micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def containing(moments: DataFrame, intervals: DataFrame, keys: list[str], at: str, starts: str = "starts_at", ends: str = "ends_at") -> DataFrame:
    """Pairs of a moment and an interval of the same keys with ``starts <= at <= ends``; the columns of both.

    ``keys`` may be empty. Null keys, moments and bounds match nothing, and an interval
    that ends before it starts contains nothing. The two sides share no columns but the keys.
    """
    begin, end = micros(F.col(starts)), micros(F.col(ends))
    length = end - begin
    width = reduce(lambda wider, w: F.when(length <= w, F.lit(w)).otherwise(wider), reversed(WIDTHS[:-1]), F.lit(WIDTHS[-1]))
    sized = intervals.where(length >= 0).withColumns({"_width": width.cast("long"), "_begin": begin, "_end": end})
    number = lambda t: F.expr(f"{t} div _width") + F.when(F.expr(f"{t} % _width < 0"), -1).otherwise(0)
    filed = sized.withColumn("_bucket", F.explode(F.sequence(number("_begin"), number("_end"))))
    widths = sized.groupBy(*keys).agg(F.collect_set("_width").alias("_widths"))
    timed = moments.withColumn("_at", micros(F.col(at))).where(F.col("_at").isNotNull())
    timed = timed.join(widths, keys) if keys else timed.withColumn("_widths", widths.select("_widths").scalar())
    asked = timed.withColumn("_width", F.explode("_widths")).withColumn("_bucket", number("_at")).drop("_widths")
    return asked.join(filed, [*keys, "_width", "_bucket"]).where(F.col("_at").between(F.col("_begin"), F.col("_end"))) \
        .drop("_width", "_bucket", "_at", "_begin", "_end")


#: Intervals of a key per bucket of its smallest width, as a power of two.
_PER_BUCKET = 2
_NODES = ("flatten(transform(sequence(0, length(bin(_after - _first)) - 1), i -> filter(array("
          "if(-shiftright(-_first, i) % 2 <> 0 AND -shiftright(-_first, i) < shiftright(_after, i), struct(_base + i AS _level, -shiftright(-_first, i) AS _bucket), NULL), "
          "if(shiftright(_after, i) % 2 <> 0 AND -shiftright(-_first, i) < shiftright(_after, i), struct(_base + i AS _level, shiftright(_after, i) - 1 AS _bucket), NULL)), x -> x IS NOT NULL)))")


def summarised(moments: DataFrame, intervals: DataFrame, keys: list[str], at: str, by: list[str], measures: dict[str, tuple[Callable, Column]],
               starts: str = "starts_at", ends: str = "ends_at") -> DataFrame:
    """Measures of the intervals of the same keys that contain a moment, per ``by`` columns of the moments.

    The rows are those of ``containing(...).groupBy(by).agg(...)``. A measure is an aggregate
    function that may be applied in parts (a sum, least or greatest) and the interval's value.
    The smallest width follows how close the intervals of a key lie, so a moment meets a
    few ends and one summary per wider width.
    """
    begin, end = micros(F.col(starts)), micros(F.col(ends))
    names = list(measures)
    valid = intervals.select(*keys, begin.alias("_begin"), end.alias("_end"), *[value.alias(n) for n, (_, value) in measures.items()]).where("_end >= _begin")
    combined = [combine(n).alias(n) for n, (combine, _) in measures.items()]
    shape = valid.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_begin").alias("_least"), F.max("_end").alias("_most"), F.max(F.expr("_end - _begin")).alias("_longest"))
    shape = shape.withColumn("_base", F.expr(f"length(bin((_most - _least) div _n)) - 1 + {_PER_BUCKET}"))
    shape = shape.select(*keys, "_base", F.expr("length(bin(shiftright(_longest + 1, _base))) - 1").alias("_levels"))
    sized = valid.join(shape.drop("_levels"), keys).withColumns({"_first": F.expr("-shiftright(-_begin, _base)"), "_after": F.expr("shiftright(_end + 1, _base)")})
    whole = (sized.where("_first < _after").select(*keys, *names, F.explode(F.expr(_NODES)).alias("_node")).select(*keys, "_node.*", *names)
             .groupBy(*keys, "_level", "_bucket").agg(*combined))
    open_ends = F.expr("array_distinct(filter(array(if(shiftright(_begin, _base) < _first, shiftright(_begin, _base), NULL), "
                       "if(shiftright(_end, _base) >= _after, shiftright(_end, _base), NULL)), x -> x IS NOT NULL))")
    parts = sized.withColumn("_bucket", F.explode(open_ends)).select(*keys, "_bucket", "_begin", "_end", *names)
    timed = moments.select(*keys, *[c for c in by if c not in keys], micros(F.col(at)).alias("_at")).where(F.col("_at").isNotNull()).join(shape, keys)
    asked = timed.withColumn("_level", F.explode(F.expr("sequence(_base, _base + _levels)"))).withColumn("_bucket", F.expr("shiftright(_at, _level)"))
    covered = asked.join(whole, [*keys, "_level", "_bucket"]).select(*by, *names)
    met = timed.withColumn("_bucket", F.expr("shiftright(_at, _base)")).join(parts, [*keys, "_bucket"]).where("_at BETWEEN _begin AND _end").select(*by, *names)
    return covered.unionByName(met).groupBy(*by).agg(*combined)
