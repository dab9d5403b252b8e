"""Places of rows in a sorted order, whatever the sizes of the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.session import cut_lineage


def numbered(rows: DataFrame, group: list[str], order: list[Column], purpose: str = "ranks") -> DataFrame:
    """``rows`` with ``place`` (0-based place in its group by ``order``) and ``of`` (rows of the group).

    Give it a written table of narrow rows: the range bounds are sampled from it. Rows are
    range-partitioned by group and order, sorted inside the partitions and written with
    their running number; what a partition holds of a group is one row of a summary, whose
    running sums are the offsets. A hot group is spread over as many partitions as it
    fills, and so are equal rows, which a tie-break tells apart. Null groups count as a
    group. Empty tables give empty tables.
    """
    keys = [F.col(c) for c in group] + list(order)
    marked = rows.withColumn("_tie", F.monotonically_increasing_id())
    ordered = marked.repartitionByRange(*keys, F.col("_tie")).sortWithinPartitions(*keys, F.col("_tie")).drop("_tie")
    written = cut_lineage(ordered.withColumn("_at", F.monotonically_increasing_id()), purpose).withColumn("_part", F.shiftright("_at", 33))
    held = written.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    one = Window.partitionBy(*[F.col(c) for c in group]) if group else Window.partitionBy(F.lit(0))
    offsets = held.select(
        F.col("_part").alias("_p"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], "_first",
        F.coalesce(F.sum("_n").over(one.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(one).alias("of"))
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return written.join(offsets, same).select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("place"), "of")
