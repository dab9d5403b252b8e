"""First/last wins, carried values and ordinals that survive one huge key.

Nothing here gathers a whole group in one task:

* keep-one uses ``row_number() = 1``, which Spark limits per map task before the
  shuffle, so a hot key sends at most one row per map task;
* carried values and ordinals work on blocks of consecutive positions, then on
  block summaries, so a group is spread over as many tasks as it has blocks.
  Their keys must not be null (use ``coalesce``), so that the joins stay plain
  equi-joins on the partitioning the windows already made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 65536


def first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per key in the given (total) order. Null keys form one group."""
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn")


def last_row(df: DataFrame, keys: list[str], position: Column) -> DataFrame:
    return first_row(df, keys, [position.desc()])


def key_set(df: DataFrame, *keys) -> DataFrame:
    """Distinct keys for a semi or anti join: pre-reduced per task, so a hot key is one row."""
    return df.select(*keys).distinct()


def _carry(df: DataFrame, keys: list[str], position: str, value: str, out: str, levels: int) -> DataFrame:
    """Add the last non-null value strictly before each row."""
    if levels == 0:
        prior = W.partitionBy(*keys).orderBy(position).rowsBetween(W.unboundedPreceding, -1)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(prior))
    block = f"_block{levels}"
    df = df.withColumn(block, F.floor(F.col(position) / BLOCK))
    prior = W.partitionBy(*keys, block).orderBy(position).rowsBetween(W.unboundedPreceding, -1)
    summary = df.groupBy(*keys, block).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(position))).alias("_v"))
    carried = _carry(summary, keys, block, "_v", "_in", levels - 1).select(*keys, block, "_in")
    local = df.withColumn("_local", F.last(value, ignorenulls=True).over(prior))
    joined = local.join(carried, [*keys, block], "left")
    plain = [c for c in df.columns if c != block]
    return joined.select(*plain, F.coalesce("_local", "_in").alias(out))


def fill_down(df: DataFrame, keys: list[str], position: str, value: str, out: str, levels: int = 1) -> DataFrame:
    """Last non-null ``value`` at or above each row, per key, by an integer position.

    Positions are unique within a key. One level leaves one summary row per 65,536
    positions and key to a single window; a second level reads the input once more.
    """
    carried = _carry(df, keys, position, value, "_before", levels)
    return carried.withColumn(out, F.coalesce(F.col(value), F.col("_before"))).drop("_before")


def ordinals(df: DataFrame, keys: list[str], position: str, ordinal: str = "ordinal", total: str | None = None) -> DataFrame:
    """1-based ordinal of each row within its key by an integer position, and the key's row count."""
    df = df.withColumn("_block", F.floor(F.col(position) / BLOCK))
    counts = df.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    counts = counts.select(*keys, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
                           F.sum("_n").over(whole).alias("_total"))
    local = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys, "_block").orderBy(position)))
    joined = local.join(counts, [*keys, "_block"])
    plain = [c for c in df.columns if c != "_block"]
    extra = [F.col("_total").alias(total)] if total else []
    return joined.select(*plain, (F.col("_rn") + F.col("_start")).alias(ordinal), *extra)
