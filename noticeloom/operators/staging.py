"""Plan shapes that keep costly expressions from being evaluated more than once.

Spark pushes a filter below the projection that computes its column and repeats
the computation there, and it adds size and null checks in front of a plain
explode. Both are right for cheap columns and wasteful for long text work. A
generator is a border that neither crosses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def hold(df: DataFrame, **columns: Column) -> DataFrame:
    """Add computed columns behind a generator border (one row in, one row out)."""
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def explode_rows(df: DataFrame, keep: list[str], array: Column | str, position: str, value: str) -> DataFrame:
    """One row per element with its 0-based position; rows without elements give none."""
    return df.select(*keep, F.posexplode_outer(array).alias(position, value)).where(F.col(position).isNotNull())


SPREAD = "spark.noticeloom.spread"


def spread(df: DataFrame, least: int = 0) -> DataFrame:
    """Give costly per-row work as many tasks as the session setting ``SPREAD`` says.

    Unset, at least ``least`` tasks are used, and 0 leaves the scan's own splits.
    """
    tasks = int(df.sparkSession.conf.get(SPREAD, None) or least)
    return df.repartition(tasks) if tasks else df


def several_per_core(spark: SparkSession) -> int:
    """Tasks for rows that cost much more to work on than to move.

    A Parquet file is split by its row groups, and one row group can hold a million rows;
    the tasks therefore follow the cores and the shuffle partitions, not the files.
    """
    return max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
