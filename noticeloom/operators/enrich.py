"""Joins whose right side only fills what is missing on the left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.functions import text as T


def fill_missing(left: DataFrame, right: DataFrame, keys: list[str], texts: list[str] = (), numbers: list[str] = (),
                 counts: list[str] = ()) -> DataFrame:
    """Blank texts, null numbers and counts that are null or not positive take the right side's value.

    ``right`` is unique per key.
    """
    fills = [*texts, *numbers, *counts]
    side = right.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in fills])
    joined = left.join(side, keys, "left")

    def value(c):
        own, other = F.col(c), F.col(f"_r_{c}")
        if c in texts:
            return F.when(T.is_blank(own), F.coalesce(other, own)).otherwise(own)
        if c in counts:
            return F.when(F.coalesce(own, F.lit(0)) <= 0, F.coalesce(other, own)).otherwise(own)
        return F.coalesce(own, other)

    return joined.select(*[value(c).alias(c) if c in fills else F.col(c) for c in left.columns])


def enrich_where(df: DataFrame, needed, enrich) -> DataFrame:
    """Send only the rows that need it through a costly join, then put both parts together."""
    need = F.coalesce(needed, F.lit(False))
    return enrich(df.where(need)).unionByName(df.where(~need))
