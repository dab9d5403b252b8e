"""Whether a notice is open at a moment, from its schedules and its applications.

Each side is reduced to one small row per notice by min / max aggregates, which
Spark combines before the shuffle; no list of schedules is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.operators.predicates import availability_matches

OPEN, PENDING, CLOSED, UNKNOWN = "open", "pending", "closed", "unknown"
FROM_APPLICATION, FROM_SCHEDULE, FROM_NONE = "application_notice", "schedule", "none"


def schedule_state(schedules: DataFrame, keys: list[str], now: Column, start: str = "starts_at", end: str = "ends_at",
                   known_only: bool = True) -> DataFrame:
    """Schedule status and representative interval per key.

    Open beats pending beats closed. The interval shown is the earliest open one,
    the next one to come, or the one that closed last (of those, the one that began
    first). With ``known_only`` a key
    whose intervals all lack a bound has no schedule; without, it is closed.
    """
    s, e = F.col(start), F.col(end)
    known = s.isNotNull() & e.isNotNull()
    is_open, is_future, is_past = known & (s <= now) & (e >= now), known & (s > now), known & (e < now)
    pair = F.struct(s.alias("s"), e.alias("e"))
    source = schedules.where(known) if known_only else schedules
    reduced = source.groupBy(*keys).agg(
        F.min(F.when(is_open, pair)).alias("_open"), F.min(F.when(is_future, pair)).alias("_next"),
        F.max(F.when(is_past, F.struct(e.alias("e"), (e - s).alias("d"), s.alias("s")))).alias("_last"))
    status = (F.when(F.col("_open").isNotNull(), OPEN).when(F.col("_next").isNotNull(), PENDING).otherwise(CLOSED))
    return reduced.select(*keys, status.alias("schedule_status"),
                          F.coalesce("_open.s", "_next.s", "_last.s").alias("starts_at"),
                          F.coalesce("_open.e", "_next.e", "_last.e").alias("ends_at"))


def application_state(applications: DataFrame, keys: list[str], status: str = "status", open_value: str = fixed.APP_OPEN,
                      pending_value: str = fixed.APP_PENDING) -> DataFrame:
    """Any open application → open, else any pending one → pending; statuses are compared as they are."""
    value = F.col(status)
    rank = F.when(value == open_value, 2).when(value == pending_value, 1)
    return (applications.where(rank.isNotNull()).groupBy(*keys).agg(F.max(rank).alias("_rank"))
            .select(*keys, F.when(F.col("_rank") == 2, OPEN).otherwise(PENDING).alias("application_status")))


def resolve(df: DataFrame) -> DataFrame:
    """Final status, its source, and whether both sources are known and disagree."""
    a, s = F.coalesce("application_status", F.lit(UNKNOWN)), F.coalesce("schedule_status", F.lit(UNKNOWN))
    return (df.withColumn("application_status", a).withColumn("schedule_status", s)
            .withColumn("status", F.when(F.col("application_status") != UNKNOWN, F.col("application_status"))
                        .otherwise(F.col("schedule_status")))
            .withColumn("status_source", F.when(F.col("application_status") != UNKNOWN, FROM_APPLICATION)
                        .when(F.col("schedule_status") != UNKNOWN, FROM_SCHEDULE).otherwise(FROM_NONE))
            .withColumn("conflict", (F.col("application_status") != UNKNOWN) & (F.col("schedule_status") != UNKNOWN)
                        & (F.col("application_status") != F.col("schedule_status"))))


def status_rank(status="status") -> Column:
    return F.when(F.col(status) == OPEN, 0).when(F.col(status) == PENDING, 1).when(F.col(status) == CLOSED, 2).otherwise(3)


def availability(notices: DataFrame, approved_offerings: DataFrame, schedules: DataFrame, applications: DataFrame,
                 now: Column, agency: str = "", statuses: tuple[str, ...] = (), open_value: str = fixed.APP_OPEN,
                 pending_value: str = fixed.APP_PENDING) -> DataFrame:
    """Availability of every notice with an approved offering.

    The agency filter runs before the joins; the joins are one row to one row.
    """
    wanted = notices.where(availability_matches("agency", F.lit(""), agency))
    counts = approved_offerings.groupBy("notice_id").agg(F.count(F.lit(1)).alias("approved_offerings"))
    times = schedule_state(schedules.where(F.col("schedule_type") == "application"), ["notice_id"], now)
    active = application_state(applications, ["notice_id"], open_value=open_value, pending_value=pending_value)
    joined = (wanted.withColumnRenamed("id", "notice_id").join(counts, "notice_id")
              .join(times, "notice_id", "left").join(active, "notice_id", "left"))
    return resolve(joined).where(availability_matches("agency", "status", "", statuses))


def ranked(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Open first, then pending, closed, unknown; earlier starts first, unknown starts last."""
    ordered = df.orderBy(status_rank(), F.col("starts_at").asc_nulls_last(), "agency", "seq", "board_kind")
    return ordered.limit(limit) if limit else ordered
