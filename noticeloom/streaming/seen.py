"""Seen cache of rejected notices, kept as state of a stream.

Per notice (agency, board, seq) one entry is kept: why it was rejected, the hash of its
title, its day, until when the entry holds, and how often it was written. A listed row whose
entry still holds and has the same title and day is skipped; any other row is read in
detail, and if it is rejected then, its entry is written anew. Entries hold ``ttl_days`` of
their status. A timer on the stream's clock forgets an entry when it ends, so the state
does not keep notices that are never listed again.

Time is that of the rows: a row is judged at its collection time, or at the stream's clock
if that is later already (the newest collection time of earlier batches, in whole milliseconds). Late rows are
judged, not dropped: the clock is taken from a column that ends before the state, so Spark
does not compare rows with it. Rows of one batch count in the order of collection time and
position.

Memory: one entry per live notice in the state store (on disk), and in a task the rows of
one notice in one batch, without titles and texts. ``files_per_batch`` of the stream bounds these.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from noticeloom import fixed
from noticeloom.functions import text as T

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_DAY = 86_400_000_000

ENTRY = "status string, title_hash string, posted_at date, expires_at long, seen_count long"
JUDGED = "outcome string, status string, expires_at long, seen_count long"


class SeenCache(StatefulProcessor):
    """Judges the rows of a notice in order and keeps its entry. Times are microseconds."""

    def __init__(self, keys: list[str], ttl_days: dict[str, int]):
        self.keys, self.ttl = len(keys), {status: days * _DAY for status, days in ttl_days.items()}
        self.row = Row(*keys, "position", "outcome", "status", "expires_at", "seen_count")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", ENTRY)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        clock = timerValues.getCurrentWatermarkInMs() * 1000
        entry = before = tuple(self.entry.get()) if self.entry.exists() else None
        listed = sorted((tuple(r[self.keys:]) for r in rows), key=lambda r: (r[1], r[0] or 0, r[2] or ""))
        for position, at, title_hash, posted, status in listed:
            now = max(at, clock)
            if entry and entry[3] <= now:
                entry = None
            same = entry and entry[1] in (None, title_hash) and (entry[2] is None or posted is None or entry[2] == posted)
            if not same and status in self.ttl:
                entry = (status, title_hash, posted, now + self.ttl[status], entry[4] + 1 if entry else 1)
            shown = (entry[0], entry[3], entry[4]) if entry else (None, None, None)
            yield self.row(*key, position, "skipped_seen" if same else "detail", *shown)
        if entry == before:
            return
        if before:
            self.handle.deleteTimer(_end(before))
        if entry:
            self.entry.update(entry)
            self.handle.registerTimer(_end(entry))
        else:
            self.entry.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.entry.clear()
        return iter(())

    def close(self) -> None:
        pass


def _end(entry: tuple) -> int:
    """Milliseconds at which the entry has ended."""
    return -(-entry[3] // 1000)


@contextmanager
def rocks(spark: SparkSession):
    """State with timers needs the disk-based store; a query keeps the setting it was started with."""
    old = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, old)


def judged(rows: DataFrame, keys: list[str], position: str, collected_at: str = "collected_at", title: str = "title",
           posted_at: str = "posted_at", category: Column | str = "category", ttl_days: dict[str, int] | None = None) -> DataFrame:
    """Keys, position, outcome (``skipped_seen`` or ``detail``) and the entry after each row of a stream.

    ``category`` is what the detail page would be judged as; rejected and unknown rows enter
    the cache. Null keys are keys of their own; a null posting day equals every day; rows
    without a collection time are judged at the stream's clock.
    """
    at = F.unix_micros(F.col(collected_at).cast("timestamp"))
    kind = F.col(category) if isinstance(category, str) else category
    status = F.when(kind == fixed.CATEGORY_RECRUITMENT, F.lit(None)).when(kind == fixed.CATEGORY_UNKNOWN, fixed.SEEN_UNKNOWN).otherwise(fixed.SEEN_REJECTED)
    narrow = rows.withColumn("_clock", F.col(collected_at).cast("timestamp")).withWatermark("_clock", "0 seconds").select(
        *keys, F.col(position).cast("long").alias("position"), F.coalesce(at, F.lit(0)).alias("_at"), T.title_hash(title).alias("_hash"),
        F.col(posted_at).cast("date").alias("_posted"), status.alias("_status"))
    shape = ", ".join(f"{k} {narrow.schema[k].dataType.simpleString()}" for k in keys)
    out = narrow.groupBy(*keys).transformWithState(SeenCache(keys, ttl_days or fixed.SEEN_TTL_DAYS), f"{shape}, position long, {JUDGED}", "Append", "EventTime")
    return out.withColumn("expires_at", F.timestamp_micros("expires_at"))


def judge_available(stream: DataFrame, out: str, checkpoint: str, keys: list[str], position: str, **columns) -> None:
    """Judge all rows that have landed since the last run and append them to the Parquet sink ``out``, each once."""
    with rocks(stream.sparkSession):
        query = judged(stream, keys, position, **columns).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint) \
            .outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
