"""Incremental runs: new landed rows only, idempotent upserts, dedupe against the stored keys."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.operators.dedupe import first_row, key_set
from noticeloom.operators.snapshots import upsert_snapshot
from noticeloom.operators.upsert import Rule
from noticeloom.session import cut_lineage


def landed_stream(spark: SparkSession, path: str, schema, glob: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Stream of landed Parquet files."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(stream: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None]) -> None:
    """Process everything that has landed and not been processed, then stop.

    A batch that fails half-way is run again with the same rows, so ``each_batch``
    must be idempotent.
    """
    query = (stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def upsert_available(stream: DataFrame, table: str, checkpoint: str, keys: list[str], position: Column,
                     rules: dict[str, Rule] | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Upsert a stream into a table of snapshots (``snapshots``), which ``snapshots.read`` reads.

    ``position`` is where a row stands in its source (collected-at, then its id). It is
    stored as the row's version: a row replaces one that stood before it, whatever batch,
    checkpoint or stream brought it, and a repeated batch changes nothing.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        rows = (prepare(batch) if prepare else batch).withColumn("row_version", position)
        upsert_snapshot(batch.sparkSession, table, rows, keys, rules, F.col("row_version"), version="row_version")

    run_available(stream, checkpoint, each)


#: Folders that the keys of a deduplicated table are dealt to.
KEY_BUCKETS = 32
#: Tasks that may write one such folder in a batch; Spark puts small ones together.
WRITE_PARTS = 16


def dedupe_available(stream: DataFrame, table: str, checkpoint: str, keys: list[str], order: list[Column], buckets: int = KEY_BUCKETS) -> None:
    """Append the first row of every key that the table does not hold yet.

    No watermark: a row counts however late it comes, and a repeat is dropped however long
    after. Null keys are equal to each other. A batch that runs again, also after half of a
    write or with a new checkpoint, finds its own rows in the table and appends the rest only.
    Rows lie in folders by a hash of their key (``key_bucket``); of the stored keys only the
    folders that a batch touches are read, so a small batch reads a small part of the table.
    The number of ``buckets`` must stay the same over a table's life.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        fresh = cut_lineage(first_row(batch, keys, order).withColumn("key_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), "dedupe-batch")
        touched = [r["key_bucket"] for r in fresh.select("key_bucket").distinct().collect()]  # at most ``buckets`` numbers
        try:
            known = batch.sparkSession.read.parquet(table).where(F.col("key_bucket").isin(touched))
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        else:
            known = key_set(known, *[F.col(k).alias(f"_known_{k}") for k in keys])
            same = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]
            fresh = fresh.join(known, reduce(Column.__and__, same), "left_anti")
        parts = F.pmod(F.xxhash64(*keys, F.lit("file")), F.lit(WRITE_PARTS))
        fresh.repartition(F.col("key_bucket"), parts).write.mode("append").partitionBy("key_bucket").parquet(table)

    run_available(stream, checkpoint, each)
