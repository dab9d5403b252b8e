"""Run records: a row when a run opens, a row when it ends, counters taken while its tables are written.

Counters are observed on the frames that the run writes anyway, so that no row is read a
second time for them. A run that fails leaves the counters so far and its error.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from noticeloom.operators.upsert import append_rows
from noticeloom.session import cut_lineage

RUNNING, SUCCEEDED, FAILED = "running", "succeeded", "failed"
_RUN = "run_id string, source string, status string, stats map<string,bigint>, labels map<string,string>, error_text string"


class Run:
    """Counters (numbers) and labels (texts) of a run that is going on."""

    def __init__(self, names: tuple[str, ...] = ()):
        self.stats: dict[str, int] = dict.fromkeys(names, 0)
        self.labels: dict[str, str] = {}

    def staged(self, df: DataFrame, purpose: str, **counters: Column) -> DataFrame:
        """``df`` written to shared storage, with counters (aggregates over its rows) taken on the way."""
        seen = Observation()
        written = cut_lineage(df.observe(seen, *[F.coalesce(c.cast("bigint"), F.lit(0)).alias(name) for name, c in counters.items()]), purpose)
        self.count(**seen.get)
        return written

    def count(self, **values: int) -> None:
        self.stats.update({name: int(v) for name, v in values.items()})

    def label(self, **values: object) -> None:
        self.labels.update({name: str(v) for name, v in values.items()})


@contextmanager
def recorded(spark: SparkSession, path: str, run_id: str, source: str, names: tuple[str, ...] = ()) -> Iterator[Run]:
    """Append an open row, run the body, append a finish row; an error is recorded and raised again.

    ``names`` are the counters that every finish row has, 0 where the run did not get to them.
    """
    run = Run(names)

    def record(status: str, error: str) -> None:
        row = spark.createDataFrame([(run_id, source, status, run.stats if status != RUNNING else {}, run.labels, error)], _RUN)
        append_rows(row.coalesce(1).withColumn("recorded_at", F.current_timestamp()), path)

    record(RUNNING, "")
    try:
        yield run
    except BaseException as error:
        record(FAILED, f"{type(error).__name__}: {error}"[:2000])
        raise
    record(SUCCEEDED, "")
