"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_ZONE = "Asia/Seoul"


def build_session(app: str = "noticeloom", master: str | None = None, partitions: int | None = None,
                  zone: str = LOCAL_ZONE) -> SparkSession:
    """A session with the settings the jobs rely on.

    AQE coalesces small shuffle partitions and splits skewed join partitions, so
    ``partitions`` is an upper bound to size for the cluster, not a tuned number.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    On a cluster that setting must name shared storage. A local master falls
    back to a temporary folder, because there every task sees it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="noticeloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df, purpose: str = "stage"):
    """Write ``df`` to shared storage and read it back, so that a lost executor
    costs a re-read and not a re-run of everything upstream."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession):
    """Inside, a job's shuffle files are deleted when it has ended, and not when the driver happens to collect garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
