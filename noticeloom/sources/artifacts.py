"""Evidence artifacts: text artifacts, sheet rows, unsupported inputs, table sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import text as T
from noticeloom.operators.staging import explode_rows


def text_artifacts(df: DataFrame, text: str, span, artifact_type, extractor, keep: list[str]) -> DataFrame:
    """Text artifacts; unreadable (null) texts still yield a row with status and reason."""
    clean = F.replace(F.col(text), F.lit("\x00"), F.lit(""))
    ok = F.col(text).isNotNull()
    return df.select(
        *keep,
        F.when(ok, T._col(artifact_type)).otherwise(F.lit(fixed.ART_HWP_UNSUPPORTED)).alias("artifact_type"),
        F.when(ok, T._col(extractor)).otherwise(F.lit("unsupported")).alias("extractor"),
        F.when(ok, F.lit(fixed.STATUS_EXTRACTED)).otherwise(F.lit(fixed.STATUS_UNSUPPORTED)).alias("status"),
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
        T._col(span).alias("source_span"),
        F.coalesce(clean, F.lit("")).alias("raw_text"),
        F.coalesce(F.length(clean), F.lit(0)).cast("bigint").alias("chars"),
        F.when(ok, F.lit(fixed.CONF_TEXT)).otherwise(F.lit(0.0)).alias("confidence"),
        F.when(ok, F.lit("")).otherwise(F.lit(fixed.UNSUPPORTED_REASON)).alias("error_text"))


def clean_cells(cells: Column) -> Column:
    return F.transform(cells, T.collapse_ws)


def sheet_rows(sheets: DataFrame, object_key: str, sheet: str, rows: str) -> DataFrame:
    """Landed sheets (array of cell arrays) → one artifact per row, numbered from 1."""
    exploded = explode_rows(sheets, [object_key, sheet], rows, "_at", "_cells")
    return exploded.select(
        object_key, sheet, (F.col("_at") + 1).alias("row_no"), clean_cells(F.col("_cells")).alias("cells"),
        T.sheet_span(object_key, sheet, F.col("_at") + 1).alias("source_span"))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet sink; only the partitions present in ``df`` are replaced.

    Rows of one partition value come from many tasks, so a hot value does not
    funnel through one writer.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append") -> None:
    """Optional relational sink through Spark's JDBC writer."""
    df.write.jdbc(url, table, mode=mode, properties=properties)
