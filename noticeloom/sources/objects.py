"""Stored objects: manifest, keys, validity; and the static registry of sources."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import text as T
from noticeloom.operators.staging import several_per_core


#: What Spark's own writers escape in the names of folders, and their name for a missing or empty value.
_ESCAPED = str.maketrans({c: f"%{ord(c):02X}" for c in [*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"]})
_MISSING = "__HIVE_DEFAULT_PARTITION__"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (pafs.LocalFileSystem(), path)


def write_objects(rows: DataFrame, root: str, parts: list[str], line: str, suffix: str = ".txt") -> int:
    """Write rows as lines of one file per object below ``root``, a new shared folder; returns the number of objects.

    ``parts`` name the object; rows of one object must follow each other in one task. All parts but the last are
    folders, the last is in the name of the file, so that there are not as many folders to make and to list as
    objects. A file takes its name when it is whole; an attempt that is lost leaves hidden files only.
    """
    system, folder = _store(root)
    system.create_dir(folder, recursive=True)
    label = lambda c, v: f"{c}={str(v).translate(_ESCAPED) if v not in (None, '') else _MISSING}"

    def store(batches):
        system, folder = _store(root)
        task, attempt, made = TaskContext.get().partitionId(), uuid.uuid4().hex, set()
        last, out, objects, hidden, name = None, None, 0, "", ""

        def finish():
            out.close()
            if system.get_file_info(name).type == pafs.FileType.NotFound:
                system.move(hidden, name)
            else:  # another attempt of this task was first
                system.delete_file(hidden)

        for batch in batches:
            for *key, text in zip(*(column.to_pylist() for column in batch.columns)):
                if key != last:
                    if out:
                        finish()
                    *above, below = map(label, parts, key)
                    at = "/".join([folder, *above])
                    if at not in made:
                        system.create_dir(at, recursive=True)
                        made.add(at)
                    hidden, name = f"{at}/.{attempt}-{objects}", f"{at}/{below}.part-{task:05d}-{objects:06d}{suffix}"
                    last, out, objects = key, system.open_output_stream(hidden, compression=None), objects + 1
                out.write((text or b"") + b"\n")
        if out:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([objects], pa.int64())], names=["objects"])

    return rows.select(*parts, F.col(line).cast("binary")).mapInArrow(store, "objects long").agg(F.sum("objects")).first()[0] or 0


def read_objects(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Landed files as rows (path, modificationTime, length, content).

    Spark counts the opening of a file like megabytes, which gives thousands of tasks with a few small files each.
    They are put together, so that a task reads about the bytes of a split; no more of them than cores need.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(path))
    size = int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return files.coalesce(max(several_per_core(spark), -(-size // split)))


def manifest(objects: DataFrame, key: str, content: str, keep: list[str]) -> DataFrame:
    """Key, digest and size of each object."""
    return objects.select(*keep, F.col(key).alias("object_key"), F.sha2(F.col(content), 256).alias("sha256"),
                          F.octet_length(F.col(content)).cast("bigint").alias("size_bytes"))


def hash_mismatches(found: DataFrame, expected: DataFrame) -> DataFrame:
    """Objects whose digest differs from the one expected for their key."""
    want = expected.select("object_key", F.col("sha256").alias("expected_sha256")).distinct()
    return found.join(want, "object_key").where(F.col("sha256") != F.col("expected_sha256"))


def attachment_key(agency, seq, fallback_seq, file_seq, filename, prefix: str = "originals") -> Column:
    """Object key of an attachment; missing parts have stand-ins."""
    return F.concat_ws("/", F.lit(prefix), _agency(agency), _seq(seq, fallback_seq),
                       F.concat(T_or(file_seq, "0"), F.lit("-"), T.sanitize_filename(filename)))


def preview_key(agency, seq, fallback_seq, file_seq, prefix: str = "previews") -> Column:
    return F.concat_ws("/", F.lit(prefix), _agency(agency), _seq(seq, fallback_seq),
                       F.concat(T_or(file_seq, "0"), F.lit("-preview.html")))


def T_or(c, default: str) -> Column:
    return F.coalesce(F.nullif(T.trim_ws(c), F.lit("")), F.lit(default))


def _agency(c) -> Column:
    return T_or(F.lower(T._col(c)), "unknown")


def _seq(seq, fallback) -> Column:
    return F.coalesce(F.nullif(T.trim_ws(seq), F.lit("")), F.nullif(T.trim_ws(fallback), F.lit("")), F.lit("unknown"))


def is_valid_key(key) -> Column:
    """Empty, absolute and escaping keys are invalid."""
    key = T.trim_ws(key)
    return F.coalesce((key != "") & ~key.startswith("/") & ~key.contains("../") & (key != ".."), F.lit(False))


def split_by_key_validity(objects: DataFrame, key: str = "object_key") -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined)."""
    return objects.where(is_valid_key(key)), objects.where(~is_valid_key(key))


def board_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.BOARDS, "agency string, board_kind string, name string, base_url string, "
                                               "list_path string, view_path string")


def application_registry(spark: SparkSession) -> DataFrame:
    return (spark.createDataFrame(fixed.APPLICATION_LISTS, "supply_type string, name string, path string")
            .withColumn("url", F.concat(F.lit(fixed.APPLICATION_BASE), "path", F.lit("?splyTy="), "supply_type")))


def select_sources(registry: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(registry entries asked for, codes asked for that the registry lacks).

    The registry is a fixed list, so broadcasting it is always safe.
    """
    codes = wanted.select(T.trim_ws(key).alias(key)).where(F.col(key) != "").distinct()
    return codes.join(F.broadcast(registry), key), codes.join(F.broadcast(registry), key, "left_anti")
