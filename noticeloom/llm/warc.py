"""WARC archives: a deterministic sharded writer and a reader.

Writing: every page becomes one record; its headers, record id and digests are made
anew from the row, and the date is a parameter, so equal input gives equal bytes. Records
are range-sorted by shard, then by a hash of the page id, the id and the digest. Shards cut
the hash range evenly, as many as the payload bytes ask for, so neither hosts nor runs of
ids make a large one. A task streams its records into gzip members, rolling to the next
file of the shard when the compressed size is reached. Files are written under temporary
names that no other attempt uses; the names the successful attempts return are moved to
their final names, and a manifest, moved into place last, says which files belong to the
archive. A job that dies leaves no manifest; attempts that were lost leave only files
that no manifest names.

Of records with equal payloads of at least ``min_bytes``, the one with the largest page id
is the ``response`` and the others are ``revisit`` records of it, without the payload.

Edge cases: null html is the empty payload; a null url gets an urn of the page; control
bytes in urls are percent-encoded; a null page id is written as an empty id and read back
as null; repeated rows with one id and payload give one response and revisits of
the same id; an empty table gives an empty archive; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeloom.session import cut_lineage, scratch_dir

MIN_BYTES = 1000
ROLL_BYTES = 1 << 30
#: Digests of repeated payloads that may be broadcast: rows of about 60 bytes.
BROADCAST_ROWS = 500_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "file string, records long, compressed_bytes long"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (pafs.LocalFileSystem(), path)


def _split_bytes(spark: SparkSession) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))


def plan_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """page_id, url, html, payload_bytes, digest, refers_to (null for responses)."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha1("html"))
    # a repeat of one row is told from its first copy only below, in the writer
    winners = cut_lineage(rows.where(F.col("payload_bytes") >= min_bytes).groupBy("digest")
                          .agg(F.max("page_id").alias("winner"), F.count("*").alias("n")).where("n > 1").select("digest", "winner"), "warc-winners")
    small = winners.count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(winners) if small else winners, "digest", "left")
    return joined.withColumn("again", F.col("winner").isNotNull()).withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("winner")), F.col("winner"))).drop("winner")


def record_bytes(page_id, url, html: bytes, digest_hex: str, refers_to, revisit: bool, date: str) -> bytes:
    """One record: WARC headers, the HTTP head, and the payload where it is a response."""
    name = lambda page: f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{page}:{digest_hex}'.encode()).digest()[:16])}>"
    tag = lambda digest: "sha1:" + base64.b32encode(digest).decode()
    target = "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{'' if page_id is None else page_id}"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    block = head if revisit else head + html
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(page_id)), ("WARC-Date", date), ("WARC-Target-URI", target),
              ("WARC-Payload-Digest", tag(bytes.fromhex(digest_hex))), ("WARC-Block-Digest", tag(hashlib.sha1(block).digest())),
              ("X-Page-Id", "" if page_id is None else str(page_id))]
    if revisit:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", name(refers_to)), ("X-Refers-To-Page-Id", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


class _Rolling:
    """The open file of a shard; rolls by compressed size."""

    def __init__(self, root: str, attempt: str, roll_bytes: int):
        self.root, self.attempt, self.roll_bytes, self.file = root, attempt, roll_bytes, None
        self.shard, self.number, self.done = None, 0, []

    def add(self, shard: int, record: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(record) + packer.flush()
        if shard != self.shard:
            self.close()
            self.shard, self.number = shard, 0
        elif self.file and self.size + len(member) > self.roll_bytes:
            self.close()
            self.number += 1
        if self.file is None:
            self.name, self.size, self.count = f"part-{self.shard:06d}-{self.number:04d}.warc.gz", 0, 0
            system, folder = _open(f"{self.root}/_temporary")
            system.create_dir(folder, recursive=True)
            self.file = system.open_output_stream(f"{folder}/{self.name}.{self.attempt}", compression=None)
        self.file.write(member)
        self.size, self.count = self.size + len(member), self.count + 1

    def close(self) -> None:
        if self.file:
            self.file.close()
            self.done.append((self.name, f"{self.name}.{self.attempt}", self.count, self.size))
            self.file = None


def write(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES,
          shard_bytes: int | None = None, roll_bytes: int = ROLL_BYTES, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write the archive below ``root`` (a new shared folder) and return its manifest.

    ``shard_bytes`` are payload bytes per shard, by default the session's
    ``spark.sql.files.maxPartitionBytes``.
    """
    spark = pages.sparkSession
    rows = plan_records(pages, id_col, url_col, html_col, min_bytes)
    total = pages.agg(F.sum(F.octet_length(F.col(html_col).cast("string")))).first()[0] or 0
    shards = max(1, -(-total // (shard_bytes or _split_bytes(spark))))
    key = F.pmod(F.xxhash64("page_id", "digest"), F.lit(1 << 40))
    rows = rows.withColumn("place", key).withColumn("shard", F.floor(F.col("place") * shards / (1 << 40)).cast("int"))
    ordered = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "place", "page_id", "digest", "url")

    def pack(batches) -> Iterator[pa.RecordBatch]:
        out, last = _Rolling(root, f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}", roll_bytes), None
        for batch in batches:
            for page_id, url, html, digest, refers_to, again, shard in zip(*(batch.column(i).to_pylist() for i in range(7))):
                payload = html.encode()
                repeat = again and (page_id, digest) == last  # the first of equal rows is the response
                last = page_id, digest
                out.add(shard, record_bytes(page_id, url, payload, digest, page_id if repeat and refers_to is None else refers_to, refers_to is not None or repeat, date))
        out.close()
        columns = zip(*out.done) if out.done else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                         names=["file", "temporary", "records", "compressed_bytes"])

    packed = cut_lineage(ordered.select("page_id", "url", "html", "digest", "refers_to", "again", "shard")
                         .mapInArrow(pack, "file string, temporary string, records long, compressed_bytes long"), "warc-packed")

    def commit(batches):
        for batch in batches:
            for name, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, folder = _open(root)
                if system.get_file_info(f"{folder}/_temporary/{temporary}").type == pafs.FileType.File:
                    system.move(f"{folder}/_temporary/{temporary}", f"{folder}/{name}")
                elif system.get_file_info(f"{folder}/{name}").type != pafs.FileType.File:
                    raise FileNotFoundError(name)
            yield batch.select([0, 2, 3])

    packed.mapInArrow(commit, _MANIFEST).write.parquet(f"{root}/_manifest.tmp")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    source = hadoop(f"{root}/_manifest.tmp")
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, hadoop(f"{root}/_manifest")):
        raise OSError(f"the manifest of {root} cannot be moved into place")
    return spark.read.schema(_MANIFEST).parquet(f"{root}/_manifest")


def records_in(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a gzip stream with a member per record."""
    rest, unpacker, data = b"", zlib.decompressobj(31), io.BytesIO()
    while rest or (rest := stream.read(1 << 16)):
        data.write(unpacker.decompress(rest))
        rest = unpacker.unused_data
        if unpacker.eof:
            raw = data.getvalue()
            head, _, body = raw.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            length = int(fields["Content-Length"])
            if len(body) != length + 4:
                raise ValueError(f"record {fields.get('WARC-Record-ID')} is damaged")
            yield fields, body[:length]
            unpacker, data = zlib.decompressobj(31), io.BytesIO()
    if data.tell():
        raise ValueError("the last record is cut off")


def _spread(files: DataFrame) -> DataFrame:
    """The manifest's file names, one to a task. AQE would put a column of a few bytes in one."""
    many = files.count()
    number = F.row_number().over(Window.orderBy("file")) - 1  # one row per file
    return files.select("file", number.alias("number")).repartitionById(max(1, many), "number").select("file")


def read(spark: SparkSession, root: str, with_payload: bool = False) -> DataFrame:
    """Records of the files that the manifest names, digests checked.

    Columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and the
    payload (null for revisits) if asked for.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64())] + ([("payload", pa.binary())] if with_payload else [])
    layout = pa.schema(fields)

    def unpack(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, folder = _open(root)
                with system.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    rows, size = [], 0
                    for head, block in records_in(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = base64.b32decode(head["WARC-Payload-Digest"][5:])
                        kind = head["WARC-Type"]
                        if base64.b32decode(head["WARC-Block-Digest"][5:]) != hashlib.sha1(block).digest() or kind == "response" and digest != hashlib.sha1(payload).digest():
                            raise ValueError(f"record {head['WARC-Record-ID']} has another digest")
                        number = lambda key: int(head[key]) if head.get(key) else None
                        told = int(http.rsplit(b"Content-Length: ", 1)[1])
                        rows.append((number("X-Page-Id"), head["WARC-Target-URI"], told, digest.hex(), kind, number("X-Refers-To-Page-Id"),
                                     *([payload if kind == "response" else None] if with_payload else [])))
                        size += len(block) if with_payload else 100
                        if len(rows) >= 5000 or size > 1 << 24:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), layout)], schema=layout)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), layout)], schema=layout)

    return _spread(spark.read.schema(_MANIFEST).parquet(f"{root}/_manifest").select("file")).mapInArrow(unpack, schema + (", payload binary" if with_payload else ""))


def new_archive(spark: SparkSession) -> str:
    return scratch_dir(spark, "warc")
