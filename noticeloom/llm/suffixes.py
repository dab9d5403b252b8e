"""Repeated passages by sparse suffix arrays.

A passage is ``LENGTH`` or more consecutive ``ALNUM`` words. It repeats where its words stood
before: in a document with a smaller id, or earlier in the same one. Every word that lies
in a repeated passage, and no other, is reported, with the place of an earlier copy.

Suffixes are kept only at minimisers: every window of ``LENGTH`` words selects its least run
of ``GRAM`` words, so equal windows select equal places. The windows that select one place
form its block, the part of the text that is compared around it. Suffixes are sorted over
all documents by their leading run, then by their block, and neighbours are compared:

* nobody shares the leading run: nothing around it repeats, the suffix is dropped;
* the neighbour has the same block: the whole block repeats, its copy is the neighbour's;
* the run is shared, but blocks differ: the match is extended left and right, word by
  word, by comparing all windows of these blocks alone by their hashes.

A run of equal suffixes, however long, is split over tasks by the sort; tasks hold one
row of it, and what they cannot see at their borders is settled from their first and last
rows (two per task). Windows meet in aggregates with map-side combine.

Edge cases: null and short texts have no passage; a row with a null id takes no part; rows
that share id and text are one document; an empty table gives an empty result; other
columns are ignored by ``passages`` and kept by ``remove``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.text import ALNUM, blobs_of, combine, each_words, mix, slices, Words
from noticeloom.session import cut_lineage

LENGTH, GRAM = 50, 8
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))

_SUFFIX = "gram long, block long, doc_id long, copy long, place int, lo int, hi int"
_KEYS = ["gram", "block", "doc_id", "copy", "place"]


class RangeHashes:
    """Hashes of word ranges from running sums of weighted word hashes."""

    def __init__(self, words: Words):
        n = len(words.hashes)
        with np.errstate(over="ignore"):
            up, self.down = (np.multiply.accumulate(np.append(np.uint64(1), np.full(n, x))) for x in (_BASE, _BACK))
            self.sums = np.append(np.uint64(0), np.cumsum(words.hashes * up[:n], dtype=np.uint64))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def blocks_of(words: Words, length: int, gram: int):
    """(text, gram hash, place, first and last window) of every selected place."""
    grams = combine(words.hashes, gram)
    width = length - gram + 1
    for d in range(len(words.bounds) - 1):
        a, b = int(words.bounds[d]), int(words.bounds[d + 1])
        if b - a < length:
            continue
        own = grams[a:b - gram + 1]
        least = np.lib.stride_tricks.sliding_window_view(own, width).argmin(1) + np.arange(len(own) - width + 1)
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        yield d, own[least[first]], least[first], first, np.append(first[1:], len(least)) - 1


def suffixes(rows: DataFrame, length: int, gram: int) -> DataFrame:
    layout = pa.schema([("gram", pa.int64()), ("block", pa.int64()), ("doc_id", pa.int64()), ("copy", pa.int64()), ("place", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])

    def run(batches):
        for batch in slices(batches):
            ids, copies = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, _, words in each_words(blobs_of(batch.column(2)), ALNUM):
                ranges, parts = RangeHashes(words), []
                for d, keys, place, lo, hi in blocks_of(words, length, gram):
                    at = int(words.bounds[d])
                    block = mix(ranges.of(at + lo, at + hi + length) + (place - lo).astype(np.uint64))
                    parts.append((keys.view(np.int64), block.view(np.int64), np.full(len(lo), ids[a + d]), np.full(len(lo), copies[a + d]), place, lo, hi))
                if parts:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[k] for p in parts]).astype(f.type.to_pandas_dtype())) for k, f in enumerate(layout)], schema=layout)

    return rows.mapInArrow(run, _SUFFIX)


_TOLD = "doc_id long, copy long, lo int, hi int, kind string, source_id long, source_lo int, task int, gram long, block long, place int"


def compare_neighbours(ordered: DataFrame) -> DataFrame:
    """What the sort shows: rows of kind ``same`` (an equal block stands before), ``edge`` (only the
    run is shared), and the ``first`` and ``last`` row of every task, with the first of the last run as source."""

    def run(batches):
        task, told, last, start, alone, any_row = TaskContext.get().partitionId(), [], None, None, True, False

        def tell(row, kind, source=None):
            told.append((row[2], row[3], row[5], row[6], kind, source[2] if source else None, source[5] if source else None, task, row[0], row[1], row[4]))

        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if last is None:
                    tell(row, "first")
                elif row[:5] == last[:5]:
                    continue  # one document that comes twice
                same_gram = last is not None and row[0] == last[0]
                if same_gram and row[1] == last[1]:
                    tell(row, "same", start)
                    last = row
                    continue
                if same_gram:
                    if alone:
                        tell(start, "edge")
                    tell(row, "edge")
                alone, start, last = not same_gram, row, row
            if told:
                yield batch_of(told)
                told = []
        if last is not None:
            tell(start, "start")
            tell(last, "last", start)
            yield batch_of(told)

    def batch_of(told):
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
        names = [x.split()[0] for x in _TOLD.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*told), types)], names=names)

    return ordered.mapInArrow(run, _TOLD)


def border_rows(told: DataFrame) -> list[tuple]:
    """What the tasks could not see: ``same`` and ``edge`` rows found between the last rows of a task and the first
    of the next. Two or three rows of every task come to the driver."""
    ends: dict[int, dict] = {}
    for r in told.where(F.col("kind").isin("first", "start", "last")).collect():
        ends.setdefault(r["task"], {})[r["kind"]] = r
    out, before = [], None
    for task in sorted(ends):
        here = ends[task]
        if before is not None and before["last"]["gram"] == here["first"]["gram"]:
            one, two = before["start"], here["first"]
            if before["last"]["block"] == two["block"]:
                if (before["last"]["doc_id"], before["last"]["copy"], before["last"]["place"]) != (two["doc_id"], two["copy"], two["place"]):
                    out.append((two["doc_id"], two["copy"], two["lo"], two["hi"], "same", one["doc_id"], one["lo"]))
            else:
                out += [(x["doc_id"], x["copy"], x["lo"], x["hi"], "edge", None, None) for x in (one, two)]
        before = here
    return out


def windows_of(edges: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """All windows of the given blocks: hash, doc_id, copy, place."""
    lists = edges.groupBy("doc_id", "copy").agg(F.collect_set(F.struct("lo", "hi")).alias("blocks"))  # bounded by the text's length
    layout = pa.schema([("hash", pa.int64()), ("doc_id", pa.int64()), ("copy", pa.int64()), ("place", pa.int32())])

    def run(batches):
        for batch in slices(batches):
            ids, copies, blocks = (batch.column(k).to_pylist() for k in (0, 1, 3))
            for a, _, words in each_words(blobs_of(batch.column(2)), ALNUM):
                ranges, parts = RangeHashes(words), []
                for d in range(len(words.bounds) - 1):
                    at = np.unique(np.concatenate([np.arange(x["lo"], x["hi"] + 1) for x in blocks[a + d]])) + int(words.bounds[d])
                    parts.append((ranges.of(at, at + length).view(np.int64), np.full(len(at), ids[a + d]), np.full(len(at), copies[a + d]), (at - int(words.bounds[d])).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[k] for p in parts]).astype(f.type.to_pandas_dtype())) for k, f in enumerate(layout)], schema=layout)

    named = rows.join(lists, ["doc_id", "copy"]).select("doc_id", "copy", "text", "blocks")
    return named.mapInArrow(run, "hash long, doc_id long, copy long, place int")


_PASSAGE = "doc_id long, copy long, first_word int, n_words int, source_id long, source_word int"


def joined(pieces: DataFrame) -> DataFrame:
    """Pieces (doc_id, copy, lo, hi, source_id, source_lo; words ``lo:hi``) of one diagonal that touch become one passage."""

    def run(batches):
        key, start, end, done = None, 0, 0, []
        for batch in slices(batches):
            for doc_id, copy, source, shift, lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
                if (doc_id, copy, source, shift) != key or lo > end:
                    if key:
                        done.append((key[0], key[1], start, end - start, key[2], start + key[3]))
                    key, start, end = (doc_id, copy, source, shift), lo, hi
                end = max(end, hi)
            yield batch_of(done)
            done = []
        if key:
            yield batch_of([(key[0], key[1], start, end - start, key[2], start + key[3])])

    def batch_of(done):
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], t) for k, t in enumerate(types)], names=[x.split()[0] for x in _PASSAGE.split(", ")])

    ordered = pieces.select("doc_id", "copy", "source_id", (F.col("source_lo") - F.col("lo")).alias("shift"), "lo", "hi")
    return ordered.repartition("doc_id", "copy", "source_id", "shift").sortWithinPartitions("doc_id", "copy", "source_id", "shift", "lo").mapInArrow(run, _PASSAGE)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, copy (tells rows with one id and different texts apart), text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text")).where("doc_id is not null")


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per repeated passage: doc_id, copy, first_word, n_words, source_id, source_word.

    Passages of one document may overlap where they have different sources.
    """
    spark, rows = docs.sparkSession, keyed(docs, id_col, text_col)
    kept = cut_lineage(suffixes(rows, length, gram), "suffixes")
    ordered = kept.repartitionByRange(*_KEYS).sortWithinPartitions(*_KEYS)
    told = cut_lineage(compare_neighbours(ordered), "suffix-neighbours")
    columns = ["doc_id", "copy", "lo", "hi", "kind", "source_id", "source_lo"]
    border = spark.createDataFrame(border_rows(told), "doc_id long, copy long, lo int, hi int, kind string, source_id long, source_lo int")
    told = told.where(F.col("kind").isin("same", "edge")).select(*columns).unionByName(border)

    windows = cut_lineage(windows_of(told.where("kind = 'edge'"), rows, length).dropDuplicates(["hash", "doc_id", "copy", "place"]), "suffix-windows")
    firsts = windows.groupBy("hash").agg(F.min(F.struct("doc_id", "copy", "place")).alias("f"), F.count("*").alias("n")).where("n > 1").select("hash", "f")
    later = windows.join(firsts, "hash").where(F.struct("doc_id", "copy", "place") != F.col("f"))
    ends = (F.col("hi") + length).alias("hi")
    pieces = told.where("kind = 'same'").select("doc_id", "copy", "lo", ends, "source_id", "source_lo").unionByName(
        later.select("doc_id", "copy", F.col("place").alias("lo"), (F.col("place") + length).alias("hi"), F.col("f.doc_id").alias("source_id"), F.col("f.place").alias("source_lo")))
    return joined(pieces)


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The documents without their repeated passages; the first copy of a passage stays.

    A removed span goes from its first to its last word. A document that has no word left
    goes. All columns are kept.
    """
    found = passages(docs, id_col, text_col, length, gram)
    spans = found.groupBy(F.col("doc_id").alias("_doc"), F.col("copy").alias("_copy")).agg(F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("_spans"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    joined_rows = docs.join(spans, (F.col(id_col).cast("long") == F.col("_doc")) & (F.xxhash64(text) == F.col("_copy")), "left").select(*[docs[c] for c in docs.columns], "_spans")
    at, last = docs.columns.index(text_col), len(docs.columns)

    def run(batches):
        for batch in slices(batches):
            texts, spans, keep = batch.column(at).to_pylist(), batch.column(last).to_pylist(), []
            for i, cut in enumerate(spans):
                if not cut:
                    keep.append(True)
                    continue
                raw = texts[i].encode()
                words = Words([raw], ALNUM)
                out, done, gone, end = [], 0, 0, 0
                for x in cut:
                    a, b = max(end, x["first_word"]), x["first_word"] + x["n_words"]
                    if b <= a:
                        continue
                    out.append(raw[done:max(done, int(words.starts[a]))])
                    done, end, gone = int(words.ends[b - 1]), b, gone + b - a
                texts[i] = b"".join([*out, raw[done:]]).decode("utf-8", "replace")
                keep.append(gone < len(words.hashes))
            columns = [pa.array(texts, batch.schema.field(k).type) if k == at else batch.column(k) for k in range(last)]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([batch.schema.field(k) for k in range(last)])).filter(pa.array(keep, pa.bool_()))

    return joined_rows.mapInArrow(run, docs.schema)
