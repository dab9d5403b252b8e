"""Benchmark decontamination with a broadcast hash set of normalised test n-grams.

Benchmark items are cut into windows of ``width`` consecutive ``ALNUM`` words (an item
with fewer words is one window). Their hashes are broadcast; every token window of
every document is looked up, a hit is verified on the words themselves, and the
verified words are counted or removed.

Broadcast size: windows are dealt into blocks of at most about ``BLOCK_BYTES``. One
block is the usual case; a larger benchmark is scanned block after block, each a map
over the documents, so nothing larger than a block is ever broadcast or collected.

Edge cases: null and word-less texts have no words and no hits; null or word-less
item texts match nothing; an item with a null id hits, but is not among the items; repeated documents give repeated rows; an item id that comes
twice counts once; an empty benchmark hits nothing. Other columns are ignored by
``report`` and kept by ``remove``, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.text import ALNUM, blobs_of, combine, each_words, slices, Words

WIDTH = 10
BLOCK_BYTES = 32 << 20
_BITS = 20


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """Distinct windows: ``item`` (as text), ``n`` words, ``window`` (words joined by blanks)."""

    def cut(batches):
        for batch in slices(batches):
            items, blobs = batch.column(0).to_pylist(), blobs_of(batch.column(1))
            out = []
            for a, _, words in each_words(blobs, ALNUM):
                for i in range(len(words.bounds) - 1):
                    own = [words.word(j) for j in range(words.bounds[i], words.bounds[i + 1])]
                    n = min(width, len(own))
                    out += [(items[a + i], n, b" ".join(own[j:j + n])) for j in range(len(own) - n + 1) if n]
            for k in range(0, len(out), 10_000):
                part = out[k:k + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in part], pa.string()), pa.array([x[1] for x in part], pa.int32()),
                     pa.array([x[2] for x in part], pa.binary())], names=["item", "n", "window"])

    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut, "item string, n int, window binary").distinct()


class WindowSet:
    """Windows of one block: sorted hashes by word count, with texts and items to verify."""

    def __init__(self, rows):
        texts: dict[int, dict[bytes, list[str]]] = defaultdict(lambda: defaultdict(list))
        for n, window, item in rows:
            texts[n][bytes(window)].append(item)
        self.by_width = {}
        for n, windows in texts.items():
            blobs = list(windows)
            words = Words(blobs, ALNUM)
            keys = np.concatenate([combine(words.hashes[a:b], n) for a, b in zip(words.bounds, words.bounds[1:])])
            known = defaultdict(list)
            for k, b in zip(keys.tolist(), blobs):
                known[k].append((b, windows[b]))
            gate = np.zeros(1 << _BITS, bool)
            gate[keys >> np.uint64(64 - _BITS)] = True
            self.by_width[n] = gate, dict(known)

    def hits(self, words: Words):
        """Verified hits: (first word, word count, items)."""
        for n, (gate, known) in self.by_width.items():
            keys = combine(words.hashes, n)
            at = np.flatnonzero(gate[keys >> np.uint64(64 - _BITS)])
            at = at[np.searchsorted(words.bounds, at, "right") == np.searchsorted(words.bounds, at + n - 1, "right")]
            for i, k in zip(at.tolist(), keys[at].tolist()):
                found = known.get(k)
                if found:
                    text = b" ".join(words.word(j) for j in range(i, i + n))
                    for window, items in found:
                        if window == text:
                            yield i, n, items


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, width: int, block_bytes: int) -> list:
    """Broadcast window sets; every block is bounded, and so is their number by the benchmark's size."""
    spark = benchmark.sparkSession
    windows = item_windows(benchmark, item_col, text_col, width)
    total = windows.agg(F.sum(F.length("window") + F.coalesce(F.length("item"), F.lit(0)) + 200)).first()[0] or 0
    count = -(-total // block_bytes)
    return [spark.sparkContext.broadcast(WindowSet(
        windows.where(F.pmod(F.xxhash64("window"), F.lit(count)) == k).select("n", "window", "item").toLocalIterator()))
        for k in range(count)]


_SCAN = "key long, n_words long, spans array<int>, items array<string>"


def scan(keyed: DataFrame, blocks: list) -> DataFrame:
    """Per row of ``keyed`` (key, text): ``spans`` (first, end word of merged hits, flat) and ``items``.

    Several blocks are applied one after the other to the same rows.
    """
    ints, strings = pa.list_(pa.int32()), pa.list_(pa.string())

    def make(block, last):
        def run(batches):
            for batch in slices(batches):
                blobs = blobs_of(batch.column(1))
                old_spans, old_items = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                sizes, spans, items = [0] * len(blobs), list(old_spans), list(old_items)
                for a, _, words in each_words(blobs, ALNUM):
                    found = defaultdict(list)
                    for i, n, its in block.value.hits(words) if block else ():
                        found[int(np.searchsorted(words.bounds, i, "right")) - 1].append((i, n, its))
                    for d, size in enumerate(np.diff(words.bounds).tolist()):
                        sizes[a + d] = size
                        if d in found:
                            base = int(words.bounds[d])
                            spans[a + d] = merged(spans[a + d], [(i - base, i - base + n) for i, n, _ in found[d]])
                            items[a + d] = sorted({*items[a + d], *(x for *_, its in found[d] for x in its if x is not None)})
                out = [batch.column(0), pa.array(sizes, pa.int64()) if last else batch.column(1), pa.array(spans, ints), pa.array(items, strings)]
                yield pa.RecordBatch.from_arrays(out, names=["key", "n_words" if last else "text", "spans", "items"])
        return run

    rows = keyed.select("key", "text", F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"))
    for block in blocks[:-1]:
        rows = rows.mapInArrow(make(block, False), "key long, text string, spans array<int>, items array<string>")
    return rows.mapInArrow(make(blocks[-1] if blocks else None, True), _SCAN)


def merged(flat: list[int], new: list[tuple[int, int]]) -> list[int]:
    """Union of word ranges as a flat sorted list."""
    out: list[int] = []
    for a, b in sorted([*zip(flat[0::2], flat[1::2]), *new]):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated, spans."""
    keyed = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text"))
    found = scan(keyed, _blocks(benchmark, item_col, item_text_col, width, block_bytes))
    total = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select(
        F.col("key").alias("doc_id"), "n_words", total.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "spans")


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           width: int = WIDTH, drop_share: float = 1.0, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without the hit words.

    A removed span goes from its first to its last word; the rest of the text stays as it
    is. A document whose hit words make up at least ``drop_share`` of its words goes
    whole; with the default only one that has nothing else. All columns are kept.
    """
    blocks = _blocks(benchmark, item_col, item_text_col, width, block_bytes)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in slices(batches):
            blobs = blobs_of(batch.column(at))
            texts, keep = batch.column(at).to_pylist(), [True] * len(blobs)
            for a, _, words in each_words(blobs, ALNUM):
                found = defaultdict(list)
                for block in blocks:
                    for i, n, _ in block.value.hits(words):
                        found[int(np.searchsorted(words.bounds, i, "right")) - 1].append((i, i + n))
                for d, new in found.items():
                    spans = merged([], new)
                    hit = sum(spans[1::2]) - sum(spans[0::2])
                    keep[a + d] = hit < drop_share * (words.bounds[d + 1] - words.bounds[d])
                    base, raw, out, done = int(words.text_starts[d]), blobs[a + d], [], 0
                    for x, y in zip(spans[0::2], spans[1::2]):
                        out.append(raw[done:int(words.starts[x]) - base])
                        done = int(words.ends[y - 1]) - base
                    texts[a + d] = b"".join([*out, raw[done:]]).decode("utf-8", "replace")
            columns = [*batch.columns]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
