"""Quality classifier: a generalised additive model with pairwise interactions.

A text becomes a row of counted features (``FEATURES``), each cut into quantile bins.
Shallow trees are boosted in turn, feature after feature, on the logistic loss; as every
tree looks at one feature, the sum of its trees is a lookup table per feature. Then trees
on two features are boosted for the pairs whose grids explain most of what is left. A
text is scored by adding the table entries of its bins.

Fitting takes a bounded sample of about ``SAMPLE`` labelled rows, chosen by a hash of the
id; only their feature rows come to the driver. Every document is scored whole.

Null and empty texts have the features of the empty text and are scored like all others;
null labels are not learned from, several labels of one id count by their mean; without
labels the score is 0.5; repeated rows give repeated rows; an empty table gives an
empty result; other columns are ignored by ``predict`` and kept by ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.text import blobs_of, chunks, slices, SPACED, Words

SAMPLE, THRESHOLD = 20_000, 0.7
BINS, GRID, ROUNDS, PAIR_ROUNDS, PAIRS, RATE = 64, 12, 120, 40, 6, 0.15
LEAVES, LEAST_ROWS = 4, 20

FEATURES = ("bytes", "words", "word_bytes", "longest_word", "upper", "digit", "symbol", "punctuation", "wide", "lines", "line_words",
            "short_lines", "repeated_lines", "distinct_words", "commonest_word", "odd_ends", "stop_marks", "blank", "bars", "marked_words")


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, np.float64)
    table[np.frombuffer(chars.encode(), np.uint8)] = 1
    return table


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _class("0123456789")
_SYMBOL = _class("!#$%&*+/<=>@\\^_`{|}~")
_POINT = _class(".,;:?'\"()-")
_STOP = _class(".?!")
_BAR = _class("|{}[]<>")
_WIDE = np.repeat([0.0, 1.0], 128)
_BLANK = _class(" \t\n\v\f\r")
_LETTERS = np.maximum(_class("abcdefghijklmnopqrstuvwxyz0123456789"), _WIDE)


def features(blobs: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    out = np.zeros((len(blobs), len(FEATURES)))
    for a, b in chunks(blobs):
        out[a:b] = _features(blobs[a:b])
    return out


def _features(blobs: list[bytes]) -> np.ndarray:
    seen = Words(blobs, SPACED)
    raw = np.frombuffer(b" ".join(blobs) + b" ", np.uint8)
    size = np.fromiter(map(len, blobs), np.float64, len(blobs))
    at = seen.text_starts
    per_text = lambda table: np.add.reduceat(table[raw], at)
    share = lambda x, of: x / np.maximum(of, 1)
    n = np.diff(seen.bounds).astype(np.float64)
    owner = np.repeat(np.arange(len(blobs)), np.diff(seen.bounds))
    lengths = (seen.ends - seen.starts).astype(np.float64)
    add = lambda x: np.bincount(owner, x, len(blobs))
    longest = np.zeros(len(blobs))
    np.maximum.at(longest, owner, lengths)
    odd = 1 - _LETTERS[seen.low[seen.ends - 1]] if len(lengths) else lengths
    marked = _SYMBOL[raw[seen.ends - 1]] if len(lengths) else lengths

    order = np.lexsort((seen.hashes, owner))
    h, o = seen.hashes[order], owner[order]
    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (o[1:] != o[:-1]))) if len(h) else np.zeros(0, np.int64)
    runs = np.diff(np.append(new, len(h)))
    distinct = np.bincount(o[new], minlength=len(blobs)).astype(np.float64)
    common = np.zeros(len(blobs))
    np.maximum.at(common, o[new], runs)

    lines = [[x for x in t.split(b"\n") if x] for t in blobs]
    n_lines = np.array([len(x) for x in lines], np.float64)
    repeated = np.array([len(x) - len(set(x)) for x in lines], np.float64)
    short = np.array([sum(len(y) < 30 for y in x) for x in lines], np.float64)
    columns = (np.log1p(size), np.log1p(n), share(add(lengths), n), longest, share(per_text(_UPPER), size), share(per_text(_DIGIT), size), share(per_text(_SYMBOL), size),
               share(per_text(_POINT), size), share(per_text(_WIDE), size), np.log1p(n_lines), share(n, n_lines), share(short, n_lines), share(repeated, n_lines),
               share(distinct, n), share(common, n), share(add(odd), n), share(per_text(_STOP), n), share(per_text(_BLANK) - 1, size), share(per_text(_BAR), size), share(add(marked), n))
    return np.stack(columns, 1)


def edges_of(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(column) else column


def tree(gain: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """A tree over ordered bins: cut where it helps most, one leaf after another; Newton steps as values."""
    g, h = np.concatenate(([0], np.cumsum(gain))), np.concatenate(([0], np.cumsum(weight)))
    parts = [(0, len(gain))]

    def value(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)

    def best(a, b):
        if b - a < 2:
            return 0.0, a
        cuts = np.arange(a + 1, b)
        got = (g[cuts] - g[a]) ** 2 / (h[cuts] - h[a] + 1.0) + (g[b] - g[cuts]) ** 2 / (h[b] - h[cuts] + 1.0) - value(a, b)
        got[(h[cuts] - h[a] < 1e-3 * LEAST_ROWS) | (h[b] - h[cuts] < 1e-3 * LEAST_ROWS)] = 0
        k = int(got.argmax())
        return float(got[k]), int(cuts[k])

    for _ in range(leaves - 1):
        found = max(((*best(a, b), a, b) for a, b in parts), key=lambda x: x[0])
        if found[0] <= 1e-9:
            break
        _, cut, a, b = found
        parts.remove((a, b))
        parts += [(a, cut), (cut, b)]
    out = np.zeros(len(gain))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def tree_of_two(gain: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree over a grid: one cut of the first feature, then one of the second on either side, or the other way round."""
    def cut_rows(g, h):
        rows = tree(g.sum(1), h.sum(1), 2)
        groups = np.cumsum(np.append(0, np.diff(rows) != 0))
        out = np.zeros_like(g)
        for k in np.unique(groups):
            own = groups == k
            out[own] = tree(g[own].sum(0), h[own].sum(0), 2)
        return out

    worth = lambda t: float((t * gain).sum() - 0.5 * (t * t * weight).sum())
    return max((cut_rows(gain, weight), cut_rows(gain.T, weight.T).T), key=worth)


class AdditiveModel:
    """Lookup tables: one per feature and one per pair of features."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray):
        self.edges = [edges_of(c, BINS) for c in rows.T]
        self.coarse = [edges_of(c, GRID) for c in rows.T]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        rate = (labels.sum() + 0.5) / (len(labels) + 1)
        self.bias = float(np.log(rate / (1 - rate)))
        if len(labels):
            self._fit(rows, labels)

    def _fit(self, rows, labels):
        fine, coarse = self._binned(rows, self.edges), self._binned(rows, self.coarse)
        total = np.full(len(labels), self.bias)

        def slopes():
            p = 1 / (1 + np.exp(-total))
            return labels - p, p * (1 - p)

        for _ in range(ROUNDS):
            for k, table in enumerate(self.tables):
                g, h = slopes()
                found = RATE * tree(np.bincount(fine[k], g, len(table)), np.bincount(fine[k], h, len(table)), LEAVES)
                table += found
                total += found[fine[k]]
        g, h = slopes()
        worth = []
        for i in range(len(self.tables)):
            for j in range(i):
                a, b = self._grids(coarse, i, j, g, h)
                t = tree_of_two(a, b)
                worth.append((float((t * a).sum() - 0.5 * (t * t * b).sum()), i, j))
        self.pairs = [(i, j, np.zeros((len(self.coarse[i]) + 1, len(self.coarse[j]) + 1))) for w, i, j in sorted(worth, reverse=True)[:PAIRS] if w > 0]
        for _ in range(PAIR_ROUNDS):
            for i, j, table in self.pairs:
                g, h = slopes()
                found = RATE * tree_of_two(*self._grids(coarse, i, j, g, h))
                table += found
                total += found[coarse[i], coarse[j]]

    def _grids(self, coarse, i, j, g, h):
        shape = len(self.coarse[i]) + 1, len(self.coarse[j]) + 1
        at = coarse[i] * shape[1] + coarse[j]
        return np.bincount(at, g, shape[0] * shape[1]).reshape(shape), np.bincount(at, h, shape[0] * shape[1]).reshape(shape)

    @staticmethod
    def _binned(rows, edges):
        return [np.searchsorted(e, c, "right") for e, c in zip(edges, rows.T)]

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.bias)
        for at, table in zip(self._binned(rows, self.edges), self.tables):
            total += table[at]
        if self.pairs:
            coarse = self._binned(rows, self.coarse)
            for i, j, table in self.pairs:
                total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-total))


def held_out(key: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == fold, F.lit(False))


def sampled_labels(labels: DataFrame, id_col: str, label_col: str, training: Column, sample: int) -> DataFrame:
    """About ``sample`` labelled ids (key, label between 0 and 1), chosen by a hash of the id."""
    known = labels.where(training & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("key")).agg(
        F.avg(F.col(label_col).cast("double")).alias("label"))
    share = min(1.0, sample / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) < share * float(1 << 30))


def fit(docs: DataFrame, labels: DataFrame, training: Column, id_col: str, text_col: str, label_col: str, sample: int) -> AdditiveModel:
    chosen = sampled_labels(labels, id_col, label_col, training, sample)  # its size is bounded, so it may be broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "key")

    def count(batches):
        for batch in slices(batches):
            found = features(blobs_of(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.tolist(), pa.list_(pa.float64())), batch.column(2)], names=["key", "x", "y"])

    got = rows.select("key", "text", "label").mapInArrow(count, "key long, x array<double>, y double").dropDuplicates(["key"]).orderBy("key").toArrow()
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    return AdditiveModel(x, (got["y"].to_numpy() >= 0.5).astype(float))


def predict(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
            folds: int = 4, fold: int = 2, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, ~held_out(id_col, folds, fold), id_col, text_col, label_col, sample))

    def run(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.value.score(features(blobs_of(batch.column(2)))), pa.float64())],
                                             names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col, folds, fold).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
         folds: int = 4, fold: int = 2, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, ~held_out(id_col, folds, fold), id_col, text_col, label_col, sample))
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array(model.value.score(features(blobs_of(batch.column(at)))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
