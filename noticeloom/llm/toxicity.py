"""Toxicity score: a bidirectional gated recurrent network over characters and words.

A word's input is its embedding (words of the training sample, one row for all others)
next to a character vector: the sum of embeddings of all its character (byte) pairs, by their place
up to ``PLACES`` and in one table for all later places, under tanh, so that unseen words built like known ones are told apart too. A recurrent
network reads a window of ``WINDOW`` words from both sides, attention pools its states,
and a linear layer gives the window's logit. Windows overlap and cover the whole text; a
text's score is that of its highest window, calibrated on the training sample.

The network is trained in numpy on the driver, on a bounded sample: about ``POSITIVE`` and
``NEGATIVE`` labelled documents, chosen by a hash of the id, and of each at most
``WINDOWS`` windows spread evenly over its text (training only). A document is one example: its
highest window is pulled towards its label. Scoring maps over all documents, in batches.

Texts without words score 0. Null labels are not learned from, several labels of one id
count by their mean; without labels of both kinds every score is 0; repeated rows
give repeated rows; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.quality import held_out
from noticeloom.llm.text import ALNUM, blobs_of, chunks, slices, Words

WINDOW, STRIDE = 48, 32
POSITIVE, NEGATIVE, WINDOWS = 1000, 1800, 20
WORD, CHAR, HIDDEN, ATTEND = 12, 12, 12, 8
PLACES, PAIRS = 7, 4096
VOCABULARY, LEAST_DOCS = 20_000, 3
EPOCHS, LEAST_STEPS, BATCH, RATE = 4, 80, 64, 0.01
#: Share of words that training shows by their characters only.
UNNAMED = 0.25
_BLOCK = 1024


def starts_of(n: int) -> list[int]:
    """First words of the windows over ``n`` words; the last window ends with the text."""
    if n <= WINDOW:
        return [0] if n else []
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def pairs_of(seen: Words, which: np.ndarray) -> np.ndarray:
    """Numbers of the character pairs at the first places of words; a mark stands before and after."""
    at = seen.starts[which][:, None] + np.arange(-1, PLACES)
    inside = (at >= seen.starts[which][:, None]) & (at < seen.ends[which][:, None])
    c = np.where(inside, seen.low[np.clip(at, 0, len(seen.low) - 1)], 0).astype(np.int64)
    number = (c[:, :-1] * 4099 + c[:, 1:] * 73) % PAIRS
    number[~(inside[:, :-1] | inside[:, 1:])] = 0
    return number + np.arange(PLACES) * PAIRS


def tails_of(seen: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the character pairs of words after the first places, and where each word's begin."""
    start, size = seen.starts[which], seen.ends[which] - seen.starts[which]
    count = np.maximum(0, size + 1 - PLACES)
    bounds = np.concatenate(([0], np.cumsum(count)))
    owner = np.repeat(np.arange(len(which)), count)
    at = PLACES + np.arange(bounds[-1]) - bounds[owner]
    c = seen.low[start[owner] + at - 1].astype(np.int32)
    after = np.where(at < size[owner], seen.low[np.minimum(start[owner] + at, len(seen.low) - 1)], 0).astype(np.int32)
    return (c * 4099 + after * 73) % PAIRS, bounds


def take_tails(tails: tuple[np.ndarray, np.ndarray], own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tails of chosen words, in their order."""
    number, bounds = tails
    count = bounds[own + 1] - bounds[own]
    new = np.concatenate(([0], np.cumsum(count)))
    return number[np.repeat(bounds[own] - new[:-1], count) + np.arange(new[-1])], new


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Gru:
    """One direction over [rows, time, 3 * HIDDEN] input parts; ``mask`` [rows, time] or None."""

    @staticmethod
    def forward(g, u, mask, keep=False):
        rows, time, _ = g.shape
        h = np.zeros((rows, HIDDEN), np.float32)
        states, trace = np.empty((rows, time, HIDDEN), np.float32), []
        for t in range(time):
            part = h @ u
            zr = sigmoid(g[:, t, :2 * HIDDEN] + part[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(g[:, t, 2 * HIDDEN:] + r * part[:, 2 * HIDDEN:])
            new = n + z * (h - n)
            if mask is not None:
                new = np.where(mask[:, t, None], new, h)
            if keep:
                trace.append((h, z, r, n, part[:, 2 * HIDDEN:]))
            h = new
            states[:, t] = h
        return states, trace

    @staticmethod
    def backward(d_states, u, mask, trace):
        rows, time, _ = d_states.shape
        dg, du, dh = np.zeros((rows, time, 3 * HIDDEN), np.float32), np.zeros_like(u), np.zeros((rows, HIDDEN), np.float32)
        for t in reversed(range(time)):
            h, z, r, n, q = trace[t]
            dh = dh + d_states[:, t]
            new = dh * mask[:, t, None]
            dn = new * (1 - z) * (1 - n * n)
            dz, dr = new * (h - n) * z * (1 - z), dn * q * r * (1 - r)
            dg[:, t] = np.concatenate((dz, dr, dn), 1)
            part = np.concatenate((dz, dr, dn * r), 1)
            du += h.T @ part
            dh = dh * ~mask[:, t, None] + new * z + part @ u.T
        return dg, du


class Network:
    def __init__(self, vocabulary: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        init = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.vocabulary = vocabulary  # sorted word hashes
        self.p = {"word": rng.normal(0, 0.1, (len(vocabulary) + 1, WORD)).astype(np.float32), "pair": rng.normal(0, 0.1, (PLACES * PAIRS, CHAR)).astype(np.float32),
                  "tail": np.zeros((PAIRS, CHAR), np.float32)}
        for d in "fb":
            self.p |= {f"w{d}": init(WORD + CHAR, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32), f"u{d}": init(HIDDEN, 3 * HIDDEN)}
        self.p |= {"aw": init(2 * HIDDEN, ATTEND), "ab": np.zeros(ATTEND, np.float32), "av": init(ATTEND, 1)[:, 0], "ow": init(2 * HIDDEN, 1)[:, 0], "ob": np.zeros(1, np.float32)}
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.steps, self.scale = 0, (1.0, 0.0)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of the word table; row 0 is for unknown words."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def inputs(self, ids: np.ndarray, pairs: np.ndarray, tails: tuple | None = None) -> np.ndarray:
        char = np.zeros((len(ids), CHAR), np.float32)
        for k in range(PLACES):
            char += self.p["pair"][pairs[:, k]]
        if tails is not None and len(tails[0]):
            number, bounds = tails
            long = np.flatnonzero(np.diff(bounds))
            begin = 0
            while begin < len(long):  # some 100,000 pairs at once; a longer word stands alone
                end = max(begin + 1, int(np.searchsorted(bounds[long + 1], bounds[long[begin]] + 100_000, "right")))
                a, b = bounds[long[begin]], bounds[long[end - 1] + 1]
                char[long[begin:end]] += np.add.reduceat(self.p["tail"][number[a:b]], bounds[long[begin:end]] - a)
                begin = end
        return np.concatenate((self.p["word"][ids], np.tanh(char)), 1)

    def gates(self, x):
        return {d: x @ self.p[f"w{d}"] + self.p[f"c{d}"] for d in "fb"}

    def pool(self, states, mask):
        a = np.tanh(states @ self.p["aw"] + self.p["ab"])
        s = a @ self.p["av"]
        if mask is not None:
            s = np.where(mask, s, -1e9)
        w = np.exp(s - s.max(1, keepdims=True))
        w /= w.sum(1, keepdims=True)
        pooled = np.matmul(w[:, None, :], states)[:, 0]
        return a, w, pooled, pooled @ self.p["ow"] + self.p["ob"][0]

    def logits(self, gates, windows: np.ndarray, mask) -> np.ndarray:
        """Logits of windows of word numbers [rows, time] into ``gates``; full windows need no mask."""
        out = np.empty(len(windows), np.float32)
        for k in range(0, len(windows), _BLOCK):
            w, m = windows[k:k + _BLOCK], None if mask is None or mask[k:k + _BLOCK].all() else mask[k:k + _BLOCK]
            f, _ = Gru.forward(gates["f"][w], self.p["uf"], m)
            b, _ = Gru.forward(gates["b"][w[:, ::-1]], self.p["ub"], None if m is None else m[:, ::-1])
            out[k:k + _BLOCK] = self.pool(np.concatenate((f, b[:, ::-1]), 2), m)[3]
        return out

    def train_step(self, ids, pairs, mask, labels, weights, tails=None):
        """One step on windows [rows, time] of ids and [rows, time, PLACES] of pairs, with the tails of all their words."""
        rows, time = ids.shape
        x = self.inputs(ids.ravel(), pairs.reshape(-1, PLACES), tails)
        g = {d: (x @ self.p[f"w{d}"] + self.p[f"c{d}"]).reshape(rows, time, -1) for d in "fb"}
        back = np.ascontiguousarray(mask[:, ::-1])
        f, f_trace = Gru.forward(g["f"], self.p["uf"], mask, True)
        b, b_trace = Gru.forward(np.ascontiguousarray(g["b"][:, ::-1]), self.p["ub"], back, True)
        states = np.concatenate((f, b[:, ::-1]), 2)
        a, w, pooled, logit = self.pool(states, mask)
        d_logit = ((sigmoid(logit) - labels) * weights / rows).astype(np.float32)
        grad = {"ow": pooled.T @ d_logit, "ob": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * self.p["ow"]
        d_states = w[:, :, None] * d_pooled[:, None, :]
        dw = np.matmul(states, d_pooled[:, :, None])[:, :, 0]
        ds = w * (dw - (w * dw).sum(1, keepdims=True))
        grad["av"] = np.tensordot(ds, a, ((0, 1), (0, 1)))
        da = ds[:, :, None] * self.p["av"] * (1 - a * a)
        grad["aw"], grad["ab"] = np.tensordot(states, da, ((0, 1), (0, 1))), da.sum((0, 1))
        d_states = d_states + da @ self.p["aw"].T
        dx = np.zeros_like(x)
        for d, part, m, trace in (("f", d_states[:, :, :HIDDEN], mask, f_trace), ("b", d_states[:, ::-1, HIDDEN:], back, b_trace)):
            dg, grad[f"u{d}"] = Gru.backward(part, self.p[f"u{d}"], m, trace)
            dg = (dg if d == "f" else dg[:, ::-1]).reshape(rows * time, -1)
            grad[f"w{d}"], grad[f"c{d}"] = x.T @ dg, dg.sum(0)
            dx += dg @ self.p[f"w{d}"].T
        dx *= mask.ravel()[:, None]
        grad["word"] = np.zeros_like(self.p["word"])
        np.add.at(grad["word"], ids.ravel(), dx[:, :WORD])
        grad["pair"] = np.zeros_like(self.p["pair"])
        char = dx[:, WORD:] * (1 - x[:, WORD:] ** 2)
        flat = pairs.reshape(-1, PLACES)
        for k in range(PLACES):
            np.add.at(grad["pair"], flat[:, k], char)
        if tails is not None:
            number, bounds = tails
            owner = np.repeat(np.arange(len(char)), np.diff(bounds))
            grad["tail"] = np.stack([np.bincount(number, char[owner, k], PAIRS) for k in range(CHAR)], 1).astype(np.float32)
        self.steps += 1
        for k, v in grad.items():
            m, s = self.moments[k]
            m += 0.1 * (v - m)
            s += 0.001 * (v * v - s)
            self.p[k] -= RATE * (m / (1 - 0.9 ** self.steps)) / (np.sqrt(s / (1 - 0.999 ** self.steps)) + 1e-8)
        return logit

    def texts(self, blobs: list[bytes]) -> np.ndarray:
        """Scores of whole texts."""
        seen = Words(blobs, ALNUM)
        best = np.full(len(blobs), -np.inf)
        if len(seen.hashes):
            _, first, inverse = np.unique(seen.hashes, return_index=True, return_inverse=True)
            gates = self.gates(self.inputs(self.ids(seen.hashes[first]), pairs_of(seen, first), tails_of(seen, first)))
            sizes = np.diff(seen.bounds)
            owner, start = [], []
            for d, n in enumerate(sizes.tolist()):
                own = starts_of(n)
                start += own
                owner += [d] * len(own)
            owner, start = np.array(owner), np.array(start, np.int64)
            order = np.argsort(-np.minimum(sizes[owner], WINDOW), kind="stable")  # full windows first
            owner, start = owner[order], start[order]
            for k in range(0, len(owner), 8 * _BLOCK):
                o = owner[k:k + 8 * _BLOCK]
                at = start[k:k + 8 * _BLOCK, None] + np.arange(WINDOW)
                mask = at < sizes[o][:, None]
                words = inverse[np.minimum(at, sizes[o][:, None] - 1) + seen.bounds[o][:, None]]
                np.maximum.at(best, o, self.logits(gates, words, mask))
        a, b = self.scale
        return np.where(np.isfinite(best), sigmoid(np.clip(a * best + b, -60, 60)), 0.0)


class Sample:
    """Training windows as numbers of distinct words, with the rows of these words in both tables."""

    def __init__(self, windows: list[bytes], owner: np.ndarray, labels: np.ndarray):
        seen = Words(windows, ALNUM)
        self.owner, self.labels = owner, labels
        self.first = np.searchsorted(owner, np.arange(len(labels) + 1))
        sizes = np.diff(seen.bounds)
        hashes, place, inverse = np.unique(seen.hashes, return_index=True, return_inverse=True)
        pair = np.unique(inverse * len(labels) + np.repeat(owner, sizes))
        spread = np.bincount(pair // len(labels), minlength=len(hashes))  # documents of each word
        common = np.flatnonzero(spread >= LEAST_DOCS)
        if len(common) > VOCABULARY:
            common = np.sort(common[np.lexsort((hashes[common], -spread[common]))[:VOCABULARY]])
        self.vocabulary = hashes[common]
        self.pairs = pairs_of(seen, place).astype(np.int32)
        self.tails = tails_of(seen, place)
        self.mask = np.arange(WINDOW) < sizes[:, None]
        self.words = inverse.astype(np.int32)[np.minimum(np.arange(WINDOW), sizes[:, None] - 1) + seen.bounds[:-1, None]]
        self.hashes = hashes

    def highest(self, net: Network, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The highest window of each document, and its logit."""
        which = np.concatenate([np.arange(self.first[d], self.first[d + 1]) for d in docs])
        own, inverse = np.unique(self.words[which], return_inverse=True)
        logit = net.logits(net.gates(net.inputs(self.ids[own], self.pairs[own], take_tails(self.tails, own))), inverse.reshape(len(which), WINDOW), self.mask[which])
        spots = np.concatenate(([0], np.cumsum(self.first[docs + 1] - self.first[docs])))
        best = np.array([a + logit[a:b].argmax() for a, b in zip(spots, spots[1:])])
        return which[best], logit[best]


def train(sample: Sample) -> Network:
    net, rng, labels = Network(sample.vocabulary), np.random.default_rng(11), sample.labels
    sample.ids = net.ids(sample.hashes)
    balance = np.where(labels > 0, 0.5 * len(labels) / max(1, labels.sum()), 0.5 * len(labels) / max(1, (1 - labels).sum())).astype(np.float32)
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // len(labels)))):
        order = rng.permutation(len(labels))
        for k in range(0, len(order), BATCH):
            docs = order[k:k + BATCH]
            top, _ = sample.highest(net, docs)
            words = sample.words[top]
            ids = np.where(rng.random(words.shape) < UNNAMED, 0, sample.ids[words])
            net.train_step(ids, sample.pairs[words], sample.mask[top], labels[docs], balance[docs], take_tails(sample.tails, words.ravel()))
    return net


def calibrate(logit: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic slope and shift by Newton steps, a little regularised."""
    x, theta = np.stack((logit, np.ones(len(logit))), 1), np.array([1.0, 0.0])
    for _ in range(25):
        p = sigmoid(np.clip(x @ theta, -30, 30))
        g = x.T @ (weight * (labels - p)) - np.array([1e-2 * (theta[0] - 1), 1e-2 * theta[1]])
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        theta = theta + np.clip(np.linalg.solve(h, g), -2, 2)
    return float(max(theta[0], 0.05)), float(theta[1])


def sample_windows(docs: DataFrame, labels: DataFrame, training: Column, id_col: str, text_col: str, label_col: str, positive: int, negative: int):
    """Windows of the sampled documents as rows (key, label, share of its kind, words); bounded per document."""
    known = labels.where(training & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("key")).agg(
        (F.avg(F.col(label_col).cast("double")) >= 0.5).alias("label"))
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {True: min(1.0, positive / max(1, n.get(True, 0))), False: min(1.0, negative / max(1, n.get(False, 0)))}
    chosen = known.where(F.pmod(F.xxhash64("key", F.lit("toxic")), F.lit(1 << 30)) < F.when(F.col("label"), share[True]).otherwise(share[False]) * float(1 << 30))

    def cut(batches):
        for batch in slices(batches):
            keys, flags, blobs = batch.column(0).to_pylist(), batch.column(1).to_pylist(), blobs_of(batch.column(2))
            for a, b in chunks(blobs):
                seen, out = Words(blobs[a:b], ALNUM), []
                for d, size in enumerate(np.diff(seen.bounds).tolist()):
                    own = starts_of(size)
                    for s in [own[i] for i in np.unique(np.linspace(0, len(own) - 1, min(WINDOWS, len(own))).astype(int))] if own else []:
                        i, j = seen.bounds[d] + s, seen.bounds[d] + min(s + WINDOW, size)
                        out.append((keys[a + d], flags[a + d], b" ".join(seen.word(k) for k in range(i, j))))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.bool_()), pa.array([x[2] for x in out], pa.binary())],
                                                 names=["key", "label", "words"])

    # the sampled ids are bounded, so they may be broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "key")
    got = rows.select("key", "label", "text").mapInArrow(cut, "key long, label boolean, words binary").toArrow()
    return got, share


def fit(docs, labels, training, id_col, text_col, label_col, positive, negative) -> Network | None:
    got, share = sample_windows(docs, labels, training, id_col, text_col, label_col, positive, negative)
    key = got["key"].to_numpy()
    if not len(key):
        return None
    order = np.argsort(key, kind="stable")
    windows = got["words"].to_pylist()
    windows = [windows[i] for i in order]
    docs_of, owner = np.unique(key[order], return_inverse=True)
    label = np.zeros(len(docs_of), np.float32)
    label[owner] = np.array(got["label"].to_pylist(), bool)[order]
    if label.min() == label.max():
        return None
    sample = Sample(windows, owner, label)
    net = train(sample)
    top = np.concatenate([sample.highest(net, np.arange(k, min(k + BATCH, len(label))))[1] for k in range(0, len(label), BATCH)])
    net.scale = calibrate(top, label, np.where(label > 0, 1 / share[True], 1 / share[False]))
    net.moments = {}
    return net


def predict(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, fold: int = 0,
            threshold: float = 0.5, positive: int = POSITIVE, negative: int = NEGATIVE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, ~held_out(id_col, folds, fold), id_col, text_col, label_col, positive, negative))

    def run(batches):
        for batch in slices(batches):
            blobs = blobs_of(batch.column(2))
            scores = [net.value.texts(blobs[a:b]) if net.value else np.zeros(b - a) for a, b in chunks(blobs, 2 << 20)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col, folds, fold).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
