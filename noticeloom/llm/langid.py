"""Language identification by segmentation-marginalised unigrams.

A language gives every piece of a fixed public vocabulary a probability. A word's
probability is the sum over all its segmentations into pieces, computed by a forward
pass; a text's is the product over its words (``ALNUM`` words behind the vocabulary's
word mark). The best language under Bayes' rule is predicted, its posterior is the score.

Pieces are learned by expectation maximisation on word counts: the forward and backward
passes give each piece's expected count, and a part of the mass is spread over all
pieces, so that every byte string has a probability.

Fitting takes a bounded sample of rows: up to about ``DOCS_PER_LANG`` whole documents of
every language, chosen by a hash of the id. All their words stay in a table of word counts;
each round maps it to expected piece counts, and only their sums by language and piece come
to the driver. Every document is
scored whole, in batches of Arrow rows; each distinct word of a batch is computed once.

Words of over ``LONGEST`` bytes are cut into parts of that length. Texts that are null or
hold no letter give ``und`` and score 0, as all texts do when nothing could be learned; null
labels are not learned from; repeated rows give repeated rows; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.text import ALNUM, blobs_of, chunks, mix, slices, _VALUE, Words
from noticeloom.session import cut_lineage

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
DOCS_PER_LANG = 1500
ROUNDS, SPREAD = 4, 0.02
LONGEST, PIECE = 32, 16
UNKNOWN = "und"
_MARK = "▁".encode()
_BITS = 22
#: Words of a task in a round; languages scored at once, and words times languages.
_TASK_WORDS, _LANGS, _CELLS = 20_000, 64, 200_000


class Vocabulary:
    """Pieces as byte strings; substrings are looked up by a running 64-bit hash."""

    def __init__(self, path: str = VOCABULARY):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {bytes([b]) for b in range(256)} | {_MARK}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                b = model.id_to_piece(i).encode()
                if len(b) <= PIECE:
                    pieces.add(b)
        self.pieces = sorted(pieces)
        width = max(map(len, self.pieces))
        table = np.zeros((len(self.pieces), width), np.uint8)
        sizes = np.array([len(p) for p in self.pieces])
        for row, p in zip(table, self.pieces):
            row[:len(p)] = np.frombuffer(p, np.uint8)
        keys = np.zeros(len(self.pieces), np.uint64)
        for k in range(width):  # the running hash goes from the last byte to the first
            here = sizes > k
            keys[here] = step(keys[here], table[np.flatnonzero(here), sizes[here] - 1 - k])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.gate = np.zeros(1 << _BITS, bool)
        self.gate[self.keys >> np.uint64(64 - _BITS)] = True

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece numbers, the count of pieces where there is none."""
        out = np.full(len(keys), len(self.keys), np.int32)
        at = np.flatnonzero(self.gate[keys >> np.uint64(64 - _BITS)])
        spot = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        hit = self.keys[spot] == keys[at]
        out[at[hit]] = self.order[spot[hit]]
        return out


def step(keys: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return mix(keys * np.uint64(0x9E3779B97F4A7C15) + _VALUE[byte])


class Lattice:
    """All pieces inside words: words sorted by length, the longest first.

    ``edges`` holds, for every end and every piece length, the number of words that reach
    so far (a leading part of the sorted words) and the piece of each.
    """

    def __init__(self, vocabulary: Vocabulary, rows: np.ndarray, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        rows, self.sizes = rows[self.order], sizes[self.order]
        self.longest = int(self.sizes[0]) if len(sizes) else 0
        self.reach = [int(np.searchsorted(-self.sizes, -j, "right")) for j in range(self.longest + 1)]
        self.edges = []
        for end in range(1, self.longest + 1):
            n = self.reach[end]
            keys = np.zeros(n, np.uint64)
            for size in range(1, min(PIECE, end) + 1):
                keys = step(keys, rows[:n, end - size])
                self.edges.append((end, size, vocabulary.find(keys)))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """[end][word, language] sums over the segmentations of each prefix."""
        a = np.zeros((self.longest + 1, len(self.sizes), p.shape[1]))
        a[0] = 1
        for end, size, piece in self.edges:
            n = len(piece)
            a[end, :n] += a[end - size, :n] * p[piece]
        return a

    def of_words(self, a: np.ndarray) -> np.ndarray:
        """Log probabilities [word, language] in the order the words were given."""
        out = np.empty(a.shape[1:])
        out[self.order] = np.log(a[self.sizes, np.arange(len(self.sizes))])
        return out

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected piece counts for one language (``p`` has one column)."""
        a = self.forward(p)[:, :, 0]
        b = np.zeros_like(a)
        b[self.sizes, np.arange(len(self.sizes))] = 1
        whole = a[self.sizes, np.arange(len(self.sizes))]
        total = np.zeros(len(p))
        for end, size, piece in reversed(self.edges):
            n = len(piece)
            through = p[piece, 0] * b[end, :n]
            total += np.bincount(piece, a[end - size, :n] * through * counts[self.order[:n]] / whole[:n], len(p))
            b[end - size, :n] += through
        return total


def byte_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(w) for w in words], np.int64)
    rows = np.zeros((len(words), LONGEST), np.uint8)
    for row, w in zip(rows, words):
        row[:len(w)] = np.frombuffer(w, np.uint8)
    return rows, sizes


def parts(word: bytes) -> list[bytes]:
    marked = _MARK + word
    return [marked[i:i + LONGEST] for i in range(0, len(marked), LONGEST)]


def expected_pieces(vocabulary: Vocabulary, p: np.ndarray, words: list[bytes], own: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language, piece, expected count) over words, each under its own language's row of ``p``."""
    split, whose = [], []
    for i, word in enumerate(words):
        cut = parts(word)
        split += cut
        whose += [i] * len(cut)
    lattice = Lattice(vocabulary, *byte_rows(split))
    whose = np.array(whose)[lattice.order]
    lang, weight = own[whose], counts[whose]
    at = np.arange(len(split))
    a = np.zeros((lattice.longest + 1, len(split)))
    a[0] = 1
    used = []
    for end, size, piece in lattice.edges:
        hit = np.flatnonzero(piece < len(vocabulary.pieces))
        share = p[lang[hit], piece[hit]]
        a[end, hit] += a[end - size, hit] * share
        used.append((end, size, hit, lang[hit] * np.int64(len(vocabulary.pieces)) + piece[hit], share))
    b = np.zeros_like(a)
    b[lattice.sizes, at] = 1
    scale = weight / a[lattice.sizes, at]
    keys, found = [], []
    for end, size, hit, key, share in reversed(used):
        through = share * b[end, hit]
        keys.append(key)
        found.append(a[end - size, hit] * through * scale[hit])
        b[end - size, hit] += through
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return key // len(vocabulary.pieces), key % len(vocabulary.pieces), np.bincount(inverse, np.concatenate(found), len(key))


def learn(vocabulary: Vocabulary, sums: DataFrame, rounds: int = ROUNDS, spread: float = SPREAD) -> tuple[list[str], np.ndarray]:
    """Piece probabilities per language of a table (lang, word, n), with a last row of zeros for what is no piece."""
    langs = sorted(r["lang"] for r in sums.select("lang").distinct().collect())
    size, context = len(vocabulary.pieces), sums.sparkSession.sparkContext
    p = np.full((len(langs), size), 1 / size)
    known = context.broadcast((vocabulary, {x: i for i, x in enumerate(langs)}))
    for _ in range(rounds if langs else 0):
        now = context.broadcast(p)

        def run(batches):
            pieces, number = known.value
            for batch in slices(batches, _TASK_WORDS):
                own = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
                lang, piece, n = expected_pieces(pieces, now.value, batch.column(1).to_pylist(), own, batch.column(2).to_numpy().astype(float))
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int64()), pa.array(piece, pa.int64()), pa.array(n, pa.float64())], names=["lang", "piece", "n"])

        got = np.zeros_like(p)
        table = sums.select("lang", "word", "n").mapInArrow(run, "lang long, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
        got[table["lang"].to_numpy(), table["piece"].to_numpy()] = table["n"].to_numpy()
        p = (1 - spread) * got / np.maximum(got.sum(1, keepdims=True), 1e-300) + spread / size
        now.unpersist()
    return langs, np.concatenate((p.T, np.zeros((1, len(langs)))))


def counted_words(docs: DataFrame, lang_col: str, docs_per_lang: int) -> tuple[dict[str, int], DataFrame]:
    """Documents of every language, and a table (lang, word, n) of all words of a bounded sample of documents."""
    labelled = docs.where("text is not null").select("key", F.col(lang_col).alias("lang"), "text").where("lang is not null")
    found = cut_lineage(labelled.groupBy("lang").agg(F.count("*").alias("_docs")), "langid-languages")
    sizes = {r["lang"]: r["_docs"] for r in found.collect()}
    share = F.least(F.lit(1.0), F.lit(float(docs_per_lang)) / F.col("_docs"))
    chosen = labelled.join(F.broadcast(found), "lang").where(F.pmod(F.xxhash64("key", F.lit("langid")), F.lit(1 << 30)) < share * float(1 << 30))

    def words(batches):
        for batch in slices(batches):
            langs, blobs = batch.column(1).to_pylist(), blobs_of(batch.column(2))
            for a, b in chunks(blobs):
                seen = Words(blobs[a:b], ALNUM)
                owner = np.searchsorted(seen.bounds, np.arange(len(seen.hashes)), "right") - 1
                number = {x: i for i, x in enumerate(dict.fromkeys(langs[a:b]))}
                own = np.array([number[x] for x in langs[a:b]], np.uint64)[owner]
                _, first, n = np.unique(mix(seen.hashes + own), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([langs[a + owner[i]] for i in first], pa.string()), pa.array([seen.word(i) for i in first], pa.binary()),
                                                  pa.array(n, pa.int64())], names=["lang", "word", "n"])

    sums = cut_lineage(chosen.select("key", "lang", "text").mapInArrow(words, "lang string, word binary, n long")
                       .groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    return sizes, cut_lineage(sums.repartition(sums.count() // _TASK_WORDS + 1, "lang", "word"), "langid-dealt")


def has_letter(blob: bytes) -> bool:
    return any(c.isalpha() for c in blob.decode("utf-8", "replace"))


class Scorer:
    def __init__(self, vocabulary: Vocabulary, langs: list[str], p: np.ndarray, prior: np.ndarray):
        self.vocabulary, self.langs, self.p, self.prior = vocabulary, langs, p, prior

    def words(self, seen: Words, which: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Log probabilities of chosen words under the languages of ``p``."""
        most = max(1, _CELLS // p.shape[1])
        sizes = seen.ends[which] - seen.starts[which] + len(_MARK)
        out = np.zeros((len(which), p.shape[1]))
        short = np.flatnonzero(sizes <= LONGEST)
        rows = np.zeros((len(short), LONGEST), np.uint8)
        rows[:, :len(_MARK)] = np.frombuffer(_MARK, np.uint8)
        at = seen.starts[which[short]][:, None] + np.arange(LONGEST - len(_MARK))
        rows[:, len(_MARK):] = seen.low[np.minimum(at, len(seen.low) - 1)]
        for k in range(0, len(short), most):
            lattice = Lattice(self.vocabulary, rows[k:k + most], sizes[short[k:k + most]])
            out[short[k:k + most]] = lattice.of_words(lattice.forward(p))
        for i in np.flatnonzero(sizes > LONGEST):
            own = parts(seen.word(which[i]))
            for k in range(0, len(own), most):
                lattice = Lattice(self.vocabulary, *byte_rows(own[k:k + most]))
                out[i] += lattice.of_words(lattice.forward(p)).sum(0)
        return out

    def texts(self, blobs: list[bytes]) -> tuple[list[str], np.ndarray]:
        lettered = np.array([has_letter(b) for b in blobs], bool)
        if not self.langs:
            return [UNKNOWN] * len(blobs), np.zeros(len(blobs))
        seen = Words(blobs, ALNUM)
        total = np.zeros((len(blobs), len(self.langs))) + self.prior
        if len(seen.hashes):
            _, first, inverse = np.unique(seen.hashes, return_index=True, return_inverse=True)
            owner = np.repeat(np.arange(len(blobs)), np.diff(seen.bounds))
            for c in range(0, len(self.langs), _LANGS):
                own = self.words(seen, first, self.p[:, c:c + _LANGS])
                for k in range(own.shape[1]):
                    total[:, c + k] += np.bincount(owner, own[inverse, k], len(blobs))
        best = total.argmax(1)
        score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        return [self.langs[k] if ok else UNKNOWN for k, ok in zip(best, lettered)], np.where(lettered, score, 0.0)


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, train: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            vocabulary: str = VOCABULARY, docs_per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from the rows of ``train`` (default: the documents) that are not held out.
    """
    train = docs if train is None else train
    rows = train.where(~held_out(id_col)).select(F.col(id_col).alias("key"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    sizes, sums = counted_words(rows.where("key is not null"), "lang", docs_per_lang)
    pieces = Vocabulary(vocabulary)
    langs, p = learn(pieces, sums)
    prior = np.log(np.array([sizes[x] for x in langs], float) / max(1, sum(sizes[x] for x in langs)))
    scorer = docs.sparkSession.sparkContext.broadcast(Scorer(pieces, langs, p, prior))

    def run(batches):
        for batch in slices(batches):
            blobs = blobs_of(batch.column(2))
            langs, scores = [], []
            for a, b in chunks(blobs, 2 << 20):
                names, found = scorer.value.texts(blobs[a:b])
                langs += names
                scores.append(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()),
                                              pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
