"""Importance resampling towards a target text distribution, over hashed word n-grams.

Texts are lower-cased (``A-Z`` only) and cut by an untrained pre-tokeniser (a regex split
that returns words with offsets). Windows of one and of two neighbouring offset pairs are
the features: a word, and two words joined by one blank. The bucket of a feature is the
CRC-32 of its UTF-8 bytes modulo ``buckets``; the CRC of a pair continues that of its
first word, so no pair is ever put together as a string.

One pass over the corpus writes every document's buckets. Histograms are summed inside
the tasks and then per bucket. The gain of a bucket compares the smoothed share of the
target with that of the corpus; a document's weight is the mean of its features' gains.
Gumbel noise from a hash of the id is added, and the documents with the highest scores are
drawn: sampling without replacement in proportion to ``exp(weight / 1000)``.

Sizes: histograms and gains have ``buckets`` rows, which is what the driver holds. A text
is cut in pieces of about ``PIECE`` bytes at separators, the first word of a piece pairing
with the last of the piece before, so a very long text needs no more memory than its
bytes, pieces and bucket numbers. Ranks come from a range sort without a single task.

Edge cases: null and word-less texts have no features, weight 0 and are not drawn (with
``least_words`` above 0); a null id hashes as an empty one and ranks first among ties;
equal ids get equal noise; repeated rows are rows of their own; with an empty target all
gains come from the corpus alone; an empty corpus gives an empty result. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import functools
import re
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.ranks import numbered
from noticeloom.llm.sqltext import ALNUM_WORD, CRC_TABLE, crc32 as sql_crc32, low
from noticeloom.llm.text import blobs_of, chunks, slices
from noticeloom.session import cut_lineage

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Bytes of a text that are tokenised at once.
PIECE = 1 << 17
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


@functools.cache
def splitter():
    """The pre-tokeniser: what matches the word pattern stays, with its offsets."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(ALNUM_WORD), behavior="removed", invert=True)


def pieces(text: bytes, size: int = PIECE):
    """The text in lower case, cut at separators after about ``size`` bytes."""
    begin = 0
    while begin < len(text):
        cut = _SEPARATOR.search(text, min(begin + size, len(text)))
        end = cut.end() if cut else len(text)
        yield text[begin:end].translate(_LOWER).decode("utf-8", "replace")
        begin = end


def features(text: bytes, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the buckets of all words and of all pairs of neighbours."""
    many, found, last = 0, [], None
    for piece in pieces(text):
        spans = [at for _, at in splitter().pre_tokenize_str(piece)]
        words = [piece[a:b].encode() for a, b in spans]
        if not words:
            continue
        singles = list(map(crc32, words))
        before = singles[:-1] if last is None else [last, *singles[:-1]]
        follow = words[1:] if last is None else words
        found += singles
        found += map(crc32, follow, map(crc32, repeat(b" "), before))
        many, last = many + len(words), singles[-1]
    return many, (np.array(found, np.int64) % buckets).astype(np.int16 if buckets <= 1 << 15 else np.int32)


def bucketed(docs: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words and the ``buckets`` of every feature."""
    kind = pa.int16() if buckets <= 1 << 15 else pa.int32()

    def cut(batches):
        for batch in slices(batches, 100):
            blobs = blobs_of(batch.column(1))
            for a, b in chunks(blobs):
                each = [features(x, buckets) for x in blobs[a:b]]
                ends = np.cumsum([0] + [len(x) for _, x in each])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array([n for n, _ in each], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([x for _, x in each]), kind))], names=["doc_id", "n_words", "buckets"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    of_id = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {of_id}, n_words long, buckets array<{'smallint' if buckets <= 1 << 15 else 'int'}>")


def flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and where each list begins and the last one ends."""
    at = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]], at - at[0]


def histogram(table: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features fall into each bucket that has any."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(flat(batch.column(0))[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    return table.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for all buckets: 1000 times the log ratio of the smoothed shares, floored."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    both = every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    sums = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    d = lambda c: F.col(c).cast("double")
    ratio = (d("t") + 1) * (F.lit(float(sums["s"])) + buckets) / ((d("s") + 1) * (F.lit(float(sums["t"])) + buckets))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weighted(table: DataFrame, of_bucket: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and ``weight``, the floored mean gain of a document's features."""

    def weigh(batches):
        for batch in batches:
            values, at = flat(batch.column(2))
            sums = np.concatenate(([0], np.cumsum(of_bucket[values])))
            n = np.diff(at).astype(np.int64)
            weight = np.where(n > 0, (sums[at[1:]] - sums[at[:-1]]) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    return table.mapInArrow(weigh, f"doc_id {table.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def noise(id_col: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS,
             least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, and ``rank`` where it is drawn."""
    table = cut_lineage(bucketed(docs, id_col, text_col, buckets), "buckets")
    wanted = histogram(bucketed(target.withColumn("_id", F.lit(0)), "_id", target_col, buckets), buckets)
    of_bucket = np.zeros(buckets, np.int64)
    for r in gains(histogram(table, buckets), wanted, buckets).toLocalIterator():
        of_bucket[r["bucket"]] = r["gain"]
    rows = cut_lineage(weighted(table, of_bucket).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")
    able = F.col("n_words") >= least_words
    placed = numbered(rows.where(able), [], [F.desc("score"), F.col("doc_id")], "draw")
    drawn = F.when(F.col("place") < F.expr(f"of * {percent} div 100"), F.col("place") + 1)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return placed.select(*columns, drawn.alias("rank")).unionByName(rows.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")


def sql() -> str:
    """The registered query as SQL."""
    def cut(table: str, key: str) -> str:
        return f"SELECT {key}, regexp_extract_all({low("coalesce(text, '')")}, '{ALNUM_WORD}') AS w FROM {table}"

    def grams(table: str, key: str) -> str:
        return (f"SELECT {key}, unnest(w) AS g FROM {table} UNION ALL "
                f"SELECT {key}, w[i] || ' ' || w[i + 1] AS g FROM (SELECT {key}, w, unnest(range(1, len(w))) AS i FROM {table})")

    return f"""
WITH {CRC_TABLE},
d AS ({cut('documents', 'doc_id')}), b AS ({cut('benchmark', 'item_id')}),
dg AS ({grams('d', 'doc_id')}), bg AS ({grams('b', 'item_id')}),
v AS (SELECT g, {sql_crc32('g')} % {BUCKETS} AS bucket FROM (SELECT g FROM dg UNION SELECT g FROM bg), crc),
s AS (SELECT bucket, count(*) AS s FROM dg JOIN v USING (g) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bg JOIN v USING (g) GROUP BY bucket),
a AS (SELECT (SELECT count(*) FROM dg) AS all_s, (SELECT count(*) FROM bg) AS all_t),
n AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + {BUCKETS}) / ((s + 1)::DOUBLE * (all_t + {BUCKETS})))) AS BIGINT) AS gain
      FROM s LEFT JOIN t USING (bucket), a),
dw AS (SELECT doc_id, count(*) AS n, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM dg JOIN v USING (g) JOIN n USING (bucket) GROUP BY doc_id),
x AS (SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
             CAST(('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8)) AS BIGINT) AS h FROM d LEFT JOIN dw USING (doc_id)),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
z AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS many FROM y WHERE words >= {LEAST_WORDS})
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <= {PERCENT} * many // 100 THEN place END AS rank
FROM y LEFT JOIN z USING (doc_id)
"""
