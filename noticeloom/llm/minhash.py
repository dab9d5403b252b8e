"""MinHash near-dedup with odd sketches.

A document is the set of its distinct ``width``-word shingles (fewer words: one shingle).
Documents with equal sets form a class, and only the class's smallest id goes on.

Signature: one-permutation MinHash of ``BINS`` samples; an empty bin borrows the sample of
the first filled bin in a fixed random order of its own, so that every sample agrees with
the probability of the Jaccard similarity, also for tiny sets. Bands of ``ROWS`` samples
give candidate buckets. All samples are folded into a parity bitmap, the odd sketch: the
population count of the XOR of two bitmaps estimates how many samples differ.

Candidates of a bucket are not listed as pairs. First every member meets the bucket's
smallest id; the best such pair of a document by its sketch is confirmed on the full
sets, and the confirmed pairs give components. Then only members of one bucket that are
still in different components are compared, by their sketches in blocks inside a task:
each document's best partner above the estimate's error margin is confirmed, and at the
end the full sets of those that still have one are brought to their blocks and all open
pairs above the margin are compared there. So no link between different components
is left out, except by the misses of banding (about 1e-7 for a pair at the threshold)
and of the sketch margin (five standard errors).

Hot groups: equal sets are collapsed with map-side combine; a bucket's smallest member is
a combined minimum; a bucket's members are split into blocks.

Edge cases: null, empty and word-less texts have empty sets and are linked with nothing;
rows with one id are one document; a null id takes no part (its component is null, it
is kept); an empty table gives an empty result; other columns are ignored by ``report``
and kept by ``dedupe``.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.graph import bounded, components, relabel
from noticeloom.llm.text import blobs_of, combine, each_words, mix, slices, SPACED
from noticeloom.session import cut_lineage

PERCENT = 80
BINS, ROWS, BANDS = 512, 5, 40
SKETCH_BITS = 1024
#: Estimated similarity from which a pair is confirmed: five standard errors below the threshold.
MARGIN = 0.12
BLOCK = 1024


def _orders():
    rng = np.random.default_rng(20)
    order = np.argsort(rng.random((BINS, BINS)), axis=1)  # order[i]: the bins that bin i asks, in turn
    rank = np.argsort(order, axis=1).astype(np.uint16)
    return np.ascontiguousarray(order[:, :16].T), rank


_FIRST, _RANK = _orders()
_SALT = mix(np.arange(1, BINS + 1, dtype=np.uint64))
_BAND_SALT = mix(np.arange(1000, 1000 + BANDS, dtype=np.uint64))


def shingle_sets(blobs: list[bytes], width: int):
    """Sorted distinct shingle hashes of each text."""
    for a, b, words in each_words(blobs, SPACED):
        runs = combine(words.hashes, width)
        for i in range(b - a):
            x, y = int(words.bounds[i]), int(words.bounds[i + 1])
            if y - x >= width:
                yield np.unique(runs[x:y - width + 1])
            else:
                yield combine(words.hashes[x:y], y - x) if y > x else np.zeros(0, np.uint64)


def samples_of(hashes: np.ndarray) -> np.ndarray:
    """MinHash samples from sorted hashes: the least hash of each bin by the leading bits."""
    bins = (hashes >> np.uint64(64 - 9)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
    filled, least = bins[first], hashes[first]
    at = np.full(BINS, -1)
    at[filled] = np.arange(len(filled))
    if len(filled) < BINS:
        empty = np.flatnonzero(at < 0)
        if len(filled) * 8 > BINS:
            asked = at[_FIRST[:, empty]]
            hit = (asked >= 0).argmax(0)
            got = asked[hit, np.arange(len(empty))]
            at[empty] = got
            empty = empty[got < 0]
        if len(empty):
            at[empty] = _RANK[np.ix_(empty, filled)].argmin(1)
    return least[at]


def bands_of(samples: np.ndarray) -> np.ndarray:
    parts = samples[:ROWS * BANDS].reshape(BANDS, ROWS)
    out = _BAND_SALT.copy()
    for k in range(ROWS):
        out = mix(out + parts[:, k])
    return out.view(np.int64)


def sketch_of(samples: np.ndarray) -> np.ndarray:
    bits = (mix(samples ^ _SALT) >> np.uint64(64 - 10)).astype(np.int64)
    return np.packbits((np.bincount(bits, minlength=SKETCH_BITS) & 1).astype(np.uint8)).view(np.int64)


def estimate(different_bits):
    """Jaccard similarity from the population count of two sketches' XOR."""
    z = np.minimum(2.0 * different_bits / SKETCH_BITS, 0.999999)
    return 1 + SKETCH_BITS / 2 * np.log(1 - z) / (2 * BINS)


def features(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, digest of the set, bands, sketch (the last three null for empty sets)."""

    def run(batches):
        for batch in slices(batches):
            n, digests, bands, sketches = [], [], [], []
            for s in shingle_sets(blobs_of(batch.column(1)), width):
                n.append(len(s))
                samples = samples_of(s) if len(s) else None
                digests.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(bands_of(samples) if len(s) else None)
                sketches.append(sketch_of(samples) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                                              pa.array(sketches, pa.list_(pa.int64()))], names=["doc_id", "n", "digest", "bands", "sketch"])

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, bands array<long>, sketch array<long>")


def with_estimate(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Adds ``estimate`` to pairs (a, b), with JVM bit counts."""
    for side in "ab":
        pairs = pairs.join(sketches.select(F.col("doc_id").alias(side), F.col("sketch").alias(f"_{side}")), side)
    different = F.aggregate(F.zip_with("_a", "_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    z = F.least(different * F.lit(2.0 / SKETCH_BITS), F.lit(0.999999))
    return pairs.select("a", "b", (1 + F.lit(SKETCH_BITS / (4.0 * BINS)) * F.log(1 - z)).alias("estimate"))


def set_table(named: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(id, items): the full sets of the named documents, counted again from their texts; five bytes a shingle."""

    def sets(batches):
        for batch in slices(batches):
            packed = [(s >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5].tobytes() for s in shingle_sets(blobs_of(batch.column(1)), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["id", "items"])

    named = cut_lineage(named.distinct(), "minhash-named")
    return cut_lineage(docs.join(bounded(named), "doc_id", "left_semi").select("doc_id", "text")
                       .mapInArrow(sets, "id long, items binary").dropDuplicates(["id"]), "minhash-sets")


def unpack(items: bytes) -> np.ndarray:
    wide = np.zeros((len(items) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(items, np.uint8).reshape(-1, 5)
    return wide.view(np.uint64)[:, 0]


def alike(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether sorted sets meet the threshold."""
    small, large = (one, two) if len(one) < len(two) else (two, one)
    if 100 * len(small) < percent * len(large):
        return False
    spot = np.searchsorted(large, small)
    same = int((large[np.minimum(spot, len(large) - 1)] == small).sum())
    return 100 * same >= percent * (len(one) + len(two) - same)


def confirm(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold.

    A set travels once for every pair that names it as ``b`` and once for ``a``; rows are
    sorted by ``a``, so a task holds one set at a time.
    """

    def compare(batches):
        owner, own = None, None
        for batch in slices(batches):
            found = []
            for a, b, items in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if b is None:
                    owner, own = a, unpack(items)
                elif owner == a and alike(own, unpack(items), percent):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

    table = set_table(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")), docs, width)
    sent = pairs.join(table.withColumnRenamed("id", "b"), "b").select("a", "b", "items")
    own = table.join(pairs.select(F.col("a").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("a"), F.lit(None).cast("long").alias("b"), "items")
    return sent.unionByName(own).repartition("a").sortWithinPartitions("a", F.col("b").asc_nulls_first()).mapInArrow(compare, "a long, b long")


def in_blocks(members: DataFrame, columns: list[str], work, layout: pa.Schema) -> DataFrame:
    """Run ``work(bucket, first, second, rows)`` where members of one bucket, but of different components, meet.

    ``members``: bucket, doc_id, label and ``columns``. Buckets with one component drop out. The
    others are cut into blocks of about ``BLOCK`` members; each two blocks meet in one
    place, where ``first`` and ``second`` are the row numbers to compare.
    """
    mixed = members.groupBy("bucket").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"), F.count("*").alias("_n")).where("_lo < _hi").select("bucket", "_n")
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    rows = members.join(mixed, "bucket").withColumn("_own", F.pmod(F.xxhash64("doc_id"), blocks).cast("int")).withColumn("_with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = rows.select("bucket", F.least("_own", "_with").alias("i"), F.greatest("_own", "_with").alias("j"), (F.col("_own") > F.col("_with")).alias("_second"), "doc_id", "label", *columns)

    def run(batches):
        def close(key, held):
            if key is None or len(held) < 2 or len({r[2] for r in held}) < 2:
                return
            second = np.array([r[0] for r in held])
            first = np.arange(len(held)) if key[1] == key[2] else np.flatnonzero(~second)
            yield from work(key[0], first, first if key[1] == key[2] else np.flatnonzero(second), held)

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], f.type) for k, f in enumerate(layout)], schema=layout)

        key, held = None, []
        for batch in slices(batches):
            found = []
            for bucket, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (bucket, i, j) != key:
                    found += close(key, held)
                    key, held = (bucket, i, j), []
                held.append(row)
            yield batch_of(found)
        yield batch_of(list(close(key, held)))

    ordered = met.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    types = {pa.int64(): "long", pa.float64(): "double"}
    return ordered.mapInArrow(run, ", ".join(f"{f.name} {types[f.type]}" for f in layout))


def open_estimates(held: list, x: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Estimated similarities of rows of different components, -1 within one."""
    s = np.array([r[3] for r in held], np.int64).view(np.uint64)
    labels = np.array([r[2] for r in held])
    got = estimate(np.bitwise_count(s[x][:, None, :] ^ s[other][None, :, :]).sum(2, dtype=np.int64))
    got[labels[x][:, None] == labels[other][None, :]] = -1
    return got


def first_shared(held: list, bucket: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether this bucket is the first that the rows of a pair share; in later ones the pair is passed over."""
    bands = np.array([r[4] for r in held], np.int64)
    band = int((bands[0] == bucket).argmax())
    return ~(bands[p, :band] == bands[q, :band]).any(1)


def meet_elsewhere(members: DataFrame, least: float) -> DataFrame:
    """What the sketches say of members of one bucket in different components, in one pass over the blocks.

    Rows (null, a, b, estimate): the most similar partner (b) of a member (a), if it reaches
    ``least``. Rows (bucket, a, null, null): members that have any such partner. Either
    counts in the first bucket that the two share.
    """

    def work(bucket, first, second, held):
        found = np.zeros(len(held), bool)
        for left, right in ((first, second), (second, first))[:1 if first is second else 2]:
            for k in range(0, len(left), 128):
                x = left[k:k + 128]
                got = open_estimates(held, x, right)
                p, q = np.nonzero(got >= least)
                found[x[p[first_shared(held, bucket, x[p], right[q])]]] = True
                best = got.argmax(1)
                r = np.flatnonzero(got[np.arange(len(x)), best] >= least)
                for i in r[first_shared(held, bucket, x[r], right[best[r]])]:
                    yield None, held[x[i]][1], held[right[best[i]]][1], float(got[i, best[i]])
        for i in np.flatnonzero(found):
            yield bucket, held[i][1], None, None

    layout = pa.schema([("bucket", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("estimate", pa.float64())])
    return in_blocks(members, ["sketch", "bands"], work, layout)


def links_within(members: DataFrame, least: float, percent: int) -> DataFrame:
    """(a, b): links between components, confirmed on the full sets that the members bring along.

    A pair that shares several buckets is compared in the first only; of a block's links
    those that join two of its parts come out, so that there are fewer than members.
    """

    def work(bucket, first, second, held):
        parent: dict[int, int] = {}

        def root(v):
            while parent.get(v, v) != v:
                parent[v] = v = parent.get(parent[v], parent[v])
            return v

        sets = {}
        for k in range(0, len(first), 128):
            x = first[k:k + 128]
            p, q = np.nonzero(open_estimates(held, x, second) >= least)
            p, q = x[p], second[q]
            if first is second:
                p, q = p[p < q], q[p < q]
            new = first_shared(held, bucket, p, q)
            for i, j in zip(p[new].tolist(), q[new].tolist()):
                one, two = root(held[i][2]), root(held[j][2])
                if one != two:
                    for r in (i, j):
                        if r not in sets:
                            sets[r] = unpack(held[r][5])
                    if alike(sets[i], sets[j], percent):
                        parent[max(one, two)] = min(one, two)
                        yield held[i][1], held[j][1]

    return in_blocks(members, ["sketch", "bands", "items"], work, pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def best_of(pairs: DataFrame, column: str) -> DataFrame:
    """Per value of ``column`` the pair with the highest estimate, by a combined maximum."""
    other = "b" if column == "a" else "a"
    best = pairs.groupBy(column).agg(F.max(F.struct("estimate", F.col(other).alias("_o"))).alias("_best"))
    return best.select(F.col(column), F.col("_best._o").alias(other))


def link(feats: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Components (node, label) over the classes' smallest ids."""
    chosen = feats.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    reps = cut_lineage(feats.join(chosen.select("doc_id", "digest"), ["doc_id", "digest"], "left_semi").select("doc_id", "bands", "sketch"), "minhash-reps")
    sketches = reps.select("doc_id", "sketch")
    buckets = reps.select("doc_id", F.explode("bands").alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("_top")).where("hub < _top").select("bucket", "hub")
    shared = cut_lineage(buckets.join(hubs, "bucket").select("bucket", "doc_id", "hub"), "minhash-buckets")
    least = percent / 100 - MARGIN

    first = shared.where("doc_id > hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    likely = with_estimate(first, sketches).where(F.col("estimate") >= least)
    tried = cut_lineage(best_of(likely, "a").select("a", "b"), "minhash-first")
    links = cut_lineage(confirm(tried, docs, width, percent), "minhash-links")
    labels = components(links)

    def members(rows: DataFrame) -> DataFrame:
        return relabel(rows.select("bucket", "doc_id", F.col("doc_id").alias("label")), "label", labels)

    # every document offers its most similar partner elsewhere: most groups become one component here
    met = cut_lineage(meet_elsewhere(members(shared).join(reps, "doc_id"), least), "minhash-met")
    tried = cut_lineage(best_of(met.where("b IS NOT NULL"), "a").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "minhash-best")
    links = links.unionByName(cut_lineage(confirm(tried, docs, width, percent), "minhash-links"))
    labels = components(links)

    # components only grow, so what is still open was open before: it is compared on full sets, inside the blocks
    live = members(met.where("b IS NULL").select("bucket", F.col("a").alias("doc_id")).distinct())
    mixed = live.groupBy("bucket").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo < _hi").select("bucket")
    live = cut_lineage(live.join(mixed, "bucket"), "minhash-open")
    table = set_table(live.select("doc_id"), docs, width)
    whole = live.join(reps, "doc_id").join(table.withColumnRenamed("id", "doc_id"), "doc_id")
    labels = components(links.unionByName(cut_lineage(links_within(whole, least, percent), "minhash-links")))
    return labels


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    feats = cut_lineage(features(rows, width), "minhash-features")
    labels = link(feats, rows, width, percent)
    classes = feats.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("_rep"))
    own = feats.select("doc_id", "n", "digest").join(classes, "digest", "left").withColumn("_rep", F.coalesce("_rep", "doc_id"))
    return relabel(own, "_rep", labels).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("_rep")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("_rep"), F.lit(True)).alias("kept"))


def dedupe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = PERCENT) -> DataFrame:
    """The documents without all but one (the smallest id) of each component; rows that share a kept id come once."""
    found = cut_lineage(report(docs, id_col, text_col, width, percent), "minhash-report")
    gone = cut_lineage(found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "minhash-gone")
    kept = docs.join(bounded(gone), F.col(id_col).cast("long") == F.col("_gone"), "left_anti")
    twice = cut_lineage(found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_twice")), "minhash-twice")
    if not twice.limit(1).count():
        return kept
    same = F.col(id_col).cast("long") == F.col("_twice")
    return kept.join(bounded(twice), same, "left_anti").unionByName(kept.join(bounded(twice), same, "left_semi").dropDuplicates([id_col]))
