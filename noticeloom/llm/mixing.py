"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash of its id. A source of size S with target T takes
each document ``floor(T / S)`` times and those below a hash threshold once more. The
threshold is found without sorting: sizes are summed by source and the leading bits of
the hash, a running sum over these few buckets finds the one where the budget ends, and only
that bucket is summed again by its next bits. The group of equal hashes at the
threshold is taken when that comes nearer to the target.

Sources in code-point order (null last) get the weights of ``cycle`` in turn. Targets
share ``share`` of all sizes by weight; none goes above ``repeats`` times its source's
size, and what is cut off is shared again by weight until nothing is above.

The driver sees one aggregate row a round and one row per partition of the source list;
hot sources meet only as partial sums of at most 1,024 buckets. Null and word-less
texts have size 0; repeated ids share a hash and are decided together; an
empty table gives an empty result; other columns are kept by ``mix`` (its own
columns replace any of the same name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from noticeloom.session import cut_lineage

CYCLE, SHARE, REPEATS = (5, 2, 1), 1.5, 2
BITS, LEVELS = 10, 6
#: Sources that may be broadcast: rows of about 100 bytes.
BROADCAST_SOURCES = 200_000


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_of(id_col: str) -> Column:
    """60 bits of a digest that any engine can compute."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def key_of(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))


def _side(df: DataFrame) -> DataFrame:
    """Broadcast a table with a row per source while it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_SOURCES else df


def weighted(sources: DataFrame, cycle: tuple[int, ...]) -> DataFrame:
    """Weights in turn by code point; ranks come from counts per range, not from one sorted task."""
    ordered = sources.withColumn("_last", F.col("mix_key") == "n").repartitionByRange("_last", "mix_key").sortWithinPartitions("_last", "mix_key")
    # the running id is the partition's number in the upper bits and the row's place below
    placed = cut_lineage(ordered.drop("_last").withColumn("_id", F.monotonically_increasing_id()), "mix-sources")
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    offset, cases = 0, F.lit(0)
    for r in sorted(placed.groupBy("_part").count().collect()):
        cases = F.when(F.col("_part") == r["_part"], offset).otherwise(cases) if offset else cases
        offset = (offset + r["count"]) % len(cycle)
    rank = (F.col("_id").bitwiseAND((1 << 33) - 1) + cases) % len(cycle)
    return placed.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (rank + 1).cast("int"))).drop("_id", "_part")


def targets(sized: DataFrame, cycle: tuple[int, ...], share: float, repeats: float) -> DataFrame:
    """mix_key, source_size, target, budget (what is left after whole rounds), whole."""
    sources = weighted(sized.groupBy("mix_key").agg(F.sum("size").alias("source_size")), cycle)
    limit = F.col("source_size") * F.lit(repeats)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, done = 0.0, -1
    while True:  # one round of sharing the excess again
        capped = limit < F.col("weight") * F.lit(level) if done >= 0 else F.lit(False)
        row = sources.agg(F.sum(F.when(capped, limit)).alias("full"), F.sum(F.when(~capped, F.col("weight"))).alias("open"), F.sum(F.when(capped, 1).otherwise(0)).alias("n")).first()
        if row["n"] is None or row["n"] == done or not row["open"]:
            break
        level, done = (share * total - (row["full"] or 0)) / row["open"], row["n"]
    target = F.least(F.col("weight") * F.lit(float(level)), limit.cast("double"))
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0)
    return (sources.withColumn("target", target).withColumn("whole", whole.cast("long"))
            .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")).drop("weight"))


def thresholds(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds ``below`` and ``at``: hashes below it, and the hash itself if ``at``, are taken once more."""
    state = cut_lineage(sources.withColumn("prefix", F.lit(0).cast("long")).withColumn("left", F.col("budget")).withColumn("own", F.lit(0).cast("long")), "mix-targets")
    for step in range(LEVELS):
        shift = BITS * (LEVELS - step - 1)
        side = _side(state.select("mix_key", "prefix"))
        inside = sized.join(side, "mix_key").where(F.shiftright("hash", shift + BITS) == F.col("prefix")) if step else sized
        sums = inside.groupBy("mix_key", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("own"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        before = F.coalesce(F.sum("own").over(Window.partitionBy("mix_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        cut = sums.withColumn("before", before).join(state.select("mix_key", F.col("left").alias("_left")), "mix_key").where(
            (F.col("before") <= F.col("_left")) & (F.col("before") + F.col("own") > F.col("_left")))
        cut = cut.select("mix_key", F.col("bucket").alias("_bucket"), F.col("before").alias("_before"), F.col("own").alias("_own"), "lo", "hi")
        state = cut_lineage(state.drop("lo", "hi").join(cut, "mix_key", "left").select(
            "mix_key", "source_size", "target", "whole", "budget", F.coalesce("_bucket", F.shiftleft("prefix", BITS)).alias("prefix"),
            (F.col("left") - F.coalesce("_before", F.lit(0))).alias("left"), F.coalesce("_own", F.lit(0)).alias("own"), "lo", "hi"), "mix-level")
        if not state.where("lo < hi").limit(1).count():  # every boundary bucket holds one hash
            state = state.withColumn("prefix", F.coalesce("lo", F.shiftleft("prefix", shift)))
            break
    return state.select("mix_key", "source_size", "target", "whole", F.col("prefix").alias("below"),
                        ((F.col("own") > 0) & (F.col("left") * 2 >= F.col("own"))).alias("at"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cycle: tuple[int, ...] = CYCLE,
         share: float = SHARE, repeats: float = REPEATS) -> tuple[DataFrame, DataFrame]:
    """Sizes per document (id, mix_key, size, hash), and the thresholds per source."""
    sized = cut_lineage(docs.select(F.col(id_col).alias("doc_id"), key_of(source_col).alias("mix_key"), size_of(text_col).alias("size"),
                                    hash_of(id_col).alias("hash")), "mix-sizes")
    return sized, thresholds(sized, targets(sized, cycle, share, repeats))


def take(sized: DataFrame, found: DataFrame) -> DataFrame:
    """Adds source_size, target, copies and taken to rows with mix_key, size and hash."""
    joined = sized.join(_side(found), "mix_key")
    copies = F.col("whole") + F.when((F.col("hash") < F.col("below")) | F.col("at") & (F.col("hash") == F.col("below")), 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("size") * F.col("copies")).drop("whole", "below", "at", "mix_key", "hash")


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken."""
    sized, found = plan(docs, **options)
    return take(sized, found)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents that the mix takes, with how often (``copies``) and their ``taken`` words."""
    _, found = plan(docs, id_col, text_col, source_col, **options)
    kept = [c for c in docs.columns if c not in ("copies", "taken")]
    aside = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(kept)]  # so that no name meets one of the plan's
    rows = docs.select(*aside, key_of(source_col).alias("mix_key"), size_of(text_col).alias("size"), hash_of(id_col).alias("hash"))
    return take(rows, found).where("copies > 0").select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(kept)], "copies", "taken")


def report_sql() -> str:
    return r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [1, 5, 2][1 + row_number() OVER (ORDER BY source NULLS LAST) % 3] AS weight FROM d GROUP BY source),
c AS (SELECT *, sum(2 * source_size) OVER o AS full_here, sum(weight) OVER () - sum(weight) OVER o AS open_after, 2.0 * source_size / weight AS ratio,
             1.5 * sum(source_size) OVER () AS budget, row_number() OVER o AS n
      FROM s WINDOW o AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT full_here - 2 * source_size AS capped, open_after + weight AS open, ratio, budget, n FROM c),
v AS (SELECT arg_min((budget - capped)::DOUBLE / open, n) AS level FROM l WHERE (budget - capped)::DOUBLE / open <= ratio),
t AS (SELECT source, source_size, least(weight * level, 2.0 * source_size)::DOUBLE AS target FROM s, v),
w AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
g AS (SELECT source, h, sum(size) AS own FROM d GROUP BY source, h),
r AS (SELECT source, h, own, coalesce(sum(own) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
SELECT d.doc_id, d.size, w.source_size, w.target,
       CAST(d.size * (whole + CASE WHEN before + own <= target - whole * source_size
                                     OR (before <= target - whole * source_size AND own > 0 AND 2 * (target - whole * source_size - before) >= own)
                                   THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source JOIN r ON d.source IS NOT DISTINCT FROM r.source AND d.h = r.h
"""
