"""Which listed rows need a detail look-up: known, seen, target and cutoff rules."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticeloom import fixed
from noticeloom.functions import dates as D
from noticeloom.functions import text as T
from noticeloom.operators import phrases
from noticeloom.operators.classify import NOTICE_RULES, notice_category
from noticeloom.operators.dedupe import first_row, key_set
from noticeloom.session import cut_lineage


def skip_known(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(key_set(known, *keys), keys, "left_anti")


def can_skip_seen(title, posted_at, now, status="seen_status", title_hash="seen_title_hash",
                  seen_posted="seen_posted_at", expires_at="seen_expires_at") -> Column:
    """A cached reject that has not expired and still has the same title and day."""
    rejected = T._col(status).isin(fixed.SEEN_REJECTED, fixed.SEEN_UNKNOWN)
    fresh = T._col(expires_at).isNull() | (T._col(expires_at) > now)
    same_title = (F.coalesce(T._col(title_hash), F.lit("")) == "") | (T._col(title_hash) == T.title_hash(title))
    return F.coalesce(rejected & fresh & same_title & F.coalesce(D.same_day(seen_posted, posted_at), F.lit(True)),
                      F.lit(False))


def with_seen(rows: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the cache entry of each row. The cache is unique per key."""
    entry = cache.select(*keys, F.col("status").alias("seen_status"), F.col("list_title_hash").alias("seen_title_hash"),
                         F.col("posted_at").alias("seen_posted_at"), F.col("expires_at").alias("seen_expires_at"))
    return rows.join(entry, keys, "left")


def match_targets(rows: DataFrame, targets: DataFrame, row_key: Column, target_key: str, tasks: int = 0) -> DataFrame:
    """Add ``target``: the least target title that equals, holds or is held by the row's title key.

    Empty keys match nothing. Rows are read where they stand, without a shuffle, as long as
    the targets make up one block (``phrases``) and no number of ``tasks`` is given.
    """
    return phrases.with_least(rows.withColumn("_row_key", row_key), "_row_key", phrases.blocks(targets.select(target_key)), "target", tasks).drop("_row_key")


def parts_of(lists: DataFrame) -> DataFrame:
    """(``_text``, ``_part``): keys that share a target, directly or through others, share a part.

    Every key takes the least label of its targets, every target the least of its keys, and
    labels are replaced by their own labels, until nothing changes: as many rounds as the
    logarithm of the longest chain of overlapping keys, whatever the numbers of keys and targets.
    """
    pairs = cut_lineage(lists.select("_text", F.explode("_found").alias("t")), "target-pairs")
    labels = pairs.select("t", F.col("t").alias("_part")).distinct()
    while True:
        keys = pairs.join(labels, "t").groupBy("_text").agg(F.min("_part").alias("_part"))
        new = pairs.join(keys, "_text").groupBy("t").agg(F.min("_part").alias("_part"))
        up = new.select(F.col("t").alias("_part"), F.col("_part").alias("_up"))
        old = labels.select("t", F.col("_part").alias("_old"))
        moved = cut_lineage(new.join(up, "_part").join(old, "t").select("t", F.col("_up").alias("_part"), (F.col("_up") != F.col("_old")).alias("_moved")), "target-parts")
        labels = moved.drop("_moved")
        if not moved.where("_moved").limit(1).count():
            return lists.select("_text", F.col("_found")[0].alias("t")).join(labels, "t").select("_text", "_part")


#: Rows of one title on a board are ranked in so many groups, so that a hot title is not sorted in one task.
RANK_GROUPS = 64
#: Pairs of a title and a target that one pass over a board takes in; more are split in parts.
PART_PAIRS = 200_000


def use_up_targets(rows: DataFrame, targets: DataFrame, row_key: Column, target_key: str, keys: list[str], order: list[str]) -> DataFrame:
    """Add ``target`` and ``is_target`` as a reader in ``order`` would, who uses up one target a row.

    A row takes the least of its targets that is still free. Of the rows of one title on a
    board, no more can take a target than the title has targets; most others are left out.
    What remains falls into parts of titles that share targets (one part, where there are
    few pairs). Each part of a board is read in order in one pass, which holds the part's
    target lists and what is used up. Rows without a free target show the least target they
    match, if any. Rows with a null key take none; rows at one place of a board take one
    each and all show the least of these.
    """
    wanted = phrases.blocks(targets.select(target_key))
    keyed = rows.withColumn("_row_key", row_key)
    if wanted.many > 1:  # read several times then, and a key costs more than reading it
        keyed = cut_lineage(keyed, "keyed-rows")
    marked = cut_lineage(phrases.with_least(keyed, "_row_key", wanted, "_least"), "target-rows")
    at = F.struct(*order)
    hits = marked.where("_least IS NOT NULL").select(*keys, at.alias("_at"), "_row_key")
    lists = cut_lineage(phrases.all_matches(hits.select("_row_key"), wanted), "target-lists")
    ranked = Window.partitionBy(*keys, "_row_key", F.pmod(F.xxhash64("_at"), F.lit(RANK_GROUPS))).orderBy("_at")
    able = hits.join(lists.withColumnRenamed("_text", "_row_key"), "_row_key").withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= F.size("_found"))
    first = F.when(F.col("_n") == 1, F.col("_found")).alias("_found")
    placed = able.select(*keys, "_at", "_row_key", first)
    if (lists.agg(F.sum(F.size("_found")).alias("n")).first()["n"] or 0) <= PART_PAIRS:
        placed = placed.withColumn("_part", F.lit(""))
    else:
        placed = placed.join(parts_of(lists).withColumnRenamed("_text", "_row_key"), "_row_key")
    taken = _read_in_order(placed, keys).groupBy(*keys, "_at").agg(F.min("_taken").alias("_taken"))
    joined = marked.withColumn("_at", at).join(taken, [*keys, "_at"], "left")
    return joined.withColumn("target", F.coalesce("_taken", "_least")).withColumn("is_target", F.col("_taken").isNotNull()).drop("_row_key", "_at", "_taken", "_least")


def _read_in_order(placed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ``_at``, ``_taken``) of the rows that take a target, part by part in the order of ``_at``."""
    group = [*keys, "_part"]

    def run(batches):
        now, lists, used, start = None, {}, set(), {}
        for batch in batches:
            where, taken = [], []
            for i, (part, key, found) in enumerate(zip(zip(*(batch.column(c).to_pylist() for c in group)), batch.column("_row_key").to_pylist(), batch.column("_found").to_pylist())):
                if part != now:
                    now, lists, used, start = part, {}, set(), {}
                mine = lists.setdefault(key, found)
                k = start.get(key, 0)
                while k < len(mine) and mine[k] in used:
                    k += 1
                if k < len(mine):
                    used.add(mine[k])
                    where.append(i)
                    taken.append(mine[k])
                start[key] = k
            kept = batch.take(pa.array(where, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in (*keys, "_at")), pa.array(taken, pa.string())], names=[*keys, "_at", "_taken"])

    shape = StructType([placed.schema[c] for c in (*keys, "_at")]).add("_taken", "string")
    ordered = placed.repartition(*group).sortWithinPartitions(*group, "_at")
    return ordered.select(*group, "_at", "_row_key", "_found").mapInArrow(run, shape)


def outcome(is_old, is_target, is_known, is_seen) -> Column:
    """Cutoff, then known, then seen; a target passes the cutoff and the cache."""
    return (F.when(is_old & ~is_target, "skipped_old").when(is_known, "skipped_known")
            .when(is_seen & ~is_target, "skipped_seen").otherwise("detail"))


def early_stop(rows: DataFrame, board: list[str], page: str, pending: DataFrame | None = None, everywhere: DataFrame | None = None) -> DataFrame:
    """Drop the pages a reader would not have asked for.

    Reading stops after the first page with an old row, once every pending target
    of the board has been met. ``pending`` lists (board, target), ``everywhere`` the
    targets of all boards instead; without both there are no targets. Works on
    per-page aggregates, so a big board is not gathered.
    """
    pages = rows.groupBy(*board, page).agg(F.max(F.col("outcome") == "skipped_old").alias("_old"))
    if everywhere is not None:
        wanted = everywhere.select("target").distinct().count()  # one number: a board has met all when it has met so many
        met = rows.where("is_target").groupBy(*board, "target").agg(F.min(page).alias("_met"))
        met = met.groupBy(*board).agg(F.count("_met").alias("_n"), F.max("_met").alias("_at"))
        ready = pages.select(*board).distinct().join(met, board, "left").withColumn(
            "_ready", F.when(F.coalesce("_n", F.lit(0)) == wanted, F.coalesce("_at", F.lit(0)))).drop("_n", "_at")
    elif pending is None:
        ready = pages.select(*board).distinct().withColumn("_ready", F.lit(0))
    else:
        met = (rows.where("is_target").groupBy(*board, "target").agg(F.min(page).alias("_met")))
        ready = (pending.select(*board, "target").distinct().join(met, [*board, "target"], "left")
                 .groupBy(*board).agg(F.when(F.count("_met") == F.count(F.lit(1)), F.max("_met")).alias("_ready"),
                                      F.count(F.lit(1)).alias("_targets")))
        ready = (pages.select(*board).distinct().join(ready, board, "left")
                 .withColumn("_ready", F.when(F.col("_targets").isNull(), F.lit(0)).otherwise(F.col("_ready")))
                 .drop("_targets"))
    stop = (pages.join(ready, board).where(F.col("_old") & (F.col(page) >= F.col("_ready")))
            .groupBy(*board).agg(F.min(page).alias("_stop")))
    return rows.join(stop, board, "left").where(F.col("_stop").isNull() | (F.col(page) <= F.col("_stop"))).drop("_stop")


def select_wanted(rows: DataFrame, wanted: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First listed row of each wanted key, and a bare row for keys that are not listed."""
    want = wanted.select(*keys).distinct()
    listed = first_row(rows.join(want, keys, "left_semi"), keys, order)
    unlisted = want.join(key_set(rows, *keys), keys, "left_anti")
    return listed.unionByName(unlisted, allowMissingColumns=True)


def judge_details(rows: DataFrame, title="title", detail_title="detail_title", body="body_text",
                  rules=NOTICE_RULES) -> DataFrame:
    """Final title and category of the rows whose detail page was read."""
    final = T.first_non_empty(F.coalesce(T._col(detail_title), F.lit("")), T._col(title))
    return rows.withColumn("final_title", T.trim_ws(final)).withColumn(
        "category", notice_category(F.col("final_title"), body, rules))


def seen_entries(rejected: DataFrame, keys: list[str], title: str, reason: str, now) -> DataFrame:
    """Cache entries for rejected rows; unknown ones expire sooner than rejected ones."""
    status = F.when(F.col(reason) == fixed.CATEGORY_UNKNOWN, fixed.SEEN_UNKNOWN).otherwise(fixed.SEEN_REJECTED)
    days = F.create_map(*[F.lit(x) for kv in fixed.SEEN_TTL_DAYS.items() for x in kv])
    return (rejected.withColumn("status", status).withColumn("list_title_hash", T.title_hash(title))
            .withColumn("expires_at", now + F.make_dt_interval(F.element_at(days, F.col("status"))))
            .withColumn("seen_count", F.lit(1)))
