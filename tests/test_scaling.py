"""Work that has to grow no faster than its input: tasks, bytes written and bytes shuffled."""

import datetime
import hashlib
import random
import time
import uuid

from pyspark.sql import functions as F

from noticeloom import session
from noticeloom.operators import promotion, quality, snapshots
from noticeloom.operators.intervals import summarised
from noticeloom.plans import registry, source_queries
from noticeloom.plans.registry import Tables
from noticeloom.sources import objects
from tests.test_promotion import frame

START = datetime.datetime(2024, 1, 1)
SECOND = datetime.timedelta(seconds=1)


def test_costly_rows_of_one_row_group_get_many_tasks(spark, tmp_path):
    spark.range(1000).toDF("o_orderkey").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    t = Tables(spark, str(tmp_path))
    assert t.orders.rdd.getNumPartitions() == 1
    wide = t.wide("orders")
    assert wide.rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism
    assert sorted(r[0] for r in wide.collect()) == list(range(1000))


def test_summaries_of_intervals_at_a_moment(spark):
    """Equal to the pairs; a key that all rows share makes no more rows than it has moments and widths."""
    rng = random.Random(5)
    intervals = [(n, 0 if n % 3 else rng.randrange(5), a := START + rng.randrange(-90_000, 90_000) * SECOND, a + rng.choice([0, 1, 7, 60, 4096, 60_000, 10 ** 8]) * SECOND) for n in range(300)]
    intervals += [(900, None, START, START), (901, 0, None, START), (902, 0, START, None), (903, 0, START + SECOND, START), (904, 0, datetime.datetime(1900, 1, 1), datetime.datetime(9999, 12, 31)),
                  (905, 9, START, START), (None, 0, START, START + SECOND), (906, 0, START, START)]
    moments = [(n, 0 if n % 3 else rng.randrange(5), START + rng.randrange(-95_000, 99_000) * SECOND) for n in range(200)]
    moments += [(1000 + i, v[1], x) for i, v in enumerate(intervals) if i % 4 == 0 or i > 298 for x in (v[2], v[3], v[3] and v[3] + datetime.timedelta(microseconds=1) if v[0] != 904 else None)]
    want = {}
    for m, k, at in moments:
        for i, key, a, b in intervals:
            if None not in (k, at, a, b) and k == key and a <= at <= b:
                n, least, most = want.get(m, (0, None, None))
                want[m] = (n + 1, i if least is None else least if i is None else min(least, i), b if most is None else max(most, b))
    left = spark.createDataFrame(moments, "m long, k long, at timestamp_ntz")
    right = spark.createDataFrame(intervals, "i long, k long, starts_at timestamp_ntz, ends_at timestamp_ntz")
    measures = {"n": (F.sum, F.lit(1)), "least": (F.min, F.col("i")), "most": (F.max, F.col("ends_at"))}
    df = summarised(left, right, ["k"], "at", ["m"], measures)
    assert {r["m"]: (r["n"], r["least"], r["most"]) for r in df.collect()} == want
    assert summarised(left, right.limit(0), ["k"], "at", ["m"], measures).collect() == []


def test_promotion_leaves_only_its_state(spark, tmp_path, monkeypatch):
    """Rows that replace stored ones are written once, and what a batch set aside is gone when the state stands."""
    monkeypatch.setattr(session, "scratch_dir", lambda _, purpose: str(tmp_path / "aside" / f"{purpose}-{uuid.uuid4().hex}"))
    path, notices = str(tmp_path / "s"), spark.createDataFrame([(1, "recruitment")], "id long, category string")
    promotion.promote_batch(spark, path, frame(spark, [{"id": i, "unit_no": str(i)} for i in range(40)]), notices)
    promotion.promote_batch(spark, path, frame(spark, [{"id": 3, "unit_no": "x"}]), notices)
    promotion.promote_batch(spark, path, frame(spark, [{"id": i, "unit_no": "y"} for i in range(30)]), notices)
    assert promotion.promoted(spark, path).where("qa_status = 'approved'").count() == 11
    assert not any(p.is_dir() for p in (tmp_path / "aside").iterdir())
    named = snapshots.current(spark, path)
    assert len(named.folders) == 1 and named.base_rows == 40


def test_promotion_keeps_two_states_and_no_shuffles(spark, tmp_path):
    """Older versions and shuffle files do not add up from batch to batch; a state with identities as text goes on as it is."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {name for f in files.getAllFiles().mkString("\n").split("\n") if (name := f.rsplit("/", 1)[-1]).startswith("shuffle")}
    path, old, notices = str(tmp_path / "s"), str(tmp_path / "old"), spark.createDataFrame([(1, "recruitment")], "id long, category string")
    there = shuffles()
    batches = [[{"id": i, "unit_no": str(i // 2)} for i in range(40)], *[[{"id": i, "unit_no": f"{n} {i // 3}"} for i in range(n, 40)] for n in (0, 5)]]
    for n, batch in enumerate(batches):
        promotion.promote_batch(spark, path, frame(spark, batch), notices)
        if n == 0:
            state = snapshots.read(spark, path, ["id"])
            assert state.schema["identity"].dataType.typeName() == "binary"
            snapshots.upsert_snapshot(spark, old, state.withColumn("identity", F.lower(F.hex("identity"))), ["id"])
        elif n == 1:
            promotion.promote_batch(spark, old, frame(spark, batch), notices)
            status = lambda at: sorted(map(tuple, promotion.promoted(spark, at).select("id", "qa_status").collect()))
            assert status(path) == status(old)
        assert len(snapshots.versions(spark, path)) <= 2 and len([*(tmp_path / "s" / "data").iterdir()]) <= 2
    until = time.time() + 20
    while left := {n for n in shuffles() - there if n.endswith(".data")}:  # they are deleted in the background
        assert time.time() < until, left
        time.sleep(0.2)
    assert snapshots.read(spark, old, ["id"]).schema["identity"].dataType.typeName() == "string"
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"


def test_gate_moves_its_outcome_and_not_the_columns_it_reads(spark):
    """What is shuffled for the notices is the names of failed clauses, not the columns behind them."""
    rows = frame(spark, [{"id": 1}, {"id": 2, "unit_no": "", "notice_id": 5, "deposit_krw": 0}, {"id": 3, "notice_id": None}])
    notices = spark.createDataFrame([(1, "recruitment"), (5, "rejected")], "id long, category string").hint("merge")
    df = quality.evaluate(rows, notices).select("id", "failed_clauses", "passes")
    plain = quality.evaluate(rows, notices, quality.gate_clauses()).select("id", "failed_clauses", "passes")
    assert sorted(df.collect()) == sorted(plain.collect())
    side = df._jdf.queryExecution().optimizedPlan().toString().split("AS _failed")[0].splitlines()[-1]
    assert "Project" in side and "housing_name" not in side.split("array_join")[0] and "deposit_krw" not in side.split("array_join")[0]
    first = [r for r in quality.promote(frame(spark, [{"id": 1}, {"id": 2}]), notices).select("id", "qa_status").collect()]
    assert sorted(map(tuple, first)) == [(1, "approved"), (2, "rejected")]


def test_stored_files_need_no_folder_and_no_task_each(spark, tmp_path, monkeypatch):
    """One file an object as before, but no folder, checksum file or task for each; names and lines as Spark's writers have them."""
    monkeypatch.setattr(source_queries, "scratch_dir", lambda _, purpose: str(tmp_path / purpose))
    texts = [(n, f"s{n % 3}", f"line {n}\né") for n in range(500)]
    docs = spark.createDataFrame(texts, "doc_id long, source string, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["object_key"]: (r["sha256"], r["size_bytes"], r["differs"]) for r in registry.QUERIES["s12_stored_files"](spark, str(tmp_path)).collect()}
    want = {}
    for n, source, text in texts:
        want[f"{source}/{n // 50}"] = want.get(f"{source}/{n // 50}", b"") + text.encode() + b"\n"
    assert got == {k: (hashlib.sha256(v).hexdigest(), len(v), int(k.split("/")[1]) % 3 == 0) for k, v in want.items()}
    assert not (tmp_path / "objects").exists()  # nothing reads them again

    assert objects.write_objects(docs.repartition("source", "doc_id").sortWithinPartitions("source", "doc_id"), str(tmp_path / "many"), ["source", "doc_id"], "text") == 500
    stored = [*(tmp_path / "many").rglob("*")]
    assert sum(p.is_dir() for p in stored) == 3 and sum(p.is_file() for p in stored) == 500
    read = objects.read_objects(spark, str(tmp_path / "many"), "*.txt")
    assert read.count() == 500 and read.rdd.getNumPartitions() <= 3 * spark.sparkContext.defaultParallelism  # a task takes 32 files otherwise

    odd = spark.createDataFrame([("a/b=%", 1, "x"), (None, 1, "y"), ("", 1, None), ("c", None, "z"), ("c", None, "é")], "source string, block int, text string")
    assert objects.write_objects(odd.coalesce(1), str(tmp_path / "odd"), ["source", "block"], "text") == 4
    assert objects.write_objects(odd.limit(0), str(tmp_path / "none"), ["source", "block"], "text") == 0
    found = {(r["path"].split("odd/")[1].split(".part-")[0], bytes(r["content"]).decode()) for r in objects.read_objects(spark, str(tmp_path / "odd"), "*.txt").collect()}
    none = "__HIVE_DEFAULT_PARTITION__"
    assert found == {("source=a%2Fb%3D%25/block=1", "x\n"), (f"source={none}/block=1", "y\n"), (f"source={none}/block=1", "\n"), (f"source=c/block={none}", "z\né\n")}
    assert objects.read_objects(spark, str(tmp_path / "none"), "*.txt").count() == 0
