from pyspark.sql import functions as F

from noticeloom.operators import dedupe, upsert
from noticeloom.streaming import incremental


def test_upsert_rules_and_last_wins(spark):
    target = spark.createDataFrame([(1, "approved", "old", 5), (2, "rejected", "old", 5)], "k long, qa_status string, label string, notice_id long")
    batch = spark.createDataFrame([(1, "pending", "a", 9, 1), (1, "pending", "b", 9, 2), (3, "pending", "c", 9, 3)], "k long, qa_status string, label string, notice_id long, p int")
    rules = {"qa_status": upsert.approval_sticks, "notice_id": upsert.keep_old}
    once = upsert.upsert(target, batch, ["k"], rules, F.col("p"))
    twice = upsert.upsert(once, batch, ["k"], rules, F.col("p"))
    want = [(1, "approved", "b", 5), (2, "rejected", "old", 5), (3, "pending", "c", 9)]
    assert sorted(map(tuple, once.collect())) == want == sorted(map(tuple, twice.collect()))


def test_uniqueness_report(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "")], "a int, b string")
    assert [tuple(r) for r in upsert.duplicates(df, ["a", "b"]).collect()] == [(1, "x", 2)]


def test_fill_down_and_ordinals_cross_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "BLOCK", 4)
    rows = [("a" if i % 3 else "b", i, i if i % 11 == 5 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, p int, v int")
    got = {(r.k, r.p): r.c for r in dedupe.fill_down(df, ["k"], "p", "v", "c").collect()}
    assert got == {(r.k, r.p): r.c for r in dedupe.fill_down(df, ["k"], "p", "v", "c", levels=2).collect()}
    ords = {(r.k, r.p): (r.ordinal, r.total) for r in dedupe.ordinals(df, ["k"], "p", total="total").collect()}
    last, seen = {}, {}
    totals = {k: sum(1 for r in rows if r[0] == k) for k in "ab"}
    for k, p, v in rows:
        last[k] = v if v is not None else last.get(k)
        seen[k] = seen.get(k, 0) + 1
        assert got[(k, p)] == last[k]
        assert ords[(k, p)] == (seen[k], totals[k])
    assert len(got) == 200


def test_stream_dedupe_late_rows_and_late_repeats(spark, tmp_path):
    landed, table = str(tmp_path / "landed"), str(tmp_path / "table")
    batches = [[("a", 1, "2024-03-01"), ("a", 2, "2024-03-02")], [("b", 3, "2023-01-01"), (None, 4, "2024-03-03")],
               [("a", 5, "2024-12-01"), (None, 6, "2024-12-01"), ("b", 7, "2024-12-01")]]

    def run(marks):
        stream = incremental.landed_stream(spark, landed, "k string, n int, ts string")
        incremental.dedupe_available(stream, table, str(tmp_path / marks), ["k"], [F.col("n")])

    for rows in batches:
        spark.createDataFrame(rows, "k string, n int, ts string").write.mode("append").parquet(landed)
        run("marks")
    want = [("a", 1), ("b", 3), ("null", 4)]
    got = lambda: sorted((str(r.k or "null"), r.n) for r in spark.read.parquet(table).collect())
    assert got() == want
    run("lost")  # a new checkpoint brings every batch again
    assert got() == want
    assert {r.key_bucket for r in spark.read.parquet(table).select("key_bucket").distinct().collect()} <= set(range(incremental.KEY_BUCKETS))
