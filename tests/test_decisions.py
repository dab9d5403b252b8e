import datetime as dt
import random

from pyspark.sql import functions as F

from noticeloom.functions import text as T
from noticeloom.operators import availability as A
from noticeloom.operators import discovery, enrich, reconcile
from noticeloom.plans import serve

NOW = dt.datetime(2026, 5, 22, 12, 0)


def at(hours):
    return NOW + dt.timedelta(hours=hours)


def test_schedule_state_bounds_are_inclusive(spark):
    rows = [(1, at(-2), at(0)), (2, at(0), at(2)), (3, at(1), at(2)), (3, at(5), at(6)), (4, at(-9), at(-8)), (4, at(-5), at(-4)), (4, at(-7), at(-4)), (5, None, at(1)),
            (6, at(-9), at(-8)), (6, at(3), at(4))]
    df = spark.createDataFrame(rows, "n int, starts_at timestamp, ends_at timestamp")
    got = {r.n: (r.schedule_status, r.starts_at) for r in A.schedule_state(df, ["n"], F.lit(NOW)).collect()}
    assert got == {1: ("open", at(-2)), 2: ("open", at(0)), 3: ("pending", at(1)), 4: ("closed", at(-7)), 6: ("pending", at(3))}


def test_application_beats_schedule_and_conflict(spark):
    notices = spark.createDataFrame([(i, "SH", "r", str(i), "t") for i in range(1, 5)], "id int, agency string, board_kind string, seq string, title string")
    offers = spark.createDataFrame([(1,), (1,), (2,), (3,)], "notice_id int")
    times = spark.createDataFrame([(1, "application", at(1), at(2)), (2, "application", at(-3), at(-2)), (2, "contract", at(-1), at(1))],
                                  "notice_id int, schedule_type string, starts_at timestamp, ends_at timestamp")
    apps = spark.createDataFrame([(1, "접수예정"), (1, "청약중"), (2, " 청약중 "), (3, "마감")], "notice_id int, status string")
    rows = A.ranked(A.availability(notices, offers, times, apps, F.lit(NOW))).collect()
    assert [(r.notice_id, r.status, r.status_source, r.conflict, r.approved_offerings) for r in rows] == [
        (1, "open", "application_notice", True, 2), (2, "closed", "schedule", False, 1), (3, "unknown", "none", False, 1)]


def test_limits():
    assert [serve.api_limit(x) for x in ("", "x", "-1", "5", "5000", None)] == [200, 200, 200, 5, 1000, 200]
    assert [serve.table_limit(x) for x in (0, 1001, 7)] == [200, 200, 7]


def test_reconcile_last_candidate_and_unknown_days(spark):
    d = dt.date(2026, 4, 29)
    apps = spark.createDataFrame([("a", "입주자 모집 공고(2026.4.29)", d), ("b", "공고", None), ("c", "공고", d)], "code string, title string, posted_at date")
    cands = spark.createDataFrame([("1", "입주자모집공고 2026.04.29", d, 1), ("2", "[입주자모집] 공고 2026.4.29", d, 2), ("3", "공고", None, 3)],
                                  "seq string, title string, posted_at date, position int")
    linked, unmatched = reconcile.reconcile(apps, cands)
    assert sorted((r.code, r.board_seq) for r in linked.collect()) == [("a", "2"), ("b", "3")]
    assert [r.code for r in unmatched.collect()] == ["c"]


def test_target_matching_equals_brute_force(spark):
    random.seed(7)
    word = lambda n: "".join(random.choice("ab") for _ in range(n))
    titles = ["", *[word(random.randint(1, 14)) for _ in range(60)]]
    targets = ["", *[word(random.randint(2, 20)) for _ in range(12)]]
    rows = spark.createDataFrame(list(enumerate(titles)), "id int, title string")
    got = {r.id: r.target for r in discovery.match_targets(rows, spark.createDataFrame([(t,) for t in targets], "t string"), F.col("title"), "t").collect()}
    for i, title in enumerate(titles):
        hits = [t for t in targets if t and title and (t in title or title in t)]
        assert got[i] == (min(hits) if hits else None)


def test_discovery_equals_a_sequential_reader(spark):
    """Cutoff, known, seen and target rules and the early stop against a plain loop."""
    random.seed(3)
    for trial in range(3):
        rows = [(p, i, f"t{random.randint(0, 9)}", p + random.randint(-3, 3) > 4, random.random() < .2, random.random() < .2) for p in range(1, 9) for i in range(4)]
        targets = {"t3", "t7"} if trial else set()
        pending, want, stopped = set(targets), {}, False
        for page in range(1, 9):
            if stopped:
                break
            old_here = False
            for p, i, title, old, known, seen in [r for r in rows if r[0] == page]:
                hit = title in pending
                if old and not hit:
                    want[(p, i)], old_here = "skipped_old", True
                    continue
                want[(p, i)] = "skipped_known" if known else "skipped_seen" if seen and not hit else "detail"
                if want[(p, i)] != "skipped_seen":
                    pending.discard(title)
            stopped = old_here and not pending
        df = spark.createDataFrame([("b", *r) for r in rows], "board string, page int, pos int, title string, is_old boolean, is_known boolean, is_seen boolean")
        wanted = spark.createDataFrame([("b", t) for t in targets], "board string, target string")
        flagged = discovery.use_up_targets(df, wanted, F.col("title"), "target", ["board"], ["page", "pos"])
        decided = flagged.withColumn("outcome", discovery.outcome(F.col("is_old"), F.col("is_target"), F.col("is_known"), F.col("is_seen")))
        got = {(r.page, r.pos): r.outcome for r in discovery.early_stop(decided, ["board"], "page", wanted).collect()}
        assert got == want


def test_seen_cache_expiry_hash_and_day(spark):
    row = ("제목", dt.date(2026, 5, 1))
    h = spark.range(1).select(T.title_hash(F.lit("제목"))).first()[0]
    cases = [("rejected", h, row[1], at(1), True), ("rejected_unknown", "", None, None, True), ("rejected", h, row[1], at(0), False),
             ("rejected", "other", row[1], at(1), False), ("rejected", h, dt.date(2026, 5, 2), at(1), False), ("accepted", h, row[1], at(1), False)]
    df = spark.createDataFrame([(*row, *c[:4]) for c in cases], "title string, posted_at date, seen_status string, seen_title_hash string, seen_posted_at date, seen_expires_at timestamp")
    assert [r[0] for r in df.select(discovery.can_skip_seen("title", "posted_at", F.lit(NOW))).collect()] == [c[4] for c in cases]


def test_enrichment_fills_only_what_is_missing(spark):
    left = spark.createDataFrame([(1, " ", None, 0), (2, "own", 5, 3)], "k int, t string, n int, c int")
    right = spark.createDataFrame([(1, "r", 7, 8), (2, "r", 7, 8)], "k int, t string, n int, c int")
    got = enrich.fill_missing(left, right, ["k"], ["t"], ["n"], ["c"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "r", 7, 8), (2, "own", 5, 3)]


def test_overlapping_targets_are_used_up_in_order(spark):
    random.seed(11)
    word = lambda: "".join(random.choice("ab") for _ in range(random.randint(1, 5)))
    rows = [("x" if i % 2 else "y", i, word()) for i in range(80)] + [("z", 0, "xab"), ("z", 1, "yab")]
    targets = sorted({word() for _ in range(15)} | {"a", "ab"})
    want = {}
    for board in "xyz":
        free = list(targets)
        for _, i, title in [r for r in rows if r[0] == board]:
            hit = next((t for t in free if t in title or title in t), None)
            want[(board, i)] = hit
            free = [t for t in free if t != hit]
    df = spark.createDataFrame(rows, "board string, pos int, title string")
    got = discovery.use_up_targets(df, spark.createDataFrame([(t,) for t in targets], "t string"), F.col("title"), "t", ["board"], ["pos"]).collect()
    assert {(r.board, r.pos): r.target if r.is_target else None for r in got} == want and len(got) == len(rows)
