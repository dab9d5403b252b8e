"""Target titles: automata over blocks, parts of titles that share targets, fixed numbers of jobs."""

import random

import pytest
from pyspark.sql import functions as F

from noticeloom.operators import discovery, phrases, windows


def brute(titles, targets):
    return {t: sorted(x for x in set(targets) if x and t and (x in t or t in x)) for t in titles}


def made(seed, letters, many, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(many)]


@pytest.mark.parametrize("chars", [1 << 20, 150])
def test_blocks_and_slices_change_no_match(spark, monkeypatch, chars):
    monkeypatch.setattr(phrases, "BLOCK_CHARS", chars)
    titles = ["", "중", "aé중", "x" * 3000, *made(1, "abé중", 120, 9)]
    targets = ["", "a", "중", "y" * 2000 + "x" * 3, *made(2, "abé중", 60, 12)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*titles, None, titles[5]])], "id long, t string")
    wanted = phrases.blocks(spark.createDataFrame([(t,) for t in [*targets, None]], "x string"))
    assert (wanted.many > 1) == (chars == 150)
    want = brute(titles, targets)
    got = phrases.with_least(rows, "t", wanted, "least").collect()
    assert len(got) == len(titles) + 2 and all(r["least"] == next(iter(want.get(r["t"], [])), None) for r in got)
    lists = {r["_text"]: r["_found"] for r in phrases.all_matches(rows.select("t"), wanted).collect()}
    assert lists == {t: m for t, m in want.items() if m}


def test_slices_are_bounded(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE_ROWS", 3)
    monkeypatch.setattr(phrases, "SLICE_CHARS", 10)
    texts = ["aaaa", "bb", "c" * 30, "d", "e", "f", "g"]
    assert list(phrases.slices(texts)) == [(0, 2), (2, 3), (3, 6), (6, 7)]
    own = phrases.Block(["b", "cc", "xgx"])
    assert [sorted(own.phrases[i] for i in h) for _, _, found in own.matches(texts) for h in found] == [[], ["b"], ["cc"], [], [], [], ["xgx"]]


def in_order(rows, targets):
    want = {}
    for board in {r[0] for r in rows}:
        free = sorted(set(targets) - {""})
        for _, at, title in sorted(r for r in rows if r[0] == board):
            hit = next((t for t in free if title and (t in title or title in t)), None)
            want[board, at] = hit
            free = [t for t in free if t != hit]
    return want


@pytest.mark.parametrize("pairs", [200_000, 0])
def test_targets_are_used_up_part_by_part(spark, monkeypatch, pairs):
    monkeypatch.setattr(discovery, "PART_PAIRS", pairs)
    monkeypatch.setattr(discovery, "RANK_GROUPS", 2)
    rng = random.Random(4)
    titles = made(5, "abcd", 40, 6) + ["hot title"] * 30
    rows = [(rng.choice("xy"), i, rng.choice(titles)) for i in range(300)]
    targets = made(6, "abcd", 25, 5) + [f"hot title {i}" for i in range(7)] + ["hot", "title"]
    df = spark.createDataFrame(rows, "board string, pos int, title string")
    got = discovery.use_up_targets(df, spark.createDataFrame([(t,) for t in targets], "t string"), F.col("title"), "t", ["board"], ["pos"]).collect()
    assert {(r.board, r.pos): r.target if r.is_target else None for r in got} == in_order(rows, targets) and len(got) == len(rows)


def test_parts_are_connected_titles(spark):
    lists = [("p", ["a", "b"]), ("q", ["b", "c"]), ("r", ["x"]), ("s", ["c", "d"]), ("t", ["y", "x"])] + [(f"n{i}", [f"k{i:02}", f"k{i + 1:02}"]) for i in range(30)]
    got = {r["_text"]: r["_part"] for r in discovery.parts_of(spark.createDataFrame([(t, sorted(f)) for t, f in lists], "_text string, _found array<string>")).collect()}
    assert got["p"] == got["q"] == got["s"] and got["r"] == got["t"] != got["p"]
    assert len({got[f"n{i}"] for i in range(30)}) == 1 and len(got) == len(lists)


def test_number_of_jobs_does_not_grow_with_equal_titles(spark, monkeypatch):
    monkeypatch.setattr(discovery, "PART_PAIRS", 0)
    tracker, used = spark.sparkContext.statusTracker(), []
    for many in (10, 1000):
        rows = spark.createDataFrame([("b", i, "same title") for i in range(many)], "board string, pos int, title string")
        targets = spark.createDataFrame([(f"same title {i:04}",) for i in range(many)], "t string")
        spark.sparkContext.setJobGroup(f"equal-{many}", "equal titles")
        got = discovery.use_up_targets(rows, targets, F.col("title"), "t", ["board"], ["pos"]).collect()
        used.append(len(tracker.getJobIdsForGroup(f"equal-{many}")))
        assert sorted((r.pos, r.target) for r in got if r.is_target) == [(i, f"same title {i:04}") for i in range(many)]
    assert used[1] <= used[0] + 2


def test_many_phrases_are_joined_and_not_read_block_by_block(spark, monkeypatch):
    """No phrase is collected and the jobs do not grow with the blocks, also where the bitmap lets most windows through."""
    monkeypatch.setattr(phrases, "BLOCK_CHARS", 100)
    monkeypatch.setattr(windows, "MOST_BITS", 1 << 16)
    monkeypatch.setattr(windows, "BITS_PER_NEEDLE", 1)
    monkeypatch.setattr(windows, "SLICE_BYTES", 300)
    tracker, used = spark.sparkContext.statusTracker(), []
    for many in (40, 4000):
        targets = [f"중{i}é{'x' * (i % 23)}" for i in range(many)]
        titles = [f"a중{i * 7}é{'x' * (i % 50)}" for i in range(90)] + ["é", "x" * 22, "x" * 23, "5é", *targets[:9], "q" * 2000 + targets[5] + "z"]
        rows = spark.createDataFrame([(t,) for t in titles], "t string")
        spark.sparkContext.setJobGroup(f"many-{many}", "many phrases")
        wanted = phrases.blocks(spark.createDataFrame([(t,) for t in targets], "x string"))
        got = {r["t"]: r["least"] for r in phrases.with_least(rows, "t", wanted, "least").collect()}
        lists = {r["_text"]: r["_found"] for r in phrases.all_matches(rows, wanted).collect()}
        used.append(len(tracker.getJobIdsForGroup(f"many-{many}")))
        want = brute(titles, targets)
        assert wanted.only == [] and lists == {t: m for t, m in want.items() if m}
        assert got == {t: next(iter(m), None) for t, m in want.items()}
    assert used[1] <= used[0] + 8


def test_windows_that_only_look_like_needles_are_not_matches(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_CHARS", 10)
    monkeypatch.setattr(windows, "_known", lambda bitmap, hashes: hashes == hashes)  # every window passes
    rows = spark.createDataFrame([("abéd",), ("zzé",), ("b",), ("中x",)], "t string")
    wanted = phrases.blocks(spark.createDataFrame([("éd",), ("bé",), ("long phrase b",), ("x",)], "x string"))
    assert {r["t"]: r["l"] for r in phrases.with_least(rows, "t", wanted, "l").collect()} == {"abéd": "bé", "zzé": None, "b": "bé", "中x": "x"}
