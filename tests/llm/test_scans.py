"""Licences, benchmark windows, archives and the source mix on rows that are easy to get wrong."""

import gzip
import hashlib
import os
import random

import pytest

from noticeloom.llm import decontam, licenses, mixing, warc
from noticeloom.llm.text import ALNUM as RULE
from noticeloom.llm.text import SPACED as OTHER
from noticeloom.llm.text import Words
from tests.llm.cases import ALNUM, SPACED, empty, odd_rows, prose, table, words


def test_words_equal_the_patterns():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB3 \t\né中.-\x00_Zİ") for _ in range(rng.randrange(60))) for _ in range(200)] + ["x" * 70_000]
    for rule, pattern in ((RULE, ALNUM), (OTHER, SPACED)):
        seen = Words([t.encode() for t in texts], rule)
        for i, t in enumerate(texts):
            assert [seen.word(k).decode() for k in range(seen.bounds[i], seen.bounds[i + 1])] == words(t, pattern)
        by_word = {}
        for k, h in enumerate(seen.hashes.tolist()):
            by_word.setdefault(h, set()).add(seen.word(k))
        assert all(len(v) == 1 for v in by_word.values())


def items(spark):
    return spark.createDataFrame([(1, prose(50, 30), 1), (2, "Short item, here", 1), (3, None, 1), (4, "...", 1), (1, prose(50, 30), 1), (10, prose(50, 12), 1), (None, "null id words", 1)], "item_id long, text string, n_hit int")


def leak_rows():
    return [(1, f"Intro {prose(50, 30)[3:]} outro", "en", "a"), (2, "a short ITEM here b short item", "en", "a"), (3, prose(51, 2000), "en", "a"), (4, prose(50, 30), "en", "a"),
            (4, prose(50, 30), "en", "a"), *odd_rows()]


@pytest.mark.parametrize("block_bytes", [1 << 25, 400])
def test_benchmark_hits_equal_brute_force(spark, block_bytes):
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in
           decontam.report(table(spark, leak_rows()), items(spark), block_bytes=block_bytes).collect()}
    windows = {}
    for r in items(spark).where("item_id is not null").collect():
        w = words(r["text"])
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(r["item_id"]))
    for i, text, *_ in leak_rows():
        w, hit, own = words(text), set(), set()
        for s in range(len(w)):
            for n in range(1, 11):
                if tuple(w[s:s + n]) in windows and s + n <= len(w):
                    hit.update(range(s, s + n))
                    own |= windows[tuple(w[s:s + n])]
        assert got[i] == (len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit))
    assert got[1][1] > 0 and got[2][1] == 3 and got[3][1] == 0


def test_hit_words_are_cut_out_and_the_rest_stays(spark):
    docs = table(spark, leak_rows())
    left = decontam.remove(docs, items(spark))
    assert left.columns == docs.columns
    kept = {r["doc_id"]: r["text"] for r in left.collect()}
    assert 4 not in kept and kept[2] == "a  b short item" and kept[3] == leak_rows()[2][1] and kept[900] is None
    assert decontam.report(empty(spark), items(spark)).count() == 0
    assert not any(r["contaminated"] for r in decontam.report(docs, items(spark).limit(0)).collect())


def test_licence_places_and_labels(spark):
    rows = [(1, "x GNU  General, Public-License! mit license", "en", "a"), (2, "Licensed under the Apache License, Version 2.0.", "en", "a"), (3, "apache version 2 0 license", "en", "a"),
            (4, "cc by cc by", "en", "a"), (4, "cc by cc by", "en", "a"), (5, "released under the MIT Licenſe mit license " * 500, "en", "a"), (6, "cK by gpl", "en", "a"),
            (7, "apache license version 2 0", "en", "a"), *odd_rows()]
    got = {r["doc_id"]: r for r in licenses.scan(table(spark, rows)).collect()}
    told = lambda i: tuple(got[i][k] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels"))
    assert told(1) == (7, 2, 1, 5, "gpl,mit", "gpl,mit") and got[1]["score"] == 0.5
    assert told(2) == (8, 1, 3, 3, "apache", "apache,apache-2.0") and got[2]["score"] == 1.0
    assert told(3) == (5, 0, None, None, "", "") and told(4) == (4, 2, 0, 2, "cc-by", "cc-by") and told(6)[1] == 0
    assert told(5)[:4] == (3500, 500, 5, 3498)
    assert told(7)[5] == "apache,apache-2.0" and got[7]["score"] == 0.625  # the template starts before the text
    assert told(900) == (0, 0, None, None, "", "") and got[900]["score"] == 0
    assert len(got) == len({i for i, *_ in rows}) and licenses.scan(empty(spark)).count() == 0


def page_rows():
    big = "<p>" + "long page " * 200
    return [(1, "http://a/1", big), (2, "http://b/2", big), (3, "http://c/3\nx", big + "!"), (4, None, "small"), (5, "http://d/5", "small"), (6, "u", None), (7, "u", ""), (8, "u", "é" * 500),
            (9, "u", "é" * 500), (9, "u", "é" * 500), (None, "u", "x"), (10, "u", "a" * 999), (11, "u", "a" * 999)]


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "shard", 1) for r in page_rows()], "page_id long, url string, html string, digest string, shard int")
    names = []
    for k in (1, 2):
        root = f"{tmp_path}/archive{k}"
        manifest = warc.write(pages.repartition(3 * k), root, shard_bytes=1500, roll_bytes=700).collect()
        assert sum(r["records"] for r in manifest) == len(page_rows())
        names.append({r["file"]: open(os.path.join(root, r["file"]), "rb").read() for r in manifest})
        assert sorted(f for f in os.listdir(root) if f.endswith(".gz")) == sorted(names[-1]) and not os.listdir(f"{root}/_temporary")
    assert names[0] == names[1] and len(names[0]) > 3  # equal bytes, whatever the input's partitions
    assert b"WARC/1.1" in gzip.decompress(next(iter(names[0].values())))
    got, read = {}, warc.read(spark, root, with_payload=True)
    read.write.parquet(f"{tmp_path}/read")
    assert read.rdd.getNumPartitions() == len(names[1]) == len([f for f in os.listdir(f"{tmp_path}/read") if f.endswith(".parquet")])
    for r in read.collect():
        got.setdefault(r["page_id"], []).append(r)
    for i, _, html in page_rows():
        body = (html or "").encode()
        for r in got[i]:
            assert r["payload_bytes"] == len(body) and r["payload_digest"] == hashlib.sha1(body).hexdigest()
            assert r["payload"] == (body if r["record_type"] == "response" else None)
    told = {i: sorted((r["record_type"], r["refers_to"]) for r in rows) for i, rows in got.items() if i is not None}
    assert told[1] == [("revisit", 2)] and told[2] == told[3] == told[4] == told[11] == [("response", None)]
    assert told[8] == [("revisit", 9)] and sorted(map(str, told[9])) == ["('response', None)", "('revisit', 9)"]


def test_archive_of_nothing_and_damage(spark, tmp_path):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    warc.write(pages.limit(0), f"{tmp_path}/none")
    assert warc.read(spark, f"{tmp_path}/none").count() == 0
    name = warc.write(pages, f"{tmp_path}/bad").collect()[0]["file"]
    path = f"{tmp_path}/bad/{name}"
    whole = open(path, "rb").read()
    open(path, "wb").write(whole[:-5])
    with pytest.raises(Exception, match="cut off"):
        warc.read(spark, f"{tmp_path}/bad").collect()


def test_mix_meets_its_targets(spark):
    rows = [(i, prose(i, 5 + i % 9), "en", ["a", "b", "c", None, "é"][i % 5] if i % 3 else "a") for i in range(400)] + odd_rows()
    docs = table(spark, rows)
    got = mixing.report(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    source = {i: s for i, _, _, s in rows}
    for r in got:
        s = source[r["doc_id"]]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    total = sum(sizes.values())
    weight = dict(zip([*sorted(s for s in sizes if s is not None), None], [5, 2, 1] * 3))
    want, level = {}, 0
    while True:
        full = {s: 2 * sizes[s] for s in sizes if want.get(s) == 2 * sizes[s]}
        level = (1.5 * total - sum(full.values())) / sum(w for s, w in weight.items() if s not in full)
        new = {s: full.get(s, min(level * weight[s], 2 * sizes[s])) for s in sizes}
        if new == want:
            break
        want = new
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - target[s]) <= 14
    kept = mixing.mix(docs)
    assert {r["doc_id"]: r["taken"] for r in kept.collect()} == {r["doc_id"]: r["taken"] for r in got if r["copies"]}
    assert mixing.mix(empty(spark)).count() == 0 and mixing.report(empty(spark)).count() == 0


def test_mix_keeps_every_column(spark):
    names = ["size", "hash", "source_size", "target", "whole", "below", "at", "mix_key", "prefix", "weight", "odd.name", "copies", "_document"]
    rows = [(i, prose(i, 20), "ab"[i % 2], *[f"{n}-{i}" for n in names]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    got = mixing.mix(docs)
    assert got.columns == [c for c in docs.columns if c != "copies"] + ["copies", "taken"]
    kept = got.collect()
    assert kept and all(tuple(r)[3:-2] == tuple(f"{n}-{r['doc_id']}" for n in names if n != "copies") and r["taken"] == 20 * r["copies"] for r in kept)


def test_items_without_an_id_hit(spark):
    docs = spark.createDataFrame([(1, "x one two three y"), (2, "four five six z"), (3, "none")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "one two three"), ("b", "one two three"), (None, "four five six"), (None, None)], "item_id string, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"], r["contaminated"]) for r in decontam.report(docs, bench, width=3).collect()}
    assert got == {1: (3, ["b"], True), 2: (3, [], True), 3: (0, [], False)}
    left = {r["doc_id"]: r["text"].split() for r in decontam.remove(docs, bench, width=3).collect()}
    assert left == {1: ["x", "y"], 2: ["z"], 3: ["none"]}
