"""The trained models: held-out accuracy, exact sums, gradients, and odd rows."""

import itertools
import random
import zlib

import numpy as np
import pytest

from noticeloom.llm import langid, quality, toxicity
from tests.llm.cases import empty, odd_rows, prose, table

SYLLABLES = {"aa": ["ba", "ko", "ti", "ru"], "bb": ["sch", "en", "ich", "auf"], "cc": ["é", "ou", "ent", "qu"]}


def talk(lang, seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_language_of_held_out_texts(spark):
    rows = [(i, talk(lang, i, 4 + i % 30), lang, "a") for i, lang in zip(range(240), itertools.cycle(SYLLABLES))] + [(500, talk("aa", 1, 9), None, "a"), (501, "é" * 300, "cc", "a")]
    got = langid.predict(table(spark, rows + odd_rows()), docs_per_lang=60).collect()
    told = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) + len(odd_rows())
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got if r["doc_id"] is not None)
    assert all(told[i]["lang_pred"] == lang for i, _, lang, _ in rows[:240]) and told[500]["lang_pred"] == "aa"
    assert all(told[i]["lang_pred"] == "und" and told[i]["score"] == 0 for i in (900, 901, 902, 903))
    assert langid.predict(empty(spark)).count() == 0


def test_forward_pass_sums_all_segmentations():
    vocabulary = langid.Vocabulary()
    rng = np.random.default_rng(2)
    p = np.append(rng.random(len(vocabulary.pieces)), 0)[:, None]
    index = {b: i for i, b in enumerate(vocabulary.pieces)}
    for word in (b"the", "▁letter".encode(), "été".encode()):
        def total(rest):
            return 1.0 if not rest else sum(p[index[rest[:k]], 0] * total(rest[k:]) for k in range(1, len(rest) + 1) if rest[:k] in index)
        lattice = langid.Lattice(vocabulary, *langid.byte_rows([word, b"x"]))
        assert np.exp(lattice.of_words(lattice.forward(p))[0, 0]) == pytest.approx(total(word), rel=1e-9)
        assert lattice.expected(p, np.array([1.0, 0.0])).sum() >= 1  # at least one piece a word


def test_every_language_is_learned(spark):
    rows = [(i, " ".join(f"{'abcdefghij'[i % 260 % 10]}{chr(97 + i % 260 // 10)}{k}" * 2 for k in range(8)), f"l{i % 260:03d}", "a") for i in range(260 * 8)]
    got = langid.predict(table(spark, rows)).collect()
    assert len({r["lang_pred"] for r in got}) == 260
    assert np.mean([r["lang_pred"] == f"l{r['doc_id'] % 260:03d}" for r in got]) > 0.99


def test_all_words_of_the_sample_are_learned_from(spark):
    texts = [" ".join(f"w{1000 * i + k}x" for k in range(1000)) for i in range(18)]
    rows = spark.createDataFrame([(i, "aa", t) for i, t in enumerate(texts)] + [(90, "bb", "été " * 3 + "中" * 40), (91, "bb", "!")], "key long, lang string, text string")
    sizes, sums = langid.counted_words(rows, "lang", 100)
    assert sizes == {"aa": 18, "bb": 2} and sums.where("lang = 'aa'").count() == 18_000
    vocabulary = langid.Vocabulary()
    langs, p = langid.learn(vocabulary, sums, rounds=2)
    for k, lang in enumerate(langs):  # the same rounds over all words in one lattice
        split = [(part, r["n"]) for r in sums.where(sums.lang == lang).collect() for part in langid.parts(bytes(r["word"]))]
        lattice, size = langid.Lattice(vocabulary, *langid.byte_rows([w for w, _ in split])), len(vocabulary.pieces)
        want = np.append(np.full(size, 1 / size), 0)
        for _ in range(2):
            got = lattice.expected(want[:, None], np.array([float(n) for _, n in split]))[:size]
            want = np.append((1 - langid.SPREAD) * got / got.sum() + langid.SPREAD / size, 0)
        assert np.allclose(p[:, k], want, rtol=1e-9, atol=0)


def labels(spark, rows):
    return spark.createDataFrame([(i, q, t, 1) for i, q, t in rows], "doc_id long, quality int, toxic int, score int")


def test_quality_of_held_out_texts(spark):
    rows = [(i, prose(i, 40).upper().replace(" ", "!! ") if i % 3 == 0 else prose(i, 40 + i % 40) + ".", "en", "a") for i in range(240)]
    marks = [(i, int(i % 3 != 0), 0) for i in range(240)] + [(0, None, None), (None, 1, 1), (7, 1, 0), (9999, 0, 0)]
    docs = table(spark, rows + odd_rows() + [rows[5]])
    got = quality.predict(docs, labels(spark, marks)).collect()
    assert len(got) == len(rows) + len(odd_rows()) + 1
    held = [r for r in got if r["held_out"] and r["doc_id"] < 240]
    assert len(held) > 30 and all(r["predicted"] == int(r["doc_id"] % 3 != 0) == int(r["score"] >= 0.7) for r in held)
    kept = quality.keep(docs, labels(spark, marks))
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in got if r["predicted"])
    assert quality.predict(empty(spark), labels(spark, marks)).count() == 0
    assert {r["score"] for r in quality.predict(docs, labels(spark, marks).limit(0)).collect()} == {0.5}


def test_additive_tables_are_the_whole_model():
    rng = np.random.default_rng(4)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # needs the pair
    model = quality.AdditiveModel(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95 and model.pairs[0][:2] == (1, 0)


def test_gradients_of_the_network():
    rng = np.random.default_rng(6)
    net = toxicity.Network(np.arange(1, 6, dtype=np.uint64))
    ids, mask = rng.integers(0, 6, (3, 5)), np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], bool)
    pairs = rng.integers(0, 50, (3, 5, toxicity.PLACES)) + np.arange(toxicity.PLACES) * toxicity.PAIRS
    y, w = np.array([1, 0, 1], np.float32), np.ones(3, np.float32)

    def loss():
        x = net.inputs(ids.ravel(), pairs.reshape(-1, toxicity.PLACES))
        z = net.logits(net.gates(x), np.arange(15).reshape(3, 5), mask).astype(np.float64)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    before = {k: v.copy() for k, v in net.p.items()}
    net.train_step(ids, pairs, mask, y, w)
    grads = {k: m / 0.1 for k, (m, _) in net.moments.items()}  # the first moment after one step
    net.p = before
    for name in ("word", "wf", "wb", "cf", "uf", "ub", "aw", "ab", "av", "ow", "ob", "pair"):
        spots = np.argsort(-np.abs(grads[name]).ravel())[:3]
        for k in spots:
            value, step = net.p[name].ravel()[k], 1e-2
            found = []
            for s in (step, -step):
                net.p[name].reshape(-1)[k] = value + s
                found.append(loss())
            net.p[name].reshape(-1)[k] = value
            assert (found[0] - found[1]) / (2 * step) == pytest.approx(grads[name].ravel()[k], rel=0.05, abs=2e-4), name


def test_toxic_words_anywhere_in_a_text(spark):
    bad = ["vilefool", "vilerat", "vilepig"]
    rows, marks = [], []
    for i in range(360):
        own = prose(i, 20 + (i * 7) % 150, 300).split()
        if i % 3 == 0:
            for k in range(1 + len(own) // 40):
                own[(i * 13 + 29 * k) % len(own)] = bad[(i + k) % 3]
        rows.append((i, " ".join(own), "en", "a"))
        marks.append((i, 1, int(i % 3 == 0)))
    far = (700, prose(1, 900, 300) + " vilefool " + prose(2, 900, 300), "en", "a")
    docs = table(spark, rows + [far, (701, prose(3, 1800, 300), "en", "a"), rows[0]] + odd_rows())
    got = toxicity.predict(docs, labels(spark, [*marks, (None, 1, 1), (0, 1, None)])).collect()
    assert len(got) == len(rows) + 3 + len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)
    told = {r["doc_id"]: r for r in got}
    held = [r for r in got if r["held_out"] and r["doc_id"] < 360]
    assert len(held) > 40 and np.mean([r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held]) > 0.95
    assert told[700]["predicted"] == 1 and told[701]["predicted"] == 0 and told[900]["score"] == told[901]["score"] == 0
    assert toxicity.predict(empty(spark), labels(spark, marks)).count() == 0


def test_gradient_of_the_later_character_pairs():
    seen = toxicity.Words(["слово дурачина дурачинб ab 中文字符中文".encode()], toxicity.ALNUM)
    which = np.arange(5)
    pairs, tails = toxicity.pairs_of(seen, which), toxicity.tails_of(seen, which)
    assert (pairs[1] == pairs[2]).all() and np.diff(tails[1]).tolist() == [max(0, len(seen.word(i)) - 6) for i in which]
    again = toxicity.take_tails(tails, np.array([4, 1]))
    assert again[0].tolist() == tails[0][tails[1][4]:].tolist() + tails[0][tails[1][1]:tails[1][2]].tolist()
    net = toxicity.Network(np.zeros(0, np.uint64))
    net.p["tail"] = np.random.default_rng(3).normal(0, 0.1, net.p["tail"].shape).astype(np.float32)
    ids, mask, y, w = np.zeros((1, 5), np.int64), np.ones((1, 5), bool), np.array([1], np.float32), np.ones(1, np.float32)

    def loss():
        z = net.logits(net.gates(net.inputs(ids.ravel(), pairs, tails)), which[None], mask).astype(np.float64)
        return float(np.logaddexp(0, z)[0] - z[0])

    x = net.inputs(ids.ravel(), pairs, tails)
    assert (x[1] != x[2]).any()
    before = {k: v.copy() for k, v in net.p.items()}
    net.train_step(ids, pairs[None], mask, y, w, tails)
    grad, net.p = net.moments["tail"][0] / 0.1, before
    for k in np.argsort(-np.abs(grad).ravel())[:3]:
        value, found = net.p["tail"].ravel()[k], []
        for step in (1e-2, -1e-2):
            net.p["tail"].reshape(-1)[k] = value + step
            found.append(loss())
        net.p["tail"].reshape(-1)[k] = value
        assert (found[0] - found[1]) / 2e-2 == pytest.approx(grad.ravel()[k], rel=0.05, abs=2e-4)


def test_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 80, 81, 500):
        starts = toxicity.starts_of(n)
        assert {k for s in starts for k in range(s, min(n, s + toxicity.WINDOW))} == set(range(n))
        assert all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:]))
