"""Near duplicates, repeated passages and close vectors against brute force."""

import itertools
import random

import numpy as np
import pytest

from noticeloom.llm import capfilters, minhash, suffixes
from noticeloom.llm.graph import components
from tests.llm.cases import SPACED, empty, odd_rows, prose, table, words


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(203, 201), (201, 202), (202, 203)] + [(5, 5)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: r for n, r in roots({x for e in edges for x in e}, edges).items() if n != r}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, width):
    w = words(text, SPACED)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def duplicates_fixture():
    rows = [(i, prose(i, 60 + i), "en", "a") for i in range(20)]
    for k in range(30):  # a group around one text, at all similarities around the threshold
        rows.append((100 + k, edited(rows[3][1] + prose(77, 90), 50 + k, 0.05 if k % 2 else 0.02), "en", "a"))
    rows += [(200 + k, rows[5][1], "en", "b") for k in range(6)] + [(300, prose(9, 4000), "en", "b"), (301, prose(9, 4000) + " tail", "en", "b"), (302, "one two", "en", "b"), (303, "One  Two", "en", "b"),
             (304, "tie", None, None), (304, "tie", None, None)]
    return rows + odd_rows()


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_brute_force(spark, width):
    rows = duplicates_fixture()
    got = {r["doc_id"]: r for r in minhash.report(table(spark, rows), width=width).collect() if r["doc_id"] is not None}
    sets = {i: shingles(t, width) for i, t, *_ in rows if i is not None}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = roots(sets, links)
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}
    assert len(set(want.values())) < len(want)


def test_dedupe_keeps_one_row_of_each_group(spark):
    rows = duplicates_fixture()
    docs = table(spark, rows)
    kept = minhash.dedupe(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(304) == 1 and ids.count(None) == 1 and 201 not in ids and 900 in ids and 901 in ids
    assert minhash.report(empty(spark)).count() == 0


def passage_words(rows, length):
    """Words in a window that stood before, per document."""
    seen, out = set(), {}
    for i, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(text)
        for s in range(len(w) - length + 1):
            key = tuple(w[s:s + length])
            if key in seen:
                out.setdefault(i, set()).update(range(s, s + length))
            seen.add(key)
    return out


def passage_fixture():
    shared, other = prose(1001, 60), prose(1002, 51)
    rows = [(i, prose(i, 150, 5000), "en", "a") for i in range(12)]
    rows += [(20 + k, f"{prose(2000 + k, 40, 5000)} {shared} {prose(3000 + k, 30, 5000)}", "en", "a") for k in range(9)]
    rows += [(40, f"{other} {prose(4, 10, 5000)} {other.upper()}", "en", "a"), (41, prose(8, 49), "en", "a"), (42, prose(8, 49), "en", "a"), (43, rows[2][1], "en", "a"),
             (44, " ".join(["same"] * 300), "en", "a"), (45, f"{' '.join(shared.split()[:49])} {prose(6001, 60, 5000)}", "en", "a"), (46, "x " * 3 + rows[4][1] + "," + prose(6, 3000, 5000), "en", "a")]
    return rows + odd_rows()


def test_passages_equal_brute_force(spark):
    rows = passage_fixture()
    got, texts = {}, {i: words(t) for i, t, *_ in rows}
    for r in suffixes.passages(table(spark, rows)).collect():
        own = texts[r["doc_id"]][r["first_word"]:r["first_word"] + r["n_words"]]
        assert r["n_words"] >= 50 and own == texts[r["source_id"]][r["source_word"]:r["source_word"] + r["n_words"]]
        assert (r["source_id"], r["source_word"]) < (r["doc_id"], r["first_word"])
        got.setdefault(r["doc_id"], set()).update(range(r["first_word"], r["first_word"] + r["n_words"]))
    assert got == passage_words(rows, 50)
    assert not {41, 42, 45} & set(got)


def test_removal_keeps_the_first_copy_and_the_rest_of_the_text(spark):
    rows = [*passage_fixture(), (20, passage_fixture()[12][1], "en", "a")]
    docs = table(spark, rows)
    left = suffixes.remove(docs)
    assert left.columns == docs.columns
    kept = {}
    for r in left.collect():
        kept.setdefault(r["doc_id"], []).append(r["text"])
    marked = passage_words(passage_fixture(), 50)
    for i, text, *_ in passage_fixture():
        want = [w for k, w in enumerate(words(text)) if k not in marked.get(i, ())]
        if i in marked and not want:
            assert i not in kept
        else:
            assert words(kept[i][0]) == want
    assert len(kept[20]) == 2 and kept[20][0] == kept[20][1]  # one row that comes twice is no copy of itself
    assert suffixes.remove(empty(spark)).count() == 0


def vector_fixture():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + k, (base[k % 7] + 0.09 * rng.normal(size=24)).tolist()) for k in range(40)]
    rows += [(200 + k, base[3].tolist()) for k in range(5)] + [(300, (base[4] * 3).tolist())]
    odd = [(400, None), (401, []), (402, [0.0] * 24), (403, [float("nan")] * 24), (404, [1.0] * 23 + [None]), (405, [float("inf")] + [1.0] * 23), (406, [1.0, 2.0]), (407, [1.0, 2.0]), (None, base[3].tolist())]
    return rows, odd


def test_close_vectors_equal_brute_force(spark):
    rows, odd = vector_fixture()
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows + odd], "vec_id long, embedding array<double>, label int, size int, dim int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in capfilters.report(df).collect()}
    v = {i: np.array(x) for i, x in rows + [odd[6], odd[7]]}
    links = [(a, b) for a, b in itertools.combinations(v, 2) if len(v[a]) == len(v[b]) and v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b]) >= 0.9]
    ids = [i for i, _ in rows + odd if i is not None]
    want, n = roots(ids, links), {i: sum(i in p for p in links) for i in ids}
    assert {i: g for i, g in got.items() if i is not None} == {i: (n[i], want[i], want[i] == i) for i in ids}
    assert got[None] == (0, None, True) and max(n.values()) > 5
    assert capfilters.report(df.limit(0)).count() == 0


def test_recall_of_the_filters_at_the_threshold():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
    one, two = ({*zip(*map(np.ndarray.tolist, capfilters.decode(v)))} for v in (x, y))
    assert len({r for r, _ in one & two}) >= 0.99 * len(x)


@pytest.mark.parametrize("dim", [2, 3, 8, 11, 12, 15, 16, 24, 32, 64, 256])
@pytest.mark.parametrize("threshold", [0.9, 0.97])
def test_recall_of_the_filters_in_every_dimension(dim, threshold):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(400, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    y = threshold * x + np.sqrt(1 - threshold ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    one, two = ({*zip(*map(np.ndarray.tolist, capfilters.decode(v, threshold)))} for v in (x, y))
    assert len(one) < 150 * len(x) and len({r for r, _ in one & two}) >= (1 if dim < capfilters.EXACT_BELOW else 0.985) * len(x)


@pytest.mark.parametrize("dim", [2, 8, 12])
def test_short_vectors_equal_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    v = rng.normal(size=(80, dim))
    v = np.concatenate((v, v[:40] + 0.12 * rng.normal(size=(40, dim))))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in capfilters.report(df).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    links = [(a, b) for a, b in itertools.combinations(range(len(v)), 2) if unit[a] @ unit[b] >= 0.9]
    want = roots(range(len(v)), links)
    assert len(links) > 10 and got == {i: (sum(i in p for p in links), want[i]) for i in range(len(v))}
