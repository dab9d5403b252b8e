"""URL filter, Merkle manifest and target resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from noticeloom.llm import merkle, resample, urlfilter
from tests.llm.cases import empty, odd_rows, prose, table, words

URLS = [
    None, "", "no scheme here", "http://", "https://Example.COM", "https://example.com/", "https://a.Example.com/en/1?q=/x#y", "https://www.example.com/en/2",
    "https://m.www.example.com/en/2#/z", "http://notexample.com/en/", "https://x.net/es/a", "https://x.net/es", "https://net/fr/", "https://mega-casino.org/en/5",
    "https://museum.org/en/5", "ftp://u:p@h.org:80/p?q://r", "https://x.org?no/path", "https://Ünï.org/päth/中", "a://b://c.com/d", "https://x.net/es/a",
]


def urls(spark, rows):
    return spark.createDataFrame([(i, u, "h", "p", "r", "v", 1.0, 2, 3.0) for i, u in rows],
                                 "page_id long, url string, host string, path string, rule string, verdict string, score double, b int, w double")


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match("[^?#]*", rest[len(host):]).group()


def rule_of(host, path, rules):
    fits = []
    for rule, action in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((len(rule), rule, action))
    return max(fits)[1:] if fits else (None, None)


def test_urls_follow_the_longest_rule_and_else_the_model(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "https://x.net/es/a"), (3, "https://museum.org/en/5")]
    df = urlfilter.judge(urls(spark, rows), urlfilter.default_rules(spark), urlfilter.default_labelled(spark))
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
    got = df.collect()
    assert sorted((r["page_id"] is None, r["page_id"] or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows)
    by_url = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got)
    model = {(r["host"], r["path"]): "block" if r["score"] >= 0.5 else "allow" for r in got}
    want = Counter()
    for i, u in rows:
        host, path = cut(u)
        rule, action = rule_of(host, path, urlfilter.RULES)
        want[(i, host, path, rule, action or model[host, path])] += 1
    assert by_url == want
    verdicts = {r["host"]: r["verdict"] for r in got}
    assert verdicts["mega-casino.org"] == "block" and verdicts["museum.org"] == "allow"


def test_rules_of_any_kind(spark):
    rules = [("a.b/x", "block"), ("A.b/x", "allow"), ("b", "allow"), ("a.b/xy", "allow"), ("b/", "block"), (None, "block"), ("c/", None), ("c/", "maybe"), ("a.b/x", "block")]
    pages = urls(spark, list(enumerate(["s://a.b/x1", "s://a.b/xyz", "s://b", "s://q.b/", "s://c/", "s://xb/"])))
    got = urlfilter.judge(pages, spark.createDataFrame(rules, "rule string, action string"), urlfilter.default_labelled(spark).limit(0)).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"]) for r in got] == [("a.b/x", "block"), ("a.b/xy", "allow"), ("b", "allow"), ("b/", "block"), (None, "block"), (None, "block")]
    assert all(r["score"] == 0.5 for r in got)


def test_no_urls(spark):
    assert urlfilter.judge(urls(spark, []), urlfilter.default_rules(spark).limit(0), urlfilter.default_labelled(spark)).collect() == []


def test_the_model_judges_hosts_that_it_has_not_seen(spark):
    bad = ["best-casino-online.org", "poker-slots.info", "www.pills-discount.org", "hot-porn-tube.net", "adclicks-server.org", "fast-loans.biz", "crack-warez.org", "spamlinks.info"]
    good = ["museum-of-art.org", "www.library.info", "news-of-the-day.org", "mathematics.net", "council.org", "winter-weather.info", "bird-club.org", "history-books.net"]
    pages = urls(spark, [(i, f"https://{h}/en/{i}") for i, h in enumerate(bad + good)])
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(pages, urlfilter.default_rules(spark).limit(0), urlfilter.default_labelled(spark)).collect()}
    right = sum(got[i] == ("block" if i < len(bad) else "allow") for i in got)
    assert right >= 0.85 * len(got)


def test_descent_equals_the_same_steps_in_plain_python(spark):
    labelled = [(u, y) for u, y in urlfilter.labelled_rows() if "-" not in u][:20] + [(None, 1), ("s://x", None), ("s://y", 7)]
    got = {r["b"]: r["w"] for r in urlfilter.train(spark.createDataFrame(labelled, "url string, blocked int"), rounds=5).collect()}

    def buckets(u):
        host, path = cut(u)
        out = {"h" + host}
        for kind, t in (("h", host), ("p", path)):
            t = "^" + re.sub("[0-9]", "0", t) + "$"
            out |= {kind + t[i:i + n] for n in urlfilter.GRAMS for i in range(len(t) - n + 1)}
        return sorted({zlib.crc32(g.encode()) % urlfilter.BUCKETS for g in out})

    rows = [(buckets(u), y) for u, y in labelled if u and y in (0, 1)]
    w = Counter()
    for _ in range(5):
        step = Counter()
        for x, y in rows:
            e = 1 / (1 + math.exp(-sum(w[b] for b in x) / math.sqrt(len(x)))) - y
            for b in x:
                step[b] += e / math.sqrt(len(x))
        for b in step:
            w[b] = w[b] * (1 - urlfilter.RATE * urlfilter.DECAY) - urlfilter.RATE / len(rows) * step[b]
    assert got.keys() == w.keys() and all(abs(got[b] - w[b]) < 1e-9 for b in got)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def merkle_by_hand(rows):
    """Rows (doc_id, source, lang, n_chars, text) to (doc_id, leaf, subroot, root, proof digest, folded root)."""
    def proofs(digests):
        paths, at = [[] for _ in digests], list(range(len(digests)))
        while len(digests) > 1:
            runs = [digests[i:i + 16] for i in range(0, len(digests), 16)]
            for n, i in enumerate(at):
                run, k = runs[i // 16], i % 16
                paths[n].append(("".join(run[:k]), "".join(run[k + 1:])))
                at[n] = i // 16
            digests = [h(*run) for run in runs]
        return digests[0], paths

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = proofs([leaf_of(r) for r in groups[s]])
    root, above = proofs([trees[s][0] for s in order])
    out = []
    for s, upper in zip(order, above):
        for row, path in zip(groups[s], trees[s][1]):
            arrived = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                arrived = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            d = leaf_of(arrived)
            for left, right in path + upper:
                d = h(left, d, right)
            out.append((row[0], leaf_of(row), trees[s][0], root, h(*[a + b for a, b in path + upper]), d, d == root))
    return sorted(map(str, out))


def proved(df):
    return sorted(str(tuple(r)) for r in merkle.report(df).collect())


def of_table(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 17}, {"a": 300, "b": 1, None: 16, "": 33, "é": 2}, {f"s{i}": 1 + i % 3 for i in range(40)}])
def test_proofs_lead_to_the_root(spark, sizes):
    rows, n = [], 0
    for s, many in sizes.items():
        for _ in range(many):
            rows.append((n * 7 % 1009, f"Text {n} ÄÖ" if n % 4 else "plain", "en" if n % 3 else None, s))
            n += 1
    df = table(spark, rows)
    got = proved(df)
    assert got == merkle_by_hand(of_table(df))
    if n > 100:
        assert 0 < sum(r.endswith("False)") for r in got) < n


def test_proofs_of_odd_rows(spark):
    rows = odd_rows() + [(900, "A" * 200_000, None, None)] + [(5, "Same Row", "en", "hot")] * 50 + [(5, "Other", "en", "hot"), (None, None, None, "hot")]
    df = table(spark, rows)
    assert proved(df) == merkle_by_hand(of_table(df))
    assert proved(empty(spark)) == []


def drawn_by_hand(rows, targets, buckets=10_000):
    def grams(text):
        w = words(text)
        return w, [zlib.crc32(g.encode()) % buckets for g in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    docs = [(i, *grams(t)) for i, t in rows]
    s, t = Counter(b for _, _, g in docs for b in g), Counter(b for x in targets for b in grams(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in s}
    out = []
    for i, w, g in docs:
        weight = sum(gain[b] for b in g) // len(g) if g else 0
        noise = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((noise + 0.5) / 4294967296))), len(w)])
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(able[:25 * len(able) // 100])}
    return sorted(str((*r[:4], rank.get(id(r)))) for r in out)


def test_draws_follow_weights_and_noise(spark, monkeypatch):
    rows = odd_rows() + [(i, prose(i, 5 + i % 40) + (" Target WORDS here" if i % 5 == 0 else ""), "en", "a") for i in range(200)]
    rows += [(None, prose(3, 30), "en", "a"), (1000, "x" * 300_000 + " y", "en", "a"), (1001, "a b, " * 60_000, "en", "a")]
    df = table(spark, rows)
    target = spark.createDataFrame([(1, "target words here"), (2, prose(7, 50)), (None, None), (3, "")], "item_id long, text string")
    got = sorted(str(tuple(r)) for r in resample.report(df, target).collect())
    assert got == drawn_by_hand([(r[0], r[1]) for r in rows], [r["text"] for r in target.collect()])


def test_draws_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resample.report(empty(spark), none).collect() == []
    rows = [(i, prose(i, 30), "en", "a") for i in range(8)]
    got = sorted(str(tuple(r)) for r in resample.report(table(spark, rows), none).collect())
    assert got == drawn_by_hand([(r[0], r[1]) for r in rows], [])


@pytest.mark.parametrize("size", [1, 3, 7, 64])
def test_pieces_change_no_feature(size, monkeypatch):
    text = "Ünï çødé! a1[b] 中文 文, " * 5 + "x" * 100 + " end"
    whole = resample.features(text.encode(), 10_000)
    monkeypatch.setattr(resample, "PIECE", size)
    parts = list(resample.pieces(text.encode(), size))
    assert "".join(parts) == text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    monkeypatch.setattr(resample, "pieces", lambda t: parts)
    many, found = resample.features(text.encode(), 10_000)
    assert many == whole[0] == len(words(text)) and sorted(found.tolist()) == sorted(whole[1].tolist())
