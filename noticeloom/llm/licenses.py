"""Licence scan with a positional index of rare words; DataFrame functions only.

Templates are short public licence notices as word lists, each with a mandatory key
phrase. Document frequencies of all template words are counted over the corpus; a
template is looked up by the two highest-IDF words of its key phrase. Per document the
positions of these words, each less the word's place in the template, are intersected:
what remains are the places where the template can lie. There the whole key phrase is
verified, and the share of all template words found at their places is the score.

Words: ``A-Z`` lower-cased, runs of digits, letters and non-ASCII characters. ``base``
labels are plain phrases (``BASE``), found the same way by one rare word each.

All work on a document stays in its row: no shuffle but the count of the template
words, no hot group. Null and word-less texts have no words, no labels, null places and
score 0; repeated rows give repeated rows; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.operators.staging import hold

# Phrases and labels of the base scan.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Notices of public licences; the key phrase stands between bars.
TEMPLATES = {
    "apache-2.0": "licensed under the |apache license version 2 0|",
    "agpl-3.0": "licensed under the |gnu affero general public license| version 3",
    "bsd": "|redistribution and use in source and binary forms| with or without modification are permitted",
    "cc-by-nc-4.0": "licensed under |cc by nc 4 0|",
    "cc-by-sa-4.0": "licensed under |cc by sa 4 0|",
    "cc-by-4.0": "licensed under |cc by 4 0|",
    "gpl-2.0": "licensed under the |gnu general public license version 2|",
    "gpl-3.0": "licensed under the |gnu general public license version 3|",
    "isc": "|permission to use copy modify and or distribute this software| for any purpose with or without fee",
    "lgpl": "licensed under the |gnu lesser general public license|",
    "mit-notice": "|released under the mit license|",
    "mit-text": "|permission is hereby granted free of charge to any person obtaining a copy| of this software",
    "mpl-2.0": "subject to the terms of the |mozilla public license v 2 0|",
    "unlicense": "this is |free and unencumbered software released into the public domain|",
}
#: Score of a document that has a base label and no template.
BASE_SCORE = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def parse(notice: str) -> tuple[list[str], int, list[str]]:
    """All words, the place of the key phrase, and its words."""
    before, key, after = notice.split("|")
    return before.split() + key.split() + after.split(), len(before.split()), key.split()


def with_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and the words, in their own letter case."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return hold(rows, words=F.regexp_extract_all("text", F.lit(f"({_WORD})"), 1)).select("doc_id", "words")


def word_at(i: Column) -> Column:
    return F.translate(F.get("words", i), _UPPER, _LOWER)


def positions(vocabulary: list[str]) -> Column:
    """Places of the words that may be in the vocabulary; ``lower`` also folds a few
    non-ASCII letters, so what is found here is compared exactly afterwards."""
    places = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: F.lower(F.get("words", i)).isin(vocabulary))


def document_frequencies(worded: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents that hold each word; at most one row a word comes to the driver."""
    found = worded.select(F.explode(F.array_distinct(F.transform(positions(vocabulary), word_at))).alias("word"))
    return {r["word"]: r["n"] for r in found.where(F.col("word").isin(vocabulary)).groupBy("word").agg(F.count("*").alias("n")).collect()}


def places_of(word: str) -> Column:
    return F.filter("near", lambda p: word_at(p) == word)


def shifted(places: Column, by: int) -> Column:
    return F.transform(places, lambda p: p - by)


def labelled(places: Column, label: str) -> Column:
    return F.transform(places, lambda p: F.struct(F.lit(label).alias("label"), p.alias("at")))


def holds(start: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(word_at(start + k) == w, F.lit(False)) for k, w in enumerate(words)])


def rare_first(words: list[str], seen: dict[str, int]) -> list[int]:
    """Places of the distinct words, highest IDF first."""
    first = {w: i for i, w in reversed(list(enumerate(words)))}
    return [first[w] for w in sorted(first, key=lambda w: (seen.get(w, 0), w))]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
         base: dict[str, str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, and ``matches`` (template label, first word, share of its words)."""
    parsed = {label: parse(t) for label, t in (TEMPLATES if templates is None else templates).items()}
    base = BASE if base is None else base
    worded = with_words(docs, id_col, text_col)
    vocabulary = sorted({w for _, _, key in parsed.values() for w in key} | {w for p in base for w in p.split()})
    seen = document_frequencies(worded, vocabulary)

    anchors, phrases = {}, {p: (p.split(), rare_first(p.split(), seen)[0]) for p in base}
    for label, (_, at, key) in parsed.items():
        anchors[label] = [(key[i], at + i) for i in rare_first(key, seen)[:2]]
    near = sorted({w for pairs in anchors.values() for w, _ in pairs} | {words[i] for words, i in phrases.values()})
    rows = hold(worded, near=positions(near))

    def base_places(phrase: str) -> Column:
        words, i = phrases[phrase]
        return F.filter(shifted(places_of(words[i]), i), lambda s: (s >= 0) & holds(s, words))

    def template_places(label: str) -> Column:
        _, at, key = parsed[label]
        lists = [shifted(places_of(w), i) for w, i in anchors[label]]
        return F.filter(reduce(F.array_intersect, lists), lambda s: (s + at >= 0) & holds(s + at, key))

    def matches(label: str) -> Column:
        words = parsed[label][0]
        share = lambda s: reduce(lambda a, b: a + b, [F.when(word_at(F.when(s + k >= 0, s + k)) == w, 1).otherwise(0) for k, w in enumerate(words)]) / F.lit(float(len(words)))
        return F.transform(template_places(label), lambda s: F.struct(F.lit(label).alias("label"), s.cast("long").alias("first_word"), share(s).alias("share")))

    none = F.array().cast("array<struct<label:string,first_word:bigint,share:double>>")
    starts = F.array().cast("array<struct<label:string,at:int>>")
    both = hold(rows,
                base=F.concat(starts, *[labelled(base_places(p), v) for p, v in base.items()]),
                matches=F.concat(none, *[matches(label) for label in parsed]))
    base_set, all_set = F.array_distinct("base.label"), F.array_distinct(F.concat(F.col("base.label"), F.col("matches.label")))
    return both.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.size("base").cast("long").alias("n_base"),
        F.array_min("base.at").cast("long").alias("first_word"), F.array_max("base.at").cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort(base_set)).alias("base_labels"), F.concat_ws(",", F.array_sort(all_set)).alias("labels"),
        F.coalesce(F.array_max("matches.share"), F.when(F.size("base") > 0, BASE_SCORE), F.lit(0.0)).alias("score"), "matches")


def scan_sql() -> str:
    """The same result (without ``matches``) as SQL: phrases compared at every place."""
    def at(words, start):
        return " AND ".join(f"w[{start} + {k}] = '{x}'" for k, x in enumerate(words))

    base = " UNION ALL ".join(f"SELECT doc_id, i - 1 AS pos, '{v}' AS label FROM p WHERE {at(k.split(), 'i')}" for k, v in BASE.items())
    hits = []
    for label, notice in TEMPLATES.items():
        words, place, key = parse(notice)
        share = " + ".join(f"CASE WHEN i - {place} + {k} >= 1 AND w[greatest(i - {place} + {k}, 1)] = '{x}' THEN 1 ELSE 0 END" for k, x in enumerate(words))
        hits.append(f"SELECT doc_id, '{label}' AS label, ({share}) / {len(words)}.0::DOUBLE AS share FROM p WHERE {at(key, 'i')}")
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
b AS ({base}), t AS ({' UNION ALL '.join(hits)}),
bs AS (SELECT doc_id, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM b GROUP BY doc_id),
ts AS (SELECT doc_id, max(share) AS share FROM t GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM b UNION ALL SELECT doc_id, label FROM t) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       coalesce(bs.labels, '') AS base_labels, coalesce(al.labels, '') AS labels,
       coalesce(share, CASE WHEN n > 0 THEN 0.5 END, 0.0)::DOUBLE AS score
FROM d LEFT JOIN bs ON d.doc_id = bs.doc_id LEFT JOIN ts ON d.doc_id = ts.doc_id LEFT JOIN al ON d.doc_id = al.doc_id
"""
