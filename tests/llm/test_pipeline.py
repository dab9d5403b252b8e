"""The composed pipeline: every stage on its own input, against brute force where it can be."""

import os

import pytest

import corpus_pipeline
from noticeloom.session import cut_lineage
from tests.llm.cases import SPACED, words
from tests.llm.test_pairs import passage_words, shingles

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables are not here")


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, FOLDER), name)
        seen.append(docs)
        if name != "mix":
            assert docs.columns == seen[0].columns
    first, good, unique, passages, clean, mixed = ({r["doc_id"]: r for r in d.collect()} for d in seen)
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    known = [i for i in first if i in marks]
    assert sum((i in good) == bool(marks[i]) for i in known) >= 0.9 * len(known)
    sets = {i: shingles(r["text"], 5) for i, r in good.items()}
    alike = lambda a, b: sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert not any(alike(a, b) for a in unique for b in unique if a < b)
    assert all(any(alike(i, j) for j in good if j != i) for i in set(good) - set(unique))
    marked = passage_words([(i, r["text"]) for i, r in unique.items()], 50)
    for i, r in unique.items():
        want = [w for k, w in enumerate(words(r["text"])) if k not in marked.get(i, ())]
        assert words(passages[i]["text"]) == want if want else i not in passages
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = words(r["text"])
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))}
    for i, r in passages.items():
        w, hit = words(r["text"]), set()
        for k in range(len(w) - 9):
            if tuple(w[k:k + 10]) in windows:
                hit.update(range(k, k + 10))
        if len(hit) < len(w):
            assert words(clean[i]["text"]) == [x for k, x in enumerate(w) if k not in hit] and clean[i]["n_chars"] == len(clean[i]["text"])
        else:
            assert i not in clean or not w
    assert set(mixed) <= set(clean) and all(r["taken"] == r["copies"] * len(words(clean[i]["text"], SPACED)) > -1 for i, r in mixed.items())


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, FOLDER).columns == [*corpus_pipeline.COLUMNS, "copies", "taken"]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "passage_dedup", "decontamination", "mix"]
