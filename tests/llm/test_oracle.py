"""Every query of the subpackage that has SQL, against it on the smallest supplied tables."""

import os

import pytest

from noticeloom.llm import queries
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables are not here")


@pytest.mark.parametrize("name", list(queries.SQL))
def test_matches_sql(spark, name):
    mine, want = compare(spark, connect(FOLDER), name, queries.QUERIES[name], queries.SQL[name], FOLDER)
    assert mine[0] == want[0]
    assert mine[1] == want[1]


@pytest.mark.parametrize("name, columns", [("op2_toxicity", ["doc_id", "held_out", "score", "predicted"]), ("op9_quality", ["doc_id", "held_out", "score", "predicted"]),
                                           ("op10_language_id", ["doc_id", "held_out", "lang_pred", "score"])])
def test_scores_every_document_once(spark, name, columns):
    got = queries.QUERIES[name](spark, FOLDER)
    assert got.columns[:4] == columns
    rows = got.collect()
    ids = sorted(r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect())
    assert sorted(r["doc_id"] for r in rows) == ids
    assert all(0 <= r["score"] <= 1 for r in rows)
