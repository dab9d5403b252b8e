"""The stored board run: repeated, with links across runs, and failing."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from noticeloom import session
from noticeloom.operators import promotion, runs, snapshots, upsert
from noticeloom.plans import pipeline, stored
from tests.test_pipeline import BOARD, list_page

NOW, CUTOFF = dt.datetime(2026, 5, 22, 12), dt.date(2026, 4, 22)
TEXT = "공실 정보 들꽃 101 호 25 ㎡ 40 ㎡ 1 룸 90,000 2,100 들꽃 101 호 25 ㎡ 40 ㎡ 1 룸 90,000 2,100 임대 기간 신청기간 : 2026.5.1 ~ 2026.5.9"


def landed(spark, *rows, applications=()):
    """Rows of (page, seq, title, day); rejected ones have 발표 in the title."""
    pages = sorted({r[0] for r in rows})
    lists = [("SH", "rental", p, list_page(*[r[1:] for r in rows if r[0] == p])) for p in pages]
    details = [("SH", "rental", seq, f"<table><caption>{title}</caption></table><div class='cont'>본문</div>") for _, seq, title, _ in rows]
    texts = [("SH", "rental", seq, "1", "notice_pdf", "pdf_text", f"k/{seq}", TEXT) for _, seq, _, _ in rows]
    notices = [("SH", "rental", "i", "01", code, title, status, dt.date.fromisoformat(day)) for code, title, status, day in applications]
    return (spark.createDataFrame(lists, BOARD + "page int, html string"), spark.createDataFrame(details, BOARD + "seq string, html string"),
            spark.createDataFrame(texts, BOARD + "seq string, file_seq string, kind string, artifact_type string, object_key string, raw_text string"),
            spark.createDataFrame(notices, BOARD + "source string, sply_ty string, recrnoti_cd string, title string, status string, posted_at date"))


def run(spark, root, name, rows, applications=(), now=NOW):
    stored.store_board_run(spark, root, name, *landed(spark, *rows, applications=applications), F.lit(now).cast("timestamp"), F.lit(CUTOFF))
    record = upsert.latest_runs(spark.read.parquet(f"{root}/collection_runs")).where(F.col("run_id") == name).first()
    return record


def table(spark, root, name):
    return snapshots.read(spark, f"{root}/{name}", list(upsert.SPECS[name].keys))


def test_runs_build_on_each_other(spark, tmp_path):
    root = str(tmp_path / "board")
    first = run(spark, root, "a", [(1, "9", "새 모집공고", "2026-05-20"), (1, "8", "당첨자 발표", "2026-05-19"), (2, "5", "오래된 모집공고", "2026-01-02"), (3, "4", "쪽 넘어 모집공고", "2026-05-01")])
    assert first.status == "succeeded" and tuple(sorted(first.stats)) == tuple(sorted(stored.BOARD_COUNTERS))
    want = dict(pages=2, list_rows=3, details=2, candidates=1, rejected=1, skipped_old=1, stopped_by_cutoff=1, downloaded=1, upserted_artifacts=3, upserted_offerings=2,
                upserted_schedules=1, total_artifacts=3, total_offerings=2, upserted_discovery_seen_cache=1, linked_application_notices=0)
    assert {k: first.stats[k] for k in want} == want
    state = {r.source_span: r.qa_status for r in promotion.promoted(spark, f"{root}/offerings").collect()}
    assert sorted(state.values()) == ["approved", "approved"]  # two table rows are two spans
    # the next run sees the known and the rejected notice again, and an application for the known one
    second = run(spark, root, "b", [(1, "9", "새 모집공고", "2026-05-20"), (1, "8", "당첨자 발표", "2026-05-19")], [("R9", "새 모집 공고", "마감", "2026-05-20"), ("R0", "다른 공고", "마감", "2026-05-20")])
    want = dict(list_rows=2, details=0, skipped_known=1, skipped_seen=1, upserted_offerings=0, total_offerings=2, upserted_application_notices=2, linked_application_notices=1)
    assert {k: second.stats[k] for k in want} == want
    notice = table(spark, root, "source_notices").first()
    links = {r.recrnoti_cd: r.notice_id for r in table(spark, root, "application_notices").collect()}
    assert links == {"R9": notice.id, "R0": None}
    # after the entry has ended the rejected notice is read again and counted once more
    third = run(spark, root, "c", [(1, "8", "당첨자 발표", "2026-05-19")], now=NOW + dt.timedelta(days=61))
    assert third.stats["details"] == 1
    entry = table(spark, root, "discovery_seen_cache").first()
    assert entry.seen_count == 2 and entry.first_seen_at < entry.last_seen_at
    assert {r.source_span: r.qa_status for r in promotion.promoted(spark, f"{root}/offerings").collect()} == state


def test_a_failing_run_leaves_its_error(spark, tmp_path):
    path = str(tmp_path / "runs")
    with pytest.raises(ValueError, match="broken"):
        with runs.recorded(spark, path, "x", "board", ("rows", "other")) as run:
            run.staged(spark.range(7).withColumn("n", F.col("id")), "seven", rows=F.count(F.lit(1)), above=F.count_if(F.col("id") > 4))
            run.label(kind="rental", pages=3)
            raise ValueError("broken page")
    rows = {r.status: r for r in spark.read.parquet(path).collect()}
    assert set(rows) == {"running", "failed"} and rows["running"].stats == {}
    assert rows["failed"].stats == {"rows": 7, "above": 2, "other": 0} and rows["failed"].labels == {"kind": "rental", "pages": "3"}
    assert rows["failed"].error_text == "ValueError: broken page"
    assert upsert.latest_runs(spark.read.parquet(path)).first().status == "failed"


def test_a_run_parses_pages_once_and_in_many_tasks(spark, tmp_path, monkeypatch):
    """Outputs of a run are read from what was kept, and landed texts are left in as many files as costly rows get tasks."""
    monkeypatch.setattr(session, "scratch_dir", lambda _, purpose: str(tmp_path / "aside" / f"{purpose}-{uuid.uuid4().hex}"))
    lists, details, texts, applications = landed(spark, *[(1 + i // 20, str(i), f"{i} 모집공고", "2026-05-20") for i in range(60)])
    before, cache = (spark.createDataFrame([], stored._SHAPES[name]) for name in ("source_notices", "discovery_seen_cache"))
    found = pipeline.board_run(lists.coalesce(1), details.coalesce(1), before, cache, applications, F.lit(NOW).cast("timestamp"), F.lit(CUTOFF))
    for df in (found.decided, found.candidates, found.refused, found.rejected):
        assert df.inputFiles() and all("/decided-" in f or "/judged-" in f for f in df.inputFiles())
    assert found.candidates.count() == 60
    stored.store_board_run(spark, str(tmp_path / "board"), "a", lists.coalesce(1), details.coalesce(1), texts.coalesce(1), applications, F.lit(NOW).cast("timestamp"), F.lit(CUTOFF))
    for kept, least in (("texts", 4), ("list-rows", 3)):
        folder = next(p for p in (tmp_path / "aside").iterdir() if p.name.startswith(f"{kept}-"))
        assert len(list(folder.glob("part-*"))) >= least, kept
