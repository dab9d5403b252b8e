"""The seen cache as stream state, against the same rules in plain Python."""

import datetime
import random

from pyspark.sql import functions as F

from noticeloom.operators.upsert import append_rows
from noticeloom.session import scratch_dir
from noticeloom.streaming import incremental, seen

DAY = datetime.timedelta(days=1)
START = datetime.datetime(2024, 1, 1)
SHAPE = "agency string, seq string, position long, title string, posted_at date, collected_at timestamp_ntz, category string"
TTL = {"rejected": 60, "rejected_unknown": 7}


def expected(landings):
    entries, clock, out = {}, None, []
    for rows in landings:
        for row in sorted(rows, key=lambda r: (r[5], r[2])):
            key, now = row[:2], max(row[5], clock or row[5])
            entry = entries.get(key)
            if entry and entry["ends"] <= now:
                entry = None
            same = bool(entry) and entry["title"] == row[3] and (entry["day"] is None or row[4] is None or entry["day"] == row[4])
            status = {"recruitment": None, "unknown": "rejected_unknown"}.get(row[6], "rejected")
            if not same and status:
                entry = {"title": row[3], "day": row[4], "status": status, "ends": now + TTL[status] * DAY, "n": entry["n"] + 1 if entry else 1}
            entries[key] = entry
            out.append((*key, row[2], "skipped_seen" if same else "detail", *((entry["status"], entry["ends"], entry["n"]) if entry else (None, None, None))))
        clock = max([clock or START] + [r[5] for r in rows])
    return sorted(out, key=str), {k: e for k, e in entries.items() if e and e["ends"] > clock}


def run(spark, landings):
    landed, out, marks = (scratch_dir(spark, x) for x in ("landed", "judged", "marks"))
    for rows in landings:
        append_rows(spark.createDataFrame(rows, SHAPE).coalesce(1), landed)
        stream = incremental.landed_stream(spark, landed, spark.createDataFrame([], SHAPE).schema)
        seen.judge_available(stream, out, marks, ["agency", "seq"], "position")
    got = spark.read.parquet(out).select("agency", "seq", "position", "outcome", "status", F.col("expires_at").cast("timestamp_ntz"), "seen_count")
    return sorted((tuple(r) for r in got.collect()), key=str), marks


def test_rows_are_judged_as_in_reading_order(spark):
    rng, rows = random.Random(5), []
    for n in range(240):
        who = rng.randrange(12)
        rows.append((None if who == 0 else "A", str(who), n, f"Title {who} {'v2' if rng.random() < 0.1 else ''}", None if n % 9 == 0 else datetime.date(2024, 1, 1 + (n % 40 == 0)),
                     START + datetime.timedelta(hours=rng.randrange(100 * 24), milliseconds=rng.randrange(1000)), ("rejected", "unknown", "recruitment")[who % 3]))
    by_time = sorted(rows, key=lambda r: r[5])
    landings = [by_time[:80], [r for r in by_time[80:160] if r[2] % 7], by_time[160:] + [r for r in by_time[80:160] if not r[2] % 7]]
    got, marks = run(spark, landings)
    want, live = expected(landings)
    assert got == want
    assert {r[3] for r in got} == {"skipped_seen", "detail"}
    kept = spark.read.format("statestore").option("path", marks).option("stateVarName", "entry").load()
    assert sorted(((r["agency"], r["seq"]) for r in kept.select("key.*").collect()), key=str) == sorted(live, key=str)


def test_expiry_to_the_microsecond_and_title_spelling(spark):
    row = lambda n, at, title="A Title": ("A", "1", n, title, None, at, "unknown")
    end = START + 7 * DAY
    got, _ = run(spark, [[row(1, START), row(2, end - datetime.timedelta(microseconds=1), "a  title"), row(3, end), row(4, end + DAY)]])
    assert [r[3] for r in sorted(got, key=lambda r: r[2])] == ["detail", "skipped_seen", "detail", "skipped_seen"]
    assert {r[2]: r[6] for r in got} == {1: 1, 2: 1, 3: 1, 4: 1}


def test_setting_of_the_session_is_restored(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    with seen.rocks(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name) == before
