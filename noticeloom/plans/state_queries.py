"""Upserts, deletes, run state and incremental runs over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from noticeloom.operators import classify, dedupe, discovery, snapshots, upsert
from noticeloom.operators.repair import attempt_rows
from noticeloom.plans.registry import query
from noticeloom.session import scratch_dir
from noticeloom.streaming import incremental, seen

L = F.lit


def K():
    return F.col("o_orderkey")


def _target(t):
    """Stored rows: two thirds of the orders."""
    return t.orders.where(K() % 3 > 0)


def _batch(t):
    """A batch of half the orders, each twice; the second copy is the later one."""
    half = t.orders.where(K() % 2 == 0)
    return half.withColumn("position", K() * 2).unionByName(half.withColumn("position", K() * 2 + 1))


# old = stored, new = in the batch
_SIDES = "FROM (SELECT *, o_orderkey % 3 > 0 AS old, o_orderkey % 2 = 0 AS new FROM orders) WHERE old OR new"


@query("m01_m04_m05_replace_all", f"""
    SELECT o_orderkey, CASE WHEN new THEN 'new-' || o_orderpriority || '-1' ELSE 'old' END AS name, CASE WHEN new THEN o_custkey ELSE -1 END AS size {_SIDES}""")
def _(t):
    target = _target(t).select("o_orderkey", L("old").alias("name"), L(-1).cast("bigint").alias("size"))
    batch = _batch(t).select("o_orderkey", "position", F.concat(L("new-"), "o_orderpriority", L("-"), F.col("position") % 2).alias("name"), F.col("o_custkey").alias("size"))
    return upsert.upsert(target, batch, ["o_orderkey"], position=F.col("position"))


def _replaced(stored, batch, table, position):
    """A table after a batch that brings every key twice; the later copy counts."""
    spec = upsert.SPECS[table]
    twice = batch.withColumn("position", L(1)).unionByName(batch.withColumns({position: F.concat(position, L("-late")), "position": L(2)}))
    return upsert.upsert(stored, twice, list(spec.keys), spec.rules, F.col("position"))


@query("m01_boards", """
    SELECT CAST(n_regionkey AS STRING) AS agency, n_name AS board_kind, CASE WHEN n_nationkey % 2 = 0 THEN 'new-late' ELSE 'old' END AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'https://n/' ELSE 'https://o/' END || CAST(n_nationkey AS STRING) AS url
    FROM nation WHERE n_nationkey % 2 = 0 OR n_nationkey % 3 > 0""")
def _(t):
    shape = lambda name, url: t.nation.select(
        "n_nationkey", F.col("n_regionkey").cast("string").alias("agency"), F.col("n_name").alias("board_kind"), L(name).alias("name"), F.concat(L(url), F.col("n_nationkey").cast("string")).alias("url"))
    return _replaced(shape("old", "https://o/").where("n_nationkey % 3 > 0").drop("n_nationkey"), shape("new", "https://n/").where("n_nationkey % 2 = 0").drop("n_nationkey"), "source_boards", "name")


@query("m04_objects", """
    SELECT 'b' || CAST(c_nationkey AS STRING) AS bucket, 'k/' || CAST(c_custkey AS STRING) AS object_key, CASE WHEN c_custkey % 2 = 0 THEN sha256(c_name) || '-late' ELSE 'old' END AS sha256,
           CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE 0 END AS size_bytes FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 > 0""")
def _(t):
    shape = lambda digest, size: t.customer.select(
        "c_custkey", F.concat(L("b"), F.col("c_nationkey").cast("string")).alias("bucket"), F.concat(L("k/"), F.col("c_custkey").cast("string")).alias("object_key"), digest.alias("sha256"), size.cast("bigint").alias("size_bytes"))
    stored = shape(L("old"), L(0)).where("c_custkey % 3 > 0").drop("c_custkey")
    return _replaced(stored, shape(F.sha2("c_name", 256), F.col("c_custkey")).where("c_custkey % 2 = 0").drop("c_custkey"), "stored_objects", "sha256")


@query("m05_attachments", """
    SELECT 'b' || CAST(l_linenumber % 2 AS STRING) AS brd_id, CAST(l_orderkey AS STRING) AS seq, CAST(min(l_linenumber) AS STRING) AS file_seq, CASE WHEN l_orderkey % 2 = 0 THEN 'new.pdf-late' ELSE 'old.pdf' END AS filename
    FROM lineitem WHERE l_orderkey % 2 = 0 OR l_orderkey % 3 > 0 GROUP BY l_orderkey, l_linenumber % 2, l_linenumber""")
def _(t):
    shape = lambda rows, name: rows.select(F.concat(L("b"), (F.col("l_linenumber") % 2).cast("string")).alias("brd_id"), F.col("l_orderkey").cast("string").alias("seq"),
                                           F.col("l_linenumber").cast("string").alias("file_seq"), L(name).alias("filename")).distinct()
    return _replaced(shape(t.lineitem.where("l_orderkey % 3 > 0"), "old.pdf"), shape(t.lineitem.where("l_orderkey % 2 = 0"), "new.pdf"), "attachments", "filename")


@query("m02_notices", f"""
    SELECT CAST(o_orderkey AS STRING) AS seq, CASE WHEN new THEN 't-new' ELSE 't-old' END AS title,
           CASE WHEN new AND o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE) WHEN old THEN DATE '2020-01-01' END AS posted_at {_SIDES}""")
def _(t):
    spec = upsert.SPECS["source_notices"]
    shape = lambda d, title, posted: d.select(L("SH").alias("agency"), L("rental").alias("board_kind"), K().cast("string").alias("seq"), L(title).alias("title"), posted.alias("posted_at"),
                                              *(["position"] if "position" in d.columns else []))
    target = shape(_target(t), "t-old", F.to_date(L("2020-01-01")))
    batch = shape(_batch(t), "t-new", F.when(K() % 4 == 0, F.to_date("o_orderdate")))
    return upsert.upsert(target, batch, list(spec.keys), spec.rules, F.col("position")).select("seq", "title", "posted_at")


@query("m03_m10_applications", f"""
    SELECT CAST(o_orderkey AS STRING) AS recrnoti_cd, CASE WHEN o_orderkey % 10 = 0 THEN 77 WHEN new AND o_orderkey % 4 = 0 THEN o_custkey WHEN old THEN 5 END AS notice_id, CASE WHEN new THEN o_orderstatus ELSE 'old' END AS status {_SIDES}""")
def _(t):
    spec = upsert.SPECS["application_notices"]
    shape = lambda d, notice, status: d.select(L("SH").alias("agency"), L("s").alias("source"), L("01").alias("sply_ty"), K().cast("string").alias("recrnoti_cd"), notice.cast("bigint").alias("notice_id"),
                                               status.alias("status"), L(None).cast("date").alias("posted_at"), *(["position"] if "position" in d.columns else []))
    merged = upsert.upsert(shape(_target(t), L(5), L("old")), shape(_batch(t), F.when(K() % 4 == 0, F.col("o_custkey")), F.col("o_orderstatus")), list(spec.keys), spec.rules, F.col("position"))
    links = t.orders.where(K() % 10 == 0).select(K().cast("string").alias("recrnoti_cd"), L(77).cast("bigint").alias("notice_id"))
    return upsert.update_column(merged, links, "recrnoti_cd", "notice_id").select("recrnoti_cd", "notice_id", "status")


@query("m06_artifacts", f"""
    SELECT CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END || '|pdf_text|s' || CAST(o_orderkey AS STRING) AS merge_key, CASE WHEN new THEN 'new' ELSE 'old' END AS raw_text {_SIDES}""")
def _(t):
    shape = lambda d, text: d.select(F.when(K() % 5 > 0, F.col("o_custkey")).alias("attachment_id"), L("pdf_text").alias("artifact_type"), F.concat(L("s"), K()).alias("source_span"), L(text).alias("raw_text"),
                                     *(["position"] if "position" in d.columns else [])).withColumn("merge_key", upsert.artifact_merge_key())
    return upsert.upsert(shape(_target(t), "old"), shape(_batch(t), "new"), ["merge_key"], position=F.col("position")).select("merge_key", "raw_text")


@query("m07_offerings", f"""
    SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'n' ELSE 'a' END || CAST(o_custkey AS STRING) || '|s' || CAST(o_orderkey AS STRING) AS merge_key, CASE WHEN old THEN 1 ELSE 2 END AS notice_id,
           CASE WHEN new THEN 'label-new' ELSE 'label-old' END AS label, CASE WHEN old AND o_orderstatus = 'O' THEN 'approved' WHEN new THEN 'pending' ELSE 'rejected' END AS qa_status {_SIDES}""")
def _(t):
    spec = upsert.SPECS["offerings"]

    def shape(d, notice, label, status):
        rows = d.select(F.when(K() % 5 > 0, F.col("o_custkey")).alias("attachment_id"), F.col("o_custkey").alias("owner"), F.concat(L("s"), K()).alias("source_span"),
                        L(notice).alias("notice_id"), L(label).alias("label"), status.alias("qa_status"), *(["position"] if "position" in d.columns else []))
        return rows.withColumn("merge_key", upsert.offering_merge_key(notice_id="owner"))
    target = shape(_target(t), 1, "label-old", F.when(F.col("o_orderstatus") == "O", "approved").otherwise("rejected"))
    return upsert.upsert(target, shape(_batch(t), 2, "label-new", L("pending")), list(spec.keys), spec.rules, F.col("position")).select("merge_key", "notice_id", "label", "qa_status")


@query("m08_schedules_last_wins", """
    SELECT l_orderkey AS notice_id, CAST(l_linenumber AS STRING) AS source_span, max(l_partkey * 100000 + l_suppkey) AS period FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def _(t):
    spec = upsert.SPECS["notice_schedules"]
    rows = t.lineitem.select(F.col("l_orderkey").alias("notice_id"), L("application").alias("schedule_type"), F.col("l_linenumber").cast("string").alias("source_span"),
                             (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("period"))
    stored = dedupe.first_row(rows.where("notice_id % 2 = 0"), list(spec.keys), [F.col("period")])
    return upsert.upsert(stored, rows, list(spec.keys), spec.rules, F.col("period")).select("notice_id", "source_span", "period")


@query("m09_seen_cache", f"""
    SELECT CAST(o_orderkey AS STRING) AS seq, CASE WHEN new THEN CASE WHEN o_orderstatus = 'P' THEN 'rejected_unknown' ELSE 'rejected' END ELSE 'rejected' END AS status, CASE WHEN old AND new THEN 4 WHEN old THEN 3 ELSE 1 END AS seen_count,
           CASE WHEN new THEN CASE WHEN o_orderstatus = 'P' THEN DATE '2024-01-08' ELSE DATE '2024-03-01' END ELSE DATE '2023-01-01' END AS expires_on {_SIDES}""")
def _(t):
    spec = upsert.SPECS["discovery_seen_cache"]
    keys = [L("SH").alias("agency"), L("rental").alias("board_kind"), K().cast("string").alias("seq")]
    target = _target(t).select(*keys, L("rejected").alias("status"), L("h").alias("list_title_hash"), L("2023-01-01").cast("timestamp_ntz").alias("expires_at"), L(3).alias("seen_count"))
    rejected = _batch(t).select(*keys, "position", F.col("o_orderpriority").alias("title"), F.when(F.col("o_orderstatus") == "P", "unknown").otherwise("rejected").alias("reason"))
    entries = discovery.seen_entries(rejected, list(spec.keys), "title", "reason", L("2024-01-01").cast("timestamp_ntz"))
    merged = upsert.upsert(target, entries, list(spec.keys), spec.rules, F.col("position"))
    return merged.select("seq", "status", "seen_count", F.to_date("expires_at").alias("expires_on"))


@query("m11_replace_repair_rows", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'old' AS origin FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_orderkey % 2 = 0 AND EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey))
    UNION ALL SELECT o_orderkey, NULL, NULL, NULL, 'new' FROM orders WHERE o_orderkey % 2 = 0""")
def _(t):
    old = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", L("old").alias("origin"))
    new = t.orders.where(K() % 2 == 0).select(K().alias("l_orderkey"), L("new").alias("origin"))
    return upsert.replace_rows(old, F.col("l_returnflag") == "R", "l_orderkey", new).drop("l_returnflag")


@query("m12_attempt_log", "SELECT sha256(text) AS input_hash, sha256(role) AS output_hash, count(*) AS attempts FROM conversations GROUP BY 1, 2")
def _(t):
    path = scratch_dir(t.spark, "attempts")
    log = attempt_rows(t.conversations, ["turn"], "text", "role")
    upsert.append_rows(log.where("turn % 2 = 0"), path)
    upsert.append_rows(log.where("turn % 2 = 1"), path)
    return t.spark.read.parquet(path).groupBy("input_hash", "output_hash").agg(F.count(L(1)).alias("attempts"))


@query("m13_latest_runs", "SELECT user_id AS run_id, arg_max(event_type, event_id) AS status, max(event_id) AS recorded_at FROM events GROUP BY user_id")
def _(t):
    runs = t.events.select(F.col("user_id").alias("run_id"), F.col("event_type").alias("status"), F.col("event_id").alias("recorded_at"))
    return upsert.latest_runs(runs)


@query("m15_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2 HAVING count(*) > 1")
def _(t):
    return upsert.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"], F.col("l_returnflag") != "N")


@query("m01_m09_upsert_table", f"""
    SELECT o_orderkey, CASE WHEN new THEN o_custkey ELSE 0 END AS size, CASE WHEN old AND new THEN 2 ELSE 1 END AS seen_count {_SIDES}""")
def _(t):
    """Two upserts into a table of snapshots; the second comes in parts, and all of it again."""
    path = scratch_dir(t.spark, "table")
    shape = lambda d, size, n: d.select(
        "o_orderkey", size.cast("bigint").alias("size"), L(1).alias("seen_count"), L(n).alias("batch_id"), *(["position"] if "position" in d.columns else []))
    rules, batch = {"seen_count": upsert.add_up}, shape(_batch(t), F.col("o_custkey"), 2)
    snapshots.upsert_snapshot(t.spark, path, shape(_target(t), L(0), 1), ["o_orderkey"], rules)
    for part in ("o_orderkey % 50 = 0", "o_orderkey % 50 <> 0", "true"):
        snapshots.upsert_snapshot(t.spark, path, batch.where(part), ["o_orderkey"], rules, F.col("position"), version="batch_id")
    return snapshots.read(t.spark, path, ["o_orderkey"]).select("o_orderkey", "size", "seen_count")


# --- incremental -----------------------------------------------------------------------------------------------
def _stream(t):
    return incremental.landed_stream(t.spark, t.folder, t.events.schema, "events.parquet")


@query("r01_incremental_upsert", "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id, event_type")
def _(t):
    """Half of the rows, all of them with a checkpoint that begins anew, then the same checkpoint again."""
    table, marks = scratch_dir(t.spark, "state"), [scratch_dir(t.spark, "marks") for _ in range(2)]
    for only, mark in (("event_id % 2 = 0", marks[0]), ("true", marks[1]), ("true", marks[1])):
        incremental.upsert_available(_stream(t).where(only).select("user_id", "event_type", "event_id", "value"), table, mark, ["user_id", "event_type"], F.col("event_id"))
    return snapshots.read(t.spark, table, ["user_id", "event_type"]).select("user_id", "event_type", "event_id", "value")


@query("r02_seen_cache_stream", """
    , clock AS (SELECT landing, date_trunc('milliseconds', max(collected_at)) AS top FROM collected_rows GROUP BY landing),
    r AS (SELECT c.*, CASE CAST(seq AS BIGINT) % 5 WHEN 0 THEN NULL WHEN 1 THEN 60 WHEN 2 THEN 60 ELSE 7 END AS days,
                 greatest(collected_at, coalesce((SELECT max(top) FROM clock k WHERE k.landing < c.landing), collected_at)) AS now,
                 row_number() OVER (PARTITION BY agency, board_kind, seq ORDER BY landing, collected_at, position) AS n FROM collected_rows c),
    walk AS (SELECT DISTINCT agency, board_kind, seq, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS position, CAST(NULL AS VARCHAR) AS outcome, CAST(NULL AS VARCHAR) AS held,
                    CAST(NULL AS DATE) AS day, CAST(NULL AS TIMESTAMP) AS ends, CAST(NULL AS BIGINT) AS times FROM r
             UNION ALL
             SELECT agency, board_kind, seq, n, position, CASE WHEN same THEN 'skipped_seen' ELSE 'detail' END, CASE WHEN same OR days IS NULL THEN held ELSE title END,
                    CASE WHEN same OR days IS NULL THEN day ELSE posted_at END, CASE WHEN same OR days IS NULL THEN ends ELSE now + days * INTERVAL 1 DAY END,
                    CASE WHEN same OR days IS NULL THEN times ELSE coalesce(times, 0) + 1 END
             FROM (SELECT *, ends IS NOT NULL AND held = title AND (day IS NULL OR posted_at IS NULL OR day = posted_at) AS same
                   FROM (SELECT r.*, CASE WHEN w.ends > now THEN held END AS held, CASE WHEN w.ends > now THEN day END AS day, CASE WHEN w.ends > now THEN ends END AS ends,
                                CASE WHEN w.ends > now THEN times END AS times
                         FROM walk w JOIN r ON w.agency = r.agency AND w.board_kind = r.board_kind AND w.seq = r.seq AND r.n = w.n + 1)))
    SELECT agency, board_kind, seq, position, outcome, ends AS expires_at, times AS seen_count FROM walk WHERE n > 0""", ("collected_rows",))
def _(t):
    """Three landings on one checkpoint; rows of earlier periods land late, entries end between and inside the runs."""
    landed, out, marks = (scratch_dir(t.spark, x) for x in ("landed", "judged", "marks"))
    rows = t.project("collected_rows")
    for n in (1, 2, 3):
        upsert.append_rows(rows.where(F.col("landing") == n), landed)
        stream = incremental.landed_stream(t.spark, landed, rows.schema)
        seen.judge_available(stream, out, marks, ["agency", "board_kind", "seq"], "position", category=classify.notice_category("title", L("")))
    judged = t.spark.read.parquet(out)
    return judged.select("agency", "board_kind", "seq", "position", "outcome", F.col("expires_at").cast("timestamp_ntz").alias("expires_at"), "seen_count")


@query("r03_stream_dedupe", "SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events")
def _(t):
    """Three landings on one checkpoint: the newer half, older days never seen, and all rows again 90 days later."""
    landed, out, marks = (scratch_dir(t.spark, x) for x in ("landed", "unique", "marks"))
    rows = t.events.select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts")
    half = L("2024-01-16").cast("timestamp_ntz")
    for part in (rows.where(F.col("ts") >= half), rows.where(F.col("ts") < half), rows.withColumn("ts", F.col("ts") + F.make_dt_interval(L(90)))):
        upsert.append_rows(part, landed)
        incremental.dedupe_available(incremental.landed_stream(t.spark, landed, rows.schema), out, marks, ["user_id", "event_type", "day"], [F.col("ts"), F.col("event_id")])
    return t.spark.read.schema(rows.schema).parquet(out).select("user_id", "event_type", "day")
