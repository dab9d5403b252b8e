"""The registered queries of the subpackage, with their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from noticeloom.llm import capfilters, decontam, langid, licenses, merkle, minhash, mixing, quality, resample, suffixes, toxicity, urlfilter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_decontamination(spark, folder):
    found = decontam.report(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL["op4_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + least(len(w), 10) - 1] AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
widths AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, w[i:i + n - 1] AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, widths WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
          FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op3_license_scan(spark, folder):
    return licenses.scan(read(spark, folder, "documents")).drop("matches")


SQL["op3_license_scan"] = licenses.scan_sql()


@query
def op7_warc(spark, folder):
    root = warc.new_archive(spark)
    warc.write(read(spark, folder, "pages"), root)
    return warc.read(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
"""


@query
def op8_source_mix(spark, folder):
    return mixing.report(read(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL["op8_source_mix"] = mixing.report_sql()


@query
def op10_language_id(spark, folder):
    return langid.predict(read(spark, folder, "documents"))


@query
def op9_quality(spark, folder):
    return quality.predict(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op2_toxicity(spark, folder):
    return toxicity.predict(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op1_near_duplicates(spark, folder):
    return minhash.report(read(spark, folder, "documents"), width=2)


SQL["op1_near_duplicates"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * same >= 80 * (x.n + y.n - same)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


@query
def op6_embedding_duplicates(spark, folder):
    return capfilters.report(read(spark, folder, "embeddings"))


SQL["op6_embedding_duplicates"] = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                     WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
"""


@query
def op5_repeated_passages(spark, folder):
    return suffixes.passages(read(spark, folder, "documents")).drop("copy")


@query
def op11_url_filter(spark, folder):
    pages = read(spark, folder, "pages")
    return urlfilter.judge(pages, urlfilter.default_rules(spark), urlfilter.default_labelled(spark)).drop("score")


SQL["op11_url_filter"] = urlfilter.sql()


@query
def op12_merkle_manifest(spark, folder):
    return merkle.report(read(spark, folder, "documents"))


SQL["op12_merkle_manifest"] = merkle.sql()


@query
def op13_target_resampling(spark, folder):
    return resample.report(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


SQL["op13_target_resampling"] = resample.sql()
