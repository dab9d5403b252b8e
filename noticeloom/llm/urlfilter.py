"""URL filter: rules first, then logistic regression on hashed character n-grams; DataFrame functions only.

``host`` is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with
``A-Z`` lower-cased; ``path`` what follows it up to ``?`` or ``#``.

Rules are a table (``rule``, ``action``) of strings like ``example.com/en/``: the part
before the first ``/`` is a host, the rest a start of the path. A rule fits its host and
all subdomains; of several the longest string wins. Rules are found by equality alone:
a URL's host suffixes are joined with the lengths of path that the rules of such a host
have, and the (host, start of path) pairs with the rules, so neither many rules nor a hot
host compares strings pairwise.

The model decides where no rule fits. Character n-grams of host and path, with marks at
both ends and every digit as ``0``, are hashed to ``BUCKETS`` buckets. Weights come from
full-batch gradient descent over a small labelled table (``url``, ``blocked``), written as
one array expression: the error of every labelled URL, then the step of every feature from
the URLs that have it. At most ``LABELLED_ROWS`` labelled rows are used (the first by
checksum of the URL); this bounds the one row that holds them. What was learned is a table of at
most ``BUCKETS`` weights, which is broadcast to the n-grams of the URLs.

Each distinct (host, path) is judged once, so a URL that makes up a third of all rows is
one row there and a skewed probe side of the last join only.

Edge cases: a null URL and one without ``://`` have empty host and path and are judged
like any other; an empty path fits only rules without a path; repeated rows give repeated
rows; null rules and labels and unknown actions are ignored; of one rule with both
actions ``block`` wins; without rules the model decides all; without labelled rows every
score is 0.5 and the verdict ``block``; an empty table gives an empty result. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.llm.sqltext import CRC_TABLE, LOWER, UPPER, crc32, low
from noticeloom.operators.staging import hold

BUCKETS = 1 << 15
#: Labelled rows used at most.
LABELLED_ROWS = 512
#: Lengths of the character n-grams.
GRAMS = (2, 3, 4)
ROUNDS, RATE, DECAY = 150, 8.0, 0.001
THRESHOLD = 0.5

# The rules of the registered query.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))

# A small labelled table: hosts whose names tell what they serve, each with the paths below.
BLOCKED_HOSTS = (
    "casino-royal.test", "vegas-casino.test", "mega-casino-win.test", "poker-bets.test", "sports-bets.test", "live-betting.test", "slots-jackpot.test",
    "lotto-winner.test", "cheap-meds.test", "pills-online.test", "discount-pharmacy.test", "viagra-shop.test", "diet-pills.test", "adult-video.test",
    "adult-chat.test", "xxx-tube.test", "porn-hd.test", "sex-cams.test", "hot-dates.test", "spam-mailer.test", "link-farm.test", "seo-spam.test",
    "ads-clicks.test", "ad-tracker.test", "ads-server.test", "click-track.test", "popup-ads.test", "warez-crack.test", "free-keygen.test",
    "torrent-crack.test", "payday-loans.test", "quick-loans.test", "replica-watch.test", "fake-luxury.test", "phish-login.test", "free-prize-win.test",
    "malware-drop.test", "earn-money-fast.test", "crypto-doubler.test", "get-rich-win.test",
)
ALLOWED_HOSTS = (
    "city-library.test", "weather-report.test", "daily-news.test", "science-journal.test", "open-docs.test", "math-lectures.test", "cooking-blog.test",
    "garden-notes.test", "travel-guide.test", "history-museum.test", "university.test", "high-school.test", "local-council.test", "train-times.test",
    "book-review.test", "music-lessons.test", "photo-club.test", "running-club.test", "health-service.test", "court-records.test", "art-gallery.test",
    "code-forum.test", "linux-wiki.test", "farm-museum.test", "track-athletics.test", "winter-sports.test", "online-atlas.test", "theatre.test",
    "therapist.test", "southern-post.test", "northland.test", "threads.test", "translation.test", "nation-archive.test", "brother.test", "together.test",
    "mountain-hut.test", "bakery.test", "bird-watching.test", "free-textbooks.test",
)
PATHS = ("/en/12", "/de/481.html", "/fr/30/", "/es/775", "/en/index.html", "/", "/de/9", "/en/640/", "/fr/118.html", "/es/52/")


def values(spark: SparkSession, rows, columns: str) -> DataFrame:
    """A small table of constants."""
    return spark.sql(f"SELECT * FROM VALUES {', '.join(str(tuple(r)) for r in rows)} AS t({columns})")


def default_rules(spark: SparkSession) -> DataFrame:
    return values(spark, RULES, "rule, action")


def labelled_rows() -> list[tuple[str, int]]:
    """Every host with one of the paths in turn, and once more below ``www.``, ``m.`` or ``blog.``"""
    return [(f"https://{prefix}{h}{PATHS[(i + k) % len(PATHS)]}", blocked) for blocked, hosts in ((1, BLOCKED_HOSTS), (0, ALLOWED_HOSTS))
            for i, h in enumerate(hosts) for k, prefix in enumerate(("", ("www.", "m.", "blog.")[i % 3]))]


def default_labelled(spark: SparkSession) -> DataFrame:
    return values(spark, labelled_rows(), "url, blocked")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def buckets_of(host: Column, path: Column) -> Column:
    """Distinct buckets of the n-grams, in ascending order; never empty."""
    def cut(kind: str, marked: Column, n: int) -> Column:
        starts = F.when(F.length(marked) >= n, F.sequence(F.lit(1), F.length(marked) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(kind), F.substr(marked, i, F.lit(n))))

    marked = {kind: F.concat(F.lit("^"), F.regexp_replace(text, "[0-9]", "0"), F.lit("$")) for kind, text in (("h", host), ("p", path))}
    grams = F.concat(F.array(F.concat(F.lit("h"), host)), *[cut(kind, text, n) for kind, text in marked.items() for n in GRAMS])
    return F.array_sort(F.array_distinct(F.transform(grams, lambda g: (F.crc32(g.cast("binary")) % BUCKETS).cast("int"))))


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def norm(buckets: Column) -> Column:
    return F.sqrt(F.size(buckets).cast("double"))


def train(labelled: DataFrame, rows: int = LABELLED_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """The learned weights (``b``, ``w``), one row per bucket that a labelled URL has: at most ``BUCKETS`` rows."""
    host, path = host_and_path(F.col("url"))
    kept = labelled.select(F.col("url").cast("string").alias("url"), F.col("blocked").cast("double").alias("y")).where("url is not null and y in (0, 1)") \
        .orderBy(F.crc32(F.col("url").cast("binary")), "url", "y").limit(rows)
    ordered = kept.select("y", buckets_of(host, path).alias("x")).agg(F.array_sort(F.collect_list(F.struct("x", "y"))).alias("u"))
    used = ordered.select(F.posexplode("u").alias("i", "e")).select("i", "e.y", F.explode("e.x").alias("b"))
    features = used.groupBy("b").agg(F.array_sort(F.collect_list("i")).alias("has")).agg(F.array_sort(F.collect_list(F.struct("b", "has"))).alias("f"))
    placed = features.select(F.posexplode("f").alias("k", "e")).select("k", F.explode("e.has").alias("i"))
    examples = placed.join(used.select("i", "y").distinct(), "i").groupBy("i", "y").agg(F.array_sort(F.collect_list("k")).alias("ks")) \
        .agg(F.array_sort(F.collect_list(F.struct("i", "y", "ks"))).alias("u"))
    both = labelled.sparkSession.range(1).select(features.scalar().alias("f"), examples.scalar().alias("u"))

    def step(w: Column) -> Column:
        def error(e: Column) -> Column:
            z = F.aggregate(e["ks"], F.lit(0.0), lambda acc, k: acc + F.get(w, k)) / norm(e["ks"])
            return (sigmoid(z) - e["y"]) / norm(e["ks"])

        rate = RATE / F.size("u").cast("double")
        return F.transform(F.array(F.transform("u", error)), lambda r: F.transform("f", lambda p, k: F.get(w, k) * (1 - RATE * DECAY) - rate * F.aggregate(
            p["has"], F.lit(0.0), lambda acc, i: acc + F.get(r, i))))[0]

    learned = hold(hold(both, f=F.col("f"), u=F.col("u")), w=F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), F.transform("f", lambda p: F.lit(0.0)), lambda w, t: step(w)))
    return learned.select(F.inline(F.arrays_zip(F.col("f.b").alias("b"), F.col("w").alias("w"))))


def scores(urls: DataFrame, weights: DataFrame) -> DataFrame:
    """``host``, ``path`` and the probability ``score`` of being blocked, for distinct (host, path)."""
    held = hold(urls, x=buckets_of(F.col("host"), F.col("path")))
    rows = held.select("host", "path", norm(F.col("x")).alias("norm"), F.explode("x").alias("b"))
    return rows.join(F.broadcast(weights), "b", "left").groupBy("host", "path").agg(
        sigmoid(F.coalesce(F.sum("w"), F.lit(0.0)) / F.first("norm")).alias("score"))


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``rule`` and ``action`` of the longest rule that fits, for distinct (host, path) that have one."""
    text = F.col("rule").cast("string")
    cut = F.instr(text, "/")
    table = rules.where(F.col("action").isin("allow", "block") & text.isNotNull()).select(
        text.alias("rule"), "action",
        F.translate(F.when(cut > 0, F.substr(text, F.lit(1), cut - 1)).otherwise(text), UPPER, LOWER).alias("rule_host"),
        F.when(cut > 0, F.substr(text, cut)).otherwise("").alias("rule_path"))
    table = table.groupBy("rule_host", "rule_path").agg(F.max(F.struct("action", "rule")).alias("r"))
    lengths = table.select("rule_host", F.length("rule_path").alias("n")).distinct()
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    below = hold(urls, s=suffixes).select("host", "path", F.explode("s").alias("rule_host"))
    starts = below.join(lengths, "rule_host").where(F.length("path") >= F.col("n")) \
        .select("host", "path", "rule_host", F.substr("path", F.lit(1), F.col("n")).alias("rule_path"))
    best = starts.join(table, ["rule_host", "rule_path"]).groupBy("host", "path").agg(F.max(F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("m"), "r")).alias("best"))
    return best.select("host", "path", "best.r.rule", "best.r.action")


def judge(pages: DataFrame, rules: DataFrame, labelled: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict and the model's ``score``."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    urls = rows.select("host", "path").distinct()
    known = scores(urls, train(labelled)).join(fitting_rules(urls, rules), ["host", "path"], "left")
    return rows.join(known, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("action", F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow")).alias("verdict"), "score")


def sql() -> str:
    """The registered query as SQL: rules compared directly, the same descent as a recursive table of weight lists."""
    def host_path(source: str, columns: str) -> str:
        rest = "coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, '')"
        return (f"SELECT {columns}, {low(f'''regexp_extract({rest}, '^([^/?#]*)', 1)''')} AS host, "
                f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) AS path FROM {source}")

    def grams(source: str, keys: str) -> str:
        parts = " UNION ALL ".join(
            f"SELECT {keys}, '{kind}' || substr(m, CAST(spot AS BIGINT), {n}) AS g FROM (SELECT {keys}, m, unnest(range(1, length(m) - {n} + 2)) AS spot "
            f"FROM (SELECT {keys}, '^' || regexp_replace({part}, '[0-9]', '0', 'g') || '$' AS m FROM {source}))"
            for kind, part in (("h", "host"), ("p", "path")) for n in GRAMS)
        return f"SELECT DISTINCT {keys}, {crc32('g')} % {BUCKETS} AS b FROM (SELECT DISTINCT {keys}, 'h' || host AS g FROM {source} UNION {parts}), crc"

    labelled = ", ".join(str(r) for r in labelled_rows())
    rules = ", ".join(str(r) for r in RULES)
    return f"""
WITH RECURSIVE {CRC_TABLE},
l AS (SELECT row_number() OVER (ORDER BY url) AS i, url, y FROM (VALUES {labelled}) AS v(url, y)),
lh AS ({host_path('l', 'i, CAST(y AS DOUBLE) AS y')}),
lx AS ({grams('lh', 'i, y, host, path')}),
k AS (SELECT b, row_number() OVER (ORDER BY b) AS k FROM (SELECT DISTINCT b FROM lx)),
u AS (SELECT list(struct_pack(y := y, ks := ks) ORDER BY i) AS u FROM (SELECT i, y, list(k ORDER BY k) AS ks FROM lx JOIN k USING (b) GROUP BY i, y)),
f AS (SELECT list(has ORDER BY k) AS f FROM (SELECT k, list(i ORDER BY i) AS has FROM lx JOIN k USING (b) GROUP BY k)),
w AS (SELECT 0 AS t, list_transform(f, lambda p: 0.0::DOUBLE) AS w FROM f
      UNION ALL
      SELECT t + 1, list_transform(f, lambda p, j: w[j] * {1 - RATE * DECAY} - {RATE} / len(u) * list_sum(list_transform(p, lambda i: r[i])))
      FROM (SELECT t, w, f, u, list_transform(u, lambda e: (1 / (1 + exp(-(list_sum(list_transform(e.ks, lambda j: w[j])) / sqrt(len(e.ks))))) - e.y) / sqrt(len(e.ks))) AS r
            FROM w, f, u WHERE t < {ROUNDS})),
m AS (SELECT b, w[k] AS w FROM k, w WHERE t = {ROUNDS}),
p AS ({host_path('pages', 'page_id')}),
h AS (SELECT DISTINCT host, path FROM p),
hx AS ({grams('h', 'host, path')}),
s AS (SELECT host, path, 1 / (1 + exp(-(coalesce(sum(w), 0) / sqrt(count(*))))) AS score FROM hx LEFT JOIN m USING (b) GROUP BY host, path),
r AS (SELECT rule, action, {low("CASE WHEN instr(rule, '/') > 0 THEN substr(rule, 1, instr(rule, '/') - 1) ELSE rule END")} AS rh,
             CASE WHEN instr(rule, '/') > 0 THEN substr(rule, instr(rule, '/')) ELSE '' END AS rp FROM (VALUES {rules}) AS v(rule, action)),
x AS (SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(action, length(rule)) AS action
      FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN score >= {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN s USING (host, path) LEFT JOIN x USING (host, path)
"""
