"""Merkle manifest of a dataset, with proofs made by pointer jumping.

A leaf is the digest of a row's fields. Per source, leaves are ordered by id and every
``FANOUT`` consecutive nodes become the digest of their concatenated digests, until one
is left: the source's subroot. The subroots, ordered by source, make the root the same way.

The path of a node is the list of its steps up: the digests to the left and to the right
of it in its run. Every node starts with a pointer to its parent and the one step that
leads there. Then pointers jump: a node joins the node it points to, takes over that
node's pointer and appends its steps, so the distance doubles with every self-join until
all pointers end at the root. The leaves of one run share the pointer of the node above
them, so they travel as one row and are told apart only at the end; a sixteenth of the
leaves is what is joined, and no step of a leaf's own run is ever shuffled.

Sizes: places of leaves come from a range sort (``ranks.numbered``), runs are groups of at
most ``FANOUT`` rows, so a source that holds a third of all rows spreads like any other.
The driver holds the root and a few counts. Every level and every round of jumps is
written to shared storage. The number of rounds is the logarithm of the tree's height.

Edge cases: fields that are null, empty or very long are encoded apart from each other
(``-`` against a byte count and the value); a null source is a source of its own and comes
first; null ids come first in their source; rows of one id and source are ordered by leaf
digest, and equal rows are interchangeable; a source of one leaf has that leaf as subroot,
and a table of one source has its subroot as root; an empty table has no rows and a null
root. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.ranks import numbered
from noticeloom.llm.sqltext import CRC_TABLE, LOWER, UPPER, crc32, low
from noticeloom.operators.staging import hold
from noticeloom.session import cut_lineage

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Tree number of the tree over the subroots.
TOP = -1
_PATH = "array<struct<left:string,right:string>>"


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def step(members: Column, i: Column) -> Column:
    """Digests to the left and right of the ``i``-th (from 0) of a run."""
    digests = members["digest"]
    return F.struct(joined(F.slice(digests, 1, i)).alias("left"), joined(F.slice(digests, i + 2, FANOUT)).alias("right"))


def fold(leaf: Column, path: Column) -> Column:
    """Root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def path_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(joined(F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)


def next_level(nodes: DataFrame, level: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """The runs of (tree, place, of, digest): (tree, level, place, of, digest, members)."""
    runs = nodes.groupBy("tree", F.expr(f"place div {FANOUT}").alias("place"), F.expr(f"(of + {FANOUT - 1}) div {FANOUT}").alias("of")) \
        .agg(F.array_sort(F.collect_list(F.struct(F.col("place"), "digest", *carried))).alias("members"))
    return runs.select("tree", F.lit(level).alias("level"), "place", "of", F.sha2(joined(F.col("members.digest")), 256).alias("digest"), "members")


def steps_up(runs: DataFrame) -> DataFrame:
    """Pointers from the members of runs inside one tree to the run's node."""
    one = runs.select("tree", "level", "place", "members", F.posexplode("members").alias("i", "m"))
    return one.select("tree", (F.col("level") - 1).alias("level"), F.col("m.place").alias("place"), F.col("tree").alias("up_tree"), F.col("level").alias("up_level"),
                      F.col("place").alias("up_place"), F.array(step(F.col("members"), F.col("i"))).alias("path"))


def higher(nodes: DataFrame, level: int, count: int, purpose: str, carried: tuple[str, ...] = ()) -> list[DataFrame]:
    """All levels above nodes of trees of at most ``count`` nodes, written."""
    levels = []
    while count > 1:
        level += 1
        levels.append(cut_lineage(next_level(nodes.where("of > 1"), level, carried if not levels else ()), purpose))
        nodes, count = levels[-1], -(-count // FANOUT)
    return levels


def jump(pointers: DataFrame) -> DataFrame:
    """Every pointer takes over the pointer it points to."""
    far = pointers.select(F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("place").alias("up_place"),
                          F.col("up_tree").alias("t"), F.col("up_level").alias("l"), F.col("up_place").alias("p"), F.col("path").alias("rest"))
    return pointers.join(far, ["up_tree", "up_level", "up_place"]).select(
        "tree", "level", "place", F.col("t").alias("up_tree"), F.col("l").alias("up_level"), F.col("p").alias("up_place"), F.concat("path", "rest").alias("path"))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source", arrived: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, arrived_leaf, subroot, root, path.

    ``arrived`` gives columns as they arrived; ``arrived_leaf`` is the digest of the row
    with these, to be folded along the path of the original leaf.
    """
    arrived = arrived or {}
    changed = reduce(lambda a, b: a | b, [~new.eqNullSafe(F.col(c)) for c, new in arrived.items()], F.lit(False))
    leaves = cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), digest_of([F.col(c) for c in fields]).alias("leaf"),
        F.when(changed, digest_of([arrived.get(c, F.col(c)) for c in fields])).alias("arrived")), "leaves")
    placed = numbered(leaves, ["source"], [F.col("doc_id"), F.col("leaf")], "leaf-places")
    runs = placed.groupBy("source", F.expr(f"place div {FANOUT}").alias("place"), "of").agg(
        F.array_sort(F.collect_list(F.struct("place", F.col("leaf").alias("digest"), "doc_id", "arrived"))).alias("members"))
    alone = F.col("of") == 1
    runs = cut_lineage(runs.select("source", F.when(alone, 0).otherwise(1).alias("level"), "place", F.expr(f"(of + {FANOUT - 1}) div {FANOUT}").alias("of"),
                                   F.when(alone, F.col("members.digest")[0]).otherwise(F.sha2(joined(F.col("members.digest")), 256)).alias("digest"), "members"), "runs")
    sources = cut_lineage(numbered(runs.where("place = 0").select("source"), [], [F.col("source")], "source-places")
                          .select(F.col("source").alias("named"), F.col("place").alias("tree"), F.col("of").alias("trees")), "sources")
    base = cut_lineage(runs.join(sources, F.col("source").eqNullSafe(F.col("named"))).drop("source", "named"), "base")

    longest, trees = base.agg(F.max("of"), F.max("trees")).first()
    if longest is None:
        empty = F.lit(None).cast("string")
        return leaves.select("doc_id", "leaf", F.coalesce("arrived", "leaf").alias("arrived_leaf"), empty.alias("subroot"), empty.alias("root"), F.lit(None).cast(_PATH).alias("path"))
    inner = higher(base.select("tree", "place", "of", "digest"), 1, longest, "levels")
    roots = base.where("of = 1").select("tree", "level", "digest")
    for nodes in inner:
        roots = roots.unionByName(nodes.where("of = 1").select("tree", "level", "digest"))
    roots = cut_lineage(roots, "subroots")
    top = higher(roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(trees).alias("of"), "digest", "level"), 0, trees, "top", ("level",))

    at = F.col("tree"), F.col("level"), F.lit(0).cast("long")
    if top:
        last = top[-1].select("tree", "level", "place", "digest")
        first = top[0].select("tree", "level", "place", "members", F.posexplode("members").alias("i", "m"))
        pointers = first.select(F.col("m.place").alias("tree"), F.col("m.level").alias("level"), F.lit(0).cast("long").alias("place"), F.col("tree").alias("up_tree"),
                                F.col("level").alias("up_level"), F.col("place").alias("up_place"), F.array(step(F.col("members"), F.col("i"))).alias("path"))
    else:
        last = roots.select(at[0], at[1], at[2].alias("place"), "digest")
        pointers = None
    root = last.first()["digest"]
    ends = last.select("tree", "level", "place", F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("place").alias("up_place"), F.array().cast(_PATH).alias("path"))
    pointers = ends if pointers is None else pointers.unionByName(ends)
    for nodes in [*inner, *top[1:]]:
        pointers = pointers.unionByName(steps_up(nodes))
    pointers = cut_lineage(pointers, "pointers")
    reach, height = 1, len(inner) + len(top)
    while reach < height:
        pointers, reach = cut_lineage(jump(pointers), "pointers"), reach * 2

    above = pointers.select("tree", "level", "place", F.col("path").alias("rest"))
    whole = base.drop("digest").join(above, ["tree", "level", "place"]).join(roots.select("tree", F.col("digest").alias("subroot")), "tree")
    each = whole.select("subroot", "level", "rest", "members", F.posexplode("members").alias("i", "m"))
    path = F.when(F.col("level") == 0, F.col("rest")).otherwise(F.concat(F.array(step(F.col("members"), F.col("i"))), F.col("rest")))
    return hold(each.select("subroot", "m", path.alias("path")), path=F.col("path")).select(
        F.col("m.doc_id").alias("doc_id"), F.col("m.digest").alias("leaf"), F.coalesce("m.arrived", "m.digest").alias("arrived_leaf"), "subroot", F.lit(root).alias("root"), "path")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; documents whose id's
    checksum is divisible by 5 arrive with their text in lower case (A-Z)."""
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    rows = manifest(docs, arrived={"text": altered})
    folded = rows.select("doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"), fold(F.col("arrived_leaf"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def sql(inner: int = 5, outer: int = 4) -> str:
    """The registered query as SQL for up to FANOUT ** inner leaves a source and FANOUT ** outer sources."""
    def field(x: str) -> str:
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || {x} END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(f) for f in (*FIELDS[:-1], text)) + ")"

    def levels(name: str, key: str, count: int) -> str:
        out = []
        for k in range(1, count + 1):
            out.append(f"{name}{k} AS (SELECT {key}p // {FANOUT} AS p, (c + {FANOUT - 1}) // {FANOUT} AS c, sha256(string_agg(dig, '' ORDER BY p)) AS dig "
                       f"FROM {name}{k - 1} WHERE c > 1 GROUP BY {key}p // {FANOUT}, c)")
            run = f"PARTITION BY {key}p // {FANOUT} ORDER BY p ROWS BETWEEN"
            out.append(f"{name}s{k - 1} AS (SELECT {key}p, coalesce(string_agg(dig, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                       f"coalesce(string_agg(dig, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k - 1} WHERE c > 1)")
        return ", ".join(out)

    climbed, done = [], "y"
    for name, count, place, same in (("n", inner, "np", "s.source IS NOT DISTINCT FROM y.source AND "), ("t", outer, "tp", "")):
        for k in range(count):
            climbed.append(f"{name}y{k} AS (SELECT y.* REPLACE (CASE WHEN s.l IS NULL THEN f ELSE sha256(s.l || f || s.r) END AS f, proof || coalesce(s.l || s.r, '') AS proof) "
                           f"FROM {done} y LEFT JOIN {name}s{k} s ON {same}s.p = {place} // {FANOUT ** k})")
            done = f"{name}y{k}"
    crc = crc32("CAST(doc_id AS VARCHAR)")
    return f"""
WITH {CRC_TABLE},
d AS (SELECT *, CASE WHEN {crc} % 5 = 0 THEN {low('text')} ELSE text END AS arrived FROM documents, crc),
e AS (SELECT doc_id, source, {leaf('text')} AS dig, {leaf('arrived')} AS cur FROM d),
n0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, dig) - 1 AS p, count(*) OVER (PARTITION BY source) AS c FROM e),
{levels('n', 'source, ', inner)},
sub AS ({" UNION ALL ".join(f"SELECT source, dig FROM n{k} WHERE c = 1" for k in range(inner + 1))}),
t0 AS (SELECT source, dig, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS p, count(*) OVER () AS c FROM sub),
{levels('t', '', outer)},
root AS ({" UNION ALL ".join(f"SELECT dig FROM t{k} WHERE c = 1" for k in range(outer + 1))}),
y AS (SELECT n0.doc_id, n0.source, n0.dig AS leaf, t0.dig AS subroot, root.dig AS root, n0.p AS np, t0.p AS tp, cur AS f, '' AS proof
      FROM n0 JOIN t0 ON t0.source IS NOT DISTINCT FROM n0.source, root),
{", ".join(climbed)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM {done}
"""
