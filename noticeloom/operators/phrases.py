"""Which strings of a table hold which phrases, or are held by them.

Phrases of at most about ``BLOCK_CHARS`` characters make up one block, the usual case: an
automaton of the block reads a string once and finds all phrases inside it, and for the other
direction an automaton of a few strings at a time reads the phrases. Strings are read
where they stand; a task and the driver hold the block. More phrases stay a table: windows
of the strings that may be phrases (``windows``) are joined with it, and windows of the
phrases with the strings, so that the work grows with the two tables and not their product.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from noticeloom.operators import windows
from noticeloom.session import cut_lineage

BLOCK_CHARS = 1 << 20
#: Characters and rows of strings that one automaton of strings is built from.
SLICE_CHARS, SLICE_ROWS = 1 << 19, 5_000


def automaton(words: dict[str, object]):
    """Automaton that reports the values of all words it reads; none without words."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for word, value in words.items():
        out.add_word(word, value)
    if words:
        out.make_automaton()
    return out if words else None


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``SLICE_ROWS`` strings and about ``SLICE_CHARS`` characters."""
    begin = chars = 0
    for i, t in enumerate(texts):
        if i > begin and (i - begin >= SLICE_ROWS or chars + len(t) > SLICE_CHARS):
            yield begin, i
            begin = i
            chars = 0
        chars += len(t)
    if begin < len(texts):
        yield begin, len(texts)


class Block:
    """Sorted phrases; ``matches`` gives the phrases that each string equals, holds or is held by."""

    def __init__(self, phrases: list[str]):
        self.phrases = sorted(set(phrases) - {""})
        self.longest = max(map(len, self.phrases), default=0)
        self.inside = automaton({p: i for i, p in enumerate(self.phrases)})

    def matches(self, texts: list[str | None], least: bool = False) -> Iterator[tuple[int, int, list[list[int]]]]:
        """Numbers of matching phrases in order, or the least one alone, for ranges of strings; null and empty strings match nothing."""
        texts = [t or "" for t in texts]
        for a, b in slices(texts):
            found: list = [None] * (b - a) if least else [set() for _ in range(a, b)]
            if self.inside:
                for k, t in enumerate(texts[a:b]):
                    hits = (i for _, i in self.inside.iter(t))
                    if least:
                        found[k] = min(hits, default=None)
                    else:
                        found[k].update(hits)
            places: dict[str, list[int]] = {}
            for k, t in enumerate(texts[a:b]):
                if 0 < len(t) <= self.longest:
                    places.setdefault(t, []).append(k)
            if around := automaton(places):
                for i, phrase in enumerate(self.phrases):
                    for _, at in around.iter(phrase):
                        for k in at:
                            if not least:
                                found[k].add(i)
                            elif found[k] is None or i < found[k]:
                                found[k] = i
            yield a, b, [[] if f is None else [f] for f in found] if least else [sorted(f) for f in found]


@dataclass(frozen=True)
class Blocks:
    """Distinct phrases: all of them where they make up one block, else a table of them; ``many`` is how many blocks they would fill."""

    many: int
    only: list[str]
    table: DataFrame


def blocks(phrases: DataFrame) -> Blocks:
    wanted = phrases.toDF("phrase").where("phrase <> ''").distinct()
    chars = wanted.agg(F.sum(F.length("phrase") + 1).alias("n")).first()["n"] or 0
    many = max(1, -(-chars // BLOCK_CHARS))
    return Blocks(many, [r["phrase"] for r in wanted.collect()] if many == 1 else [], wanted if many == 1 else cut_lineage(wanted, "phrases"))


def _read(rows: DataFrame, text: str, block: list[str], name: str, kind: DataType, value: Callable[[Block, list[int]], object]) -> DataFrame:
    """``rows`` with a column made of the phrases of one block that each string matches."""
    names = rows.columns

    def run(batches):
        own = Block(block)
        for batch in batches:
            for a, b, found in own.matches(batch.column(text).to_pylist(), least=value is _least):
                made = pa.array([value(own, hits) if hits else None for hits in found], pa.list_(pa.string()) if isinstance(kind, ArrayType) else pa.string())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in names), made], names=[*names, name])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(name, kind)]))


def _least(block: Block, hits: list[int]) -> str:
    return block.phrases[hits[0]]


def _all(block: Block, hits: list[int]) -> list[str]:
    return [block.phrases[i] for i in hits]


def with_least(rows: DataFrame, text: str, phrases: Blocks, name: str, tasks: int = 0) -> DataFrame:
    """``rows`` with the least phrase that equals, holds or is held by the string ``text``; null where none does.

    With ``tasks``, strings are spread over so many to be read.
    """
    spread = lambda df: df.repartition(tasks) if tasks else df
    if phrases.many == 1:
        return _read(spread(rows), text, phrases.only, name, StringType(), _least)
    texts = rows.select(F.md5(text).alias("_key"), F.col(text).alias("_text")).where("_text <> ''")
    found = _least_inside(spread(texts), phrases.table).unionByName(_around(texts, phrases.table))
    best = found.groupBy("_key").agg(F.min("_found").alias(name))
    return rows.withColumn("_key", F.md5(text)).join(best, "_key", "left").drop("_key")


def all_matches(texts: DataFrame, phrases: Blocks) -> DataFrame:
    """(``_text``, ``_found``): every distinct matching string with all its phrases in order."""
    if phrases.many == 1:
        return _read(_strings(texts), "_text", phrases.only, "_found", ArrayType(StringType()), _all).where("_found IS NOT NULL")
    strings = cut_lineage(_strings(texts).withColumn("_key", F.md5("_text")), "strings")
    inside = _phrases_only(windows.candidates(strings, windows.needles(phrases.table)), phrases.table)
    found = inside.unionByName(_around(strings, phrases.table))
    lists = found.groupBy("_key").agg(F.array_sort(F.collect_set("_found")).alias("_found"))
    return strings.join(lists, "_key").select("_text", "_found")


def _strings(texts: DataFrame) -> DataFrame:
    return texts.toDF("_text").where("_text <> ''").distinct()


def _phrases_only(found: DataFrame, table: DataFrame) -> DataFrame:
    return found.join(table.toDF("_found"), "_found", "left_semi").select("_key", "_found")


def _least_inside(texts: DataFrame, table: DataFrame) -> DataFrame:
    """(``_key``, ``_found``) of texts (``_key``, ``_text``) that hold phrases: the least, or more with it.

    The least window that may be a phrase nearly always is one. Texts where it is not are
    read once more, with all their windows.
    """
    wanted = windows.needles(table)
    first = cut_lineage(windows.candidates(texts, wanted, least=True).groupBy("_key").agg(F.min("_found").alias("_found")), "windows")
    real = _phrases_only(first, table)
    missed = cut_lineage(first.join(table.toDF("_found"), "_found", "left_anti").select("_key"), "missed")
    if missed.isEmpty():
        return real
    return real.unionByName(_phrases_only(windows.candidates(texts.join(missed, "_key", "left_semi"), wanted), table))


def _around(texts: DataFrame, table: DataFrame) -> DataFrame:
    """(``_key``, ``_found``) of texts (``_key``, ``_text``) inside phrases, with each of these."""
    longest = table.agg(F.max(F.octet_length("phrase")).alias("n")).first()["n"]
    short = cut_lineage(texts.where(F.octet_length("_text") < longest).select("_text").distinct(), "short-strings")
    held = windows.candidates(table.select(F.col("phrase").alias("_key"), F.col("phrase").alias("_text")), windows.needles(short))
    return held.join(short.toDF("_found"), "_found", "left_semi").select(F.md5("_found").alias("_key"), F.col("_key").alias("_found"))
