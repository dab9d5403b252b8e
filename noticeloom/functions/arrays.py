"""Small helpers on array columns, used to keep text work inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_CELL, _HEAD, _TAIL = "\x01", "\x02", "\x03"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def match_all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def group(match: Column, pattern: str, index: int) -> Column:
    return F.regexp_extract(match, pattern, index)


def carry_forward(values: Column) -> Column:
    """Fill empty strings of an array with the last non-empty one before them, in linear time."""
    marked = F.transform(values, lambda v: F.concat(F.when(v != "", F.concat(F.lit(_HEAD), v)).otherwise(""), F.lit(_CELL)))
    runs = F.split(F.array_join(marked, ""), _HEAD)

    def expand(run):
        head = F.substring_index(run, _CELL, 1)
        return F.array_repeat(head, F.length(run) - F.length(head))

    return F.flatten(F.transform(runs, expand))


def at(array: Column, index) -> Column:
    """Element by 0-based index, null beyond the ends."""
    return F.get(array, index if isinstance(index, Column) else F.lit(index))


def first(array: Column, default: str = "") -> Column:
    return F.coalesce(at(array, 0), F.lit(default))


def last(array: Column, default: str = "") -> Column:
    return F.coalesce(at(F.reverse(array), 0), F.lit(default))


def scan(text: Column, pattern: str, groups: int) -> Column:
    """Every match with its groups, the text in front of it and the text up to the next one.

    Array of (gap, match, tail, g). The text is marked up in one regex pass and then
    taken apart at the marks, so a match costs one evaluation however many groups it
    has. The text must not hold the mark characters; ``printable`` drops them.
    """
    fields = "".join(f"${i}{_CELL}" for i in range(1, groups + 1))
    marked = F.regexp_replace(text, pattern, f"{_HEAD}{fields}$0{_TAIL}")

    def parts(pieces):
        def one(piece, i):
            head = F.split(F.substring_index(piece, _TAIL, 1), _CELL)
            before = at(pieces, i)
            return F.struct(
                F.when(i == 0, before).otherwise(F.substring_index(before, _TAIL, -1)).alias("gap"),
                at(head, groups).alias("match"), F.substring_index(piece, _TAIL, -1).alias("tail"), head.alias("g"))
        return F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 1), one)

    return let(F.split(marked, _HEAD), parts)


def g(found: Column, index: int) -> Column:
    """Group of a scanned match, ``''`` when it took no part."""
    return at(found["g"], index - 1)


def printable(text: Column) -> Column:
    """Drop NUL and the mark characters."""
    return F.translate(text, "\x00" + _CELL + _HEAD + _TAIL, "")
