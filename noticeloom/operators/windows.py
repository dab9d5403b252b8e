"""Which windows of long or many strings may equal one of many needles, by hashes of bytes.

All windows of a length get a rolling hash from one running sum over the bytes of a slice of
rows. A bitmap of bounded size tells which hashes needles have: of their whole length, and
of their longest beginning whose length is a power of two, so that a place is tested once per
power and again per length only where a beginning fits. The bitmap lets some other windows
through; callers join what comes out with the needles, which keeps the result exact. The
work is linear in the bytes read and in what comes out, however many needles there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap: so many per needle, and at most.
BITS_PER_NEEDLE, MOST_BITS = 64, 1 << 27
#: Bytes of rows that are hashed at a time; a longer row is read alone.
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_BEGINNING = np.uint64(0xD1B54A32D192ED03)
_U = np.uint64


@dataclass(frozen=True)
class Needles:
    """Lengths of the needles in bytes, by power of two, and the bitmap of their hashes."""

    lengths: dict[int, list[int]]
    bitmap: np.ndarray


def _powers(base: int, most: int) -> np.ndarray:
    """Powers 0 to ``most`` modulo ``2 ** 64``."""
    factors = np.full(most + 1, base, _U)
    factors[0] = 1
    return np.cumprod(factors, dtype=_U)


class _Sums:
    """Hashes of windows of a slice of rows: ``values`` are its bytes, ``starts`` the first byte of each row and the end."""

    def __init__(self, values: np.ndarray, starts: np.ndarray):
        self.values, self.starts = values, starts
        self.back = _powers(_BACK, len(values))
        self.sums = np.append(_U(0), np.cumsum((values.astype(_U) + _U(1)) * _powers(_BASE, len(values))[:-1], dtype=_U))

    def of(self, at: np.ndarray, length, salt: np.uint64 = _U(0)) -> np.ndarray:
        h = (self.sums[at + length] - self.sums[at]) * self.back[at] + np.asarray(length).astype(_U) * _U(0xA0761D6478BD642F) + salt
        h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
        return h ^ (h >> _U(32))


def _slices(strings: pa.Array) -> Iterator[tuple[int, _Sums]]:
    """The strings in ranges of about ``SLICE_BYTES``, each with the number of its first one."""
    strings = strings.fill_null("").cast(pa.large_binary())
    if not len(strings):
        return
    _, ends, data = strings.buffers()
    ends = np.frombuffer(ends, np.int64)[strings.offset:strings.offset + len(strings) + 1]
    values = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(strings):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1)
        yield first, _Sums(values[ends[first]:ends[last]], ends[first:last + 1] - ends[first])
        first = last


def _bits(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    return (hashes & _U(size - 1)).astype(np.int64), (hashes >> _U(32) & _U(size - 1)).astype(np.int64)


def _known(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    a, b = _bits(hashes, 8 * len(bitmap))
    return (bitmap[a >> 3] >> (a & 7).astype(np.uint8) & bitmap[b >> 3] >> (b & 7).astype(np.uint8) & 1).astype(bool)


def needles(strings: DataFrame) -> Needles:
    """Of the one column of ``strings``, which are distinct and not empty."""
    column = strings.columns[0]
    counts = {r["n"]: r["count"] for r in strings.groupBy(F.octet_length(column).cast("long").alias("n")).count().collect()}
    lengths: dict[int, list[int]] = {}
    for n in sorted(counts):
        lengths.setdefault(n.bit_length() - 1, []).append(n)
    size = 1 << 16
    while size < min(BITS_PER_NEEDLE * sum(counts.values()), MOST_BITS):
        size *= 2

    def run(batches):
        bitmap = np.zeros(size // 8, np.uint8)
        for batch in batches:
            for _, sums in _slices(batch.column(0)):
                at, length = sums.starts[:-1], np.diff(sums.starts)
                at, length = at[length > 0], length[length > 0]
                for hashes in (sums.of(at, length), sums.of(at, 1 << np.floor(np.log2(length)).astype(np.int64), _BEGINNING)):
                    for bit in _bits(hashes, size):
                        np.bitwise_or.at(bitmap, bit >> 3, (1 << (bit & 7)).astype(np.uint8))
        words = bitmap.view(np.int64)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(words[used], pa.int64())], names=["word", "bits"])

    found = strings.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(size // 64, np.int64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return Needles(lengths, words.view(np.uint8))


def _places(sums: _Sums, wanted: Needles) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, places) of the windows of whole characters that may be needles, in order of place."""
    rows = np.repeat(np.arange(len(sums.starts) - 1), np.diff(sums.starts))
    ends = sums.starts[1:][rows]
    border = np.append(sums.values & 0xC0 != 0x80, True)
    heads = np.flatnonzero(border[:-1])
    for power, lengths in wanted.lengths.items():
        at = heads[heads + (1 << power) <= ends[heads]]
        at = at[_known(wanted.bitmap, sums.of(at, 1 << power, _BEGINNING))]
        for length in lengths:
            here = at[at + length <= ends[at]]
            here = here[border[here + length]]
            here = here[_known(wanted.bitmap, sums.of(here, length))]
            if len(here):
                yield length, rows[here], here


def _least_places(sums: _Sums, found) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of the places of one length, those of a row whose first eight bytes are least; where these are all, the first of them."""
    padded = np.append(sums.values, np.zeros(8, np.uint8)).astype(_U)
    begins = np.zeros(len(sums.values), _U)
    for i in range(8):
        begins = begins << _U(8) | padded[i:i + len(begins)]
    for length, rows, at in found:
        key = begins[at] >> _U(8 * max(0, 8 - length))
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        least = np.repeat(np.minimum.reduceat(key, first), np.diff(np.append(first, len(rows))))
        keep = key == least
        rows, at = rows[keep], at[keep]
        if length <= 8:
            first = np.append(True, rows[1:] != rows[:-1])
            rows, at = rows[first], at[first]
        yield length, rows, at


def candidates(strings: DataFrame, wanted: Needles, least: bool = False) -> DataFrame:
    """(``_key``, ``_found``) of strings (``_key``, ``_text``): the different windows that may be needles, or the least of them alone."""
    def run(batches):
        for batch in batches:
            keys = batch.column("_key")
            for first, sums in _slices(batch.column("_text")):
                raw, mine = sums.values.tobytes(), {}
                places = _places(sums, wanted)
                for length, rows, at in _least_places(sums, places) if least else places:
                    for row, i in zip(rows.tolist(), at.tolist()):
                        mine.setdefault(row, set()).add(raw[i:i + length])
                pairs = [(first + row, w) for row, found in mine.items() for w in ((min(found),) if least else found)]
                if pairs:
                    numbers, windows = zip(*pairs)
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(numbers)), pa.array(windows, pa.binary()).cast(pa.string())], names=["_key", "_found"])

    return strings.select("_key", "_text").mapInArrow(run, "_key string, _found string")
