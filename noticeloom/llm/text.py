"""Words and word hashes of whole texts, as numpy arrays over Arrow batches.

Two word rules are used. ``SPACED`` words are runs of bytes other than ASCII white
space; ``ALNUM`` words are runs of ASCII digits, letters and non-ASCII bytes. Both
lower-case ``A-Z`` only. All separators are ASCII, so a rule on bytes equals the rule
on characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACED, ALNUM = "spaced", "alnum"
#: Bytes handled at once; a longer text forms a chunk of its own.
CHUNK_BYTES = 1 << 18
_STEP = 1 << 16


def _splitmix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit number over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


mix = _splitmix


def _tables():
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    value = _splitmix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    is_word = {}
    spaced = np.ones(256, bool)
    spaced[[32, 9, 10, 11, 12, 13]] = False
    alnum = np.zeros(256, bool)
    alnum[48:58] = alnum[97:123] = alnum[128:] = True
    is_word[SPACED], is_word[ALNUM] = spaced, alnum
    with np.errstate(over="ignore"):
        power = np.full(_STEP, np.uint64(0x9E3779B97F4A7C15 | 1))
        power[0] = 1
        power = np.multiply.accumulate(power)
    return low, value, is_word, power


_LOW, _VALUE, _IS_WORD, _POWER = _tables()
_FAR = _splitmix(np.arange(1, 1 + 4096, dtype=np.uint64)) | np.uint64(1)
_VALUES = {rule: np.where(_IS_WORD[rule], _VALUE, np.uint64(0)) for rule in (SPACED, ALNUM)}


class Words:
    """The words of several texts: ``hashes``, byte ranges ``starts``/``ends`` in ``low``,
    and ``bounds``, so that text ``i`` has the words ``bounds[i]:bounds[i + 1]``."""

    def __init__(self, blobs: list[bytes], rule: str):
        raw = np.frombuffer(b" ".join(blobs) + b" ", np.uint8)
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) + 1
        ends_of_text = np.cumsum(sizes)
        self.low = _LOW[raw]
        inside = _IS_WORD[rule][self.low]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.bounds = np.concatenate(([0], np.searchsorted(self.starts, ends_of_text)))
        self.text_starts = ends_of_text - sizes
        if len(self.starts):
            first = self.starts[0]
            at = np.arange(first, len(raw)) - np.repeat(self.starts, np.diff(np.append(self.starts, len(raw))))
            longest = int((self.ends - self.starts).max())
            v = _VALUES[rule][self.low[first:]] * _POWER[at & (_STEP - 1) if longest >= _STEP else np.minimum(at, _STEP - 1)]
            if longest >= _STEP:
                v *= _FAR[(at >> 16) % len(_FAR)]
            h = np.add.reduceat(v, self.starts - first)
            self.hashes = _splitmix(h + (self.ends - self.starts).astype(np.uint64))
        else:
            self.hashes = np.zeros(0, np.uint64)

    def word(self, i: int) -> bytes:
        return self.low[self.starts[i]:self.ends[i]].tobytes()


def blobs_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as the empty text."""
    return [b or b"" for b in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that Python objects and results of a few rows exist at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def chunks(blobs: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together; a longer text stands alone."""
    begin = size = 0
    for i, b in enumerate(blobs):
        if i > begin and size + len(b) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(b)
    if begin < len(blobs):
        yield begin, len(blobs)


def each_words(blobs: list[bytes], rule: str) -> Iterator[tuple[int, int, Words]]:
    for a, b in chunks(blobs):
        yield a, b, Words(blobs[a:b], rule)


def combine(hashes: np.ndarray, width: int) -> np.ndarray:
    """Order-sensitive 64-bit hashes of all runs of ``width`` consecutive word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, width):
        out = _splitmix(out + np.uint64(0x9E3779B97F4A7C15)) ^ hashes[j:j + n]
    return _splitmix(out)
