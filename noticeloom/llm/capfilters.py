"""Embedding near-dedup with spherical-cap filters from random product codes.

A filter is a direction; a vector passes it when their cosine exceeds ``least_cosine``, which
is derived from the dimension and the threshold: two vectors at the threshold share ``SHARED``
filters on average. Directions come from product codes: a random rotation, the coordinates cut into two
blocks, a random codebook for each, all combinations of two codewords. List decoding
finds all passed filters of a vector from its inner products with the codewords alone; a vector
that passes fewer than ``FEWEST`` goes to its best ones too. ``CODES`` independent codes make the
chance to share no filter small (about 0.0015 for a cosine of exactly 0.9 in 64 dimensions).

Vectors of fewer than ``EXACT_BELOW`` dimensions miss no pair: their filters are the cells of a
grid over at most ``AXES`` rotated coordinates. A vector goes to all cells within half the
distance of two vectors at the threshold, so two linked ones meet in the cell of their midpoint.

Equal vectors form a class; its smallest id is filtered, once. Rows meet per filter, with
the members of a filter split into blocks, and cosines are computed in double precision.
A pair that shares several filters counts in the first of them only, so links are
counted per vector inside the tasks, and only spanning edges of a block leave it:
neither candidates nor links are emitted as pairs.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing, nor do rows with a null id (their component is null); vectors of different
lengths are never compared; rows with one id count as one class member each; an
empty table gives an empty result; labels and other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.graph import components, relabel
from noticeloom.llm.text import slices
from noticeloom.session import cut_lineage

THRESHOLD = 0.9
CODES, WORDS = 40, 64
#: Filters that two vectors at the threshold share on average; in 64 dimensions and at 0.9 a cap of 3.4 / sqrt(64).
SHARED, FEWEST = 12.345, 8
EXACT_BELOW, AXES, CELLS = 16, 6, 30
BLOCK = 256


def shared_caps(dim: int, least: float, cosine: float, n: int = 400) -> float:
    """Share of all directions within ``least`` of both of two unit vectors with that cosine."""
    half = np.arccos(cosine) / 2
    along = np.linspace(least / np.cos(half), 1, n)[:, None]  # in the plane of the two: along their midpoint, and across
    top = np.minimum((along * np.cos(half) - least) / np.sin(half), np.sqrt(np.maximum(0, 1 - along ** 2)))
    across = top * np.linspace(0, 1, n)
    density = np.maximum(0, 1 - along ** 2 - across ** 2) ** ((dim - 4) / 2)
    return float((dim - 2) / np.pi * np.trapezoid(np.trapezoid(density, across, axis=1), along[:, 0]))


@lru_cache(maxsize=64)
def least_cosine(dim: int, threshold: float = THRESHOLD) -> float:
    """The cosine at which two vectors at the threshold share ``SHARED`` filters on average."""
    cosine = min(max(threshold, -0.99), 0.9999)
    low, high = 0.0, float(np.cos(np.arccos(cosine) / 2))
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (middle, high) if CODES * WORDS * WORDS * shared_caps(dim, middle, cosine) > SHARED else (low, middle)
    return low


@lru_cache(maxsize=8)
def codes(dim: int) -> tuple:
    """Rotated codebooks, ready to multiply: per code two [dim, WORDS] matrices."""
    out = []
    for k in range(CODES):
        rng = np.random.default_rng([31, dim, k])
        turn, half = np.linalg.qr(rng.normal(size=(dim, dim)))[0], (dim + 1) // 2
        books = []
        for a, b in ((0, half), (half, dim)):
            book = rng.normal(size=(b - a, WORDS))
            book /= np.maximum(np.linalg.norm(book, axis=0), 1e-12) * np.sqrt(2.0)
            books.append(turn[:, a:b] @ book)
        out.append(books)
    return tuple(out)


@lru_cache(maxsize=16)
def axes(dim: int) -> np.ndarray:
    turn = np.linalg.qr(np.random.default_rng([37, dim]).normal(size=(dim, dim)))[0]
    return turn[:, :AXES]


def cells(unit: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of all grid cells that may hold the midpoint of a unit vector and one it links with."""
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) / 2 + 1e-6
    width = max(2 * reach, 2 / CELLS)
    x = unit @ axes(unit.shape[1])
    edge = 1 + reach + 1e-6  # no coordinate goes further
    per_axis = int(2 * edge / width) + 1
    row, cell, far = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x))
    for k in range(x.shape[1]):
        lowest = np.floor((x[row, k] - reach + edge) / width).astype(np.int64)
        count = np.floor((x[row, k] + reach + edge) / width).astype(np.int64) - lowest + 1
        at = np.repeat(np.arange(len(row)), count)
        own = lowest[at] + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        row, left = row[at], own * width - edge
        away = far[at] + np.maximum(0, np.maximum(left - x[row, k], x[row, k] - left - width)) ** 2
        near = away <= reach * reach
        row, cell, far = row[near], cell[at][near] * per_axis + own[near], away[near]
    return row, cell


def decode(unit: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all filters passed by unit vectors."""
    if unit.shape[1] < EXACT_BELOW:
        row, which = cells(unit, threshold)
        order = np.lexsort((which, row))
        return row[order], which[order].astype(np.int32)
    rows, filters, best, top = [], [], [], []
    least = least_cosine(unit.shape[1], threshold)
    for k, (one, two) in enumerate(codes(unit.shape[1])):
        a, b = unit @ one, unit @ two
        near = np.nonzero(a >= least - b.max(1, keepdims=True))  # a codeword that no partner can lift is left out
        row, i = near
        hit, j = np.nonzero(b[row] >= (least - a[row, i])[:, None])
        rows.append(row[hit])
        filters.append(k * WORDS * WORDS + i[hit] * WORDS + j)
        best.append(k * WORDS * WORDS + a.argmax(1) * WORDS + b.argmax(1))
        top.append(a.max(1) + b.max(1))
    row, which = np.concatenate(rows), np.concatenate(filters)
    few = np.flatnonzero(np.bincount(row, minlength=len(unit)) < FEWEST)
    if len(few):
        order = np.argsort(-np.stack(top, 1)[few], axis=1, kind="stable")[:, :FEWEST]
        row = np.concatenate((row, np.repeat(few, FEWEST)))
        which = np.concatenate((which, np.take_along_axis(np.stack(best, 1)[few], order, 1).ravel()))
    row, which = np.unique(np.stack((row, which)), axis=1)
    return row, which.astype(np.int32)


def clean(vectors: list) -> list:
    """float64 arrays, None where a vector links with nothing."""
    out = []
    for v in vectors:
        if v is None or not len(v) or any(x is None for x in v):
            out.append(None)
            continue
        x = np.array(v, np.float64) + 0.0
        size = np.linalg.norm(x)
        out.append(x if np.isfinite(x).all() and np.isfinite(size) and size > 0 else None)
    return out


def classes(rows: DataFrame) -> DataFrame:
    """vec_id, digest (null where the vector links with nothing)."""

    def run(batches):
        for batch in slices(batches):
            found = [None if x is None else blake2b(x.tobytes(), digest_size=16).digest() for x in clean(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["vec_id", "digest"])

    return rows.mapInArrow(run, "vec_id long, digest binary")


def spread(reps: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per passed filter: dim, filter, vec_id, size, vector, all its filters."""
    layout = pa.schema([("dim", pa.int32()), ("filter", pa.int32()), ("vec_id", pa.int64()), ("size", pa.int64()), ("vector", pa.binary()), ("passed", pa.binary())])

    def run(batches):
        for batch in slices(batches):
            ids, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            vectors = clean(batch.column(2).to_pylist())
            for dim in sorted({len(x) for x in vectors}):
                own = [i for i, x in enumerate(vectors) if len(x) == dim]
                for k in range(0, len(own), 64):
                    part = own[k:k + 64]
                    x = np.stack([vectors[i] for i in part])
                    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                    row, which = decode(unit, threshold)
                    cut = np.searchsorted(row, np.arange(len(part) + 1))
                    lists = [which[a:b].tobytes() for a, b in zip(cut, cut[1:])]
                    packed = [v.tobytes() for v in (x.astype(np.float32) if (x.astype(np.float32) == x).all() else x)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), dim), pa.int32()), pa.array(which), pa.array([ids[part[r]] for r in row], pa.int64()),
                         pa.array([sizes[part[r]] for r in row], pa.int64()), pa.array([packed[r] for r in row], pa.binary()), pa.array([lists[r] for r in row], pa.binary())], schema=layout)

    return reps.select("vec_id", "size", "embedding").mapInArrow(run, "dim int, filter int, vec_id long, size long, vector binary, passed binary")


def linked(ids, sizes, second, vectors, passed, which, lone, threshold):
    """Link counts and spanning edges among the members of one or two blocks of a filter."""
    second = np.array(second)
    first = np.arange(len(ids)) if lone else np.flatnonzero(~second)
    other = first if lone else np.flatnonzero(second)
    dim = len(vectors[0])
    unit = np.stack(vectors)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit[first] @ unit[other].T >= threshold
    if lone:
        np.fill_diagonal(near, False)
    if not dim or not near.any():
        return
    # pairs that share an earlier filter were counted there
    p, q = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    lists = [np.frombuffer(passed[i], np.int32) for i in range(len(ids))]
    lists = [x[x < which] for x in lists]
    known = np.unique(np.concatenate(lists))
    if len(known):
        def incidence(members):
            out = np.zeros((len(members), len(known)), np.float32)
            for r, i in enumerate(members):
                out[r, np.searchsorted(known, lists[i])] = 1
            return out
        near[np.ix_(p, q)] &= incidence(first[p]) @ incidence(other[q]).T == 0
    if not near.any():
        return
    ids, sizes = np.array(ids), np.array(sizes)
    count = np.zeros(len(ids), np.int64)
    count[first] += near @ sizes[other]
    if not lone:
        count[other] += near.T @ sizes[first]
    label = ids.copy()
    while True:  # smallest id of each connected part
        far = np.iinfo(np.int64).max
        one = np.where(near, label[other][None, :], far).min(1)
        two = np.where(near, label[first][:, None], far).min(0)
        new = label.copy()
        np.minimum.at(new, first, one)
        np.minimum.at(new, other, two)
        if (new == label).all():
            break
        label = new
    for i in np.flatnonzero(count):
        yield int(ids[i]), int(label[i]), int(count[i])


def meet(spreaded: DataFrame, threshold: float) -> DataFrame:
    """(vec_id, label, n): links of a vector in one filter, and the smallest id it is joined to there."""
    loads = spreaded.groupBy("dim", "filter").agg(F.count("*").alias("_n")).where("_n > 1")
    rows = spreaded.join(loads, ["dim", "filter"])
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    met = rows.withColumn("_own", F.pmod(F.xxhash64("vec_id"), blocks).cast("int")).withColumn("_with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.select("dim", "filter", F.least("_own", "_with").alias("i"), F.greatest("_own", "_with").alias("j"),
                     (F.col("_own") > F.col("_with")).alias("second"), "vec_id", "size", "vector", "passed")

    def run(batches):
        def close(key, held):
            dim, which, i, j = key
            ids, sizes, second, packed, passed = held
            vectors = [np.frombuffer(v, np.float32 if len(v) == 4 * dim else np.float64).astype(np.float64) for v in packed]
            return linked(ids, sizes, second, vectors, passed, which, i == j, threshold)

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], names=["vec_id", "label", "n"])

        key, held = None, ([], [], [], [], [])
        for batch in slices(batches):
            found = []
            for dim, which, i, j, second, vec_id, size, vector, passed in zip(*(c.to_pylist() for c in batch.columns)):
                if (dim, which, i, j) != key:
                    if key and len(held[0]) > 1:
                        found += close(key, held)
                    key, held = (dim, which, i, j), ([], [], [], [], [])
                for into, x in zip(held, (vec_id, size, second, vector, passed)):
                    into.append(x)
            yield batch_of(found)
        if key and len(held[0]) > 1:
            yield batch_of(list(close(key, held)))

    return met.repartition("dim", "filter", "i", "j").sortWithinPartitions("dim", "filter", "i", "j").mapInArrow(run, "vec_id long, label long, n long")


def report(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    known = cut_lineage(classes(rows), "cap-classes")
    groups = cut_lineage(known.where("digest is not null and vec_id is not null").groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")), "cap-groups")
    reps = rows.join(groups.select(F.col("rep").alias("vec_id"), "size"), "vec_id").dropDuplicates(["vec_id"])
    spreaded = cut_lineage(spread(reps, threshold), "cap-filters")
    met = cut_lineage(meet(spreaded, threshold), "cap-links")
    labels = components(met.select(F.col("vec_id").alias("a"), F.col("label").alias("b")))
    counts = met.groupBy(F.col("vec_id").alias("rep")).agg(F.sum("n").alias("_n"))
    own = known.join(groups, "digest", "left").join(counts, "rep", "left").withColumn("_root", F.coalesce("rep", "vec_id"))
    linking = F.col("rep").isNotNull() & F.col("vec_id").isNotNull()
    return relabel(own, "_root", labels).select(
        "vec_id", F.when(linking, F.coalesce("_n", F.lit(0)) + F.col("size") - 1).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.when(linking, F.col("_root")).otherwise(F.col("vec_id"))).alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("_root"), F.lit(True)).alias("kept"))
