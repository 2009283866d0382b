"""Exact integer k-means over a VA-file: vectors compressed to cells of a few bits per dimension.

Each dimension is divided into 2 ** BITS cells between its least and largest value, at marks spaced by the dimension's mean and
spread. A row of the file holds a vector's cells, a few bits each, beside the whole vector. In every round a lookup
table gives, for each dimension, cell and centroid, the least and the largest squared difference that a value of that
cell can have; their sums enclose the vector's distance to each centroid. A centroid whose interval begins above
the end of another one's cannot be nearest. Only where several intervals overlap is the whole vector fetched and compared, with those centroids
alone. A scan reads columns, not single values, so the two lie in one row, and fetching means unpacking the row's vector.

A round is one pass without a shuffle of vectors: tasks send sums of their clusters, one row per cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import written

N_COMPONENTS = 64
K = 16
ROUNDS = 3
SCALE = 64
SEED = 1
BITS = 6
#: The cells between the two outer ones reach so many spreads from the mean.
REACH = 3.5
#: Integers are kept within this bound either way, so that 64 squared differences stay within 63 bits.
BOUND = 1 << 27
#: Vectors handled at once.
STEP = 1 << 13
FILE = "vec_id bigint, cells binary, vector binary"


class Marks(NamedTuple):
    """For each dimension the inclusive ends of its cells: ``low[d, c] <= value <= high[d, c]``."""

    low: np.ndarray
    high: np.ndarray


class Tables(NamedTuple):
    """For each dimension, cell and centroid the least and the largest squared difference."""

    least: np.ndarray
    largest: np.ndarray


def usable(vector: Column, n: int = N_COMPONENTS) -> Column:
    """True for vectors of exactly ``n`` components, none of them null, infinite or not a number."""
    def is_finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.coalesce((F.size(vector) == n) & F.forall(vector, is_finite), F.lit(False))


def integers(column: pa.Array, n: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, as rows."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, n)
    return np.clip(np.floor(scale * x), -BOUND, BOUND).astype(np.int64)


def marks_of(low: np.ndarray, high: np.ndarray, mean: np.ndarray, spread: np.ndarray, bits: int = BITS) -> Marks:
    """Cells between the extremes, cut at equal steps from ``REACH`` spreads below the mean to as many above."""
    steps = np.linspace(-REACH, REACH, (1 << bits) - 1)
    cuts = np.clip(np.floor(mean[:, None] + spread[:, None] * steps).astype(np.int64), low[:, None], high[:, None])
    return Marks(np.c_[low, cuts + 1], np.c_[cuts, high])


def statistics(rows: DataFrame, n: int, scale: int) -> Marks | None:
    """The marks of all dimensions; each batch sends ``n`` rows of sums, which meet in one aggregate by dimension."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = integers(batch.column(0), n, scale)
                f = x.astype(np.float64)
                sums = [np.arange(n), x.min(axis=0), x.max(axis=0), np.full(n, len(x)), f.sum(axis=0), (f * f).sum(axis=0)]
                yield pa.RecordBatch.from_arrays([pa.array(s) for s in sums], ["d", "low", "high", "n", "s", "q"])

    found = rows.mapInArrow(parts, "d bigint, low bigint, high bigint, n bigint, s double, q double")
    sums = found.groupBy("d").agg(*[F.min("low"), F.max("high"), F.sum("n"), F.sum("s"), F.sum("q")]).orderBy("d").collect()
    if not sums:
        return None
    _, low, high, count, s, q = (np.array(c) for c in zip(*sums, strict=True))
    mean = s / count
    return marks_of(low.astype(np.int64), high.astype(np.int64), mean, np.sqrt(np.maximum(q / count - mean * mean, 1)))


def cells_of(x: np.ndarray, marks: Marks) -> np.ndarray:
    """The cell of each component: the first whose end is not below it."""
    return np.stack([np.searchsorted(high[:-1], x[:, d]) for d, high in enumerate(marks.high)], axis=1).astype(np.uint8)


def packed(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bit by bit: the lowest bits of all components, then the next ones."""
    return np.concatenate([np.packbits((cells >> b) & 1, axis=1) for b in range(bits)], axis=1)


def unpacked(data: np.ndarray, n: int, bits: int = BITS) -> np.ndarray:
    planes = np.split(data, bits, axis=1)
    return sum(np.unpackbits(plane, axis=1, count=n) << b for b, plane in enumerate(planes))


def lookup(marks: Marks, centroids: np.ndarray) -> Tables:
    low, high = marks.low[:, :, None], marks.high[:, :, None]
    c = centroids.T[:, None, :]
    gap = np.maximum(np.maximum(low - c, c - high), 0)
    far = np.maximum(np.abs(c - low), np.abs(c - high))
    return Tables(gap * gap, far * far)


def fixed_binary(column: pa.Array, dtype: type) -> np.ndarray:
    """Binary values of equal length as rows of numbers."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(dtype).reshape(n, -1)


def as_binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def nearest(cells: np.ndarray, vectors: np.ndarray, tables: Tables, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """The nearest centroid of each vector, ties to the smaller number, and how many vectors were fetched for it."""
    least = np.zeros((len(cells), len(centroids)), np.int64)
    largest = np.zeros_like(least)
    for d in range(cells.shape[1]):
        least += tables.least[d][cells[:, d]]
        largest += tables.largest[d][cells[:, d]]
    open_ = least <= largest.min(axis=1)[:, None]
    cluster = np.argmax(open_, axis=1)
    fetched = np.flatnonzero(open_.sum(axis=1) > 1)
    best = np.full(len(fetched), np.iinfo(np.int64).max)
    for k, centroid in enumerate(centroids):
        here = np.flatnonzero(open_[fetched, k])
        away = vectors[fetched[here]].astype(np.int64) - centroid
        distance = (away * away).sum(axis=1)
        closer = distance < best[here]
        best[here[closer]] = distance[closer]
        cluster[fetched[here[closer]]] = k
    return cluster, len(fetched)


def vector_file(vectors: DataFrame, vec_id: str, embedding: str, n: int, scale: int) -> tuple[DataFrame, Marks | None]:
    """The file of all usable vectors, and its marks; none where there is no usable vector."""
    rows = vectors.filter(usable(F.col(embedding), n)).select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("x"))
    marks = statistics(rows.select("x"), n, scale)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = integers(batch.column(1), n, scale)
                columns = [batch.column(0), as_binary(packed(cells_of(x, marks))), as_binary(x.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cells", "vector"])

    return (written(rows.mapInArrow(build, FILE), "vector-file") if marks else rows.select("vec_id").limit(0)), marks


def first_centroids(file: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of least SHA-256 of seed, colon and id, a null id taken as empty; equal ids by the bytes of the vector."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = file.select(key.alias("key"), "vector").orderBy("key", "vector").limit(k).collect()
    return np.stack([np.frombuffer(r["vector"], np.int32).astype(np.int64) for r in rows])


def parts_of(batches: Iterator[pa.RecordBatch], tables: Tables, centroids: np.ndarray) -> Iterator[tuple]:
    """Batches in small parts: ids, vectors, nearest centroids."""
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            cells, vectors = unpacked(fixed_binary(part.column(1), np.uint8), centroids.shape[1]), fixed_binary(part.column(2), np.int32)
            yield part.column(0), vectors, nearest(cells, vectors, tables, centroids)[0]


def next_centroids(file: DataFrame, marks: Marks, centroids: np.ndarray) -> np.ndarray:
    """Each centroid as the floor of the mean of its vectors; one without vectors stays. k rows meet at the driver."""
    tables, k, n = lookup(marks, centroids), *centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, n), np.int64), np.zeros(k, np.int64)
        for _, vectors, cluster in parts_of(batches, tables, centroids):
            order = np.argsort(cluster, kind="stable")
            found, first = np.unique(cluster[order], return_index=True)
            total[found] += np.add.reduceat(vectors[order].astype(np.int64), first, axis=0)
            count += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(count)
        cluster, d = np.repeat(some, n), np.tile(np.arange(n), len(some))
        columns = [cluster, d, np.repeat(count[some], n), total[some].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["cluster", "d", "n", "total"])

    found = file.mapInArrow(sums, "cluster bigint, d bigint, n bigint, total bigint")
    wide = F.sum(F.col("total").cast("decimal(38,0)"))
    out = centroids.copy()
    for row in found.groupBy("cluster", "d").agg(F.sum("n").alias("n"), wide.alias("total")).collect():
        out[row["cluster"], row["d"]] = int(row["total"]) // row["n"]
    return out


def clustered(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
    k: int = K, rounds: int = ROUNDS, n: int = N_COMPONENTS, scale: int = SCALE, seed: int = SEED,
) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid (its final components).

    Usable are vectors of ``n`` components without nulls and non-finite values; others give no row. Components become
    floor(scale * x), held within 2 ** 27 either way. The first centroids are the ``k`` vectors of least hash of their ids, or all
    where there are fewer; after ``rounds`` rounds vectors are assigned once more. Ties go to the smaller number. Rows
    that repeat count as often as they stand, with or without an id. Without usable vectors the result is empty.
    Ids are whole numbers; other columns are not read.
    """
    file, marks = vector_file(vectors, vec_id, embedding, n, scale)
    names = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    if marks is None:
        return file.selectExpr("vec_id", "0 AS cluster", *[f"0L AS {c}" for c in ("distance", "cluster_inertia", "inertia")], "array(0L) AS centroid")
    centroids = first_centroids(file, k, seed)
    for _ in range(rounds):
        centroids = next_centroids(file, marks, centroids)
    tables = lookup(marks, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors, cluster in parts_of(batches, tables, centroids):
            away = vectors.astype(np.int64) - centroids[cluster]
            columns = [ids, pa.array(cluster.astype(np.int32)), pa.array((away * away).sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    found = written(file.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"), "clusters")
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    ends = [(c, s, sum(inertia.values()), [int(x) for x in centroids[c]]) for c, s in inertia.items()]
    # One row per cluster.
    facts = found.sparkSession.createDataFrame(ends, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return found.join(F.broadcast(facts), "cluster").select(*[c.split()[0] for c in names.split(", ")])


def report(vectors: DataFrame, **options) -> DataFrame:
    """``clustered`` with ``centroid_sha256``, over the centroid's decimal components joined by commas."""
    text = F.concat_ws(",", F.col("centroid").cast("array<string>"))
    return clustered(vectors, **options).withColumn("centroid_sha256", F.sha2(text.cast("binary"), 256)).drop("centroid")
