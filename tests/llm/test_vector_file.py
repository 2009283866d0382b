"""Clusters equal to those of exact k-means with whole numbers, and intervals that enclose every distance."""

import hashlib
import math
import random

import numpy as np
import pytest

from helpers import clashing
from marketstream.llm import vector_file as va

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k, rounds, n, scale=64):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if usable(v, n)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    centroids = [v for _, v in order[:k]]

    def assigned():
        out = []
        for i, v in kept:
            d, c = min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), at) for at, c in enumerate(centroids))
            out.append((i, v, c, d))
        return out

    for _ in range(rounds):
        members = {}
        for _, v, c, _ in assigned():
            members.setdefault(c, []).append(v)
        for c, vs in members.items():
            centroids[c] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    last = assigned()
    whole = {c: sum(d for *_, x, d in last if x == c) for *_, c, _ in last}
    return sorted((str(i), c, d, whole[c], sum(whole.values()), centroids[c]) for i, _, c, d in last)


def usable(v, n):
    return v is not None and len(v) == n and all(x is not None and math.isfinite(x) for x in v)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def got(df):
    return sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid"]) for r in df.collect())


def vectors(rng, count, n, spread):
    middles = [[rng.gauss(0, spread) for _ in range(n)] for _ in range(5)]
    return [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(middles)]) for i in range(count)]


@pytest.mark.parametrize(("n", "k", "spread"), [(4, 3, 0.05), (8, 6, 1.0), (64, 16, 0.1)])
def test_random_vectors(spark, n, k, spread):
    rows = vectors(random.Random(n), 300, n, spread)
    assert got(va.clustered(table(spark, rows), k=k, n=n)) == brute(rows, k, 3, n)


def test_odd_rows(spark):
    """Wrong lengths, nulls and non-finite values go; repeats, ties, a missing id, far values and negative zeros stay."""
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, None), (2, []), (3, [0.5] * 3), (4, [0.5] * 5), (5, [0.5, None, 0.5, 0.5]), (6, [nan] * 4), (7, [0.0, inf, 0.0, 0.0]),
        (8, [0.0] * 4), (8, [0.0] * 4), (8, [-0.0] * 4), (9, [1.0] * 4), (10, [0.5] * 4), (None, [0.5] * 4), (None, [-1.01] * 4),
        (-11, [1000.0, -1000.0, 0.01, -0.01]), (12, [0.5, 0.5, 0.5, 0.5]),
    ]
    df = clashing(table(spark, rows), "cluster", "distance", "cells", "vector", "centroid")
    assert got(va.clustered(df, k=4, n=4)) == brute(rows, 4, 3, 4)


def test_fewer_vectors_than_centroids(spark):
    rows = [(1, [0.1] * 4), (2, [0.9] * 4)]
    assert got(va.clustered(table(spark, rows), n=4)) == brute(rows, 16, 3, 4)


def test_equal_vectors(spark):
    """All centroids equal: everything belongs to the first, the others stay empty."""
    rows = [(i, [0.3] * 4) for i in range(40)]
    found = got(va.clustered(table(spark, rows), n=4))
    assert found == brute(rows, 16, 3, 4) and {r[1] for r in found} == {0}


def test_no_usable_vector(spark):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    for rows in ([], [(1, [1.0])]):
        found = va.report(table(spark, rows))
        assert found.columns == names and found.collect() == []


def test_values_beyond_the_bound(spark):
    """Held at the bound, so that nothing overflows."""
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.0])]
    found = va.clustered(table(spark, rows), n=2, k=1, rounds=0).collect()
    assert all(0 <= r["distance"] <= 2 * (2 * va.BOUND) ** 2 for r in found) and len(found) == 3


def test_intervals_enclose_distances():
    """Cells come back from their bytes; every distance lies in its interval; few vectors are fetched where centroids are apart."""
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(0, 8, (500, 64)) + rng.choice([-60, 0, 60], (500, 1))).astype(np.int64)
    marks = va.marks_of(x.min(axis=0), x.max(axis=0), x.mean(axis=0), x.std(axis=0))
    cells = va.cells_of(x, marks)
    assert (va.unpacked(va.packed(cells), 64) == cells).all() and va.packed(cells).shape[1] == 8 * va.BITS and cells.max() < 1 << va.BITS
    centroids = np.stack([x[x.mean(axis=1) < -30].mean(axis=0), x[abs(x.mean(axis=1)) < 30].mean(axis=0)]).astype(np.int64)
    tables = va.lookup(marks, centroids)
    d = np.arange(64)
    least, largest = (t[d[None, :], cells].sum(axis=1) for t in tables)
    exact = ((x[:, None, :] - centroids) ** 2).sum(axis=2)
    assert (least <= exact).all() and (exact <= largest).all()
    cluster, fetched = va.nearest(cells, x, tables, centroids)
    assert (cluster == exact.argmin(axis=1)).all() and fetched < 500
