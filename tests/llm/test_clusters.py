import hashlib
import math
from collections import Counter

import pytest

from sievework.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, label int"


def made(n, dims=64, seed=3, spread=40):
    """Vectors around a few centres, on a coarse grid so that many are equal."""
    state, out = seed, []
    for i in range(n):
        row = []
        for j in range(dims):
            state = (state * 1103515245 + 12345) % (1 << 31)
            row.append(((i % 5) * (j % 3) + (state >> 16) % 3 / spread - 2.0) / 8)
        out.append((i, row, i % 5))
    return out


def plain(rows, k=40, rounds=5, dims=64):
    """Lloyd's rounds over all rows, one at a time, in Python's integers."""
    bound = 1 << 27
    kept = [(r[0], tuple(math.floor(max(-bound, min(bound, 256 * x))) for x in r[1])) for r in rows if r[1] is not None and len(r[1]) == dims and all(x is not None and math.isfinite(x) for x in r[1])]
    mark = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [q for _, q in sorted(kept, key=mark)[:k]]
    far = lambda q, c: sum((a - b) ** 2 for a, b in zip(q, c, strict=True))
    place = lambda q: min((far(q, c), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        members: dict = {}
        for _, q in kept:
            members.setdefault(place(q)[1], []).append(q)
        for i, qs in members.items():
            centroids[i] = tuple(sum(x) // len(qs) for x in zip(*qs, strict=True))
    found = [(v, *place(q)[::-1]) for v, q in kept]
    own = Counter()
    for _, c, d in found:
        own[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(v, c, d, own[c], sum(own.values()), sha[c]) for v, c, d in found]


def same(spark, rows, schema=SCHEMA):
    out = clusters.query(spark.createDataFrame(rows, schema))
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(plain(rows), key=str)


def test_same_as_plain_rounds(spark):
    rows = made(300)
    rows += [(1000 + i, rows[7][1], 0) for i in range(150)]  # a third of all rows are copies
    same(spark, rows)


def test_odd_vectors(spark):
    rows = made(60)
    rows[3] = (3, None, 0)
    rows[4] = (4, [], 0)
    rows[5] = (5, [0.0] * 63, 0)
    rows[6] = (6, [0.0] * 65, 0)
    rows[7] = (7, [float("nan"), *[0.0] * 63], 0)
    rows[8] = (8, [float("-inf"), *[0.0] * 63], 0)
    rows[9] = (9, [None, *[0.0] * 63], 0)
    rows[10] = (10, [3e38, -3e38, *[0.0] * 62], 0)
    rows[11] = (11, [3e38, 3e38, *[0.0] * 62], 0)
    rows[12] = (None, rows[0][1], None)
    rows += [rows[0], rows[0], (13, rows[14][1], 1), (13, rows[15][1], 1)]
    same(spark, rows)


def test_few_and_no_vectors(spark):
    same(spark, made(3))
    same(spark, [])
    same(spark, [(1, None, 0)])


def test_clashing_columns(spark):
    rows = made(50)
    table = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA + ", Cluster int, q int, N string")
    assert sorted(map(tuple, clusters.query(table).collect())) == sorted(plain(rows))


@pytest.mark.parametrize("most", [5, 1 << 20])
def test_distances_are_exact(most):
    import numpy as np

    rng = np.random.default_rng(1)
    x, c = rng.integers(-most, most, (200, 64)), rng.integers(-most, most, (7, 64))
    wide = ((x[:, None].astype(object) - c[None].astype(object)) ** 2).sum(axis=2)
    best, far = clusters.nearest(x, c)
    assert [list(r).index(min(r)) for r in wide] == best.tolist() and [min(r) for r in wide] == far.tolist()
