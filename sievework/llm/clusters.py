"""Centroid clustering of quantised vectors, each distinct vector once.

Vectors are turned into integers, and equal ones are grouped with their multiplicity, so a
vector with any number of copies is one row of what follows.  Lloyd's rounds run on the
distinct vectors: a task assigns its vectors to the nearest centroid in blocks and sums
them, weighted by multiplicity, in 64-bit integers; Spark adds up one row for each
centroid, component and task, and k x dims sums reach the driver.  At the end the
assignment of distinct vectors is joined back to the vec_ids: vectors that make up a
thousandth of all rows or more (at most a thousand, hence broadcast) apart from the rest,
so that copies don't meet in one task.

Vectors that are null, of another length, or with a null, NaN or infinite component are
left out.  Components beyond 2 ** 19 in magnitude count as that, so that squared distances
fit 64 bits.  A null vec_id is hashed as the empty text; rows with equal vec_id are told
apart by their vectors, and repeated rows are repeated in the result.  Of equally near
centroids the smaller number wins.  With fewer vectors than centroids there are as many
centroids as vectors; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

DIMS = 64
CENTROIDS = 40
ROUNDS = 5
STEPS = 256
SEED = 2
#: Components are held within this, see above.
LARGEST = 1 << 27
#: A vector with this share of all rows is joined apart.
HOT = 1000
BLOCK = 8192
EXACT = float(1 << 53)


def usable(vector: Column, dims: int = DIMS) -> Column:
    """Whether a vector has `dims` components, all of them finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, finite), F.lit(False))


def quantised(vector: Column) -> Column:
    """floor(STEPS * x) of each component, as integers."""
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * STEPS, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int")
    return F.transform(vector, whole)


def first_centroids(vectors: DataFrame, k: int, seed: int = SEED) -> np.ndarray:
    """The vectors whose ids hash lowest; vectors: (vec_id, q). k rows reach the driver."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(mark.alias("mark"), "q").orderBy("mark", "q").limit(k).collect()
    return np.array([r.q for r in rows], np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the number of its nearest centroid and the squared distance to it.

    |x|^2 - 2 xc + |c|^2; in floating point where all sums are whole numbers below 2 ** 53.
    """
    most = float(max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)))
    kind = np.float64 if 4 * x.shape[1] * most * most < EXACT else np.int64
    a, c = x.astype(kind), centroids.astype(kind)
    table = (c * c).sum(axis=1) - 2 * (a @ c.T)
    best = table.argmin(axis=1)
    return best, (table[np.arange(len(a)), best] + (a * a).sum(axis=1)).astype(np.int64)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most BLOCK rows, and their vectors as a matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, part.column("q").flatten().to_numpy().reshape(part.num_rows, -1).astype(np.int64)


def moved(distinct: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: each centroid's floored mean, or itself if nothing is nearest to it."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for part, x in blocks(batches):
            best, _ = nearest(x, centroids)
            times = part.column("n").to_numpy()
            order = np.argsort(best, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(best[order]) > 0])
            total[best[order][first]] += np.add.reduceat((x * times[:, None])[order], first, axis=0)
            count[best[order][first]] += np.add.reduceat(times[order], first)
        some = np.flatnonzero(count)
        if len(some):
            values = np.column_stack([count[some], total[some]])
            each = dims + 1
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, each)), pa.array(np.tile(np.arange(each), len(some))), pa.array(values.ravel())], ["c", "i", "v"])

    rows = distinct.mapInArrow(sums, "c long, i long, v long").groupBy("c", "i").agg(F.sum("v").alias("v")).collect()
    table: dict[int, dict[int, int]] = {}
    for r in rows:
        table.setdefault(r.c, {})[r.i] = r.v
    out = centroids.copy()
    for c, v in table.items():
        out[c] = [v[i + 1] // v[0] for i in range(dims)]
    return out


def assigned(distinct: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(q, n, cluster, distance) of each distinct vector."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in blocks(batches):
            best, far = nearest(x, centroids)
            yield pa.RecordBatch.from_arrays([part.column("q"), part.column("n"), pa.array(best, pa.int32()), pa.array(far)], ["q", "n", "cluster", "distance"])

    return distinct.mapInArrow(assign, "q array<int>, n long, cluster int, distance long")


def grouped(vectors: DataFrame) -> DataFrame:
    """(q, n): each distinct vector and how many rows have it."""
    return stored(vectors.groupBy("q").agg(F.count("*").alias("n")))


def lloyd(distinct: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    for _ in range(rounds):
        centroids = moved(distinct, centroids)
    return centroids


def joined(vectors: DataFrame, found: DataFrame, keep: list[str]) -> DataFrame:
    """Rows of vectors with what was found for their q; copies that are very many apart from the rest."""
    total = found.agg(F.sum("n")).first()[0] or 0
    often = found.filter(F.col("n") * HOT >= total).select("q", *keep)  # at most HOT rows
    rest = found.filter(F.col("n") * HOT < total).select("q", *keep)
    others = vectors.join(F.broadcast(often.select("q")), "q", "left_anti")
    return vectors.join(F.broadcast(often), "q").unionByName(others.join(rest, "q"))


def clustered(table: DataFrame, vector: str = "embedding", ident: str = "vec_id", k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS) -> tuple[DataFrame, np.ndarray]:
    """(ident, cluster, distance, cluster_inertia, inertia) of each usable row, and the final centroids."""
    spark = table.sparkSession
    vectors = table.filter(usable(F.col(vector), dims)).select(F.col(ident).alias("vec_id"), quantised(F.col(vector)).alias("q"))
    centroids = first_centroids(vectors, k)
    if not len(centroids):
        none = vectors.select("vec_id", *[F.lit(0).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"))])
        return none.withColumnRenamed("vec_id", ident), np.zeros((0, dims), np.int64)
    distinct = grouped(vectors)
    centroids = lloyd(distinct, centroids, rounds)
    found = stored(assigned(distinct, centroids))
    spread = {r.cluster: r.v for r in found.groupBy("cluster").agg(F.sum(F.col("n") * F.col("distance")).alias("v")).collect()}
    sums = spark.createDataFrame([(c, v, sum(spread.values())) for c, v in spread.items()], "cluster int, cluster_inertia long, inertia long")
    out = joined(vectors, found, ["cluster", "distance"]).join(F.broadcast(sums), "cluster")  # a row for each centroid
    return out.select(F.col("vec_id").alias(ident), "cluster", "distance", "cluster_inertia", "inertia"), centroids


def digests(centroids: np.ndarray) -> list[str]:
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]


def query(table: DataFrame) -> DataFrame:
    rows, centroids = clustered(table)
    marks = table.sparkSession.createDataFrame(list(enumerate(digests(centroids))), "cluster int, centroid_sha256 string")
    return rows.join(F.broadcast(marks), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
