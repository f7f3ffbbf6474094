"""Quality classifier: a factorisation machine.

A document is a sparse vector: its hashed words, weighted by how often they occur and
scaled to length one, and statistics of its structure and its n_chars, scaled by the
sample's mean and deviation.  Pairs of features interact through low-rank factors, and
the sum over all pairs takes linear time by the identity
    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

The model is fitted on a bounded sample of labelled documents and has a fixed size, so
it can be broadcast; every document is scored where it is read.  Null texts count as
empty, null n_chars as 0.  Repeated rows are repeated in the result; of rows with
one doc_id the least text is learned from.  Without labels
every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, fold, slices, span_hashes, text_buffers, word_spans

#: At most so many labelled documents are learned from, those whose ids hash lowest.
SAMPLE = 8000
SLOTS = 1 << 16
RANK = 8
EPOCHS = 10
CUT = 0.3
STATS = 12
BREAK = np.zeros(256, bool)
BREAK[list(b".!?")] = True


def vectors(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse words (row, slot, value, sorted by row) and a matrix of statistics."""
    rows = len(offsets) - 1
    low = LOWER[data]
    starts, ends, row = word_spans(data, offsets)
    slot = (span_hashes(low, starts, ends) >> np.uint64(48)).astype(np.int64)
    pair, often = np.unique(row * SLOTS + slot, return_counts=True)
    at, slot = pair // SLOTS, pair % SLOTS
    value = np.log1p(often)
    norm = np.sqrt(np.bincount(at, value * value, rows))
    value = value / norm[at]
    words = np.bincount(row, minlength=rows)
    size = np.diff(offsets)
    inside = np.repeat(np.arange(rows), size)
    count = lambda m: np.bincount(inside[m], minlength=rows)
    letters = (low >= 97) & (low <= 122)
    upper = count((data >= 65) & (data <= 90))
    digits = count((data >= 48) & (data <= 57))
    wide = count(data >= 128)
    lines = count(data == 10) + 1
    stops = count(BREAK[data])
    plain = count(letters)
    blank = count((data <= 32))
    odd = size - plain - digits - wide - blank - stops
    per = lambda a, b: a / np.maximum(b, 1)
    stats = np.stack([
        np.log1p(words), per(size - blank, words), per(upper, plain), per(digits, size), per(wide, size), per(odd, size), per(stops, words),
        np.log1p(per(words, lines)), per(np.bincount(at, minlength=rows), words), per(np.bincount(at[often > 1], often[often > 1], rows), words),
        np.log1p(np.maximum(n_chars, 0)), np.log1p(per(n_chars, size)),
    ], axis=1)
    return at, slot, value, stats


class Machine:
    """w0, weights and factors of SLOTS words followed by STATS statistics."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.w0 = 0.0
        self.w = np.zeros(SLOTS + STATS)
        self.v = rng.normal(0, 0.02, (SLOTS + STATS, RANK))
        self.mean, self.spread = np.zeros(STATS), np.ones(STATS)

    def features(self, at: np.ndarray, slot: np.ndarray, value: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One sparse vector for each row; values clipped so that no statistic outweighs the rest."""
        rows = len(stats)
        dense = np.clip((stats - self.mean) / self.spread, -4, 4)
        return np.r_[at, np.repeat(np.arange(rows), STATS)], np.r_[slot, np.tile(SLOTS + np.arange(STATS), rows)], np.r_[value, dense.ravel()]

    def margin(self, at: np.ndarray, i: np.ndarray, x: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """w0 + linear part + pairs by the sum-of-squares identity; and the factor sums."""
        sums = np.stack([np.bincount(at, self.v[i, f] * x, rows) for f in range(RANK)], axis=1)
        squares = np.bincount(at, (self.v[i] ** 2).sum(axis=1) * x * x, rows)
        return self.w0 + np.bincount(at, self.w[i] * x, rows) + 0.5 * ((sums**2).sum(axis=1) - squares), sums

    def score(self, at, slot, value, stats) -> np.ndarray:
        m, _ = self.margin(*self.features(at, slot, value, stats), len(stats))
        return 1 / (1 + np.exp(-np.clip(m, -30, 30)))

    def fit(self, at: np.ndarray, slot: np.ndarray, value: np.ndarray, stats: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.1, shrink: float = 1e-4) -> None:
        """Adaptive gradient steps on the log loss; rows in a fixed shuffled order."""
        self.mean, self.spread = stats.mean(axis=0), stats.std(axis=0) + 1e-6
        share = np.clip(y.mean(), 0.01, 0.99)
        self.w0 = float(np.log(share / (1 - share)))
        begin = np.searchsorted(at, np.arange(len(y) + 1))
        gw, gv = np.full(len(self.w), 1e-6), np.full(self.v.shape, 1e-6)
        rng = np.random.default_rng(1)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for k in range(0, len(order), batch):
                rows = order[k : k + batch]
                take = np.concatenate([np.arange(begin[r], begin[r + 1]) for r in rows])
                place = np.repeat(np.arange(len(rows)), begin[rows + 1] - begin[rows])
                a, i, x = self.features(place, slot[take], value[take], stats[rows])
                m, sums = self.margin(a, i, x, len(rows))
                error = (1 / (1 + np.exp(-np.clip(m, -30, 30))) - y[rows]) / len(rows)
                used, back = np.unique(i, return_inverse=True)
                ex = error[a] * x
                dw = np.bincount(back, ex, len(used)) + shrink * self.w[used]
                dv = np.stack([np.bincount(back, ex * (sums[a, f] - self.v[i, f] * x), len(used)) for f in range(RANK)], axis=1) + shrink * self.v[used]
                gw[used] += dw**2
                gv[used] += dv**2
                self.w[used] -= rate * dw / np.sqrt(gw[used])
                self.v[used] -= rate * 0.3 * dv / np.sqrt(gv[used])
                self.w0 -= rate * 0.1 * error.sum()


def chars(docs: DataFrame):
    return F.coalesce(F.col("n_chars").cast("double"), F.lit(0.0)).alias("n_chars")


def fitted(docs: DataFrame, labels: DataFrame, sample: int) -> Machine | None:
    marks = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    marks = marks.filter(fold(F.col("doc_id"), 5) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            at, slot, value, stats = vectors(*text_buffers(b.column("text")), b.column("n_chars").to_numpy(zero_copy_only=False))
            ends = np.searchsorted(at, np.arange(b.num_rows + 1))
            parts = [[x[i:j].astype(t).tobytes() for i, j in zip(ends, ends[1:])] for x, t in ((slot, "<u2"), (value, "<f4"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("good"), *(pa.array(p, pa.binary()) for p in parts), pa.array([s.astype("<f8").tobytes() for s in stats], pa.binary())], ["doc_id", "good", "slot", "value", "stats"])

    some = docs.select("doc_id", "text", chars(docs)).join(F.broadcast(marks), "doc_id").groupBy("doc_id", "good").agg(F.min(F.struct("text", "n_chars")).alias("row"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    got = some.select("doc_id", "good", "row.text", "row.n_chars").mapInArrow(make, f"doc_id {kind}, good int, slot binary, value binary, stats binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: r.doc_id)
    slot = [np.frombuffer(r.slot, "<u2") for r in got]
    at = np.repeat(np.arange(len(got)), [len(s) for s in slot])
    machine = Machine()
    machine.fit(at, np.concatenate(slot).astype(np.int64), np.concatenate([np.frombuffer(r.value, "<f4") for r in got]).astype(float), np.stack([np.frombuffer(r.stats, "<f8") for r in got]), np.array([r.good for r in got], float))
    return machine


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score) for each row of docs."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, sample))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.value
        for b in slices(batches):
            if machine is None:
                score = np.full(b.num_rows, 0.5)
            else:
                score = machine.score(*vectors(*text_buffers(b.column("text")), b.column("n_chars").to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", chars(docs)).mapInArrow(make, f"doc_id {kind}, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, labels).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
