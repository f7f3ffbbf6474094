"""SimHash near-duplicates by bit-sliced comparison.

A text's fingerprint has a bit set where more than half of its shingles' hashes have
it.  Two texts link when their fingerprints differ in at most `radius` bits.  Equal
fingerprints are grouped first, so a group of copies of any size is one row in what
follows.  The distinct fingerprints are spread over tables: the 64 bits are cut into
blocks, and whichever bits differ, some choice of blocks agrees, so every link is found
by the table of that choice.  A key that very many share is divided by pieces of the other
bits, again without loss.  Inside a table rows with the same key are compared many at
once: bit planes are stored vertically, 64 fingerprints to a word, distances grow in
carry-save bit counters, and a word is abandoned once all its 64 distances exceed the
radius.  Each key yields links that span its groups, never all pairs.  Components come
from alternating star contractions in Spark.

Null texts and texts without words have fingerprint zero and link like any other.  A
null doc_id never names a component unless all its members are null.  Repeated rows are
repeated in the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, cut, partitions, slices, text_buffers, unused, word_spans

SEED = 42
#: A key that more fingerprints have is divided.
CROWD = 4096


def shingle_bits(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """One fingerprint for each row."""
    rows = len(offsets) - 1
    starts, ends, row = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(rows, np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(starts)), lengths)
    at = np.arange(len(word))
    joined = np.full(len(word) + len(starts), 32, np.uint8)
    joined[at + word] = LOWER[data[at - firsts[word] + starts[word]]]
    begin = firsts + np.arange(len(starts))
    end = begin + lengths
    count = np.bincount(row, minlength=rows)
    first_word = np.cumsum(count) - count
    place = np.arange(len(starts)) - first_word[row]
    head = np.flatnonzero((place + width <= count[row]) | (place == 0))
    tail = head + np.minimum(width, count[row[head]]) - 1
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(begin[head].tolist(), end[tail].tolist(), strict=True)), np.uint64, len(head))
    of = row[head]
    new = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    out = np.zeros(rows, np.uint64)
    out[of[new]] = majority(hashes, new)
    return out


def majority(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each stretch of hashes the bits that more than half of it have."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.diff(np.r_[starts, len(hashes)])
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, th, fp): the text's hash, and the fingerprint as a signed long."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = shingle_bits(*text_buffers(b.column("text")), width)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(fp.view(np.int64))], ["doc_id", "th", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(make, f"doc_id {kind}, th long, fp long")


class Planes:
    """Bit planes of a block of fingerprints, 64 to a word."""

    def __init__(self, values: np.ndarray):
        self.n, self.words = len(values), (len(values) + 63) // 64
        bits = np.zeros((self.words * 64, 64), np.uint8)
        bits[: self.n] = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        packed = np.packbits(bits.T, axis=1, bitorder="little").copy().view(np.uint64)
        self.planes = np.zeros((64, self.words + 2), np.uint64)
        self.planes[:, : self.words] = packed

    def near(self, step: int, wanted: np.ndarray, radius: int) -> np.ndarray:
        """The i of `wanted` whose distance to fingerprint i + step is at most radius."""
        mask = np.zeros(self.words * 64, np.uint8)
        mask[wanted] = 1
        lanes = np.packbits(mask, bitorder="little").view(np.uint64)
        live = np.flatnonzero(lanes)
        jump, shift = divmod(step, 64)
        low = np.minimum(live + jump, self.words + 1)
        high = np.minimum(low + 1, self.words + 1)

        def differ(k: int, at: np.ndarray | slice) -> np.ndarray:
            plane = self.planes[k]
            other = plane[low[at]]
            if shift:
                other = (other >> np.uint64(shift)) | (plane[high[at]] << np.uint64(64 - shift))
            return plane[live[at]] ^ other

        at, fine = within(~lanes[live], differ, radius)
        word, bit = np.nonzero(fine)
        return live[at][word] * 64 + bit

    def pairs(self, rows: np.ndarray, words: tuple[int, int], radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j) at most radius apart: i of `rows`, j of the words from words[0] up to words[1], and after i."""
        first = np.maximum(rows // 64, words[0])
        count = np.maximum(words[1] - first, 0)
        row = np.repeat(rows, count)
        word = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        over = np.where(word == row // 64, full >> (63 - row % 64).astype(np.uint64), np.uint64(0))  # lanes up to i itself
        own, lane = row // 64, (row % 64).astype(np.uint64)

        def differ(k: int, at: np.ndarray | slice) -> np.ndarray:
            plane = self.planes[k]
            return plane[word[at]] ^ (np.uint64(0) - (plane[own[at]] >> lane[at] & np.uint64(1)))

        at, fine = within(over, differ, radius)
        found, bit = np.nonzero(fine)
        return row[at][found], word[at][found] * 64 + bit


def within(over: np.ndarray, differ: Callable, radius: int) -> tuple[np.ndarray | slice, np.ndarray]:
    """Which words have lanes at most radius apart, and those lanes, 64 to a row.

    Lanes of over are left out from the start; differ(k, at) has the lanes that differ in
    bit k, for the words at `at`.  Words are abandoned once all their lanes are over.
    """
    at: np.ndarray | slice = slice(None)
    digits = [np.zeros(len(over), np.uint64) for _ in range(radius.bit_length())]
    for k in range(64):
        carry = differ(k, at)
        for digit in digits:
            both = digit & carry
            digit ^= carry
            carry = both
        over = over | carry
        if k % 8 == 7:
            keep = over != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not keep.all():
                at = np.flatnonzero(keep) if isinstance(at, slice) else at[keep]
                over, digits = over[keep], [d[keep] for d in digits]
                if not len(over):
                    break
    fine = ~over  # fewer than 2 ** len(digits) bits differ
    if radius + 1 != 1 << len(digits):
        equal, less = np.full(len(over), 0xFFFFFFFFFFFFFFFF, np.uint64), np.zeros(len(over), np.uint64)
        for i in reversed(range(len(digits))):
            if radius >> i & 1:
                less |= equal & ~digits[i]
                equal &= digits[i]
            else:
                equal &= ~digits[i]
        fine &= less | equal
    return at, np.unpackbits(fine.view(np.uint8), bitorder="little").reshape(-1, 64)


def spanning_links(table: np.ndarray, key: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the close pairs of equal (table, key) connect. Rows are sorted by table and key."""
    n = len(fp)
    root = list(range(n))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left, right = [], []
    planes, step = Planes(fp), 1
    wanted = np.arange(n - 1)
    while True:
        wanted = wanted[wanted + step < n]
        wanted = wanted[(key[wanted] == key[wanted + step]) & (table[wanted] == table[wanted + step])]
        if not len(wanted):
            break
        for i in planes.near(step, wanted, radius).tolist():
            a, b = top(i), top(i + step)
            if a != b:
                root[b] = a
                left.append(i)
                right.append(i + step)
        step += 1
    return fp[left], fp[right]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def pieces(mask: int, n: int) -> list[int]:
    """The bits that mask lacks, in n pieces."""
    bits = [b for b in range(64) if not mask >> b & 1]
    edges = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(edges, edges[1:])]


def divided(spread: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """(fp, t, k) with the rows of crowded keys under radius + 1 longer keys each.

    Where two fingerprints agree in a key's blocks they differ in at most radius of the other
    bits, so of radius + 1 pieces of these one agrees, too: no link is lost.
    """
    crowded = spread.groupBy("t", "k").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select("t", "k", F.lit(True).alias("crowded"))
    table = F.array(*[F.array(*[F.lit(signed(m | p)) for p in pieces(m, radius + 1)]) for m in masks])
    key = lambda t, k: F.struct(t.cast("int").alias("t"), k.alias("k"))
    longer = F.transform(F.element_at(table, F.col("t") + 1), lambda m, j: key(F.col("t") + (j + 1) * len(masks), F.col("fp").bitwiseAND(m)))
    own = F.when(F.col("crowded"), longer).otherwise(F.array(key(F.col("t"), F.col("k"))))
    return spread.join(crowded, ["t", "k"], "left").select("fp", F.explode(own).alias("own")).select("fp", "own.t", "own.k")


def links(fps: DataFrame, radius: int, blocks: int = 6) -> DataFrame:
    """(a, b) with a < b: links among the distinct values of fps.fp that connect all pairs within the radius."""
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(bounds, bounds[1:])]
    masks = [sum(part[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    spread = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks])).alias("t", "k"))
    spread = divided(spread, masks, radius)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3

        def found(t: np.ndarray, k: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b = (x.view(np.int64) for x in spanning_links(t, k, fp.view(np.uint64), radius))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in batches:
            t, k, fp = (np.concatenate([h, batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)]) for h, c in zip(held, ("t", "k", "fp"), strict=True))
            if not len(t):
                continue
            last = int(np.argmax((t == t[-1]) & (k == k[-1])))  # the key that may go on
            if last:
                yield found(t[:last], k[:last], fp[:last])
            held = [t[last:], k[last:], fp[last:]]
        if len(held[0]) > 1:
            yield found(*held)

    n = partitions(fps.sparkSession)
    return spread.repartition(n, "t", "k").sortWithinPartitions("t", "k").mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is its component's smallest node.

    Alternating star contractions: a large star hangs a node's larger neighbours on its
    smallest one, a small star the smaller ones; the number of rounds is logarithmic.
    """

    def star(e: DataFrame, both: bool) -> DataFrame:
        up = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        near = up.unionByName(up.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else up
        low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        hung = near.join(low, "u")
        hung = hung.filter("v > u") if both else hung
        out = hung.select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not both:
            out = out.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(e)
    while True:
        e = cut(star(star(e, True), False))
        after = state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, th, fp, root, component_id) for each row of docs; rows of a component share its root."""
    prints = cut(fingerprints(docs, width))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = components(links(classes.select("fp"), radius)).withColumnRenamed("node", "fp")
    placed = cut(classes.join(roots, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    named = placed.join(placed.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select("doc_id", "th", "fp", "root", "component_id")


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """docs without near copies: of each component one row with the smallest doc_id stays; nulls come last."""
    return first_rows(docs, near_duplicates(docs, width, radius))


def first_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with one row for each root of found (doc_id, th, root).

    Of rows with equal doc_id and text the one stays whose other columns hash lowest, in
    every run; columns that can't be hashed (maps) don't tell rows apart.
    """
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("th"))).alias("row"))
    doc, th = unused(docs, "keep_doc"), unused(docs, "keep_th")
    keep = first.select(F.col("row.doc_id").alias(doc), F.col("row.th").alias(th))
    kept = docs.withColumn(th, F.xxhash64("text"))
    kept = kept.join(keep, kept.doc_id.eqNullSafe(keep[doc]) & (kept[th] == keep[th]), "left_semi")
    order = F.xxhash64(F.lit(0), *[kept[c] for c, kind in docs.dtypes if c != "text" and "map<" not in kind and kind != "variant"])
    row = F.struct(*[kept[c] for c in docs.columns])
    return kept.groupBy(kept.doc_id, kept[th]).agg(F.min_by(row, order).alias(doc)).select(f"{doc}.*")
