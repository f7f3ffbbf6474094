"""Suffix-array dedup of passages by the difference-cover algorithm.

A byte goes if it lies in a string of `span` bytes that also starts in a document with a
smaller doc_id.  Strings never cross documents and are judged on the input.

What has to be sorted is narrowed down first, without loss.  Of equal texts only the
first takes part: the others go whole.  A string of `span` bytes has a minimizer, the
least hash among its windows of `anchor` bytes, so equal strings have equal minimizers;
those that occur in one document only are left out.  What remains is cut into pieces: the
longest run of strings with the same minimizer.  Equal pieces are grouped, with their
smallest doc_id, and dealt to partitions by minimizer, where all strings that may be
equal meet.  A partition sorts the suffixes of its pieces with the difference-cover
algorithm (samples at positions not divisible by three, named by their sorted triples,
recursion on the names, merge of the other suffixes), compares adjacent suffixes' first
`span` bytes, and finds the smallest doc_id for each string.

A minimizer that very many pieces have, such as a common phrase in ever new surroundings,
is no one's to sort: its different pieces are taken apart, and each string is dealt by a
hash of its own, where Spark finds the smallest doc_id.

A null doc_id comes after all others.  Null texts are empty.  Rows that share a doc_id
don't remove each other's bytes.  Repeated rows are repeated in the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, slices, stored, text_buffers, window_hashes

SPAN = 50
ANCHOR = 20
#: Suffixes that a task sorts at once; a minimizer's pieces aren't divided, but are sorted only if they fill FEW blocks at most.
BLOCK = 1_000_000
FEW = 4
LAST = (1 << 63) - 1
LOW = np.uint64(0xFFFFFFFF)


def minimizers(data: np.ndarray, offsets: np.ndarray, span: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with the same minimizer: first string's start, number of strings, minimizer, row."""
    none = np.zeros(0, np.int64)
    low = window_hashes(data, anchor)
    size, width = 1, span - anchor + 1
    while size < width:  # least of each width windows, by doubling
        step = min(size, width - size)
        low = np.minimum(low[: len(low) - step], low[step:]) if len(low) > step else low[:0]
        size += step
    if not len(low):
        return none, none, none.astype(np.uint64), none
    valid = np.zeros(len(low) + 1, bool)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(low)]
    valid[:-1] = np.arange(len(low)) + span <= offsets[row + 1]
    first = valid[:-1].copy()
    first[1:] &= ~valid[:-2] | (low[1:] != low[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(first)
    turn = first | ~valid[:-1]
    ends = np.r_[np.flatnonzero(turn), len(low)]
    count = ends[np.searchsorted(ends, start, side="right")] - start
    return start, count, low[start], row[start]


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the values; and the rank of each, equal ones having the same."""
    order = np.argsort(values)
    new = np.zeros(len(order), bool)
    s = values[order]
    new[1:] = s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


def packed(*columns: np.ndarray) -> np.ndarray:
    """One number for each row, in the order of the columns, the first first. Columns aren't negative."""
    out = columns[0].astype(np.int64)
    top = int(out.max(initial=0)) + 1
    for c in columns[1:]:
        size = int(c.max(initial=0)) + 1
        if top * size >= 1 << 62:
            out = ranked(out)[1]
            top = int(out.max(initial=0)) + 1
        out = out * size + c
        top *= size
    return out


def suffix_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes of text by at least their first `depth` symbols; text's symbols are positive.

    Suffixes that agree so far may share a rank. With depth len(text) it's the full order.
    """
    n = len(text)
    if n < 3:
        return ranked(packed(*[np.r_[text[k:], np.zeros(k, text.dtype)] for k in range(n)]))[1] if n else np.zeros(0, np.int64)
    padded = np.r_[text.astype(np.int64), 0, 0, 0]
    at = np.arange(n)
    one, two = at[at % 3 == 1], at[at % 3 == 2]
    if n % 3 == 1:
        one = np.r_[one, n]  # so that the sample at the end of the first half is a mark
    sample = np.r_[one, two]
    order, name = ranked(packed(padded[sample], padded[sample + 1], padded[np.minimum(sample + 2, n + 2)]))
    if depth > 3 and name[order[-1]] + 1 < len(name):
        name = suffix_ranks(name + 1, -(-depth // 3))  # a symbol of the names is a triple
        order = np.empty(len(name), np.int64)
        order[name] = np.arange(len(name))
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = name + 1
    rank[n:] = 0
    # the others: their first symbol, and the rank of what follows
    zero = at[at % 3 == 0]
    zero = zero[np.argsort(packed(padded[zero], rank[zero + 1]))]
    merged = sample[order]
    merged = merged[merged < n]
    # merge: a suffix of the sample is compared with the others by one symbol and a rank if
    # its place is 1 modulo 3, by two symbols and a rank if it is 2
    is_one = merged % 3 == 1
    place = np.empty(len(merged), np.int64)
    for these, ahead in ((is_one, 1), (~is_one, 2)):
        own = np.r_[zero, merged[these]]
        key = packed(*[padded[own + k] for k in range(ahead)], rank[own + ahead])
        place[these] = np.searchsorted(np.sort(key[: len(zero)]), key[len(zero) :])
    place = np.maximum.accumulate(place)
    total = np.empty(n, np.int64)
    total[merged] = np.arange(len(merged)) + place
    total[zero] = np.arange(len(zero)) + np.searchsorted(place, np.arange(len(zero)), side="right")
    return total


def least_documents(pieces: list[bytes], docs: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string of span bytes in the pieces, in order: its piece, and the smallest of docs over equal strings."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.ones(int(sizes.sum()) + len(sizes), np.int64)  # 1 between pieces
    inside = np.ones(len(text), bool)
    inside[starts + sizes] = False
    text[inside] = np.frombuffer(b"".join(pieces), np.uint8)
    text[inside] += 2
    rank = suffix_ranks(text, span)
    counts = sizes - span + 1
    piece = np.repeat(np.arange(len(pieces)), counts)
    at = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[piece]
    order = np.empty(len(text), np.int64)
    order[rank] = np.arange(len(text))
    is_string = np.zeros(len(text), bool)
    is_string[at] = True
    order = order[is_string[order]]
    # adjacent prefixes, eight bytes at a time
    raw, word = np.zeros(len(text) + 16, np.uint8), np.empty(len(text), np.uint64)
    raw[: len(text)] = text - 2
    for k in range(min(8, len(text))):
        to = word[k::8]
        to[:] = raw[k : k + 8 * len(to)].view("<u8")
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in sorted({*range(0, span - 7, 8), span - 8}):
        w = word[order + k]
        same &= w[1:] == w[:-1]
    first = np.flatnonzero(np.r_[True, ~same])[: len(order)]
    owner = np.zeros(len(text), np.int64)
    owner[at] = piece
    low = np.minimum.reduceat(docs[owner[order]], first) if len(order) else np.zeros(0, np.int64)
    out = np.zeros(len(text), np.int64)
    out[order] = np.repeat(low, np.diff(np.r_[first, len(order)]))
    return piece, out[at]


RUNS = "array<struct<skip:int,n:int,least:long>>"


def marked(docs: DataFrame) -> DataFrame:
    """docs' text with t1 and t2, two hashes of it, and d, the doc_id for comparison."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"), F.coalesce("text", F.lit("")).alias("text")).withColumns({"t1": F.xxhash64("text"), "t2": F.hash("text")})


def shared_minimizers(docs: DataFrame, span: int, anchor: int, buckets: int) -> DataFrame:
    """(t1, mz): the minimizers of a text that some different text has too, their low 32 bits.

    A bucket holds few enough for these bits to tell nearly all of them apart; where they
    don't, a piece more is sorted.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            _, _, mz, row = minimizers(*text_buffers(b.column("text")), span, anchor)
            text = b.column("t1").to_numpy(zero_copy_only=False)[row]
            order = np.lexsort((text, mz))
            mz, text = mz[order], text[order]
            new = np.r_[True, (mz[1:] != mz[:-1]) | (text[1:] != text[:-1])][: len(mz)]
            mz, text = mz[new], text[new]
            edge = np.searchsorted((mz >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(edge))
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *(pa.array([x[edge[k] : edge[k + 1]].tobytes() for k in used], pa.binary()) for x in ((mz & LOW).astype("<u4"), text))], ["bucket", "mz", "text"])

    def match(table: pa.Table) -> pa.Table:
        mz = np.frombuffer(b"".join(table.column("mz").to_pylist()), "<u4")
        text = np.frombuffer(b"".join(table.column("text").to_pylist()), "<i8")
        order = np.argsort(mz, kind="stable")
        mz, text = mz[order], text[order]
        first = np.flatnonzero(np.r_[True, mz[1:] != mz[:-1]])
        several = np.minimum.reduceat(text, first) != np.maximum.reduceat(text, first)
        keep = np.repeat(several, np.diff(np.r_[first, len(mz)]))
        return pa.table({"t1": text[keep], "mz": mz[keep].astype(np.int64)})

    blobs = docs.select("t1", "text").mapInArrow(make, "bucket int, mz binary, text binary")
    return blobs.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(match, "t1 long, mz long")


def pieces(texts: DataFrame, shared: DataFrame, span: int, anchor: int) -> DataFrame:
    """(t1, t2, d, start, mz, size, piece): runs of strings whose minimizer is shared, with their bytes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, offsets = text_buffers(b.column("text"))
            start, count, mz, row = minimizers(data, offsets, span, anchor)
            lists = b.column("shared")
            sizes = np.diff(np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1])
            wanted = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            of = np.repeat(np.arange(b.num_rows), sizes)
            # membership of (row, mz): both sides sorted by a scramble of the two
            mixed = lambda r, m: m ^ (r.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            table = np.sort(mixed(of, wanted))
            key = mixed(row, mz & LOW)
            at = np.minimum(np.searchsorted(table, key), max(len(table) - 1, 0))
            use = (table[at] == key) if len(table) else np.zeros(len(key), bool)
            start, count, mz, row = start[use], count[use], mz[use], row[use]
            raw = data.tobytes()
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(own) for c in ("t1", "t2", "d")), pa.array((start - offsets[row]).astype(np.int32)), pa.array(mz.view(np.int64)), pa.array((count + span - 1).astype(np.int32)), pa.array([raw[i:j] for i, j in zip(start.tolist(), (start + count + span - 1).tolist(), strict=True)], pa.binary())], ["t1", "t2", "d", "start", "mz", "size", "piece"])

    lists = shared.groupBy("t1").agg(F.collect_set("mz").alias("shared"))
    return texts.join(lists, "t1").select("t1", "t2", "d", "text", "shared").mapInArrow(make, "t1 long, t2 int, d long, start int, mz long, size int, piece binary")


def crowded(found: DataFrame, block: int) -> DataFrame:
    """(mz): minimizers whose pieces, equal ones included, have more bytes than a few blocks."""
    return stored(found.groupBy("mz").agg(F.sum("size").alias("n")).filter(F.col("n") > FEW * block).select("mz"))


def owners_apart(found: DataFrame, span: int) -> DataFrame:
    """Like owners(), string by string: for minimizers that many pieces have."""
    distinct = found.groupBy("mz", "piece").agg(F.min("d").alias("d"))
    each = F.transform(F.sequence(F.lit(1), F.octet_length("piece") - (span - 1)), lambda i: F.substring("piece", i, F.lit(span)))
    strings = distinct.select("mz", F.xxhash64("piece").alias("ph"), "d", F.posexplode(F.transform(each, lambda s: F.struct(F.xxhash64(s).alias("s1"), F.hash(s).alias("s2")))).alias("skip", "s"))
    strings = strings.select("mz", "ph", "d", "skip", "s.s1", "s.s2")
    least = strings.groupBy("mz", "s1", "s2").agg(F.min("d").alias("least"))
    run = F.struct("skip", F.lit(1).alias("n"), "least")
    return strings.join(least, ["mz", "s1", "s2"]).groupBy("mz", "ph").agg(F.collect_list(run).alias("runs"))  # as many as the piece has strings


def owners(found: DataFrame, span: int, block: int) -> DataFrame:
    """(mz, ph, runs): for each different piece the smallest doc_id of its strings, by runs of them."""
    many = crowded(found, block)
    if many.isEmpty():
        return owners_sorted(found, span, block)
    apart = owners_apart(found.join(many, "mz", "left_semi"), span)
    return owners_sorted(found.join(many, "mz", "left_anti"), span, block).unionByName(apart)


def owners_sorted(found: DataFrame, span: int, block: int) -> DataFrame:
    """Like owners(), by a suffix sort in each partition."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def done(rows: pa.Table) -> pa.RecordBatch:
            piece, low = least_documents(rows.column("piece").to_pylist(), rows.column("d").to_numpy(), span)
            new = np.flatnonzero(np.r_[True, (piece[1:] != piece[:-1]) | (low[1:] != low[:-1])][: len(piece)])
            of = piece[new]
            begin = np.searchsorted(piece, np.arange(len(rows)))
            runs = pa.StructArray.from_arrays([pa.array((new - begin[of]).astype(np.int32)), pa.array(np.diff(np.r_[new, len(piece)]).astype(np.int32)), pa.array(low[new])], ["skip", "n", "least"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(rows) + 1)).astype(np.int32)), runs)
            rows = rows.combine_chunks()
            return pa.RecordBatch.from_arrays([rows.column("mz").combine_chunks(), rows.column("ph").combine_chunks(), lists], ["mz", "ph", "runs"])

        size = 0
        for b in batches:
            at = 0
            while at < b.num_rows:
                mz = b.column("mz").to_numpy(zero_copy_only=False)
                lengths = np.cumsum(np.r_[0, np.diff(text_buffers(b.column("piece"))[1])])
                end = b.num_rows
                if size + lengths[end] - lengths[at] >= block:  # end where a minimizer ends, at the first chance
                    full = max(at, int(np.searchsorted(lengths, lengths[at] + block - size)) - 1)
                    turns = np.flatnonzero(mz[1:] != mz[:-1]) + 1
                    turns = turns[turns > full]
                    end = int(turns[0]) if len(turns) else b.num_rows
                    held.append(b.slice(at, end - at))
                    size += int(lengths[end] - lengths[at])
                    if len(turns):
                        yield done(pa.Table.from_batches(held))
                        held, size = [], 0
                else:
                    held.append(b.slice(at))
                    size += int(lengths[end] - lengths[at])
                at = end
        if held:
            yield done(pa.Table.from_batches(held))

    n = partitions(found.sparkSession)
    distinct = found.groupBy("mz", "piece").agg(F.min("d").alias("d")).withColumn("ph", F.xxhash64("piece"))
    return distinct.repartition(n, "mz").sortWithinPartitions("mz").select("mz", "ph", "piece", "d").mapInArrow(sort, f"mz long, ph long, runs {RUNS}")


def covered(texts: DataFrame, marks: DataFrame, span: int) -> DataFrame:
    """(t1, t2, n_removed, n_spans, kept_sha256) for each text."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, offsets = text_buffers(b.column("text"))
            lists = b.column("marks").to_pylist()
            step = np.zeros(len(data) + 1, np.int64)
            for row, own in enumerate(lists):
                if own:
                    at = offsets[row] + np.array([m["start"] for m in own], np.int64)
                    np.add.at(step, at, 1)
                    np.add.at(step, at + np.array([m["n"] for m in own], np.int64) + span - 1, -1)
            gone = np.cumsum(step[:-1]) > 0
            sums = np.r_[0, np.cumsum(gone)]
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            edges = offsets[:-1][offsets[:-1] < len(data)]
            first[edges] = gone[edges]
            runs = np.r_[0, np.cumsum(first)]
            raw = data.tobytes()
            kept = [hashlib.sha256(raw[i:j] if not own else data[i:j][~gone[i:j]].tobytes()).hexdigest() for i, j, own in zip(offsets.tolist(), offsets[1:].tolist(), lists, strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("t1"), b.column("t2"), pa.array(sums[offsets[1:]] - sums[offsets[:-1]]), pa.array(runs[offsets[1:]] - runs[offsets[:-1]]), pa.array(kept)], ["t1", "t2", "n_removed", "n_spans", "kept_sha256"])

    lists = marks.groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "n")).alias("marks"))
    return texts.join(lists, ["t1", "t2"], "left").select("t1", "t2", "text", "marks").mapInArrow(make, "t1 long, t2 int, n_removed long, n_spans long, kept_sha256 string")


def deduped(docs: DataFrame, span: int = SPAN, anchor: int = ANCHOR, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of docs."""
    rows = marked(docs)
    texts = rows.groupBy("t1", "t2").agg(F.min("d").alias("d"), F.first("text").alias("text"))
    shared = stored(shared_minimizers(rows, span, anchor, partitions(docs.sparkSession)))
    found = stored(pieces(texts, shared, span, anchor), compression="zstd")
    owned = stored(owners(found, span, block))
    hits = found.select("t1", "t2", "d", "start", "mz", F.xxhash64("piece").alias("ph")).join(owned, ["mz", "ph"])
    hits = hits.select("t1", "t2", "d", "start", F.explode("runs").alias("r")).filter("r.least < d")
    marks = hits.select("t1", "t2", (F.col("start") + F.col("r.skip")).alias("start"), F.col("r.n").cast("long").alias("n"))
    firsts = stored(covered(texts, marks, span).join(rows.groupBy("t1", "t2").agg(F.min("d").alias("first")), ["t1", "t2"]))
    own = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t1"), F.hash(F.coalesce("text", F.lit(""))).alias("t2"))
    copy = (F.col("d") > F.col("first")) & (F.col("n_bytes") >= span)
    return own.join(firsts, ["t1", "t2"]).select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )


def query(docs: DataFrame) -> DataFrame:
    return deduped(docs)
