"""Line dedup by a segment-partition edit join.

A line is removed if the same line, or one within a few edits of it, stands earlier: in a
document with a smaller doc_id, or further up in the same one.  All lines are judged on the
input.  Edits are insertions, deletions and substitutions of code points: two for lines of
48 or more, one from 24 on (by the shorter line); shorter ones go only for equal ones, since
an edit makes another word of them.  Lines without a word always stay.  (Bytes that aren't
UTF-8 count one by one.)

If two lines differ by at most k edits and one is cut into k + 1 segments, a segment
occurs unchanged in the other, at a place that its length and the difference in length
narrow down.  k edits also change at most 2 k counts of classes of code points by one, so pairs
that share a segment by chance or by copying, but differ elsewhere, mostly end where they
meet.  Each slice of documents sends the hashes of its distinct lines' segments
(the index) and of the substrings to look up (the probes) to the buckets that hold them,
as packed arrays; a line that is everywhere is sent once a slice.  Candidates are then
verified on their texts by a banded bit-parallel edit distance, many pairs in a step.

A line goes for one earlier line, however many there are.  So of a key that very many lines
share, such as a template's, all are compared with the FIRST earliest of them only; what
that leaves undecided is compared with the whole key afterwards.

A null doc_id comes after all others.  A null text stays null.  Repeated rows and rows
that share a doc_id don't remove each other's equal lines at the same place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BASE, BYTE_CODE, GOLDEN, SPACE, cut, mix, partitions, powers, slices, stored, text_buffers, unused

#: Edits that lines of so many code points or more may differ by, the longest first.
EDITS = ((48, 2), (24, 1))
NEAR = min(n for n, _ in EDITS)
MOST = max(k for _, k in EDITS)
#: A line of more than this share of all lines is matched with its verdict apart from the rest; there are fewer than 1 / HOT such lines.
HOT = 1 / 1000
#: Bits of the filter that tells candidates' lines from the rest.
FILTER = 1 << 24
CHUNK = 1 << 19
PACKED = ("key", "line", "sign", "when")
#: Lines of a key beyond which its FIRST earliest stand for it at first.
CROWD = 2000
FIRST = 32
BACK = pow(BASE, -1, 1 << 64)
_backs = np.ones(1, np.uint64)


def backs(n: int) -> np.ndarray:
    """Inverses of powers(n)."""
    global _backs
    if len(_backs) < n:
        _backs = np.full(max(n, 4096), BACK, np.uint64)
        _backs[0] = 1
        np.multiply.accumulate(_backs, out=_backs)
    return _backs[:n]


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and number in its row of each line."""
    breaks = np.flatnonzero(data == 10)
    of = np.searchsorted(offsets, breaks, side="right") - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    row = np.concatenate([np.arange(len(offsets) - 1), of])
    order = np.lexsort((starts, row))
    starts, row = starts[order], row[order]
    last = np.r_[row[1:] != row[:-1], True][: len(row)]
    ends = np.where(last, offsets[row + 1], np.r_[starts[1:] - 1, 0][: len(row)])
    first = np.searchsorted(row, np.arange(len(offsets) - 1))
    return starts, ends, row, np.arange(len(row)) - first[row]


def digests(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each span."""
    both = b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    pairs = np.frombuffer(both, ">u8").astype(np.uint64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def points(raw: bytes) -> np.ndarray:
    """The code points of a text; its bytes, if it isn't UTF-8."""
    if raw.isascii():
        return np.frombuffer(raw, np.uint8)
    try:
        return np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:
        return np.frombuffer(raw, np.uint8)


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each code point of data; where the spans start and end in them."""
    point = points(data.tobytes())
    if point.itemsize == 1:
        return BYTE_CODE[point], starts, ends
    code = BYTE_CODE[np.minimum(point, 255)]
    wide = np.flatnonzero(point > 255)
    code[wide] = mix((point[wide].astype(np.uint64) + np.uint64(1)) * np.uint64(GOLDEN))
    place = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    return code, place[starts], place[ends]


def allowed(length: np.ndarray) -> np.ndarray:
    """How many edits lines of these lengths may differ by from longer ones."""
    out = np.zeros(len(length), np.int64)
    for least, k in reversed(EDITS):
        out[length >= least] = k
    return out


def segments(length: np.ndarray, i: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of segment i of limit + 1 of lines of these lengths; the later ones are longer by one."""
    size, longer = length // (limit + 1), length % (limit + 1)
    plain = limit + 1 - longer
    return i * size + np.maximum(i - plain, 0), size + (i >= plain)


def keys(code: np.ndarray, starts: np.ndarray, lengths: np.ndarray, line: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """(key, line) of the index and of the probes of lines in code; the shorter line of a pair is the one in the index."""
    sums = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(code * powers(len(code)), out=sums[1:])
    inverse = backs(len(code) + 1)

    def key(at: np.ndarray, size: np.ndarray, length: np.ndarray, i: int) -> np.ndarray:
        return mix((sums[at + size] - sums[at]) * inverse[at] + mix(length.astype(np.uint64) * np.uint64(64) + np.uint64(i)))

    index, probes = [], []
    for shorter in range(MOST + 1):
        limits = allowed(lengths - shorter)
        for limit in range(max(shorter, 1), MOST + 1):
            own = np.flatnonzero(limits == limit)
            other, begin = lengths[own] - shorter, starts[own]
            for i in range(limit + 1):
                at, size = segments(other, i, limit)
                if not shorter:
                    index.append((key(begin + at, size, other, i), line[own]))
                low = max(-i, shorter - (limit - i))
                high = min(i, shorter + (limit - i))
                for move in range(low, high + 1):
                    fits = (at + move >= 0) & (at + move + size <= lengths[own])
                    probes.append((key((begin + at + move)[fits], size[fits], other[fits], i), line[own][fits]))
    return tuple(tuple(np.concatenate(x) for x in zip(*part, strict=True)) for part in (index, probes))


def segment_blobs(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, ikey, iline, isign, iwhen, pkey, pline, psign, pwhen), packed, of a slice for a bucket.

    Keys have 32 bits, lines and their signatures 64; when: about where the line stands first,
    the doc_id as a short floating-point number (0 if it is none).
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, offsets = text_buffers(b.column("text"))
            starts, ends, row, _ = line_spans(data, offsets)
            code, begin, close = spelled(data, starts, ends)
            use = close - begin >= NEAR
            if not use.any():
                continue
            line, _ = digests(data.tobytes(), starts[use], ends[use])
            starts, ends = begin[use], close[use]
            line, first, back = np.unique(line, return_index=True, return_inverse=True)
            when = np.full(len(line), np.inf)
            np.minimum.at(when, back, b.column("doc_when").to_numpy(zero_copy_only=False)[row[use]])
            order = np.argsort(starts[first])
            line, starts, ends, when = line[order], starts[first][order], ends[first][order], when[order].astype("<f4")
            sign = signatures(code, starts, ends)
            group = (starts // CHUNK).astype(int)
            found: list = [[], []]
            for g in np.unique(group):  # lines of about CHUNK bytes at once
                own = group == g
                low = int(starts[own].min())
                for out, part in zip(found, keys(code[low : int(ends[own].max())], starts[own] - low, (ends - starts)[own], np.flatnonzero(own)), strict=True):
                    out.append(part)
            blobs = []
            for part in found:
                key, of = (np.concatenate(x) for x in zip(*part, strict=True))
                order = np.argsort(key)
                key, of = key[order], of[order]
                edge = np.searchsorted((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1))
                for x in (key.astype("<u4"), line[of], sign[of], when[of]):
                    blobs.append(pa.array([x[i:j].tobytes() for i, j in zip(edge, edge[1:], strict=False)], pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets, dtype=np.int32)), *blobs], ["bucket", *(side + c for side in "ip" for c in PACKED)])

    number = isinstance(docs.schema["doc_id"].dataType, T.NumericType)
    when = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("inf"))) if number else F.lit(0.0)
    return docs.select("text", when.alias("doc_when")).mapInArrow(make, ", ".join(["bucket int", *(f"{side}{c} binary" for side in "ip" for c in PACKED)]))


def signatures(code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How often each of 15 classes of code points occurs in a line, modulo 16, in four bits each; then how many edits the line allows for."""
    lengths = ends - starts
    row = np.repeat(np.arange(len(starts)), lengths)
    at = np.arange(len(row)) - (np.cumsum(lengths) - lengths)[row] + starts[row]
    counts = np.bincount(row * 16 + (code[at] >> np.uint64(60)).astype(np.int64), minlength=16 * len(starts)).reshape(-1, 16)
    counts[:, 0] += counts[:, 15]
    counts[:, 15] = allowed(lengths)
    return ((counts & 15).astype(np.uint64) << (4 * np.arange(16)).astype(np.uint64)).sum(axis=1, dtype=np.uint64)


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether signatures of shorter lines a and longer ones b allow for as many edits as a does."""
    total = np.zeros(len(a), np.int64)
    for k in range(15):
        x = ((a >> np.uint64(4 * k)) - (b >> np.uint64(4 * k))).astype(np.int64) & 15
        total += np.minimum(x, 16 - x)
    return total <= 2 * (a >> np.uint64(60)).astype(np.int64)


def distinct_pairs(key: np.ndarray, line: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each key and line once, with the row that is least by the last column."""
    order = np.lexsort((*more[-1:], line, key))
    key, line = key[order], line[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (line[1:] != line[:-1])][: len(key)]
    return key[new], line[new], *(m[order][new] for m in more)


def met(index: tuple[np.ndarray, ...], probe: tuple[np.ndarray, ...], most: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) with a < b: probes and the first `most` lines of their keys, where signatures are alike. The index is sorted by key."""
    (ikey, iline, isign, _), (pkey, pline, psign, _) = index, probe
    low = np.searchsorted(ikey, pkey, side="left")
    n = np.minimum(np.searchsorted(ikey, pkey, side="right") - low, most)
    out: list = [(pline[:0], pline[:0])]
    for part in np.split(np.arange(len(n)), np.flatnonzero(np.diff(np.cumsum(n) // (1 << 20))) + 1):
        at = np.repeat(low[part] - (np.cumsum(n[part]) - n[part]), n[part]) + np.arange(n[part].sum())
        b = np.repeat(pline[part], n[part])
        near = (iline[at] != b) & alike(isign[at], np.repeat(psign[part], n[part]))
        a, b = iline[at][near], b[near]
        out.append(distinct_pairs(np.minimum(a, b), np.maximum(a, b)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def candidates(blobs: DataFrame, buckets: int, undecided=None) -> DataFrame:
    """(a, b) with a < b: lines where a probe of one finds a segment of the other, and whose signatures are alike.

    Lines of crowded keys are compared with the earliest ones only, and named by rows (a, a).
    With undecided, a filter of lines, instead: the pairs of crowded keys with such a line.
    """
    crowd, first = CROWD, FIRST

    def match(table: pa.Table) -> pa.Table:
        kinds = {"key": "<u4", "line": "<u8", "sign": "<u8", "when": "<f4"}
        index, probe = (distinct_pairs(*[np.frombuffer(b"".join(table.column(side + c).to_pylist()), kinds[c]) for c in PACKED]) for side in "ip")
        order = np.lexsort((index[3], index[0]))
        index = tuple(x[order] for x in index)
        n = np.searchsorted(index[0], probe[0], side="right") - np.searchsorted(index[0], probe[0], side="left")
        many = n > crowd
        few, crowded = tuple(x[(n > 0) & ~many] for x in probe), tuple(x[many] for x in probe)
        inside = np.isin(index[0], crowded[0])
        own = tuple(x[inside] for x in index)  # lines of crowded keys
        if undecided is None:
            named = np.unique(np.r_[crowded[1], own[1]])
            parts = [met(index, few, crowd), met(own, crowded, first), (named, named)]
        else:
            open_ = lambda x: tuple(c[passing(undecided.value, x[1])] for c in x)
            parts = [met(own, open_(crowded), len(own[0])), met(open_(own), crowded, len(own[0]))]
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*parts, strict=True))
        return pa.table({"a": a, "b": b})

    return blobs.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(match, "a long, b long").distinct()


def occurrences(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc, th, line_no) of each line that may go; doc: doc_id as text."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, offsets = text_buffers(b.column("text"))
            starts, ends, row, number = line_spans(data, offsets)
            blank = np.r_[0, np.cumsum(~SPACE[data])]
            use = blank[ends] > blank[starts]
            h1, h2 = digests(data.tobytes(), starts[use], ends[use])
            at = pa.array(row[use])
            yield pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), b.column("doc_id").take(at), b.column("th").take(at), pa.array(number[use].astype(np.int32))], ["h1", "h2", "doc_id", "th", "line_no"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(make, f"h1 long, h2 long, doc_id {kind}, th long, line_no int")


def filtered(ids: DataFrame):
    """A filter of fixed size, broadcast: a bit for each h of ids, and so for some other lines."""
    bit = F.pmod("h", F.lit(FILTER))
    words = ids.groupBy(F.shiftright(bit, 5).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(h, {FILTER}) & 31 as int))")).alias("bits")).toArrow().to_pandas()  # FILTER / 32 rows at most
    table = np.zeros(FILTER // 32, np.uint32)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return ids.sparkSession.sparkContext.broadcast(table)


def passing(bits: np.ndarray, line: np.ndarray) -> np.ndarray:
    at = line.view(np.int64) % FILTER
    return (bits[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1)).astype(bool)


def wanted_texts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(h1, h2, line) for the lines in pairs, and some others that a filter of fixed size lets through."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    held = filtered(ids)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, offsets = text_buffers(b.column("text"))
            starts, ends, _, _ = line_spans(data, offsets)
            use = ends - starts >= NEAR
            starts, ends = starts[use], ends[use]
            raw = data.tobytes()
            h1, h2 = digests(raw, starts, ends)
            new = np.flatnonzero(passing(held.value, h1))
            new = new[np.unique(h1[new], return_index=True)[1]]
            yield pa.RecordBatch.from_arrays([pa.array(h1[new].view(np.int64)), pa.array(h2[new].view(np.int64)), pa.array([raw[i:j] for i, j in zip(starts[new].tolist(), ends[new].tolist(), strict=True)], pa.binary())], ["h1", "h2", "line"])

    found = docs.select("text").mapInArrow(make, "h1 long, h2 long, line binary")
    return found.join(ids, found.h1 == ids.h, "left_semi").dropDuplicates(["h1", "h2"])


def near_enough(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Which pairs of lines are as few edits apart as the shorter one allows for."""
    a, b = ([points(x) for x in side] for side in (left, right))
    limit = allowed(np.array([min(len(x), len(y)) for x, y in zip(a, b, strict=True)], np.int64))
    out = np.zeros(len(a), bool)
    for k in range(1, MOST + 1):
        own = np.flatnonzero(limit == k)
        out[own] = within([a[i] for i in own], [b[i] for i in own], k)
    return out


def within(left: list, right: list, limit: int) -> np.ndarray:
    """Which pairs of sequences of numbers are at most limit edits apart: Hyyrö's banded bit vectors, one pair a lane.

    A lane's word holds the vertical differences of the 2 * limit + 1 rows about the
    diagonal; the band moves down one row with each column.
    """
    out = np.zeros(len(left), bool)
    swap = [len(a) < len(b) for a, b in zip(left, right, strict=True)]
    long = [b if s else a for a, b, s in zip(left, right, swap, strict=True)]
    short = [a if s else b for a, b, s in zip(left, right, swap, strict=True)]
    m, n = np.array([len(x) for x in long], np.int64), np.array([len(x) for x in short], np.int64)
    order = np.flatnonzero((m - n <= limit) & (m > 2 * limit))
    for i in np.flatnonzero((m - n <= limit) & (m <= 2 * limit)):
        out[i] = plain_distance(long[i], short[i]) <= limit
    order = order[np.argsort(-n[order], kind="stable")]
    at = 0
    one = np.uint64(1)
    while at < len(order):
        width = int(m[order[at]])
        lanes = order[at : at + max(1, CHUNK // (width + 1))]
        at += len(lanes)
        columns, rows = width + 2 * limit + 2, len(lanes)
        pattern = np.zeros((rows, columns), np.uint32)  # 0: before and after the line; limit places before
        text = np.full((rows, int(n[lanes].max(initial=0))), 1 << 30, np.uint32)
        for k, i in enumerate(lanes.tolist()):
            pattern[k, limit : limit + m[i]] = long[i]
            pattern[k, limit : limit + m[i]] += 1
            text[k, : n[i]] = short[i]
            text[k, : n[i]] += 1
        pattern, text = np.ascontiguousarray(pattern.T), np.ascontiguousarray(text.T)
        size, turn = n[lanes], m[lanes] - limit
        vp = np.full(rows, (((1 << (limit + 1)) - 1) << (63 - limit)), np.uint64)
        vn = np.zeros(rows, np.uint64)
        distance = np.full(rows, limit, np.int64)
        edge = np.full(rows, 1 << 62, np.uint64)
        for j in range(len(text)):
            live = int(np.searchsorted(-size, -j, side="left"))  # lanes with more than j columns
            c = text[j, :live]
            x = np.zeros(live, np.uint64)
            for k in range(2 * limit + 1):
                x |= (pattern[j + k, :live] == c).astype(np.uint64) << np.uint64(63 - 2 * limit + k)
            p, q = vp[:live], vn[:live]
            d0 = (((x & p) + p) ^ p) | x | q
            hp, hn = q | ~(d0 | p), d0 & p
            down = j < turn[:live]
            distance[:live] += np.where(down, (d0 >> np.uint64(63)) ^ one, ((hp & edge[:live]) > 0).astype(np.int64) - ((hn & edge[:live]) > 0)).astype(np.int64)
            edge[:live] = np.where(down, edge[:live], edge[:live] >> one)
            vp[:live] = hn | ~((d0 >> one) | hp)
            vn[:live] = (d0 >> one) & hp
        out[lanes] = distance <= limit
    return out


def plain_distance(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def links(docs: DataFrame, undecided=None) -> tuple[DataFrame, DataFrame]:
    """(a1, a2, b1, b2): different lines as few edits apart as they may be, once each; and (h1), the lines of crowded keys (see candidates)."""
    buckets = partitions(docs.sparkSession)
    found = cut(candidates(segment_blobs(docs, buckets), buckets, undecided))
    pairs, many = found.filter("a <> b"), found.filter("a = b").select(F.col("a").alias("h1"))
    texts = cut(wanted_texts(docs, pairs))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = near_enough(b.column("left").to_pylist(), b.column("right").to_pylist())
            yield b.select(["a1", "a2", "b1", "b2"]).filter(pa.array(near))

    a = texts.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("line").alias("left"))
    b = texts.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("line").alias("right"))
    both = pairs.join(a, F.col("a") == F.col("a1")).join(b, F.col("b") == F.col("b1"))
    both = both.filter(F.abs(F.length("left") - F.length("right")) <= 4 * MOST)  # bytes of a code point
    return cut(both.select("a1", "a2", "b1", "b2", "left", "right").mapInArrow(verify, "a1 long, a2 long, b1 long, b2 long")), many


def earlier(pairs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h1, h2, other): where the earliest of a line's near lines stands first."""
    both = pairs.unionByName(pairs.select(F.col("b1").alias("a1"), F.col("b2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2")))
    other = firsts.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("first").alias("other"))
    return both.join(other, ["b1", "b2"]).groupBy(F.col("a1").alias("h1"), F.col("a2").alias("h2")).agg(F.min("other").alias("other"))


def removals(docs: DataFrame) -> DataFrame:
    """(doc_id, th, gone): the numbers of the lines to remove from a document."""
    spots = stored(occurrences(docs))
    place = F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id"), F.col("line_no"))
    firsts = cut(spots.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")))
    pairs, many = links(docs)
    if not many.isEmpty():
        gone = firsts.join(earlier(pairs, firsts), ["h1", "h2"]).filter("other < first").select("h1")
        left = cut(many.join(gone, "h1", "left_anti"))
        if not left.isEmpty():
            more, _ = links(docs, filtered(left.withColumnRenamed("h1", "h")))
            pairs = pairs.unionByName(more)
    near = earlier(pairs, firsts)
    bad = cut(firsts.join(near, ["h1", "h2"], "left").filter("n > 1 or other < first").select("h1", "h2", "n", F.least("first", "other").alias("first")))
    most = max(1000, int((firsts.agg(F.sum("n")).first()[0] or 0) * HOT))
    hot = F.broadcast(bad.filter(F.col("n") > most).drop("n"))  # fewer than 1 / HOT rows
    cold = bad.filter(F.col("n") <= most).drop("n")
    gone = spots.join(hot, ["h1", "h2"]).unionByName(spots.join(hot.select("h1", "h2"), ["h1", "h2"], "left_anti").join(cold, ["h1", "h2"])).filter(place > F.col("first"))
    return gone.groupBy("doc_id", "th").agg(F.collect_set("line_no").alias("gone"))


def deduped(docs: DataFrame, counts: bool = False) -> DataFrame:
    """docs with the removed lines gone from text (and n_chars as long as it is then); counts adds n_lines and n_removed."""
    doc, th, numbers = (unused(docs, c) for c in ("line_doc", "line_th", "line_gone"))
    gone = removals(docs).select(F.col("doc_id").alias(doc), F.col("th").alias(th), F.col("gone").alias(numbers))
    joined = docs.join(gone, docs.doc_id.eqNullSafe(gone[doc]) & (F.xxhash64(docs.text) == gone[th]), "left")
    lines = F.split("text", "\n", -1)
    text = F.when(F.col(numbers).isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(numbers, i)), "\n"))
    columns = {c: F.col(c) for c in docs.columns} | {"text": text.alias("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.col(numbers).isNull(), F.col("n_chars")).otherwise(F.length(text).cast(kind)).alias("n_chars")
    columns = list(columns.values())
    if counts:
        columns += [F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size(numbers), F.lit(0)).cast("long").alias("n_removed")]
    return joined.select(*columns)


def digest(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def query(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256)."""
    out = deduped(docs.select("doc_id", "text"), counts=True)
    return out.select("doc_id", F.greatest("n_lines", F.lit(0)).alias("n_lines"), F.greatest("n_removed", F.lit(0)).alias("n_removed"), digest("text").alias("kept_sha256"))
