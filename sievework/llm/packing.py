"""Packing token sequences into windows by non-negative least squares.

Each document becomes its tokenizer ids and one end id.  Every full window of a document
is a sequence of its own; what remains is shorter than a window, so the remainders are
described by a histogram of at most `window` lengths.  On the driver shallow combinations
of lengths that fill a window exactly are enumerated (all pairs and triples, quadruples of
two lengths), how often to use each is the solution of a non-negative least-squares problem
against the histogram, and the counts are rounded and kept within what there is; what
rounding leaves is solved again while that places rows.  The residuals are packed greedily
into windows that they fill.  What fills none is laid end to end and cut at the windows'
edges.  Only the very last sequence is padded.

A document's place follows from its length and its rank among the rows of that length.
Ranks are counted in salted groups, so a length that a third of all rows share is spread.

Null and empty texts are the end id alone.  Repeated rows are packed once each.
"""

from __future__ import annotations

import os
import re
import string
import unicodedata
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import compress, repeat
from operator import is_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, slices, stored

WINDOW = 2048
END = 1
#: A sweep or a round that leaves more than this share of the (squared) rest is the last one.
SETTLED = 0.9
#: How many words an encoder remembers at most.
CACHE = 450_000
#: What stands between words that are encoded together, and how many of them.
MARK = "|"
TOGETHER = 100
#: Marks that begin a piece of their own after a letter or digit; an apostrophe may begin one of letters.
MARKS = string.punctuation.replace("'", "").replace(MARK, "")
BEFORE_MARKS = re.compile(rf"[{re.escape(MARKS)}](?<=[^\W_].)")
#: A tokenizer that gives other ids for these without its normalizer and its way of splitting isn't used without them.
PROBE = ("the quick brown fox jumps over the lazy dog | internationalization zzyzx", "größer été naïve œuvre ñandú Привет漢字 | straße".lower())


class Encoder:
    """A tokenizer of white-space separated words that remembers the words it has seen.

    The tokenizer lower-cases and drops white space, so a text's ids are those of its
    words.  Texts for which that is not certain go to the tokenizer whole.
    """

    #: Separators on which the two kinds of splitting differ, a letter whose lower case depends on its place, special tokens.
    odd = ("\x1c", "\x1d", "\x1e", "\x1f", "Σ", "<|")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # small letters, composed, are nothing to normalize, and a word of them is one piece; ASCII bytes stand for themselves
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.ascii = self.bare(pre_tokenizers.WhitespaceSplit(), PROBE[0])
        self.letters = self.bare(pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytewise]), PROBE[1])
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.mark = self.tokenizer.token_to_id(f"{MARK}</w>")
        #: Which ids end a piece; None, if not every byte can.
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        if not all(f"{c}</w>" in vocab for c in pre_tokenizers.ByteLevel.alphabet()):
            self.last = None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def bare(self, splits, probe: str):
        """A tokenizer with the same model that only splits; the whole one, if they differ on the probe."""
        from tokenizers import Tokenizer

        out = Tokenizer(self.tokenizer.model)
        out.pre_tokenizer = splits
        one, other = (t.encode(probe, add_special_tokens=False).ids for t in (out, self.tokenizer))
        return out if one == other else self.tokenizer

    def whole(self, texts: list[str]) -> list[bytes]:
        code = self.code
        return [array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def parted(self, words: list[str], tokenizer, between: str, last: np.ndarray) -> Iterator[tuple[str, bytes]]:
        """Each word and its ids, from texts of many words; last: of an id, whether it is the last one of a word or what stands between."""
        size, cut = self.kind.itemsize, len(between.split())
        parts = [words[k : k + TOGETHER] for k in range(0, len(words), TOGETHER)]
        for part, e in zip(parts, tokenizer.encode_batch_fast([between.join(part) for part in parts], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.kind)
            ends = (np.flatnonzero(last[ids]) + 1) * size
            raw, begins, ends = ids.tobytes(), [0, *ends.tolist()], [*(ends - cut * size).tolist(), len(ids) * size]
            yield from zip(part, [raw[a:b] for a, b in zip(begins[: len(part)], ends[: len(part)], strict=True)], strict=True)

    def single(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each word and its ids; many words go to the tokenizer as one text.

        A word of letters is one piece, whose last id can only be a last one.  Between others
        stand marks: token sequences of one id, which only words that hold the mark can have.
        """
        kinds: tuple[list[str], ...] = ([], [], [], [])
        for w in words:
            kinds[w.isalpha() and 1 + w.isascii() or 3 * (MARK in w)].append(w)
        plain, letters, ascii_letters, other = kinds
        if self.last is None or self.letters is self.tokenizer or self.ascii is self.tokenizer:
            plain, letters, ascii_letters = plain + letters + ascii_letters, [], []
        for own, tokenizer in ((letters, self.letters), (ascii_letters, self.ascii)):
            yield from self.parted(own, tokenizer, " ", self.last)
        if self.mark is None:
            other, plain = other + plain, []
        else:
            yield from self.parted(plain, self.tokenizer, f" {MARK} ", np.arange(self.tokenizer.get_vocab_size()) == self.mark)
        yield from zip(other, self.whole(other), strict=True)

    def words(self, text: str) -> list[str] | None:
        """The text's words, without the marks after a letter or digit, which are words of their own; None, if it must stay whole."""
        if any(x in text for x in self.odd) or not composed(text):
            return None
        low = text.lower()
        return BEFORE_MARKS.sub(r" \g<0>", low).split() if composed(low) else None

    def learn(self, words: set[str]) -> None:
        """Sees to it that all these words are known."""
        again = words & self.older.keys()
        self.known.update((w, self.older[w]) for w in again)
        self.known.update(self.single(list(words - again)))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, with the end id."""
        if len(self.known) > CACHE // 2:  # what isn't used meanwhile is forgotten next time
            self.known, self.older = {}, self.known
        get = self.known.get
        split: list[tuple[list[str], list, list[int]] | None] = []  # words, what is known of them, places of those that aren't known
        new: set[str] = set()
        for t in texts:
            if (words := self.words(t)) is None:
                split.append(None)
                continue
            found = list(map(get, words))
            holes = list(compress(range(len(words)), map(is_, found, repeat(None)))) if None in found else []
            new.update(map(words.__getitem__, holes))
            split.append((words, found, holes) if holes else ([], [b"".join(found)], holes))
        self.learn(new)
        end = np.array([END], self.kind).tobytes()
        out = []
        for t, own in zip(texts, split, strict=True):
            if own is None:
                parts = self.whole([t])
            else:
                words, parts, holes = own
                for k in holes:
                    parts[k] = self.known[words[k]]
            out.append(np.frombuffer(b"".join(parts) + end, self.kind))
        return out


def composed(text: str) -> bool:
    """Whether the text is its own composed form; a text of Latin-1 is."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return unicodedata.is_normalized("NFC", text)
    return True


_encoders: dict[str, Encoder] = {}


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokens(docs: DataFrame, path: str, window: int, salts: int, most: int) -> DataFrame:
    """A row for each document: its full windows' checksums, and the ids that remain."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encoder = _encoders[path]
        for b in slices(batches, most=most):
            ids = encoder.ids([t or "" for t in b.column("text").to_pylist()])
            full = [len(x) // window for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array(full, pa.int64()),
                    pa.array([len(x) % window for x in ids], pa.int32()),
                    pa.array([[crc(x[k * window : (k + 1) * window]) for k in range(n)] for x, n in zip(ids, full, strict=True)], pa.list_(pa.int64())),
                    pa.array([x[n * window :].tobytes() for x, n in zip(ids, full, strict=True)], pa.binary()),
                    pa.array([encoder.kind.itemsize] * len(ids), pa.int32()),
                ],
                ["doc_id", "n", "full", "length", "checks", "rest", "unit"],
            )
        encoder.older = {}  # a worker that waits holds less

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", "text").mapInArrow(make, f"doc_id {kind}, n long, full long, length int, checks array<long>, rest binary, unit int")
    return made.withColumn("mark", F.crc32("rest")).withColumn("salt", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(salts)).cast("int"))


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All pairs and triples of lengths that fill the window, and quadruples of two lengths, a row each; 0 fills up."""
    have = np.zeros(window + 1, bool)
    have[lengths[(lengths > 0) & (lengths < window)]] = True
    at = np.flatnonzero(have)
    none = np.zeros_like(at)

    def kept(*columns: np.ndarray) -> np.ndarray:
        """The rows whose last length occurs, in order of length."""
        last = columns[-1]
        rows = np.stack(columns, axis=1)[(last > 0) & have[np.maximum(last, 0)]]
        return np.sort(rows, axis=1)

    low, few = at[2 * at <= window], none[2 * at <= window]
    found = [kept(few, few, low, window - low), kept(at, at, at, window - 3 * at)]
    if window % 2 == 0:
        low = at[4 * at < window]
        found.append(kept(low, low, window // 2 - low, window // 2 - low))
    first, second = np.nonzero(np.triu(have[at][:, None] & have[at]))
    first, second = at[first], at[second]
    third = window - first - second
    use = third >= second
    found.append(kept(0 * first[use], first[use], second[use], third[use]))
    return np.concatenate(found)


def descend(columns: list[tuple[int, ...]], x: list[float], left: list[float]) -> None:
    """Coordinate descent on x and what it leaves of each length, until a sweep gains next to nothing."""
    norms = [sum(c.count(a) for a in c) for c in columns]
    last = sum(v * v for v in left)
    while last:
        for j, c in enumerate(columns):
            step = max(sum(map(left.__getitem__, c)) / norms[j], -x[j])
            if step:
                x[j] += step
                for a in c:
                    left[a] -= step
        now = sum(v * v for v in left)
        if now > SETTLED * last:
            return
        last = now


def solve(columns: np.ndarray, counts: np.ndarray) -> tuple[list[tuple[int, ...]], list[float]]:
    """Combinations and how often to use each: x >= 0 that brings sum_c x_c * (how often a length is in c) near counts.

    An active set: in each round every combination is priced, and for each length the one
    that lowers the squared rest the most joins those in use.
    """
    left = counts.astype(float).tolist()
    norm = sum((columns[:, [i]] == columns) & (columns[:, [i]] > 0) for i in range(columns.shape[1])).sum(axis=1)
    tie = 1 + 1e-6 * (np.arange(len(columns)) * 40503 % 65536) / 65536  # equal gains don't all meet in one length
    active: list[tuple[int, ...]] = []
    x: list[float] = []
    last = float(np.square(counts, dtype=float).sum())
    while len(columns):
        rest = np.array(left)
        rest[0] = 0
        step = rest[columns].sum(axis=1) / norm
        gain = np.where(step > 0, step * step * norm, 0) * tie
        best = np.zeros(len(counts))
        for k in range(columns.shape[1]):
            np.maximum.at(best, columns[:, k], gain)
        best[0] = np.inf
        join = ((gain[:, None] == best[columns]) & (gain[:, None] > 0)).any(axis=1)
        known = set(active)
        fresh = [c for c in (tuple(v for v in row if v) for row in columns[join].tolist()) if c not in known]
        active, x = active + fresh, x + [0.0] * len(fresh)
        descend(active, x, left)
        used = [j for j, v in enumerate(x) if v > 0]
        active, x = [active[j] for j in used], [x[j] for j in used]
        now = sum(v * v for v in left)
        if not fresh or now > SETTLED * last:
            break
        last = now
    return active, x


def filled(left: np.ndarray, longest: int, window: int) -> list[int] | None:
    """Lengths that fill a window with the longest, from what is left: the largest not longer that fit, the last one or two so that they end at its edge."""
    free = left.copy()
    free[longest] -= 1
    out, room = [longest], window - longest
    while room:
        if free[room] > 0:
            return [*out, room]
        low = np.arange(1, room // 2 + 1)
        pair = low[(free[low] > 0) & (free[room - low] > (low == room - low))]
        if len(pair):
            return [*out, room - int(pair[-1]), int(pair[-1])]
        fits = np.flatnonzero(free[: min(room, longest + 1)] > 0)
        if not len(fits):
            return None
        out.append(int(fits[-1]))
        free[out[-1]] -= 1
        room -= out[-1]
    return out


def plan(counts: dict[int, int], window: int) -> tuple[dict[int, tuple[list[int], list[tuple[int, int]]]], int, dict[str, int]]:
    """Where each length's slots are, the sequences used, and how many rows went which way.

    For each length: the ranks at which its slots begin, and (first sequence, offset) of
    each slot.  The slot at the last of those ranks is that of the rows left over: its pair
    holds None and the place of the first one in the stream of them.
    """
    left = np.zeros(window + 1, np.int64)
    left[list(counts)] = list(counts.values())
    left[0] = 0
    used = 0
    ways = {"least_squares": 0, "greedy": 0, "stream": 0}
    out: dict[int, tuple[list[int], list]] = {a: ([], []) for a in counts}

    def use(c: list[int] | tuple[int, ...], n: int, way: str) -> None:
        nonlocal used
        offset = 0
        for a in c:
            out[a][0].append(counts[a] - int(left[a]))
            out[a][1].append((used, offset))
            left[a] -= n
            offset += a
        used += n
        ways[way] += n * len(c)

    def most(c: list[int] | tuple[int, ...]) -> int:
        return min(int(left[a]) // c.count(a) for a in c)

    while left.any():  # what rounding leaves is a smaller problem of the same kind
        rest = left.sum()
        columns, x = solve(combinations(np.flatnonzero(left), window), left)
        for j in sorted(range(len(x)), key=lambda j: (-x[j], columns[j])):
            n = min(int(x[j] + 0.5), most(columns[j]))
            if n > 0:
                use(columns[j], n, "least_squares")
        if left.sum() > SETTLED * rest:
            break
    for a in range(window - 1, 0, -1):
        while left[a] and (c := filled(left, a, window)):
            use(c, most(c), "greedy")
    stream = 0
    for a in sorted(counts, reverse=True):
        out[a][0].append(counts[a] - int(left[a]))
        out[a][1].append((None, stream))
        stream += a * int(left[a])
        ways["stream"] += int(left[a])
    return out, used, ways


def pieces(docs: DataFrame, path: str, window: int = WINDOW, most: int = 1 << 18) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for each piece; `most` bytes of text are looked at together."""
    spark = docs.sparkSession
    rows = stored(tokens(docs, path, window, partitions(spark), most))
    cells = rows.groupBy("length", "salt").agg(F.count("*").alias("rows"), F.sum("full").alias("fulls"))
    before = "over (partition by length order by salt)"
    cells = cells.select("length", "salt", "rows", "fulls", F.expr(f"sum(rows) {before} - rows").alias("rank_base"), F.expr(f"sum(fulls) {before} - fulls").alias("full_base"))
    totals = sorted(tuple(r) for r in cells.groupBy("length").agg(F.sum("rows"), F.sum("fulls")).collect())  # at most `window` rows
    places, used, _ = plan({a: n for a, n, _ in totals if a}, window)
    whole, at = {}, used
    for a, _, fulls in totals:
        whole[a] = at
        at += fulls
    after = at  # the sequences of the residual stream come last
    order = "over (partition by length, salt order by doc_id, n, mark rows unbounded preceding)"
    numbered = rows.select("*", F.expr(f"row_number() {order} - 1").alias("r"), F.expr(f"sum(full) {order} - full").alias("f"))
    numbered = numbered.join(cells.select("length", "salt", "rank_base", "full_base"), ["length", "salt"])
    numbered = numbered.select("doc_id", "n", "full", "length", "checks", "rest", "unit", (F.col("r") + F.col("rank_base")).alias("rank"), (F.col("f") + F.col("full_base")).alias("first"))
    held = spark.sparkContext.broadcast((places, whole, after))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, whole, after = held.value
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for b in slices(batches, "rest"):
            out, source = [], []
            columns = [b.column(c).to_pylist() for c in ("n", "full", "length", "checks", "rest", "unit", "rank", "first")]
            for i, (n, full, length, checks, rest, unit, rank, first) in enumerate(zip(*columns, strict=True)):
                begin = len(out)
                for k in range(full):
                    out.append((k * window, window, checks[k], n, whole[length] + first + k, 0))
                if length:
                    ids = np.frombuffer(rest, f"<u{unit}")
                    ranks, slots = places[length]
                    s = bisect_right(ranks, rank) - 1
                    seq, offset = slots[s]
                    if seq is not None:
                        out.append((full * window, length, crc(ids), n, seq + rank - ranks[s], offset))
                    else:
                        low = offset + (rank - ranks[s]) * length
                        high, done = low + length, low
                        while done < high:
                            stop = min(high, (done // window + 1) * window)
                            out.append((full * window + done - low, stop - done, crc(ids[done - low : stop - low]), n, after + done // window, done % window))
                            done = stop
                source += [i] * (len(out) - begin)
            numbers = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(source, pa.int64())), *(pa.array(x, pa.int64()) for x in numbers)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(place, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(docs: DataFrame) -> DataFrame:
    return pieces(docs, default_path())
