"""Language-model scores: a probabilistic suffix tree over words beside smoothed word counts.

The symbols are the contract's tokens: lower-cased words, one end mark for each text, and
one symbol for all words that no training text has.  A context is the last one to `depth`
words; it is a state of the tree if its next-symbol distribution diverges from that of its
longest proper suffix by `diverge` nats in all, over the next symbols that were seen at
least `least` times there.  A state's distribution is smoothed with its suffix's: `discount`
is taken off each such count, and what that and the rarer next symbols leave goes to the
suffix.  The root is the word counts' own distribution, so a text without states scores as
these do.  A token is scored by the longest suffix of what precedes it that is a state.

So the logarithm of a text's probability is that of the word counts, plus a value for each
occurrence of a state and of a known (state, next symbol): it is a sum over the text's
n-grams, and neither counts nor states ever are in one place.

Texts are encoded once, in slices: a dictionary of word hashes and numbers into it, in a
table that is bucketed by slice.  A slice sends each of its distinct n-grams once to the
bucket that counts it, as packed arrays, and gets the counts back.  The first slice that has
a frequent n-gram tells Spark about it; Spark derives states and values from those rows by
joins and aggregations, and the slices ask the buckets for the values of those n-grams that
a filter of bounded size lets through.  Buckets are sized by
the number of tokens.  All thresholds are absolute counts, so there are more states the more
texts there are.

Words are told apart by 64-bit hashes, longer n-grams by as many bits as make a clash less
likely than 2 ** -16 for each.  A null text is empty: its one token is the end.  Repeated
rows are repeated in the result and each counts.  Without training rows all counts are 0
and every text scores 0.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, fold, mix, new_path, partitions, slices, span_hashes, stored, text_buffers, word_spans

#: The longest context, in words.
DEPTH = 2
#: Least count of an n-gram that the tree knows.
LEAST = 4
#: Least divergence of a state from its suffix: nats in all, over the context's occurrences.
DIVERGE = 6.0
#: What is taken off each count.
DISCOUNT = 0.5
#: Bytes of text in a slice; tokens for each bucket.
SLICE, SHARE = 4 << 20, 1_000_000
#: The filter of n-grams that have a value has 2 ** FILTER bits at most; beyond that it lets more through.
FILTER = 26
END = np.uint64(0x5851F42D4C957F2D)
OWNER = np.uint32(1 << 31)


def squeezed(values: np.ndarray) -> bytes:
    """The values' first bytes, then their second bytes, and so on, compressed."""
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()
    return struct.pack("<q", len(raw)) + pa.compress(raw, codec="zstd", asbytes=True)


def restored(raw: bytes, kind: str) -> np.ndarray:
    n = struct.unpack_from("<q", raw)[0]
    flat = np.frombuffer(pa.decompress(memoryview(raw)[8:], n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def steps(rising: np.ndarray) -> bytes:
    """Like squeezed(), of numbers that rise."""
    return squeezed(np.diff(rising, prepend=rising.dtype.type(0)).astype(rising.dtype))


def summed(raw: bytes) -> np.ndarray:
    return np.cumsum(restored(raw, "<u8"), dtype=np.uint64)


def encoded(docs: DataFrame, learn: Column) -> DataFrame:
    """A row for each slice: its documents, whether they are learned from, their sizes with the end, a dictionary and numbers into it.

    The table is bucketed by slice, so that joining it by slice doesn't move it.  It is in the
    catalog only while it is written: what was read of it knows its files and buckets.
    """
    kind = docs.schema["doc_id"].dataType

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, b in enumerate(slices(batches, most=SLICE)):
            data, offsets = text_buffers(b.column("text"))
            low = LOWER[data]
            starts, ends, row = word_spans(low, offsets)
            count = np.bincount(row, minlength=b.num_rows) + 1
            close = np.cumsum(count) - 1
            tokens = np.full(int(count.sum()), END, np.uint64)
            inside = np.ones(len(tokens), bool)
            inside[close] = False
            tokens[inside] = span_hashes(low, starts, ends)
            words, ids = np.unique(tokens, return_inverse=True)
            train = b.column("learn").to_numpy(zero_copy_only=False).astype(np.uint8)
            blobs = (squeezed(train), squeezed(count.astype("<u4")), steps(words), squeezed(ids.astype("<u4")))
            doc = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column("doc_id"))
            yield pa.RecordBatch.from_arrays([pa.array([task << 32 | number], pa.int64()), doc, *(pa.array([x], pa.binary()) for x in blobs), pa.array([len(tokens)], pa.int64()), pa.array([int((train * count).sum())], pa.int64())], ["slice", "doc", "train", "size", "words", "ids", "tokens", "learned"])

    spark = docs.sparkSession
    made = docs.select("doc_id", "text", learn.alias("learn")).mapInArrow(make, f"slice long, doc array<{kind.simpleString()}>, train binary, size binary, words binary, ids binary, tokens long, learned long")
    name = f"sievework_{uuid.uuid4().hex}"
    made.write.bucketBy(partitions(spark), "slice").options(path=new_path(spark), compression="none").format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files are outside the catalog's folder and stay
    return table


def row_of(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Of the one row: training marks and sizes of the documents, the dictionary, each token's number in it and document."""
    train, size = restored(table.column("train")[0].as_py(), "u1").astype(bool), restored(table.column("size")[0].as_py(), "<u4").astype(np.int64)
    ids = restored(table.column("ids")[0].as_py(), "<u4").astype(np.int64)
    return train, size, summed(table.column("words")[0].as_py()), ids, np.repeat(np.arange(len(size)), size)


def codes(words: np.ndarray, ids: np.ndarray, size: np.ndarray, depth: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length 2 to depth + 1: the n-grams that lie in one document, as (place of the last token, code).

    The code of an n-gram is made of its first token and the code of the rest; it has its
    bits at the upper end, so that cutting it short keeps the order.
    """
    token = words[ids]
    place = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
    out, code = [], token
    for k in range(1, depth + 1):
        first = np.r_[np.zeros(min(k, len(token)), np.uint64), token[:-k]]
        code = mix(first * np.uint64(0x9E3779B97F4A7C15) + code + np.uint64(k))
        at = np.flatnonzero(place >= k)
        out.append((at, code[at] >> np.uint64(64 - bits)))
    return out


def dealt(code: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Where each bucket's part of the rising codes begins, and the end."""
    top = code >> np.uint64(bits - 32)
    return np.searchsorted((top * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1))


def distinct_codes(found: list[tuple[np.ndarray, np.ndarray]], train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, and how often each occurs in training tokens."""
    both = np.concatenate([np.zeros(0, np.uint64), *(code << np.uint64(1) | train[at].astype(np.uint64) for at, code in found)])
    both.sort()
    code = both >> np.uint64(1)
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][: len(code)])
    return code[first], np.add.reduceat((both & np.uint64(1)).astype(np.int64), first) if len(first) else np.zeros(0, np.int64)


def requests(slices_: DataFrame, depth: int, bits: int, buckets: int) -> DataFrame:
    """(slice, bucket, w, wn, g, gn): a slice's distinct words and longer n-grams for a bucket, with their training counts."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                table = pa.Table.from_batches([b.slice(k, 1)])
                train, size, words, ids, row = row_of(table)
                learned = train[row]
                often = np.bincount(ids[learned], minlength=len(words))
                code, n = distinct_codes(codes(words, ids, size, depth, bits), learned)
                w, g = dealt(words, 64, buckets), dealt(code, bits, buckets)
                used = np.flatnonzero((np.diff(w) > 0) | (np.diff(g) > 0))
                blobs = [[steps(words[w[i] : w[i + 1]]), squeezed(often[w[i] : w[i + 1]].astype("<u4")), steps(code[g[i] : g[i + 1]]), squeezed(n[g[i] : g[i + 1]].astype("<u4"))] for i in used]
                yield pa.RecordBatch.from_arrays([pa.array([table.column("slice")[0].as_py()] * len(used), pa.int64()), pa.array(used.astype(np.int32)), *(pa.array([x[c] for x in blobs], pa.binary()) for c in range(4))], ["slice", "bucket", "w", "wn", "g", "gn"])

    return slices_.select("slice", "train", "size", "words", "ids").mapInArrow(make, "slice long, bucket int, w binary, wn binary, g binary, gn binary")


def answers(asked: DataFrame, least: int, buckets: int) -> DataFrame:
    """For each slice and bucket the counts in all training texts; of n-grams only those of `least` or more, marked for one slice that has it."""

    def total(codes_: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        _, first, back = np.unique(np.concatenate(codes_), return_index=True, return_inverse=True)
        return np.bincount(back, np.concatenate(counts), len(first)).astype(np.int64), first, back

    def answer(table: pa.Table) -> pa.Table:
        take = lambda c, f: [f(x) for x in table.column(c).to_pylist()]
        words = take("w", summed)
        ends = np.cumsum([len(x) for x in words])[:-1]
        n, _, back = total(words, take("wn", lambda x: restored(x, "<u4")))
        known = int((n > 0).sum())
        replies = np.split(n[back].astype("<u4"), ends)
        grams = take("g", summed)
        ends = np.cumsum([len(x) for x in grams])[:-1]
        n, first, back = total(grams, take("gn", lambda x: restored(x, "<u4")))
        n[n < least] = 0
        out = n[back].astype("<u4")
        out[first[n > 0]] |= OWNER
        return pa.table({"slice": table.column("slice"), "bucket": table.column("bucket"), "w": pa.array([squeezed(x) for x in replies], pa.binary()), "g": pa.array([squeezed(x) for x in np.split(out, ends)], pa.binary()), "distinct": pa.array([known, *[0] * (table.num_rows - 1)], pa.int64())})

    return asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(answer, "slice long, bucket int, w binary, g binary, distinct long")


KINDS = [(c, t) for c, t in (("kind", pa.int32()), ("slice", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("k", pa.int32()), ("ctx", pa.int64()), ("gram", pa.int64()), ("rest", pa.int64()), ("n", pa.int64()), ("total", pa.int64()), ("p", pa.float64()))]


def resolved(slices_: DataFrame, replies: DataFrame, depth: int, bits: int, tokens: int, distinct: int) -> DataFrame:
    """kind 0: a slice's base scores and known tokens; 1: n-grams of `least` or more, each once.

    ctx: the context's code; rest: that of the n-gram without its first word; total: the
    context's count; p: the last word's probability by the word counts.
    """
    whole = np.log10(tokens + distinct + 1)

    def make(own: pa.Table, got: pa.Table) -> pa.Table:
        def part(rows: int, **columns) -> pa.Table:
            return pa.table([pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in KINDS], [c for c, _ in KINDS])

        _, size, words, ids, row = row_of(own)
        name = own.column("slice")[0].as_py()
        order = np.argsort(got.column("bucket").to_numpy())
        w, g = got.column("w").to_pylist(), got.column("g").to_pylist()
        c = np.concatenate([restored(w[i], "<u4") for i in order]).astype(np.int64)
        marks = np.concatenate([np.zeros(0, "<u4"), *(restored(g[i], "<u4") for i in order)])
        found = codes(words, ids, size, depth, bits)
        code, _ = distinct_codes(found, np.zeros(len(ids), bool))
        n = (marks & ~OWNER).astype(np.int64)
        base = np.bincount(row, (np.log10(c + 1) - whole)[ids], len(size))
        known = np.bincount(row, (c > 0)[ids], len(size)).astype(np.int64)
        out = [part(1, kind=[0], slice=[name], a=[squeezed(base)], b=[squeezed(known)])]
        place = np.zeros(len(ids), np.int64)  # of the n-gram one shorter that ends here, in `code`
        for k, (at, own_code) in enumerate(found, 1):
            before = place
            place = np.zeros(len(ids), np.int64)
            place[at] = np.searchsorted(code, own_code)
            mine = at[(marks[place[at]] & OWNER) > 0]
            _, once = np.unique(place[mine], return_index=True)
            mine = mine[once]
            it, prior = place[mine], mine - 1
            columns = {"gram": code[it], "n": n[it], "p": (c[ids[mine]] + 1) / (tokens + distinct + 1)}
            if k == 1:
                columns |= {"ctx": words[ids[prior]], "rest": np.zeros(len(mine), np.uint64), "total": c[ids[prior]]}
            else:
                columns |= {"ctx": code[before[prior]], "rest": code[before[mine]], "total": n[before[prior]]}
            sound = columns["total"] >= columns["n"]  # else rarer n-grams clash, and their context is as rare
            columns = {x: (v.view(np.int64) if v.dtype == np.uint64 else v)[sound] for x, v in columns.items()}
            out.append(part(int(sound.sum()), kind=[1] * int(sound.sum()), k=[k] * int(sound.sum()), **columns))
        return pa.concat_tables(out)

    schema = ", ".join(f"{c} {'int' if t == pa.int32() else 'long' if t == pa.int64() else 'double' if t == pa.float64() else 'binary'}" for c, t in KINDS)
    return slices_.select("slice", "train", "size", "words", "ids").groupBy("slice").cogroup(replies.select("slice", "bucket", "w", "g").groupBy("slice")).applyInArrow(make, schema)


def states(model: DataFrame, depth: int = DEPTH, diverge: float = DIVERGE, discount: float = DISCOUNT) -> tuple[DataFrame, DataFrame]:
    """The tree's states (k, ctx, total, share) and the n-grams' (k, gram, ctx, p, gain).

    share: the part of a state's distribution that its suffix gives; p: the smoothed
    probability of the n-gram's last symbol after its first k; gain: log10 of p over what
    the suffix's part alone would be, null where the context is no state.
    """
    all_states = grams = None
    for k in range(1, depth + 1):
        own = model.filter(F.col("k") == k)
        if grams is None:
            own = own.withColumn("before", F.col("p"))
        else:
            shorter = level.select(F.col("gram").alias("rest"), F.col("p").alias("before"))
            own = own.drop("before").join(shorter, "rest")
        found = own.groupBy("ctx").agg(F.max("total").alias("whole"), F.sum("n").alias("kept"), F.count("*").alias("kinds"), F.sum(F.col("n") * F.log(F.col("n") / F.col("total") / F.col("before"))).alias("diverges"))
        found = stored(found.filter(F.col("diverges") >= diverge).select("ctx", F.col("whole").alias("total"), ((F.greatest(F.col("whole") - F.col("kept"), F.lit(0)) + discount * F.col("kinds")) / F.col("whole")).alias("share")))
        level = own.select("gram", "ctx", "n", "before").join(found, "ctx", "left")
        lower = F.col("share") * F.col("before")
        level = stored(level.select("gram", "ctx", F.coalesce((F.col("n") - discount) / F.col("total") + lower, F.col("before")).alias("p"), F.log10(1 + (F.col("n") - discount) / F.col("total") / lower).alias("gain")))
        own_states, own_grams = found.select(F.lit(k).alias("k"), "*"), level.select(F.lit(k).alias("k"), "*")
        all_states = own_states if all_states is None else all_states.unionByName(own_states)
        grams = own_grams if grams is None else grams.unionByName(own_grams)
    return all_states, grams


def values(found: tuple[DataFrame, DataFrame]) -> DataFrame:
    """(word, code, value): what each occurrence of a word, or of a longer n-gram, adds to a text's score."""
    own, grams = found
    one = own.select((F.col("k") == 1).alias("word"), F.col("ctx").alias("code"), F.log10("share").alias("value"))
    two = grams.filter("gain is not null").select(F.lit(False).alias("word"), F.col("gram").alias("code"), F.col("gain").alias("value"))
    return one.unionByName(two).groupBy("word", "code").agg(F.sum("value").alias("value"))


def sieve(table: DataFrame) -> np.ndarray:
    """A bit for each of the lowest bits of the codes in table; FILTER bits at most."""
    size = 1 << min(FILTER, max(10, (16 * table.count()).bit_length()))
    low = F.col("code").bitwiseAND(F.lit(size - 1))
    words = table.groupBy(F.shiftright(low, 5).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((code & {size - 1}) & 31 as int))")).alias("bits")).toArrow()  # 2 ** FILTER / 32 rows at most
    out = np.zeros(size // 32, np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def passing(bits: np.ndarray, code: np.ndarray) -> np.ndarray:
    low = (code & np.uint64(32 * len(bits) - 1)).astype(np.int64)
    return code[(bits[low >> 5] >> (low & 31).astype(np.uint32) & np.uint32(1)).astype(bool)]


def wanted(slices_: DataFrame, held, depth: int, bits: int, buckets: int) -> DataFrame:
    """(slice, bucket, w, g): a slice's distinct words and longer n-grams that the filter lets through, for a bucket."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                table = pa.Table.from_batches([b.slice(k, 1)])
                _, size, words, ids, _ = row_of(table)
                code, _ = distinct_codes(codes(words, ids, size, depth, bits), np.zeros(len(ids), bool))
                words, code = passing(held.value, words), passing(held.value, code)
                w, g = dealt(words, 64, buckets), dealt(code, bits, buckets)
                used = np.flatnonzero((np.diff(w) > 0) | (np.diff(g) > 0))
                yield pa.RecordBatch.from_arrays([pa.array([table.column("slice")[0].as_py()] * len(used), pa.int64()), pa.array(used.astype(np.int32)), *(pa.array([steps(x[at[i] : at[i + 1]]) for i in used], pa.binary()) for x, at in ((words, w), (code, g)))], ["slice", "bucket", "w", "g"])

    return slices_.select("slice", "train", "size", "words", "ids").mapInArrow(make, "slice long, bucket int, w binary, g binary")


def valued(asked: DataFrame, table: DataFrame, bits: int, buckets: int) -> DataFrame:
    """(slice, bucket, wv, gv): the values of what was asked for, 0 where there is none."""

    def answer(rows: pa.Table, model: pa.Table) -> pa.Table:
        is_word = model.column("word").to_numpy(zero_copy_only=False).astype(bool)
        code, value = model.column("code").to_numpy().view(np.uint64), model.column("value").to_numpy()
        out: dict = {"slice": rows.column("slice"), "bucket": rows.column("bucket")}
        for side, mask in (("w", is_word), ("g", ~is_word)):
            order = np.argsort(code[mask])
            known, worth = np.r_[code[mask][order], np.uint64(0)], np.r_[value[mask][order], 0.0].astype("<f4")
            replies = []
            for raw in rows.column(side).to_pylist():
                own = summed(raw)
                at = np.searchsorted(known[:-1], own)
                replies.append(squeezed(np.where(known[at] == own, worth[at], np.float32(0))))
            out[side + "v"] = pa.array(replies, pa.binary())
        return pa.table(out)

    top = F.when(F.col("word"), F.shiftrightunsigned("code", 32)).otherwise(F.shiftrightunsigned("code", bits - 32)).bitwiseAND(F.lit(0xFFFFFFFF))
    table = table.withColumn("bucket", F.shiftright(top * F.lit(buckets), 32).cast("int"))
    left = asked.repartition(buckets, "bucket").groupBy("bucket")
    return left.cogroup(table.repartition(buckets, "bucket").groupBy("bucket")).applyInArrow(answer, "slice long, bucket int, wv binary, gv binary")


def totals(slices_: DataFrame, replies: DataFrame, base: DataFrame, held, depth: int, bits: int, tokens: int, kind: str) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for each document."""

    def make(own: pa.Table, got: pa.Table) -> pa.Table:
        _, size, words, ids, row = row_of(own)
        number = got.column("bucket").to_pylist()
        here = number.index(None)
        base_score = restored(got.column("base")[here].as_py(), "<f8")
        known = restored(got.column("known")[here].as_py(), "<i8")
        order = sorted((i for i in range(len(number)) if i != here), key=number.__getitem__)
        score = base_score.copy()
        found = codes(words, ids, size, depth, bits)
        every, _ = distinct_codes(found, np.zeros(len(ids), bool))
        for side, places, code in (("wv", [(np.arange(len(ids)), words[ids])], words), ("gv", found, every)):
            code, raw = passing(held.value, code), got.column(side).to_pylist()
            worth = np.concatenate([np.zeros(0, "<f4"), *(restored(raw[i], "<f4") for i in order)]).astype(float)
            code, worth = np.r_[code[worth != 0], np.uint64(0)], np.r_[worth[worth != 0], 0.0]
            for at, own_code in places:
                to = np.searchsorted(code[:-1], own_code)
                hit = np.flatnonzero(code[to] == own_code)
                score += np.bincount(row[at[hit]], worth[to[hit]], len(size))
        doc = own.column("doc").combine_chunks()
        return pa.table({"doc_id": doc.flatten(), "n_tokens": size, "n_known": known, "train_tokens": np.full(len(size), tokens), "base_score": base_score, "score": score})

    both = replies.unionByName(base.select("slice", F.col("a").alias("base"), F.col("b").alias("known")), allowMissingColumns=True)
    return slices_.select("slice", "doc", "train", "size", "words", "ids").groupBy("slice").cogroup(both.groupBy("slice")).applyInArrow(make, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def fitted(docs: DataFrame, learn: Column, depth: int = DEPTH, least: int = LEAST) -> tuple:
    """The encoded slices; what the buckets said about them (see resolved()); bits, buckets and training tokens."""
    texts = encoded(docs, learn)
    size, tokens = (int(x or 0) for x in texts.agg(F.sum("tokens"), F.sum("learned")).first())
    buckets = max(partitions(docs.sparkSession), -(-size // SHARE))
    bits = min(63, max(40, (size * depth).bit_length() + 16))
    replies = stored(answers(requests(texts, depth, bits, buckets), least, buckets))
    distinct = int(replies.agg(F.sum("distinct")).first()[0] or 0)
    return texts, stored(resolved(texts, replies, depth, bits, tokens, distinct)), bits, buckets, tokens


def counted(docs: DataFrame, learn: Column) -> DataFrame:
    """What scored() tells without the tree: the same steps without contexts, so that only words are counted and asked for."""
    texts, found, _, _, tokens = fitted(docs, learn, depth=0)
    base = found.filter("kind = 0").select("slice", F.col("a").alias("base"), F.col("b").alias("known"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, *raw in zip(b.column("doc"), *(b.column(c).to_pylist() for c in ("size", "known", "base")), strict=True):
                size, known, score = (restored(x, t) for x, t in zip(raw, ("<u4", "<i8", "<f8"), strict=True))
                yield pa.RecordBatch.from_arrays([doc.values, pa.array(size.astype(np.int64)), pa.array(known), pa.array(np.full(len(size), tokens)), pa.array(score)], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.select("slice", "doc", "size").join(base, "slice").mapInArrow(make, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double")


def scored(docs: DataFrame, learn: Column, depth: int = DEPTH, least: int = LEAST, diverge: float = DIVERGE) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for each row of docs; learn: which rows are learned from."""
    texts, found, bits, buckets, tokens = fitted(docs, learn, depth, least)
    worth = stored(values(states(found.filter("kind = 1"), depth, diverge)))
    held = docs.sparkSession.sparkContext.broadcast(sieve(worth))
    replies = valued(wanted(texts, held, depth, bits, buckets), worth, bits, buckets)
    return totals(texts, replies, found.filter("kind = 0"), held, depth, bits, tokens, docs.schema["doc_id"].dataType.simpleString())


def held_out() -> Column:
    return fold(F.col("doc_id"), 7) == 2


def query(docs: DataFrame) -> DataFrame:
    return scored(docs, ~held_out()).select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def base_query(docs: DataFrame) -> DataFrame:
    """The columns of query() that need no tree."""
    return counted(docs, ~held_out()).select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score")
