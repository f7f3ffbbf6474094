"""Spelling variant grouping: words one edit apart, by an even-partition pigeonhole join.

Words are counted over all texts.  A word of l letters is cut into two segments, the first
of l // 2 letters.  Of two words one edit apart at least one segment of the shorter (or of
either, if they are equally long) stands in the other as it is: the first at its start, the
second at its end, which in a word that is one letter longer is one place further on.  So
each word is indexed by its two segments and its length, and probes the index with its own
substrings at these places, for words of its length and words one letter shorter.

Where a segment is intact the edit lies in the other one, for which the same holds again.
So each segment key is divided, for all words alike, by the halves of the other segment:
a key names about three quarters of a word, and no key gathers all words that share a short
beginning or end.  Pairs that meet are verified inside the join (one edit exactly, in code
points), so that only true pairs leave it; a pair that meets under several keys counts once.
Words beyond WIDE letters join apart, where finding their first difference by halves is
linear in their length.

From the pairs come each word's number of near words and its form: the near word with the
largest count (of equals the smallest in code-point order), if that is at least RATIO times
the word's own.  Counts grow by that factor along a chain of forms, so chains are short and
a few doublings find every root.

Null texts have no words, and a null doc_id counts as the empty text.  Repeated rows count
again.  Texts of any length are read whole; a run without an end is one word.  No table has
a word twice; an empty one gives an empty result.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, stored

#: Letters of a run, and what lower-casing touches.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONG = 7
OFTEN = 2
WIDE = 64
RATIO = 10
#: A run loses a letter where this divides its checksum.
SLIP = 31


def runs(docs: DataFrame, least: int = LONG) -> DataFrame:
    """(doc_id, run): every run of at least `least` letters, in lower case."""
    found = F.regexp_extract_all("text", F.lit(RUN.replace("+", f"{{{least},}}")), 0)
    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run")).select("id", F.translate("run", UPPER, LOWER).alias("run"))


def slipped(run: Column, ident: Column) -> Column:
    """The run, without one of its letters where its checksum says so."""
    h = F.crc32(F.encode(F.concat(ident, F.lit(":"), run), "utf-8"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % SLIP == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def counted(words: DataFrame, least: int = LONG, often: int = OFTEN) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; summed in each task first."""
    return words.filter(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= often)


def segments(start: Column, size: Column) -> tuple[tuple[Column, Column], tuple[Column, Column]]:
    """(start, length) of both segments of a stretch."""
    half = F.floor(size / 2).cast("int")
    return (start, half), (start + half, size - half)


def keys(word: Column, size: Column) -> Column:
    """The four keys under which a word meets words of `size` letters.

    `size` is the word's own length, or one less: then what lies to the right of the edit
    stands one place further on in the word.  Each key is one segment and one half of the other.
    """
    shift = F.length(word) - size
    piece = lambda at, n, moved: F.substring(word, at + (shift if moved else F.lit(0)), n)
    (a, an), (b, bn) = segments(F.lit(1), size)
    (a1, an1), (a2, an2) = segments(a, an)
    (b1, bn1), (b2, bn2) = segments(b, bn)
    parts = (
        (piece(a, an, False), piece(b1, bn1, False)),  # the edit is in the second half of the second segment
        (piece(a, an, False), piece(b2, bn2, True)),  # in its first half
        (piece(a1, an1, False), piece(b, bn, True)),  # in the second half of the first segment
        (piece(a2, an2, True), piece(b, bn, True)),  # in its first half
    )
    return F.array(*[F.xxhash64(F.lit(i), size, x, y) for i, (x, y) in enumerate(parts)])


def one_edit(a: Column, b: Column) -> Column:
    """Whether b is a with one letter put in or another in its place, by bisection for where they part."""
    step = lambda p, _: F.when(F.substring(a, F.lit(1), halfway(p)) == F.substring(b, F.lit(1), halfway(p)), F.struct(halfway(p).alias("low"), p["high"].alias("high"))).otherwise(
        F.struct(p["low"].alias("low"), (halfway(p) - 1).alias("high"))
    )
    halfway = lambda p: F.ceil((p["low"] + p["high"]) / 2).cast("int")
    span = F.struct(F.lit(0).alias("low"), F.length(a).alias("high"))
    same = F.aggregate(F.sequence(F.lit(1), F.lit(32)), span, step)["low"]
    end = lambda x, at: F.substring(x, at, F.length(x))
    return (a != b) & (end(a, same + 1 + (F.length(a) == F.length(b)).cast("int")) == end(b, same + 2))


def met(words: DataFrame, one: Column) -> DataFrame:
    """(a, na, b, nb): pairs for which `one` holds, b the longer or the later; a pair may come repeatedly."""
    word, size = F.col("word"), F.length("word")
    index = words.select(F.explode(keys(word, size)).alias("key"), word.alias("a"), F.col("n").alias("na"))
    probes = F.concat(keys(word, size), keys(word, size - 1))
    probe = words.select(F.explode(probes).alias("key"), word.alias("b"), F.col("n").alias("nb"))
    later = (F.length("b") > F.length("a")) | (F.col("a") < F.col("b"))
    return index.join(probe, (index["key"] == probe["key"]) & later & one).select("a", "na", "b", "nb")


def pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb): words that are one edit apart, each pair once; words: (word, n)."""
    size = F.length("word")
    short = met(words.filter(size <= WIDE), F.levenshtein("a", "b", 1) == 1)
    wide = met(words.filter(size >= WIDE), one_edit(F.col("a"), F.col("b")))
    return short.unionByName(wide).distinct()


def near(found: DataFrame) -> DataFrame:
    """(word, n_near, best): how many near words a word has, and (count, word) of the chosen one."""
    both = found.select(F.col("a").alias("word"), (-F.col("nb")).alias("m"), F.col("b").alias("of"))
    both = both.unionByName(found.select(F.col("b").alias("word"), (-F.col("na")).alias("m"), F.col("a").alias("of")))
    return both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct("m", "of")).alias("best"))


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) for each (word, form): the last word of its chain, which has at most `steps` steps."""
    out = forms.select("word", F.col("form").alias("root"))
    for _ in range(ceil(log(max(steps, 1), 2))):
        ahead = out.select(F.col("word").alias("root"), F.col("root").alias("next"))
        out = cut(out.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return out


def grouped(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each (word, n)."""
    stats = near(pairs(words))
    best = F.when(-F.col("best.m") >= ratio * F.col("n"), F.col("best"))
    rows = words.join(stats, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), best.alias("best"))
    rows = stored(rows.select("word", "n", "n_near", F.col("best.of").alias("form"), (-F.col("best.m")).alias("form_n")))
    ends = rows.agg(F.min("n").alias("low"), F.max("n").alias("high")).first()
    steps = 1 if not ends.low else int(log(ends.high / ends.low, ratio) + 1e-9) + 1
    root = roots(rows.filter("form is not null"), steps)
    return rows.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))


def query(docs: DataFrame) -> DataFrame:
    words = runs(docs).select(slipped(F.col("run"), F.col("id")).alias("word"))
    return grouped(stored(counted(words))).select("word", "form", "root", "n", "n_near", "form_n")
