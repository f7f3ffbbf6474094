"""Quality rules: learned decision lists, with DataFrame and SQL functions only.

Measures of a text are Spark expressions.  On a bounded sample of labelled documents
Spark finds each measure's quantiles and counts good and bad documents for each
combination of bins; from these statistics sequential covering grows conjunctions of
thresholds that single out bad documents, prunes them on statistics held apart, and
removes what they cover.  The result is an ordered conditional expression.

Null texts have no words.  A text with no letter has zero ratios.  Repeated rows are
repeated in the result; of rows with one doc_id the least text is learned from.  Without
labels there are no rules, and the verdict is `kept`.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, cut

#: At most so many labelled documents are learned from, those whose ids hash lowest.
SAMPLE = 8000
BINS = 20
LITERALS = 3
RULES = 12
PRECISION = 0.8
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
MEASURES = ("word_length", "symbol_share", "upper_share", "digit_share", "mark_share", "dup_line_share", "repeat_share", "distinct_share", "n_words", "line_words")


def bound(value: Column, body) -> Column:
    """body(value), where value is computed once however often body's lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def repeat_words(words: Column) -> Column:
    """How many words lie in a 3-word window that occurs twice or more."""
    windows = F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 2, F.lit(1))), lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)))
    )

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(p: Column) -> Column:
            h = lambda j: p[j]["h"]
            last = F.size(p) - 1
            twice = F.filter(F.sequence(F.lit(0), last), lambda j: ((j > 0) & (h(j) == h(F.greatest(j - 1, F.lit(0))))) | ((j < last) & (h(j) == h(F.least(j + 1, last)))))
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda j: F.array(p[j]["i"], p[j]["i"] + 1, p[j]["i"] + 2)))))

        return F.when(F.size(hashes) == F.size(F.array_distinct(hashes)), F.lit(0)).otherwise(bound(ordered, count))

    return bound(windows, covered)


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns of `keep`, the base counts and the measures."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words"), F.size(F.array_distinct(w)).alias("n_distinct")
    )
    on = lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    counted = docs.select(
        *keep,
        bound(F.regexp_extract_all(text, F.lit(WORD), 0), of).alias("w"),
        bound(lines, on).alias("l"),
        F.length(text).alias("chars"),
        without(text, SPACES).cast("long").alias("word_chars"),
        (F.length(text) - without(text, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length(text) - without(text, UPPER)).alias("n_upper"),
        (F.length(text) - without(text, DIGITS)).alias("n_digits"),
        (F.length(text) - without(text, "!?.,;:")).alias("n_marks"),
    )
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0)).cast("double")
    base = counted.select(*keep, "w.*", "l.*", "word_chars", "n_symbols", "n_upper", "n_digits", "n_marks")
    return base.select(
        *keep,
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        F.struct(
            share("word_chars", "n_words").alias("word_length"),
            share("n_symbols", "word_chars").alias("symbol_share"),
            share("n_upper", "word_chars").alias("upper_share"),
            share("n_digits", "word_chars").alias("digit_share"),
            share("n_marks", "word_chars").alias("mark_share"),
            share("n_dup_lines", "n_lines").alias("dup_line_share"),
            share("n_repeat_words", "n_words").alias("repeat_share"),
            share("n_distinct", "n_words").alias("distinct_share"),
            F.col("n_words").cast("double").alias("n_words"),
            share("n_words", "n_lines").alias("line_words"),
        ).alias("m"),
    )


def statistics(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[list[list[float]], list[tuple]]:
    """Thresholds of each measure; rows (part, bins, good, bad). At most `sample` rows reach the driver."""
    marks = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    some = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").groupBy("doc_id", "good").agg(F.min("text").alias("text"))
    some = cut(measured(some, "doc_id", "good").filter("not base_failed").select("doc_id", "good", "m.*"))
    points = [i / BINS for i in range(1, BINS)]
    found = some.agg(*[F.expr(f"percentile_approx({m}, array({', '.join(map(str, points))}), 10000)").alias(m) for m in MEASURES]).first()
    cuts = [sorted(set(found[m] or ())) for m in MEASURES]
    binned = [sum([(F.col(m) > c).cast("int") for c in at], F.lit(0)).alias(m) for m, at in zip(MEASURES, cuts, strict=True)]
    part = (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)) == 0).cast("int").alias("part")
    table = some.select(part, "good", *binned).groupBy("part", *MEASURES).agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    return cuts, [(r["part"], tuple(r[m] for m in MEASURES), r["good"], r["bad"]) for r in table.collect()]


def holds(rule: list[tuple[int, bool, int]], bins: tuple) -> bool:
    return all((bins[f] > t) == above for f, above, t in rule)


def tally(rule: list, rows: list[tuple]) -> tuple[int, int]:
    """Good and bad documents that the rule covers."""
    inside = [r for r in rows if holds(rule, r[1])]
    return sum(r[2] for r in inside), sum(r[3] for r in inside)


def grow(rows: list[tuple], width: list[int]) -> list[tuple[int, bool, int]]:
    """A conjunction of (measure, above or not, bin), literal by literal, by information gain."""
    rule: list = []
    good, bad = sum(r[2] for r in rows), sum(r[3] for r in rows)
    while len(rule) < LITERALS and good and bad:
        best = (1e-9, None, 0, 0)
        for f, n in enumerate(width):
            g, b = [0] * (n + 1), [0] * (n + 1)
            for r in rows:
                g[r[1][f]] += r[2]
                b[r[1][f]] += r[3]
            low_g = low_b = 0
            for t in range(n):
                low_g, low_b = low_g + g[t], low_b + b[t]
                for above, x, y in ((False, low_g, low_b), (True, good - low_g, bad - low_b)):
                    if y:
                        gain = y * (log2(y / (x + y)) - log2(bad / (good + bad)))
                        best = max(best, (gain, (f, above, t), x, y), key=lambda v: v[0])
        if best[1] is None:
            break
        rule.append(best[1])
        good, bad = best[2:]
        rows = [r for r in rows if holds(rule[-1:], r[1])]
    return rule


def learn(cuts: list[list[float]], table: list[tuple], precision: float = PRECISION) -> list[list[tuple[str, bool, float]]]:
    """Rules for bad documents, in the order in which they were found."""
    width = [len(c) for c in cuts]
    rows, apart = [r for r in table if r[0] == 0], [r for r in table if r[0] == 1]
    rules = []
    while len(rules) < RULES and any(r[3] for r in rows):
        rule = grow(rows, width)
        worth = lambda k: (lambda g, b: (b - g) / (b + g) if b + g else -1.0)(*tally(rule[:k], apart))
        if not rule:
            break
        rule = rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))]
        good, bad = (x + y for x, y in zip(tally(rule, rows), tally(rule, apart), strict=True))
        if bad < 3 or bad < precision * (good + bad):
            break
        rules.append([(MEASURES[f], above, cuts[f][t]) for f, above, t in rule])
        rows = [r for r in rows if not holds(rule, r[1])]
        apart = [r for r in apart if not holds(rule, r[1])]
    return rules


def verdict(rules: list[list[tuple[str, bool, float]]]) -> Column:
    """The decision list as one conditional expression over the measures."""
    out = F
    for rule in rules:
        test = F.lit(True)
        for name, above, at in rule:
            value = F.col(f"m.{name}")
            test = test & ((value > at) if above else (value <= at))
        out = out.when(test, F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Base counts, base_failed and kept for each row of docs."""
    rules = learn(*statistics(docs, labels, sample))
    return measured(docs, "doc_id").withColumn("kept", ~F.col("base_failed") & verdict(rules)).drop("m")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(docs, labels)
