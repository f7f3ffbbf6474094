"""Language identification of whole and mixed-language texts.

Words are runs of letters.  The script of a word narrows the candidates to languages
that are seen in that script; each candidate's score is the word's log-probability
under its letter trigrams; a Viterbi pass over the words, with a penalty for each switch,
labels spans.  A document's language is the one that labels most of its letters, its
score that share of the letters.

Trigram counts come from all training rows: each task counts into fixed tables, so what
is summed and broadcast is bounded by the number of languages times SLOTS.  Documents
are decoded many at a time, one word of each in a step.

A null text, and one without letters, is `und` with score 0.  Letters of scripts that
no training language has say nothing; if there are no others the most frequent language
is returned, with score 0.  Without training rows everything is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, slices, text_buffers

SLOTS = 1 << 16
#: Bytes of text that are looked at together; arrays take some thirty times as many.
SLICE = 1 << 20
SWITCH = 12.0
#: Least share of a text's letters that its language must have in the pipeline.
LEAST_SCORE = 0.5
#: A language is a candidate in a script that holds this share of its letters.
SCRIPT_SHARE = 0.01
#: First and last code points of the scripts, by block.
SCRIPTS = (
    (0x41, 0x24F, "Latin"), (0x1E00, 0x1EFF, "Latin"), (0x370, 0x3FF, "Greek"), (0x1F00, 0x1FFF, "Greek"), (0x400, 0x52F, "Cyrillic"),
    (0x530, 0x58F, "Armenian"), (0x590, 0x5FF, "Hebrew"), (0x600, 0x77F, "Arabic"), (0x900, 0x97F, "Devanagari"), (0x980, 0x9FF, "Bengali"),
    (0xA00, 0xA7F, "Gurmukhi"), (0xA80, 0xAFF, "Gujarati"), (0xB80, 0xBFF, "Tamil"), (0xC00, 0xC7F, "Telugu"), (0xC80, 0xCFF, "Kannada"),
    (0xD00, 0xD7F, "Malayalam"), (0xE00, 0xE7F, "Thai"), (0xE80, 0xEFF, "Lao"), (0x10A0, 0x10FF, "Georgian"), (0x1100, 0x11FF, "Hangul"),
    (0xAC00, 0xD7AF, "Hangul"), (0x1200, 0x137F, "Ethiopic"), (0x1780, 0x17FF, "Khmer"), (0x3040, 0x30FF, "Kana"), (0x3400, 0x9FFF, "Han"), (0x20000, 0x2FA1F, "Han"),
)
NAMES = ("other", *dict.fromkeys(name for _, _, name in SCRIPTS))


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: is it a letter, its lower case, its script."""
    points = range(0x110000)
    letter = np.fromiter((chr(c).isalpha() for c in points), bool, 0x110000)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x1E944):
        if letter[c] and len(x := chr(c).lower()) == 1:
            lower[c] = ord(x)
    script = np.zeros(0x110000, np.uint8)
    for a, b, name in SCRIPTS:
        script[a : b + 1] = NAMES.index(name)
    return letter, lower, script


def analysed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Trigram slot of each letter; first letter, length, script and row of each word."""
    letter, lower, script = tables()
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    before = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    edges = before[offsets]
    is_letter = letter[points]
    at = np.flatnonzero(is_letter)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    first = np.r_[True, at[1:] != at[:-1] + 1]
    cutting = np.zeros(len(points) + 1, bool)
    cutting[edges] = True
    first |= cutting[at]
    c = lower[points[at]]
    last = np.r_[first[1:], True]
    left = np.r_[np.uint32(0), c[:-1]]
    left[first] = 0
    right = np.r_[c[1:], np.uint32(0)]
    right[last] = 0
    slot = ((left * np.uint32(0x9E3779B1) + c * np.uint32(0x85EBCA6B) + right * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)) >> np.uint32(16)
    begin = np.flatnonzero(first)
    length = np.diff(np.r_[begin, len(at)])
    return slot, begin, length, script[points[at[begin]]].astype(np.int64), np.searchsorted(edges, at[begin], side="right") - 1


def trained(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Languages; log-probability of each slot; allowed[script, language]; share of documents."""
    width = SLOTS + len(NAMES) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in slices(batches, most=SLICE):
            slot, begin, length, script, row = analysed(*text_buffers(b.column("text")))
            langs = b.column("lang").to_pylist()
            names = {x: i for i, x in enumerate(dict.fromkeys(langs))}
            of = np.array([names[x] for x in langs])
            grams = np.bincount(np.repeat(of[row], length) * SLOTS + slot, minlength=len(names) * SLOTS).reshape(-1, SLOTS)
            inside = np.bincount(of[row] * len(NAMES) + script, length, len(names) * len(NAMES)).reshape(-1, len(NAMES))
            for x, i in names.items():
                sums.setdefault(x, np.zeros(width, np.int64))
                sums[x] += np.r_[grams[i], inside[i].astype(np.int64), (of == i).sum()]
        for x, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "slot", "n"])

    counts = docs.select("text", "lang").mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    langs = sorted(counts["lang"].unique())
    table = np.zeros((len(langs), width))
    for i, x in enumerate(langs):
        own = counts[counts["lang"] == x]
        table[i, own["slot"]] = own["n"]
    grams = table[:, :SLOTS] + 0.1
    scripts = table[:, SLOTS:-1]
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    documents = table[:, -1]
    return langs, np.log(grams / grams.sum(axis=1, keepdims=True)).T.astype(np.float32).copy(), allowed.T.copy(), documents / max(documents.sum(), 1)


def viterbi(scores: np.ndarray, row: np.ndarray, rows: int, switch: float) -> np.ndarray:
    """The best label of each word. Rows are decoded side by side, the longest first."""
    n, width = scores.shape
    count = np.bincount(row, minlength=rows)
    start = np.cumsum(count) - count
    order = np.argsort(-count, kind="stable")
    start = start[order]
    alive = np.searchsorted(-count[order], -np.arange(count.max(initial=0)), side="left")  # rows with more than t words
    kind = np.min_scalar_type(width)
    came = np.empty(n, kind)
    stay = np.empty((n, width), bool)
    best = np.zeros((rows, width), np.float32)
    for t, m in enumerate(alive):
        w = start[:m] + t
        old = best[:m]
        top = old.argmax(axis=1)
        high = old[np.arange(m), top][:, None]
        came[w] = top
        stay[w] = keep = old >= high - switch
        best[:m] = np.where(keep, old, high - switch) - high + scores[w]
    label = np.empty(n, kind)
    state = best.argmax(axis=1)
    for t in range(len(alive) - 1, -1, -1):
        m = alive[t]
        w = start[:m] + t
        label[w] = state[:m]
        state[:m] = np.where(stay[w, state[:m]], state[:m], came[w])
    return label


def labelled(data: np.ndarray, offsets: np.ndarray, model: tuple, switch: float) -> tuple[np.ndarray, ...]:
    """Label, letters and row of each word that has candidates; and how many letters each row has."""
    langs, grams, allowed, _ = model
    slot, begin, length, script, row = analysed(data, offsets)
    rows = len(offsets) - 1
    letters = np.bincount(row, length, rows)
    known = allowed[script].any(axis=1) if len(script) else np.zeros(0, bool)
    scores = np.add.reduceat(grams[slot], begin, axis=0) if len(begin) else np.zeros((0, len(langs)), np.float32)
    scores = np.where(allowed[script[known]], scores[known], np.float32(-1e4))
    return viterbi(scores, row[known], rows, switch), length[known], row[known], letters


def decided(data: np.ndarray, offsets: np.ndarray, model: tuple, switch: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and number of spans of each row."""
    langs, _, _, prior = model
    rows = len(offsets) - 1
    if not langs:
        return np.full(rows, "und", object), np.zeros(rows), np.zeros(rows, np.int64)
    label, length, row, letters = labelled(data, offsets, model, switch)
    votes = np.bincount(row * len(langs) + label, length, rows * len(langs)).reshape(rows, -1)
    silent = votes.sum(axis=1) == 0
    pred = np.where(silent, prior.argmax(), votes.argmax(axis=1))
    score = np.where(silent, 0, votes.max(axis=1) / np.maximum(votes.sum(axis=1), 1))
    names = np.where(letters == 0, "und", np.array(langs, object)[pred])
    turn = np.r_[True, (label[1:] != label[:-1]) | (row[1:] != row[:-1])][: len(label)]
    return names, score, np.bincount(row[turn], minlength=rows)


def identify(docs: DataFrame, learn: Column, switch: float = SWITCH) -> DataFrame:
    """docs' doc_id, lang_pred, score and spans; learn: which rows may be learned from."""
    model = docs.sparkSession.sparkContext.broadcast(trained(docs.filter(learn & F.col("lang").isNotNull())))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=SLICE):
            names, score, spans = decided(*text_buffers(b.column("text")), model.value, switch)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(spans.astype(np.int32))], ["doc_id", "lang_pred", "score", "n_spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(make, f"doc_id {kind}, lang_pred string, score double, n_spans int")


def accepted(docs: DataFrame, least: float = LEAST_SCORE, switch: float = SWITCH) -> DataFrame:
    """The rows of docs that identify() gives a language with a score of `least` or more.

    A row goes if it is `und`, if its letters are of scripts that say nothing, or if no
    language has that share of them.  Where no row has a language to learn from, nothing
    can be told, and all rows stay.
    """
    model = docs.sparkSession.sparkContext.broadcast(trained(docs.filter(F.col("lang").isNotNull())))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=SLICE):
            names, score, _ = decided(*text_buffers(b.column("text")), model.value, switch)
            yield b.filter(pa.array((names != "und") & (score >= least) if model.value[0] else np.ones(b.num_rows, bool), pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def held_out() -> Column:
    return fold(F.col("doc_id"), 4) == 2


def query(docs: DataFrame) -> DataFrame:
    return identify(docs, ~held_out()).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_spans")
