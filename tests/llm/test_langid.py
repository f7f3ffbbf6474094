import random
import zlib
from collections import Counter, defaultdict
from itertools import groupby
from math import log

import numpy as np
from pyspark.sql import functions as F

from sievework.llm import langid
from tests.llm.cases import empty, rows, table

SOUNDS = {"aa": ["the", "ing", "th", "er", "wh"], "bb": ["sch", "ung", "keit", "ein", "ß"], "cc": ["при", "вет", "ми", "ро"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randrange(1, 4))) for _ in range(n))


def corpus():
    rng = random.Random(6)
    return [(i, text(rng, lang, rng.randrange(5, 60)), lang, "s", None) for i, lang in enumerate(rng.choices(sorted(SOUNDS), k=240))]


def test_held_out_accuracy_and_odd_texts(spark):
    rng = random.Random(7)
    mixed = text(rng, "aa", 40) + " " + text(rng, "bb", 25)
    odd = [(900, None, "aa", "s", 0), (901, "", "aa", "s", 0), (902, "12 34 !!", "bb", "s", 8), (903, "漢字", "aa", "s", 2), (904, mixed, None, "s", 1), (None, "thing", None, None, None)]
    out = {r.doc_id: r for r in langid.query(table(spark, corpus() + odd)).collect()}
    held = [r for r in corpus() if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert len(held) > 30 and all(out[r[0]].held_out for r in held)
    assert sum(out[r[0]].lang_pred == r[2] for r in held) >= 0.97 * len(held)
    assert [out[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and out[902].score == 0
    assert out[903].lang_pred in SOUNDS and out[903].score == 0
    assert out[904].lang_pred == "aa" and out[904].n_spans == 2 and 0.4 < out[904].score < 0.8
    assert out[None].lang_pred == "aa" and all(0 <= r.score <= 1 for r in out.values())


def script_of(c):
    return next((name for a, b, name in langid.SCRIPTS if a <= ord(c) <= b), "other")


def words_of(text):
    """Runs of letters, and the slots of each letter's neighbourhood."""
    out = []
    for letters, run in groupby(text or "", str.isalpha):
        if letters:
            run = list(run)
            low = [ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in run]
            around = zip([0, *low[:-1]], low, [*low[1:], 0], strict=True)
            out.append((run, [((a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) * 0x27D4EB2F & 0xFFFFFFFF) >> 16 for a, b, c in around]))
    return out


def plain(data):
    """(doc_id, lang, score) word by word, with the best of all paths found by a table of states."""
    grams, scripts, docs = defaultdict(Counter), defaultdict(Counter), Counter()
    for i, text, lang, *_ in data:
        if lang is not None and zlib.crc32(str("" if i is None else i).encode()) % 4 != 2:
            docs[lang] += 1
            for run, slots in words_of(text):
                grams[lang].update(slots)
                scripts[lang][script_of(run[0])] += len(run)
    langs = sorted(docs)
    total = {x: sum(grams[x].values()) + 0.1 * langid.SLOTS for x in langs}
    may = lambda x, s: scripts[x][s] >= langid.SCRIPT_SHARE * max(sum(scripts[x].values()), 1)
    out = []
    for i, text, *_ in data:
        words = [w for w in words_of(text) if any(may(x, script_of(w[0][0])) for x in langs)]
        if not words_of(text):
            out.append((i, "und", 0.0))
            continue
        best: dict = {}
        for run, slots in words:
            worth = {x: sum(log((grams[x][s] + 0.1) / total[x]) for s in slots) for x in langs if may(x, script_of(run[0]))}
            best = {x: max(((v - langid.SWITCH * (y != x), path) for y, (v, path) in best.items()), default=(0, ()), key=lambda p: p[0]) for x in worth}
            best = {x: (v + worth[x], (*path, x)) for x, (v, path) in best.items()}
        votes = Counter()
        for (run, _), x in zip(words, max(best.values(), key=lambda p: p[0])[1] if best else (), strict=True):
            votes[x] += len(run)
        lang = max(langs, key=lambda x: (votes[x], -langs.index(x))) if votes else max(langs, key=lambda x: docs[x])
        out.append((i, lang, votes[lang] / sum(votes.values()) if votes else 0.0))
    return out


def test_same_as_word_by_word(spark):
    rng = random.Random(11)
    data = corpus()
    for i in range(60):  # texts of several languages, of odd letters, of words that several languages share
        parts = [text(rng, rng.choice(sorted(SOUNDS)), rng.randrange(1, 12)) for _ in range(rng.randrange(1, 5))] + rng.choices(["12 34", "ÄÖÜ", "漢字 かな", "Ŀ ǅ ß", "a", "--"], k=2)
        rng.shuffle(parts)
        data.append((1000 + i, " ".join(parts), None, "s", None))
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.query(table(spark, data)).collect()}
    for i, lang, score in plain(data):
        assert found[i][0] == lang and abs(found[i][1] - score) < 1e-9


def test_labels_of_held_out_rows_are_not_used(spark):
    data = corpus()
    spoiled = [(*r[:2], "zz", *r[3:]) if zlib.crc32(str(r[0]).encode()) % 4 == 2 else r for r in data]
    both = [sorted(map(tuple, langid.query(table(spark, x)).collect())) for x in (data, spoiled)]
    assert both[0] == both[1]


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    for _ in range(30):
        sizes = rng.integers(0, 6, 5)
        row = np.repeat(np.arange(5), sizes)
        scores = rng.normal(0, 3, (len(row), 3)).astype(np.float32)
        label = langid.viterbi(scores, row, 5, 2.0)
        for r in range(5):
            own = scores[row == r]
            worth = lambda path: sum(own[i, p] for i, p in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))  # noqa: E731, B023
            if len(own):
                best = max(worth(p) for p in np.ndindex(*[3] * len(own)))
                assert abs(worth(label[row == r].tolist()) - best) < 1e-3


def test_without_training_rows_and_accepted(spark):
    docs = table(spark, rows()).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.query(docs).collect()} == {"und"}
    assert langid.query(empty(spark)).count() == 0
    kept = langid.accepted(table(spark, rows()).withColumn("score", F.lit(1)))
    assert kept.columns[-1] == "score" and kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in rows())
