import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sievework.llm import quality_fm
from sievework.llm.common import span_hashes
from tests.llm.cases import empty, prose, rows, table

LABELS = "doc_id long, quality int, toxic int"


def test_identity_against_all_pairs():
    m = quality_fm.Machine()
    rng = np.random.default_rng(1)
    m.w, m.v = rng.normal(size=m.w.shape), rng.normal(size=m.v.shape)
    i, x = rng.choice(1000, 12, replace=False), rng.normal(size=12)
    found = m.margin(np.zeros(12, int), i, x, 1)[0][0]
    plain = m.w0 + m.w[i] @ x + sum(m.v[i[a]] @ m.v[i[b]] * x[a] * x[b] for a in range(12) for b in range(a))
    assert abs(found - plain) < 1e-9


def plain_words(text):
    """Each word's slot and weight: log of 1 + its count, the text's weights of length one."""
    low = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    often = Counter(int(span_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w.encode())]))[0]) >> 48 for w in low)
    weight = {s: np.log1p(n) for s, n in often.items()}
    norm = np.sqrt(sum(x * x for x in weight.values()))
    return {s: x / norm for s, x in weight.items()}, low


def test_features_text_by_text():
    texts = [r[1] or "" for r in rows(20)]
    raw = [t.encode() for t in texts]
    ends = np.cumsum([0, *map(len, raw)])
    chars = np.array([len(t) for t in texts], float)
    at, slot, value, stats = quality_fm.vectors(np.frombuffer(b"".join(raw), np.uint8), ends, chars)
    for k, t in enumerate(texts):
        words, low = plain_words(t)
        own = at == k
        assert dict(zip(slot[own].tolist(), np.round(value[own], 9).tolist(), strict=True)) == {s: round(float(x), 9) for s, x in words.items()}
        upper, letters = sum("A" <= c <= "Z" for c in t), sum(c.isascii() and c.isalpha() for c in t)
        assert np.allclose(stats[k][[0, 1, 2, 3, 10]], [np.log1p(len(low)), sum(len(w.encode()) for w in low) / max(len(low), 1), upper / max(letters, 1), sum(c.isascii() and c.isdigit() for c in t) / max(len(raw[k]), 1), np.log1p(len(t))])


def test_steps_follow_the_gradient():
    """One step on one row against the loss's slope, measured by small changes."""
    rng = np.random.default_rng(4)
    at, slot, value = np.zeros(5, int), np.array([3, 8, 20, 21, 40]), rng.random(5) + 0.2
    stats, y = rng.random((1, quality_fm.STATS)), np.array([1.0])

    def loss(m):
        return -np.log(m.score(at, slot, value, stats)[0])

    before, after = quality_fm.Machine(), quality_fm.Machine()
    before.mean, before.spread = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    before.w0 = float(np.log(0.99 / 0.01))
    after.fit(at, slot, value, stats, y, epochs=1, batch=1, shrink=0.0)
    for part, old, new in (("w", before.w, after.w), ("v", before.v, after.v)):
        for place in ([(int(i),) for i in slot] if part == "w" else [(int(i), f) for i in slot for f in range(3)]):
            start = old[place]
            old[place] = start + 1e-5
            up = loss(before)
            old[place] = start - 1e-5
            slope = (up - loss(before)) / 2e-5
            old[place] = start
            assert (abs(slope) < 1e-9 and new[place] == start) or np.sign(new[place] - start) == -np.sign(slope)


def labelled():
    rng = random.Random(8)
    data, marks = [], []
    for i in range(500):
        text = prose(rng, 60)
        if bad := rng.random() < 0.3:
            text = text.replace("the", "spam").upper()
        data.append((i, text, "en", "s", len(text)))
        marks.append((i, int(not bad), 0))
    return data, marks


def test_held_out_accuracy(spark):
    data, marks = labelled()
    out = {r.doc_id: r for r in quality_fm.query(table(spark, data), spark.createDataFrame(marks, LABELS)).collect()}
    held = [m for m in marks if zlib.crc32(str(m[0]).encode()) % 5 == 0]
    assert all(out[m[0]].held_out for m in held) and len(held) > 50
    assert sum(out[m[0]].predicted == m[1] for m in held) >= 0.95 * len(held)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in out.values())


def test_held_out_labels_are_not_used(spark):
    data, marks = labelled()
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in marks]
    both = [sorted(map(tuple, quality_fm.query(table(spark, data), spark.createDataFrame(m, LABELS)).collect())) for m in (marks, turned)]
    assert both[0] == both[1]


def test_odd_rows(spark):
    marks = spark.createDataFrame([(0, 1, 0), (3, 0, 0), (3, 1, 0), (None, 1, 0), (5, None, 0), (7, 0, 0)], LABELS)
    docs = table(spark, rows()).withColumn("good", F.lit(2)).withColumn("score", F.lit("x"))
    assert quality_fm.query(docs, marks).count() == len(rows())
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality_fm.query(docs, none).collect()} == {0.5}
    assert quality_fm.query(empty(spark), none).count() == 0
