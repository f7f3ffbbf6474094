import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.llm import suffix_dedup
from tests.llm.cases import empty, rows, table


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_full_order(symbols):
    text = np.array(symbols, np.int64)
    rank = suffix_dedup.suffix_ranks(text, max(len(text), 1))
    order = sorted(range(len(symbols)), key=lambda i: symbols[i:])
    assert [int(rank[i]) for i in order] == list(range(len(symbols)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=9, max_size=40), st.integers(0, 9)), min_size=1, max_size=8), st.integers(8, 9))
def test_least_documents(cases, span):
    pieces = [c[0].encode() for c in cases]
    piece, low = suffix_dedup.least_documents(pieces, np.array([c[1] for c in cases]), span)
    at = [(i, p[k : k + span]) for i, p in enumerate(pieces) for k in range(len(p) - span + 1)]
    assert piece.tolist() == [i for i, _ in at]
    assert low.tolist() == [min(cases[i][1] for i, y in at if y == x) for _, x in at]


def expected(data, span=50):
    first: dict = {}
    for r in data:
        raw, d = (r[1] or "").encode(), float("inf") if r[0] is None else r[0]
        for k in range(len(raw) - span + 1):
            first[raw[k : k + span]] = min(first.get(raw[k : k + span], d), d)
    out = []
    for r in data:
        raw, d = (r[1] or "").encode(), float("inf") if r[0] is None else r[0]
        gone = bytearray(len(raw))
        for k in range(len(raw) - span + 1):
            if first[raw[k : k + span]] < d:
                gone[k : k + span] = b"\1" * span
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((r[0], len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def planted():
    """Texts built of shared passages with few kinds of letters, so that strings repeat at many places."""
    rng = random.Random(3)
    parts = ["".join(rng.choice("abé ") for _ in range(rng.choice([20, 49, 50, 51, 90]))) for _ in range(12)]
    texts = ["".join(rng.choice(parts) if rng.random() < 0.7 else "".join(rng.choice("xyz") for _ in range(30)) for _ in range(8)) for _ in range(40)]
    return [(i, t, "en", "s", len(t)) for i, t in enumerate([*texts, "a" * 49, "a" * 50, "b" * 400, "b" * 300, "a" * 50, "a" * 49])]


def test_against_all_strings(spark):
    data = [*rows(), *((r[0] + 200, *r[1:]) for r in planted())]
    found = sorted((tuple(r) for r in suffix_dedup.query(table(spark, data)).collect()), key=str)
    assert found == expected(data)


def test_small_blocks(spark):
    data = planted()
    found = sorted((tuple(r) for r in suffix_dedup.deduped(table(spark, data).repartition(5), block=200).collect()), key=str)
    assert found == expected(data)


def test_strings_of_crowded_minimizers_apart(spark):
    """A phrase in ever new surroundings, some of which repeat, and runs of one letter."""
    rng = random.Random(4)
    phrase = "the very same twenty letters"
    around = ["".join(rng.choice("abcdefgh ") for _ in range(40)) for _ in range(300)]
    texts = [rng.choice(around) + phrase + rng.choice(around) + "-" * rng.choice([0, 60, 200]) for _ in range(400)]
    data = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows = suffix_dedup.marked(table(spark, data))
    texts = rows.groupBy("t1", "t2").agg(F.min("d").alias("d"), F.first("text").alias("text"))
    found = suffix_dedup.pieces(texts, suffix_dedup.shared_minimizers(rows, 50, 20, 3), 50, 20)
    assert 0 < suffix_dedup.crowded(found, 1250).count() < found.select("mz").distinct().count()
    both = [sorted((r.mz, r.ph, s, r.runs[k].least) for r in x.collect() for k in range(len(r.runs)) for s in range(r.runs[k].skip, r.runs[k].skip + r.runs[k].n)) for x in (suffix_dedup.owners_apart(found, 50), suffix_dedup.owners_sorted(found, 50, 10**6))]
    assert both[0] == both[1]
    out = sorted((tuple(r) for r in suffix_dedup.deduped(table(spark, data), block=1250).collect()), key=str)
    assert out == expected(data)


def test_empty(spark):
    assert suffix_dedup.query(empty(spark)).count() == 0
