import math
import os
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sievework.llm import lm
from tests.llm.cases import empty, rows, table

TABLES = "/root/testdata/sf0.01"


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def held(r):
    return zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2


class Plain:
    """The tree by its definition: states by divergence tests, each token scored by the longest suffix that is a state."""

    def __init__(self, texts, depth, least, diverge, discount):
        self.counts = Counter(w for t in texts for w in t)
        self.total, self.kinds = sum(self.counts.values()), len(self.counts)
        self.states = {}
        self.depth, self.discount = depth, discount
        for k in range(1, depth + 1):
            seen, whole = defaultdict(Counter), Counter()
            for t in texts:
                for i in range(k, len(t)):
                    seen[tuple(t[i - k : i])][t[i]] += 1
                    whole[tuple(t[i - k : i])] += 1
            new = {}
            for c, then in seen.items():
                known = {w: n for w, n in then.items() if n >= least}
                if known and sum(n * math.log(n / whole[c] / self.after(c[1:], w)) for w, n in known.items()) >= diverge:
                    new[c] = (whole[c], known)
            self.states |= new

    def after(self, context, word):
        """Probability of the word by the longest suffix of the context that is a state."""
        while context and context not in self.states:
            context = context[1:]
        if not context:
            return (self.counts[word] + 1) / (self.total + self.kinds + 1)
        whole, known = self.states[context]
        left = whole - sum(known.values()) + self.discount * len(known)
        return (max(known.get(word, 0) - self.discount, 0) + left * self.after(context[1:], word)) / whole

    def score(self, text):
        return sum(math.log10(self.after(tuple(text[max(0, i - self.depth) : i]), w)) for i, w in enumerate(text))


def spelled(data):
    return [[*tokens(r[1]), None] for r in data]


def test_scores_are_those_of_the_plain_tree(spark):
    data = rows(80) + [(200 + i, "one two three four five six. " * (i % 4) + "one two nine", "en", "s", None) for i in range(30)]
    texts = spelled(data)
    train = [t for t, r in zip(texts, data, strict=True) if not held(r)]
    for depth, least, diverge in ((2, 4, 6.0), (3, 2, 1.0)):
        plain = Plain(train, depth, least, diverge, lm.DISCOUNT)
        assert plain.states
        out = lm.scored(table(spark, data), ~lm.held_out(), depth, least, diverge).collect()
        base = [sum(math.log10((plain.counts[w] + 1) / (plain.total + plain.kinds + 1)) for w in t) for t in texts]
        wanted = [(str(r[0]), len(t), sum(plain.counts[w] > 0 for w in t), plain.total, round(b, 6)) for r, t, b in zip(data, texts, base, strict=True)]
        assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == sorted(wanted)
        scores = sorted((str(r[0]), plain.score(t)) for r, t in zip(data, texts, strict=True))
        for (name, s), (other, t) in zip(sorted((str(r.doc_id), r.score) for r in out), scores, strict=True):
            assert name == other and abs(s - t) < 1e-3 * max(1, len(data[0][1])) / 100 + 1e-4 * abs(t)


def test_states_are_those_of_the_plain_tree(spark):
    data = rows(80) + [(200 + i, "one two three four five six. " * (i % 4) + "one two nine", "en", "s", None) for i in range(30)]
    plain = Plain([t for t, r in zip(spelled(data), data, strict=True) if not held(r)], 2, 4, 6.0, lm.DISCOUNT)
    _, found, _, _, _ = lm.fitted(table(spark, data), ~lm.held_out())
    own, _ = lm.states(found.filter("kind = 1"))
    by_length = Counter(len(c) for c in plain.states)
    assert {r["k"]: r["count"] for r in own.groupBy("k").count().collect()} == by_length and len(by_length) == 2
    assert sorted(r.total for r in own.collect()) == sorted(n for n, _ in plain.states.values())


def test_a_state_is_a_distribution():
    texts = [["a", "b", "a", "c", None], ["a", "b", "a", "b", None]] * 6
    plain = Plain(texts, 2, 2, 0.5, lm.DISCOUNT)
    for context in [(), *plain.states]:
        assert abs(sum(plain.after(context, w) for w in plain.counts) + plain.after(context, "unseen") - 1) < 1e-9


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="needs the tables")
def test_tree_beats_word_counts_on_held_out_texts(spark):
    out = lm.query(spark.read.parquet(f"{TABLES}/documents.parquet")).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > 0.97 * out[1]


def test_empty_and_without_training_rows(spark):
    assert lm.query(empty(spark)).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm.query(table(spark, [(only, "a b", "en", "s", 3)])).first()
    assert r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.n_tokens == 3 and r.base_score == 0 and r.score == 0


def test_counts_without_the_tree_are_the_same(spark, monkeypatch):
    data = rows()
    docs = table(spark, data)
    with monkeypatch.context() as m:
        m.setattr(lm, "states", None)  # nothing of the tree is asked for
        found = sorted(map(tuple, lm.base_query(docs).collect()), key=repr)
    assert found == sorted((tuple(r)[:-1] for r in lm.query(docs).collect()), key=repr)
    assert lm.base_query(empty(spark)).count() == 0


def test_token_counts_grow_no_tree(spark, monkeypatch):
    from sievework.llm import queries

    monkeypatch.setattr(lm, "states", None)
    assert queries.token_counts(spark, "/root/testdata/sf0.001").count() > 0
