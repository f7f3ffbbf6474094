import hashlib
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.llm import line_dedup
from sievework.llm.common import WORD
from tests.llm.cases import WORDS, empty, rows, table


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=40), st.lists(st.tuples(st.integers(0, 40), st.integers(0, 2), st.integers(0, 255)), max_size=5)), min_size=1, max_size=8), st.integers(0, 4))
def test_bit_vectors_against_the_full_matrix(cases, limit):
    left, right = [], []
    for text, edits in cases:
        other = bytearray(text)
        for at, what, byte in edits:
            at = min(at, len(other))
            if what == 0:
                other.insert(at, byte)
            elif at < len(other):
                if what == 1:
                    del other[at]
                else:
                    other[at] = byte
        left.append(text)
        right.append(bytes(other))
    wanted = [line_dedup.plain_distance(a, b) <= limit for a, b in zip(left, right, strict=True)]
    assert line_dedup.within(*[[np.frombuffer(x, np.uint8) for x in side] for side in (left, right)], limit).tolist() == wanted


def near(a, b):
    shorter = min(len(a), len(b))
    limit = 2 if shorter >= 48 else 1 if shorter >= 24 else 0
    return abs(len(a) - len(b)) <= limit and line_dedup.plain_distance(a, b) <= limit


def expected(data):
    places = []
    for r in data:
        key = (r[0] is None, r[0] or 0)
        places += [(line, (*key, i)) for i, line in enumerate((r[1] or "").split("\n")) if re.search(WORD, line)]
    out = []
    for r in data:
        key = (r[0] is None, r[0] or 0)
        kept, gone = [], 0
        lines = (r[1] or "").split("\n")
        for i, line in enumerate(lines):
            drop = bool(re.search(WORD, line)) and any(p < (*key, i) and (y == line or near(line, y)) for y, p in places)
            gone += drop
            kept += [] if drop else [line]
        out.append((r[0], 0 if r[1] is None else len(lines), gone, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def planted():
    rng = random.Random(9)
    base = [" ".join(rng.choice(WORDS) for _ in range(14)) for _ in range(12)]
    data = []
    for i in range(30):
        lines = []
        for _ in range(5):
            x = list(rng.choice(base))
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(x))
                x[at : at + rng.randrange(2)] = rng.choice(["", "q", "é", "漢", "\U0001f600"])
            lines.append("".join(x)[: rng.choice([22, 23, 24, 25, 30, 46, 47, 48, 49, 200, 200])])
        data.append((i, "\n".join(lines), "en", "s", None))
    return data


def test_against_all_pairs(spark):
    data = rows(25) + [(r[0] + 100, *r[1:]) for r in planted()]
    data = [r for r in data if r[0] != 10_000]
    found = sorted((tuple(r) for r in line_dedup.query(table(spark, data)).collect()), key=str)
    assert found == expected(data)


def test_edits_are_code_points(spark):
    """Pairs of lines in one table, each pair of letters of its own; whether the second line goes."""
    han = "天地玄黄宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏閏餘成歲律呂調陽雲騰致雨"
    pairs = {
        (han, han[:20] + "漢" + han[20:]): 1,
        ("thirty four letters are in a line x", "thirty four letters are in a line x."): 1,
        ("twenty four letters here", "twenty four letters here."): 1,
        ("here are 24 letters, too", "here are 24 letters, to"): 0,
        ("only 23 letters, it is x", "only 23 letters, it is"): 0,
        ("é" * 47, "é" * 45 + "èè"): 0,
        ("ö" * 48, "ö" * 46 + "üü"): 1,
        ("ñ" * 48, "ñ" * 45 + "ççç"): 0,
        ("\U0001f600" * 50, "\U0001f600" * 48): 1,
    }
    data = [(2 * k + i, x, None, None, None) for k, pair in enumerate(pairs) for i, x in enumerate(pair)]
    found = {r.doc_id: r.n_removed for r in line_dedup.query(table(spark, data)).collect()}
    assert found == {2 * k + i: i * gone for k, gone in enumerate(pairs.values()) for i in (0, 1)}


def test_columns_stay(spark):
    docs = table(spark, planted()).selectExpr("*", "1 as gone", "'x' as h1", "2 as line_gone", "3 as line_doc", "4 as line_th", "5 as line_no")
    out = line_dedup.deduped(docs)
    assert out.columns == docs.columns and out.count() == 30
    assert line_dedup.query(empty(spark)).count() == 0


def test_one_line_in_20000_documents(spark):
    data = [(i, f"the same line everywhere\n{hashlib.sha256(str(i).encode()).hexdigest()}", "en", "s", None) for i in range(20_000)]
    out = line_dedup.removals(table(spark, data)).collect()
    assert len(out) == 19_999 and all(0 in r.gone for r in out)


def template(rng, n, digits):
    """Lines of one template with numbers in it, in documents of a few lines."""
    lines = [f"the price of item {rng.randrange(10**digits):0{digits}d} in our store was set by the keeper of the store" for _ in range(n)]
    return [(i, "\n".join(lines[at : at + 4]), "en", "s", None) for i, at in enumerate(range(0, n, 4))]


@pytest.mark.parametrize(("crowd", "first", "digits"), [(20, 1, 4), (5, 3, 8)])
def test_crowded_keys_give_the_same(spark, monkeypatch, crowd, first, digits):
    data = template(random.Random(crowd + digits), 200, digits) + [(r[0] + 1000, *r[1:]) for r in planted()] + [(None, template(random.Random(2), 4, digits)[0][1], None, None, None)]
    random.Random(1).shuffle(data)
    wanted = expected(data)
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    monkeypatch.setattr(line_dedup, "FIRST", first)
    docs = table(spark, data)
    assert not line_dedup.links(docs)[1].isEmpty()
    assert sorted((tuple(r) for r in line_dedup.query(docs).collect()), key=str) == wanted
    named = docs.withColumn("doc_id", F.format_string("%06d", "doc_id"))  # ids that aren't numbers
    found = {(r.n_lines, r.n_removed, r.kept_sha256) for r in line_dedup.query(named.filter("doc_id <> '  null'")).collect()}
    assert found >= {r[1:] for r in wanted if r[0] is not None}


def test_20000_lines_of_one_template(spark):
    rng = random.Random(7)
    data = template(rng, 20_000, 4)
    began = time.perf_counter()
    found = {r.doc_id: r for r in line_dedup.query(table(spark, data)).collect()}
    assert time.perf_counter() - began < 300
    assert sum(r.n_lines for r in found.values()) == 20_000
    # a code of four digits within two of an earlier one goes, and soon all codes have one
    seen: list[str] = []
    for i, text, *_ in data[:200]:
        gone = 0
        for line in text.split("\n"):
            code = line[18:22]
            gone += any(line_dedup.plain_distance(code.encode(), c.encode()) <= 2 for c in seen)
            seen.append(code)
        assert found[i].n_removed == gone
    assert all(found[i].n_removed == 4 for i in range(2000, 5000))
