import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sievework.llm import licenses
from sievework.llm.licenses import NOTICE, NOTICES, PHRASES, SHARE, SLACK, TEMPLATES
from tests.llm.cases import empty, prose, rows, table

NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
TEXT = {t.label: t.text for t in NOTICES}


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_spans(w):
    """(label, start, end, similarity) of notices: every pair of equal k-grams, position by position."""
    out = []
    for k, t in enumerate(TEMPLATES):
        v = words(t.text)
        if t.phrase:
            continue
        lines = defaultdict(set)
        for i in range(len(w) - NOTICE + 1):
            for j in range(len(v) - NOTICE + 1):
                if w[i : i + NOTICE] == v[j : j + NOTICE]:
                    lines[i - j].add(j)
        for d in lines:
            near = [(e, j) for e in range(d - SLACK, d + SLACK + 1) for j in lines.get(e, ())]
            start, end = min(e + j for e, j in near), max(e + j for e, j in near) + NOTICE
            sim = len({x for _, j in near for x in range(j, j + NOTICE)}) / max(len(v), end - start)
            if sim >= SHARE:
                q = (end - start) // 4
                out.append((start + q, end - q, k, t.label, start, end, sim))
    groups, high = [], -1
    for s in sorted(out):
        if not groups or s[0] >= high:
            groups.append([])
        high = max(high, s[1])
        groups[-1].append(s)
    return {(s[3], s[4], s[5], s[6]) for g in groups for s in g if s[6] == max(x[6] for x in g)}


def plain(data):
    out = []
    for ident, text, *_ in data:
        w = words(text)
        places = [(i, t.label) for t in PHRASES for i in range(len(w)) if w[i : i + len(t.text.split())] == t.text.split()]
        found = plain_spans(w)
        base = {x for _, x in places}
        at = [i for i, _ in places]
        score = max([1.0] * bool(places) + [s[3] for s in found], default=0.0)
        out.append((ident, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | {s[0] for s in found})), score))
    return sorted(out, key=str)


def result(docs):
    out = licenses.query(docs)
    assert out.columns == NAMES
    return sorted(map(tuple, out.collect()), key=str)


def changed(rng, text, n):
    """The text with n words replaced, left out or put in."""
    w = text.split(" ")
    for _ in range(n):
        at = rng.randrange(len(w) + 1)
        w[at : at + rng.choice([0, 1])] = rng.choice([[], ["other"], ["other", "words"]])
    return " ".join(w)


def test_same_as_comparing_all_positions(spark):
    rng = random.Random(5)
    data = [(i, prose(rng, 40) + " " + changed(rng, rng.choice(TEMPLATES).text, i % 12) + "\n" + prose(rng, 30), "en", "s", None) for i in range(60)]
    data += [(100 + i, " ".join(changed(rng, t.text, 2) for t in rng.sample(TEMPLATES, 3)), "en", "s", None) for i in range(15)]
    data += rows(40)
    got = result(table(spark, data))
    assert got == plain(data) and len({r[6] for r in got}) > 8


@pytest.mark.parametrize("label", sorted(TEXT))
def test_notices_with_changes_are_found_and_told_apart(spark, label):
    rng = random.Random(label)
    text = prose(rng, 200) + "\n" + TEXT[label].upper().replace(", ", " ,\n// ") + "\n" + prose(rng, 100)
    data = [(1, text, None, None, None), (2, changed(rng, TEXT[label], 3), None, None, None), (3, " ".join(TEXT[label].split()[: len(TEXT[label].split()) // 3]), None, None, None)]
    got = {r[0]: r for r in result(table(spark, data))}
    assert label in got[1][6].split(",") and label in got[2][6].split(",") and got[1][7] >= 0.95
    assert set(got[1][6].split(",")) <= {label, *got[1][5].split(",")}
    assert got[3][6] == got[3][5]  # a third of a notice is none


def test_spans_are_where_the_notice_is(spark):
    before, after = "one two three four five", "six seven eight"
    text = f"{before} {TEXT['isc']} {after}"
    found = [r for r in licenses.spans(table(spark, [(1, text, None, None, None)])).collect() if r.label == "isc"]
    assert [(r.start, r.end, r.similarity, r.base) for r in found] == [(5, 5 + len(words(TEXT["isc"])), 1.0, False)]


def test_places_of_phrases(spark):
    texts = ["MIT License", "mit-license, MIT\nLICENSE; the mit license", "mit licenses", "GNU General Public", "gnu general public license license", "CC BY-NC cc_by ccby", "cc cc by by", "é mit license", "Apache\x00License", "apache éa license"]
    data = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = result(table(spark, data))
    assert got == plain(data)
    assert {r[0]: r[2] for r in got} == {0: 1, 1: 3, 2: 0, 3: 0, 4: 1, 5: 2, 6: 1, 7: 1, 8: 1, 9: 0}


def test_odd_tables(spark):
    data = [(1, None, None, None, None), (None, "the mit license", None, None, None), (None, None, None, None, None), (1, "cc by", None, None, None), (1, "cc by", None, None, None), (1, "apache license " * 30_000, None, None, None), (2, "x " * 50_000 + TEXT["bsd"], None, None, None)]
    docs = table(spark, data).withColumns({c: F.lit(1) for c in ("Label", "d", "th", "gram", "template", "N_words", "found_id")})
    got = result(docs)
    small = [r for r in data if r[1] is None or len(r[1]) < 99]
    assert [r for r in got if r[1] < 99] == plain(small)
    assert (1, 60_000, 30_000, 0, 59_998, "apache", "apache", 1.0) in got and (2, 50_000 + len(words(TEXT["bsd"])), 0, None, None, "", "bsd", 1.0) in got
    assert licenses.query(empty(spark)).count() == 0


def test_no_broadcast_gives_the_same(spark, monkeypatch):
    data = rows(30) + [(50, TEXT["mpl"], None, None, None)]
    wanted = result(table(spark, data))
    monkeypatch.setattr(licenses, "BROADCAST", -1)
    assert result(table(spark, data)) == wanted


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for out in (licenses.diagonals(docs, TEMPLATES), licenses.query(docs)):
        assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())
