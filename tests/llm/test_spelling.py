import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievework.llm import spelling
from tests.llm.cases import SCHEMA, empty, table


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def counts(data):
    out = Counter()
    for ident, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            out[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def plain(n):
    """Every word against every other."""
    close = {w: [x for x in n if one_edit(w, x)] for w in n}
    best = {w: min(c, key=lambda x: (-n[x], x)) for w, c in close.items() if c}
    form = {w: b for w, b in best.items() if n[b] >= 10 * n[w]}

    def last(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), last(w), n[w], len(close[w]), n[form[w]] if w in form else None) for w in n)


def found(rows):
    return sorted(map(tuple, rows.collect()))


def typos(rng, words, n):
    """A frequent word at most a few edits away from each rare one."""
    out = []
    for k, w in enumerate(words):
        out += [w] * (600 if k % 3 == 0 else 30)
        for _ in range(n):
            v, at = w, rng.randrange(len(w) + 1)
            for _ in range(rng.choice([1, 1, 2])):
                c = rng.choice("aeiouxÿÀß×")
                v = rng.choice([v[:at] + c + v[at:], v[:at] + v[at + 1 :], v[:at] + c + v[at + 1 :]])
            out += [v] * rng.choice([1, 2, 3, 40])
    rng.shuffle(out)
    return out


def documents(words, each=50):
    return [(i, " ".join(words[at : at + each]), "en", None, None) for i, at in enumerate(range(0, len(words), each))]


def test_same_as_all_pairs(spark):
    rng = random.Random(4)
    stems = ["".join(rng.choice("abcdeÉéñ") for _ in range(rng.randrange(6, 15))) for _ in range(12)]
    data = documents(typos(rng, stems, 25))
    out = spelling.query(table(spark, data))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    wanted = plain(counts(data))
    assert found(out) == wanted and any(r[1] and r[2] != r[1] for r in wanted)


def test_families_that_share_halves(spark):
    """Words of one beginning, of one end, and all of the same letters, two edits apart and fewer."""
    letters = "abcdefgh"
    words = [f"prefixes{x}{y}" for x in letters for y in letters] + [f"{x}{y}suffixes" for x in letters for y in letters]
    words += ["a" * n for n in range(6, 14)] + ["ab" * n for n in range(3, 7)] + ["ba" * n for n in range(3, 7)]
    n = {w: 2 + len(w) % 3 for w in words}
    rows = spark.createDataFrame(list(n.items()), "word string, n long")
    assert found(spelling.grouped(rows).select("word", "form", "root", "n", "n_near", "form_n")) == plain(n)


def test_chains_reach_their_root(spark):
    n = {"aaaaaaa" + "b" * k: 3 * 10**k for k in range(9)}
    rows = spark.createDataFrame(list(n.items()), "word string, n long")
    out = spelling.grouped(rows)
    assert {r.root for r in out.collect()} == {"aaaaaaabbbbbbbb"}
    assert found(out.select("word", "form", "root", "n", "n_near", "form_n")) == plain(n)


@pytest.mark.parametrize("wide", [7, 10, 64])
def test_wide_words_are_verified_alike(spark, monkeypatch, wide):
    monkeypatch.setattr(spelling, "WIDE", wide)
    rng = random.Random(wide)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(7, 12))) for _ in range(300)}
    words |= {"ab" * 31 + end for end in ("", "a", "b", "ab", "aa", "ba", "éa", "abé", "aba", "abab")}
    n = {w: 2 for w in words}
    rows = spark.createDataFrame(list(n.items()), "word string, n long")
    assert found(spelling.grouped(rows).select("word", "form", "root", "n", "n_near", "form_n")) == plain(n)


def test_ties_go_to_the_first_in_code_point_order(spark):
    n = {"wordone": 2, "wordonez": 20, "wordonea": 20, "wordoné": 20, "wordon×": 19}
    rows = spark.createDataFrame(list(n.items()), "word string, n long")
    assert found(spelling.grouped(rows).select("word", "form", "root", "n", "n_near", "form_n")) == plain(n)


def test_odd_texts(spark):
    long = "x" * 300_000
    data = [
        (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, " \t12-$\n", None, None, None), (None, "neighbour neighbour NEIGHBOUR neighbor neighbor", None, None, None), (None, None, None, None, None),
        (4, "neighbour-neighbour_neighbour neighbour ÀÉÎÕÜàé àÉÎÕÜàé ÀÉÎÕÜàé ÀÉÎÕÜàé Привет漢字", None, None, None), (4, "neighbour neighbour", None, None, None), (4, "neighbour neighbour", None, None, None),
        (5, long, None, None, None), (6, long, None, None, None), (7, long + "y " + long + "y", None, None, None), (8, "many words again " * 20_000, None, None, None),
    ]
    extra = table(spark, data).withColumn("Word", F.lit(1)).withColumn("n", F.lit("x")).withColumn("key", F.lit(2)).withColumn("run", F.lit(3))
    wanted = plain(counts(data))
    assert found(spelling.query(extra)) == wanted and "neighbour" in {r[0] for r in wanted}
    assert spelling.query(empty(spark)).count() == 0


@pytest.mark.parametrize("ident", [1, 15, 10**12])
def test_slips_are_the_contracts(spark, ident):
    words = [f"{a}abcdefgé{b}" for a in "abcdefghijklm" for b in "abcdefghijklm"]
    data = [(ident, " ".join(words * 2), "en", None, None)]
    out = spelling.counted(spelling.runs(spark.createDataFrame(data, SCHEMA)).select(spelling.slipped(F.col("run"), F.col("id")).alias("word")))
    wanted = counts(data)
    assert {r.word: r.n for r in out.collect()} == wanted and min(map(len, wanted)) < 10
