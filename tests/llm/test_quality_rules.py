import random
import re
from collections import Counter

from sievework.llm import quality_rules
from tests.llm.cases import empty, prose, rows, table

LABELS = "doc_id long, quality int, toxic int"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_counts(spark):
    data = rows()
    out = quality_rules.query(table(spark, data), spark.createDataFrame([], LABELS)).collect()
    found = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in out)
    assert found == sorted(str((r[0], *counts(r[1]))) for r in data)
    assert all(r.kept == (not r.base_failed) for r in out)


def test_learns_symbols(spark):
    rng = random.Random(2)
    data, marks = [], []
    for i in range(400):
        text = prose(rng, 160)
        if bad := i % 4 == 0:
            text = text.replace(" ", "### ")
        data.append((i, text, "en", "s", None))
        marks.append((i, int(not bad), 0))
    out = quality_rules.query(table(spark, data), spark.createDataFrame(marks, LABELS)).filter("not base_failed").collect()
    assert out and sum(r.kept == (r.doc_id % 4 != 0) for r in out) >= 0.97 * len(out)


def made(rng, n, bad, apart=0.3, bins=6):
    """Rows of (part, bins, good, bad) in which bad(bins) says which documents are bad."""
    out = []
    for _ in range(n):
        own = tuple(rng.randrange(bins) for _ in quality_rules.MEASURES)
        out.append((int(rng.random() < apart), own, int(not bad(own)), int(bad(own))))
    return out


CUTS = [[float(t) for t in range(5)] for _ in quality_rules.MEASURES]


def covered(rules, own):
    """Whether some rule covers a document in these bins; a bin above t is a value above cut t."""
    at = dict(zip(quality_rules.MEASURES, own, strict=True))
    return any(all((at[name] > c) == above for name, above, c in rule) for rule in rules)


def test_a_conjunction_is_grown():
    rows = made(random.Random(1), 4000, lambda b: b[1] > 3 and b[4] <= 1)
    rules = quality_rules.learn(CUTS, rows)
    assert [sorted(r) for r in rules] == [sorted([("symbol_share", True, 3.0), ("mark_share", False, 1.0)])]


def test_rules_cover_one_kind_after_the_other():
    bad = lambda b: (b[0] > 3 and b[3] > 2) or b[6] > 4 or (b[2] <= 0 and b[7] <= 1)
    rows = made(random.Random(2), 8000, bad)
    rules = quality_rules.learn(CUTS, rows)
    assert 3 <= len(rules) <= quality_rules.RULES and max(map(len, rules)) > 1
    wrong = sum(covered(rules, own) != bool(b) for _, own, _, b in rows)
    assert wrong <= 0.02 * len(rows)


def test_what_held_out_statistics_dont_bear_out_is_pruned():
    """In the growing part alone high values of another measure are good, so a literal more is grown there."""
    rows = made(random.Random(3), 4000, lambda b: b[5] > 2)
    rows = [(0, b, 1, 0) if part == 0 and b[8] == 5 else (part, b, g, n) for part, b, g, n in rows]
    grown = quality_rules.grow([r for r in rows if r[0] == 0], [len(c) for c in CUTS])
    assert [(quality_rules.MEASURES[f], above, t) for f, above, t in grown[:2]] == [("dup_line_share", True, 2), ("n_words", False, 4)]
    assert quality_rules.learn(CUTS, rows) == [[("dup_line_share", True, 2.0)]]


def test_no_rule_without_precision():
    rng = random.Random(4)
    rows = [(r[0], r[1], *((1, 0) if rng.random() < 0.7 else (0, 1))) for r in made(rng, 3000, lambda _: False)]
    assert all(len(r) <= quality_rules.LITERALS for r in quality_rules.learn(CUTS, rows)) and quality_rules.learn(CUTS, []) == []


def test_conjunction_in_texts(spark):
    """Either of capitals and digits alone is fine, both are bad."""
    rng = random.Random(9)
    data, marks = [], []
    for i in range(600):
        text, capitals, digits = prose(rng, 160), rng.random() < 0.5, rng.random() < 0.5
        text = text.upper() if capitals else text
        text = re.sub(" ", lambda _: f" {rng.randrange(10**5)} ", text) if digits else text
        data.append((i, text, "en", "s", None))
        marks.append((i, int(not (capitals and digits)), 0))
    docs, labels = table(spark, data), spark.createDataFrame(marks, LABELS)
    rules = quality_rules.learn(*quality_rules.statistics(docs, labels, quality_rules.SAMPLE))
    assert any({"upper_share", "digit_share"} <= {x[0] for x in r} or len(r) > 1 for r in rules)
    good = dict((i, q) for i, q, _ in marks)
    out = quality_rules.query(docs, labels).filter("not base_failed").collect()
    assert sum(r.kept == bool(good[r.doc_id]) for r in out) >= 0.97 * len(out)


def test_plan_has_no_python(spark):
    out = quality_rules.query(table(spark), spark.createDataFrame([(0, 1, 0), (5, 0, 0)], LABELS))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert quality_rules.query(empty(spark), spark.createDataFrame([], LABELS)).count() == 0
