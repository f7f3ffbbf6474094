from collections import Counter

import corpus_pipeline
from sievework.llm import mixing
from sievework.llm.common import stored
from tests.llm import test_line_dedup, test_mixing, test_packing, test_simhash
from tests.llm.cases import rows, table


def test_stages_against_plain_versions(spark):
    data = rows(60) + [(r[0] + 100, *r[1:]) for r in test_line_dedup.planted()]
    data = [r for r in data if r[0] != 10_000]
    docs = table(spark, data)
    names = docs.columns
    before = [tuple(r) for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, ""))
        after = [tuple(r) for r in docs.collect()]
        if k < 4:
            assert docs.columns == names
        if name == "language":
            assert Counter(after) == Counter(r for r in before if any(c.isalpha() for c in r[1] or ""))
        elif name == "lines":
            import hashlib

            wanted = [(x[0], x[3]) for x in test_line_dedup.expected(before)]
            assert Counter((r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in after) == Counter(wanted)
        elif name == "near_copies":
            groups = {(c[2] if c[2] is not None else "null") for c in test_simhash.classes(before)}
            assert len(after) == len(groups) and set(after) <= set(before)
            assert {r[0] if r[0] is not None else "null" for r in after} == groups
        elif name == "mixture":
            size, _, goal = test_mixing.expected(before)
            own = dict(zip(before, size, strict=True))
            times = Counter(after)
            assert set(times) <= set(before) and max(times.values()) <= 2
            for source, wanted in goal.items():
                taken = sum(n * own[r] for r, n in times.items() if r[3] == source)
                assert abs(taken - wanted) <= max(n for r, n in own.items() if r[3] == source)
        else:
            test_packing.check(docs.collect(), before, 2048)
        before = after


def test_run(spark, tmp_path):
    table(spark, rows(30)).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    table(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_mixing_keeps_clashing_names(spark):
    docs = table(spark, rows(20)).selectExpr("*", "1 as passes", "'x' as edge", "2 as rest", "3 as words", "4 as upto", "5 as mix_size", "6 as mix_copy", "7 as mix_members", "8 as mix_times", "9 as row")
    out = mixing.repeated(docs)
    assert out.columns == docs.columns and out.count() > 0
