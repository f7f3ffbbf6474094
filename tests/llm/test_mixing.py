import random
import re
import time
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from sievework.llm import mixing
from tests.llm.cases import empty, rows, table


def expected(data):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in data]
    total = defaultdict(int)
    for r, n in zip(data, size, strict=True):
        total[r[3]] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    fixed: dict = {}
    while True:
        free = [s for s in order if s not in fixed]
        left = 1.5 * sum(size) - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * total[s]]
        if not over:
            return size, total, fixed | share
        fixed |= {s: 2.0 * total[s] for s in over}


def test_targets_and_taken(spark):
    data = rows(300)
    size, total, goal = expected(data)
    found = [r.asDict() for r in mixing.query(table(spark, data)).collect()]
    assert len(found) == len(data)
    own = sorted((str(r[0]), n, total[r[3]]) for r, n in zip(data, size, strict=True))
    assert sorted((str(r["doc_id"]), r["size"], r["source_size"]) for r in found) == own
    taken = defaultdict(int)
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source_size"], round(r["target"], 6)] += r["taken"]
    for s in total:
        biggest = max(n for r, n in zip(data, size, strict=True) if r[3] == s)
        assert abs(taken[total[s], round(goal[s], 6)] - goal[s]) <= biggest / 2 + 1
    again = mixing.query(table(spark, data[::-1]).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in mixing.query(table(spark, data)).collect())


def test_overlapping_sources_are_routed():
    # b can only be filled by the shared pattern, so the shared words go there
    taken = mixing.flow({("a",): 100, ("a", "b"): 50}, {"a": 100, "b": 50}, 2)
    assert taken == {("a",): 100, ("a", "b"): 50}
    # a second pass is bought only for what a first pass cannot give
    taken = mixing.flow({("a",): 100, ("a", "b"): 50}, {"a": 120, "b": 60}, 2)
    assert sum(taken.values()) == 180 and taken["a", "b"] >= 60


def cheapest(supply, quota, most):
    """(words, cost) of the best way to deal patterns' words out, by trying all."""
    ways = [(p, n, s) for p, n in supply.items() for s in p]
    best = (0, 0)
    for give in product(*[range(most * n + 1) for _, n, _ in ways]):
        of, to = defaultdict(int), defaultdict(int)
        for x, (p, _, s) in zip(give, ways, strict=True):
            of[p] += x
            to[s] += x
        if all(of[p] <= most * n for p, n in supply.items()) and all(to[s] <= q for s, q in quota.items()):
            best = max(best, (sum(give), -sum(cost(of[p], n) for p, n in supply.items())))
    return best


def cost(taken, n):
    """Pass k over n words costs k - 1 a word."""
    return sum(max(0, taken - k * n) for k in range(1, 9)) if n else 0


def reachable(taken, quota):
    """Whether what is taken can be dealt to the sources' quotas (a cut for each set of sources)."""
    names = list(quota)
    return all(sum(n for p, n in taken.items() if set(p) <= {s for s, w in zip(names, want, strict=True) if w}) <= sum(quota[s] for s, w in zip(names, want, strict=True) if w) for want in product([0, 1], repeat=len(names)))


def test_flow_is_the_cheapest_of_the_largest():
    rng = random.Random(3)
    for _ in range(60):
        names = "abc"[: rng.randrange(2, 4)]
        patterns = {tuple(sorted(rng.sample(names, rng.randrange(1, 3)))) for _ in range(rng.randrange(1, 4))}
        supply = {p: rng.randrange(0, 4) for p in patterns}
        quota = {s: rng.randrange(0, 7) for s in names}
        taken = mixing.flow(supply, quota, 2)
        assert set(taken) == set(supply) and all(0 <= taken[p] <= 2 * n for p, n in supply.items()) and reachable(taken, quota)
        assert (sum(taken.values()), -sum(cost(taken[p], n) for p, n in supply.items())) == cheapest(supply, quota, 2)


def test_very_many_sources():
    rng = random.Random(5)
    own = {(f"s{k}",): rng.randrange(1, 10**6) for k in range(100_000)}
    shared = {tuple(sorted((f"s{k}", f"s{k + 1}"))): rng.randrange(1, 10**6) for k in range(0, 40_000, 2)}
    quota = {s: rng.randrange(1, 3 * 10**6) for (s,) in own}
    began = time.perf_counter()
    taken = mixing.flow(own | shared, quota, 2)
    assert time.perf_counter() - began < 30
    for k in range(0, 40_000, 2):  # two sources and what they share, in closed form
        a, b, both = (f"s{k}",), (f"s{k + 1}",), tuple(sorted((f"s{k}", f"s{k + 1}")))
        total = min(quota[a[0]] + quota[b[0]], 2 * (own[a] + own[b] + shared[both]), quota[a[0]] + 2 * (own[b] + shared[both]), quota[b[0]] + 2 * (own[a] + shared[both]))
        total = min(total, min(quota[a[0]], 2 * own[a]) + min(quota[b[0]], 2 * own[b]) + 2 * shared[both])
        assert taken[a] + taken[b] + taken[both] == total
    assert all(taken[f"s{k}",] == min(quota[f"s{k}"], 2 * own[f"s{k}",]) for k in range(40_001, 100_000))


def test_overlapping_sources_in_a_table(spark):
    """Documents of one source, of the other and of both: quotas are met, and reruns agree."""
    rng = random.Random(8)
    data = [(i, rng.randrange(1, 50), rng.choice([["a"], ["b"], ["a", "b"], ["b", "a", "a"]])) for i in range(3000)]
    docs = spark.createDataFrame([(*r, r[0]) for r in data], "doc_id long, n long, of array<string>, mark long")
    mixed, sizes, goal = mixing.mix(docs, F.col("of"), F.col("n"), weights=(3, 1), share=0.6)
    found = {r.doc_id: r for r in mixed.collect()}
    supply = defaultdict(int)
    for _, n, of in data:
        supply[tuple(sorted(set(of)))] += n
    wanted = mixing.flow(supply, {s: round(g) for s, g in goal.items()}, 2)
    assert sizes == {s: sum(n for p, n in supply.items() if s in p) for s in "ab"} and len(found) == len(data)
    for p in supply:
        took = sum(found[i].mix_times * n for i, n, of in data if tuple(sorted(set(of))) == p)
        assert abs(took - wanted[p]) <= 26
    again, _, _ = mixing.mix(docs.repartition(5), F.col("of"), F.col("n"), weights=(3, 1), share=0.6)
    assert {r.doc_id: r.mix_times for r in again.collect()} == {k: r.mix_times for k, r in found.items()}


def test_ids_that_are_null_are_spread(spark):
    data = [(None, f"word{i} and more words", "en", "s", None) for i in range(4000)]
    lean = table(spark, data).selectExpr("doc_id", "source", "4 as n", "xxhash64(text) as mark")
    mixed, _, _ = mixing.mix(lean, F.array("source"), F.col("n"))
    assert mixed.agg(F.sum(F.col("mix_times") * 4)).first()[0] == 24_000
    order = lean.select(F.pmod(F.xxhash64(F.lit(11), "doc_id", "mark"), F.lit(mixing.BUCKETS)).alias("b")).groupBy("b").count()
    assert order.agg(F.max("count")).first()[0] < 20


def test_targets_stop_at_twice_the_size():
    goal = mixing.targets({"a": 10, "b": 1000, None: 10}, (5, 2, 1), 1.5, 2)
    assert goal["a"] == 20 and sum(goal.values()) == pytest.approx(1530) and goal[None] == 20


def test_empty_and_repeated(spark):
    assert mixing.query(empty(spark)).count() == 0
    docs = table(spark, rows(60))
    out = mixing.repeated(docs)
    assert out.columns == docs.columns and out.count() > 0
    assert mixing.repeated(empty(spark)).count() == 0
