import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sievework.llm import simhash
from tests.llm.cases import empty, rows, table


def plain(text, width=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    parts = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(data):
    prints = [plain(r[1]) for r in data]
    group = list(range(len(data)))
    for i in range(len(data)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = {g: min((r[0] for r, h in zip(data, group, strict=True) if h == g and r[0] is not None), default=None) for g in group}
    return sorted(((r[0], f"{p:016x}", ids[g]) for r, p, g in zip(data, prints, group, strict=True)), key=str)


def test_against_all_pairs(spark):
    data = rows()
    found = sorted((tuple(r) for r in simhash.query(table(spark, data)).collect()), key=str)
    assert found == classes(data)


def test_empty(spark):
    assert simhash.query(empty(spark)).count() == 0


def test_extra_columns_with_clashing_names(spark):
    more = table(spark).withColumn("fp", F.lit(1)).withColumn("root", F.lit("x")).withColumn("rep", F.lit(0))
    assert simhash.query(more).count() == len(rows())
    assert simhash.first_of_each(more).columns == more.columns


def test_bit_planes_find_every_close_pair():
    rng = random.Random(5)
    for radius in (0, 1, 2, 3, 5):
        base = [rng.getrandbits(64) for _ in range(20)]
        fps = np.array([b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(7))) & (2**64 - 1) for b in base for _ in range(12)], np.uint64)
        planes = simhash.Planes(fps)
        for step in (1, 3, 63, 64, 65, 130):
            wanted = np.arange(len(fps) - step)
            near = set(planes.near(step, wanted, radius).tolist())
            assert near == {i for i in wanted.tolist() if int(fps[i] ^ fps[i + step]).bit_count() <= radius}


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {tuple(r) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(61)}


def test_first_of_each_keeps_clashing_names(spark):
    docs = table(spark).selectExpr("*", "1 as keep_of", "2 as keep_doc", "3 as keep_th", "4 as root", "5 as fp")
    assert simhash.first_of_each(docs).columns == docs.columns


def groups(fps, edges):
    root = {int(x): int(x) for x in fps}

    def top(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in edges:
        root[top(a)] = top(b)
    out = {}
    for x in root:
        out.setdefault(top(x), set()).add(x)
    return {frozenset(g) for g in out.values()}


def close_pairs(fps, radius):
    for i in range(len(fps)):
        near = np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= radius
        yield from ((int(fps[i]), int(x)) for x in fps[i + 1 :][near])


def family(n, seed, spread=5):
    """Fingerprints with equal high bits, some a few bits apart."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 32, n // 4, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 32, (n, spread), dtype=np.uint64)
    flips[rng.random((n, spread)) < 0.6] = 0
    return np.unique(np.bitwise_xor.reduce(flips, axis=1) ^ rng.choice(base, n) | np.uint64(0x7123456700000000))


def table_of(spark, fps):
    return spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")


def test_crowded_keys_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 50)
    fps = np.concatenate([family(1500, 1), family(300, 2) ^ np.uint64(0x00FFFF0000000000)])
    found = [(a, b) for a, b in simhash.links(table_of(spark, fps), 3).collect()]
    assert groups(fps, found) == groups(fps, close_pairs(fps, 3))
    assert all((a ^ b).bit_count() <= 3 for a, b in found)


def test_one_key_of_20000(spark):
    fps = family(24_000, 3)
    masks = [0xFFFFFFFF << 32]
    spread = table_of(spark, fps).select("fp", F.lit(0).alias("t"), F.col("fp").bitwiseAND(F.lit(masks[0] - (1 << 64))).alias("k"))
    sizes = [r[0] for r in simhash.divided(spread, masks, 3).groupBy("t", "k").count().select("count").collect()]
    assert len(fps) > 20_000 and sum(sizes) == 4 * len(fps) and max(sizes) < 400
    found = simhash.components(simhash.links(table_of(spark, fps), 3))
    assert found.count() > 5000


def test_of_equal_ids_and_texts_one_row_stays_in_every_run(spark):
    data = [(1, "a b c d e f", lang, source, None) for lang in ("en", "de", None) for source in ("x", "y", None)] + [(None, "a b c d e f", "en", "x", 1)]
    docs = table(spark, data).withColumn("more", F.create_map(F.lit("a"), F.lit(1)))
    stay = {str(simhash.first_of_each(docs.repartition(n)).collect()) for n in (1, 2, 3, 5)}
    assert len(stay) == 1 and simhash.first_of_each(docs).count() == 1


def test_planes_find_all_close_pairs():
    random = np.random.default_rng(1)
    for n in (1, 2, 63, 64, 65, 200):
        values = random.integers(0, 1 << 24, n).astype(np.uint64)
        planes = simhash.Planes(values)
        for radius in (3, 7, 10):
            wanted = {(i, j) for i in range(n) for j in range(i + 1, n) if int(values[i] ^ values[j]).bit_count() <= radius}
            i, j = planes.pairs(np.arange(n), (0, planes.words), radius)
            assert {(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True) if b < n} == wanted
            assert {(a, a + k) for k in range(1, n) for a in planes.near(k, np.arange(n - k), radius).tolist()} == wanted
