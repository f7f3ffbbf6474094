"""Mixing sources to target weights by min-cost flow.

Documents are summed by membership pattern (the set of sources they belong to), so what
reaches the driver is one row for each pattern that occurs.  There a min-cost flow sends
words from patterns to source quotas; each further pass over a pattern costs more than
the one before, and no pattern is passed more often than `most` times.  The flow says how
many words each pattern gives: whole passes, and a rest.  The rest is filled in the
order of a seeded hash: hash buckets are summed first, so only the one bucket in which
the rest ends is ordered row by row.

Null texts have size 0; rows of size 0 are there as often as the pattern is passed as a
whole.  A null source is a source of its own, after the others.  The order depends on id
and text, so null or repeated ids are spread like others.  Rows with equal id and text are
interchangeable: at the edge of the rest either may be the one that is taken, which gives
the same rows.  A document is taken whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, cut

BUCKETS = 4096
#: The patterns' plan is broadcast if it has at most so many rows, else it is joined by shuffling.
BROADCAST = 100_000


def targets(sizes: dict, weights: Sequence[float], share: float, most: float) -> dict:
    """Words for each source: share of all by weight, at most `most` times its size, the excess dealt again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), list(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] > most * sizes[s]]
        if not full:
            return out | {s: unit * weight[s] for s in free}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
        free = [s for s in free if s not in out]
    return out


class Network:
    """A flow network by arcs; arc a and a ^ 1 are each other's way back."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def arc(self, a: int, b: int, room: int) -> int:
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [room, 0]
        return len(self.to) - 2

    def levels(self, start: int) -> list[int]:
        """How many arcs with room lead to each node; -1 where none do."""
        level = [-1] * len(self.out)
        level[start] = 0
        front = [start]
        while front:
            ahead = []
            for a in front:
                for e in self.out[a]:
                    b = self.to[e]
                    if self.room[e] and level[b] < 0:
                        level[b] = level[a] + 1
                        ahead.append(b)
            front = ahead
        return level

    def fill(self, start: int, end: int) -> None:
        """Adds flow until there is no way left: along shortest ways, all of one length before longer ones."""
        while (level := self.levels(start))[end] >= 0:
            tried = [0] * len(self.out)
            way: list[int] = []
            a = start
            while True:
                if a == end:
                    step = min(self.room[e] for e in way)
                    for e in way:
                        self.room[e] -= step
                        self.room[e ^ 1] += step
                    way = way[: next(k for k, e in enumerate(way) if not self.room[e])]
                    a = self.to[way[-1]] if way else start
                    continue
                while tried[a] < len(self.out[a]):
                    e = self.out[a][tried[a]]
                    if self.room[e] and level[self.to[e]] == level[a] + 1:
                        break
                    tried[a] += 1
                if tried[a] < len(self.out[a]):
                    way.append(self.out[a][tried[a]])
                    a = self.to[way[-1]]
                elif way:
                    a = self.to[way.pop() ^ 1]
                    tried[a] += 1
                else:
                    break


def flow(supply: dict[tuple, int], quota: dict, most: int) -> dict[tuple, int]:
    """Words to take from each pattern: a cheapest largest flow.

    Pass k over a pattern costs k - 1 a word, the same for all patterns.  So the cheapest
    flow is had pass by pass: all that the first passes can give, then what second passes
    add to it, and so on; what is taken from a pattern never shrinks meanwhile.  A source
    that shares no pattern takes what it wants from its own, at once.
    """
    shared = {s for p in supply if len(p) > 1 for s in p}
    taken = {p: min(quota[p[0]], most * n) if p and p[0] not in shared else 0 for p, n in supply.items()}
    order = lambda s: (s is None, s or "")  # noqa: E731  so that equally cheap flows are the same in every run
    patterns = sorted((p for p in supply if p and p[0] in shared), key=lambda p: [order(s) for s in p])
    number = {s: 2 + len(patterns) + k for k, s in enumerate(sorted((s for s in quota if s in shared), key=order))}
    net = Network(2 + len(patterns) + len(number))
    first = [net.arc(0, 2 + k, 0) for k in range(len(patterns))]
    for k, p in enumerate(patterns):
        for s in p:
            net.arc(2 + k, number[s], most * supply[p])
    for s, k in number.items():
        net.arc(k, 1, quota[s])
    for _ in range(most if patterns else 0):
        for e, p in zip(first, patterns, strict=True):
            net.room[e] += supply[p]
        net.fill(0, 1)
    return taken | {p: net.room[e ^ 1] for e, p in zip(first, patterns, strict=True)}


def mix(docs: DataFrame, members: Column, size: Column, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 11, ident: str = "doc_id", mark: str = "mark") -> tuple[DataFrame, dict, dict]:
    """docs with `mix_size`, `mix_times` (how often the mix takes the row) and `mix_members`; source sizes; targets.

    members: an array column of the sources a row belongs to.  mark: a column that tells
    rows with one id apart, such as a hash of their texts.
    """
    order = F.xxhash64(F.lit(seed), F.col(ident), F.col(mark))
    rows = docs.select("*", F.array_sort(F.array_distinct(members)).alias("mix_members"), size.cast("long").alias("mix_size"), order.alias("mix_order"))
    # rows without words are never the ones at the edge
    rows = rows.withColumn("mix_bucket", F.when(F.col("mix_size") == 0, BUCKETS).otherwise(F.pmod("mix_order", F.lit(BUCKETS))).cast("int"))
    cells = cut(rows.groupBy("mix_members", "mix_bucket").agg(F.sum("mix_size").alias("mix_words")))
    supply = {tuple(r[0]): int(r[1]) for r in cells.groupBy("mix_members").agg(F.sum("mix_words")).collect()}
    sizes: dict = {}
    for p, n in supply.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    goal = targets(sizes, weights, share, most)
    taken = flow(supply, {s: round(t) for s, t in goal.items()}, most)
    plan = [(list(p), taken[p] // n if n else 0, taken[p] % n if n else 0) for p, n in supply.items()]
    kind = T.StructType([T.StructField("mix_members", rows.schema["mix_members"].dataType), T.StructField("mix_passes", T.LongType()), T.StructField("mix_rest", T.LongType())])
    plan = docs.sparkSession.createDataFrame(plan, kind)
    # "upto": words in a pattern's buckets before this one; BUCKETS rows a pattern at most
    upto = cells.join(plan, "mix_members").select("*", F.expr("sum(mix_words) over (partition by mix_members order by mix_bucket) - mix_words").alias("upto"))
    edge = upto.filter("upto < mix_rest and mix_rest <= upto + mix_words").groupBy("mix_members").agg(F.min(F.struct("mix_bucket", "upto")).alias("edge"))
    plan = cut(plan.join(edge, "mix_members", "left").select("mix_members", "mix_passes", "mix_rest", F.coalesce(F.col("edge.mix_bucket"), F.lit(-1)).alias("mix_edge"), F.coalesce(F.col("edge.upto"), F.lit(0)).alias("mix_upto")))
    placed = rows.join(F.broadcast(plan) if len(supply) <= BROADCAST else plan, "mix_members")
    whole = placed.filter("mix_bucket <> mix_edge").withColumn("mix_times", F.expr("mix_passes + if(mix_bucket < mix_edge, 1, 0)"))
    inner = f"sum(mix_size) over (partition by mix_members order by mix_order, {ident}, {mark}, mix_size rows unbounded preceding)"
    part = placed.filter("mix_bucket = mix_edge").withColumn("mix_times", F.expr(f"mix_passes + if(mix_upto + {inner} - mix_size / 2 <= mix_rest, 1, 0)"))
    return whole.unionByName(part).drop("mix_passes", "mix_rest", "mix_edge", "mix_upto", "mix_bucket", "mix_order"), sizes, goal


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0))


def query(docs: DataFrame) -> DataFrame:
    lean = cut(docs.select("doc_id", F.col("source").cast("string").alias("source"), words("text").alias("n"), F.xxhash64("text").alias("mark")))
    mixed, sizes, goal = mix(lean, F.array("source"), F.col("n"))
    table = docs.sparkSession.createDataFrame([(s, n, float(goal[s])) for s, n in sizes.items()], "source string, source_size long, target double")
    out = mixed.withColumnRenamed("source", "own").join(table, F.col("own").eqNullSafe(F.col("source")))
    return out.select("doc_id", F.col("mix_size").alias("size"), "source_size", "target", (F.col("mix_times") * F.col("mix_size")).cast("long").alias("taken"))


def repeated(docs: DataFrame) -> DataFrame:
    """docs as the mix takes them: a document that is taken twice is there twice."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("doc_id").alias("mix_id"), F.col("source").cast("string").alias("mix_source"), words("text").alias("mix_n"), F.xxhash64("text").alias("mix_mark"))
    mixed, _, _ = mix(packed, F.array("mix_source"), F.col("mix_n"), ident="mix_id", mark="mix_mark")
    return mixed.filter("mix_times > 0").select("row", F.explode(F.expr("sequence(1L, mix_times)"))).select("row.*")
