"""Edge cases of the column functions and the routing, in batch and as a stream."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from sievework.functions import maps, syntax, text
from sievework.functions.factors import required
from sievework.plans.routing import SCHEMA, Route, decisions, routed
from sievework.streaming.requests import log_decisions, read_requests

JSON = [
    '{"a":1} x', "NaN", '{"a":NaN}', '{"a":Infinity}', '{"a":1,"a":2}', '{"a":1,}', '"\\ud800"', "{'a':1}", "[1,2", "", "\ufeff{\"a\":1}", "01",
    '{"a":1}', "1", "null", '""', "[]", '{"a":1}\n\n', '{"a":"\\x"}', '"a\tb"', "// c\n1", None,
]


def strict(t):
    if t is None:
        return None
    try:
        json.loads(t)
    except ValueError:
        return False
    return True


def test_json_is_judged_strictly(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(JSON)], "i int, t string")
    found = {r.i: r.e for r in rows.select("i", syntax.json_error("t").alias("e")).collect()}
    assert [found[i] is None for i in range(len(JSON))] == [strict(t) in (True, None) for t in JSON]


@pytest.mark.parametrize(("code", "fine"), [("x = 1", True), ("", True), ("x = (", False), ("if x:\ny", False), ("\0", False)])
def test_python(spark, code, fine):
    row = spark.createDataFrame([(code,)], "t string").select(syntax.python_error("t").alias("e")).first()
    assert (row.e is None) == fine


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


def test_text(spark):
    assert [one(spark, text.stem(F.lit(p))) for p in ("a/foo.md", "foo.bar.md", ".md", "noext", "a/")] == ["foo", "foo.bar", ".md", "noext", ""]
    assert one(spark, text.strip(F.lit("\t\u00a0a b\u2003\n"))) == "a b"
    assert tuple(one(spark, text.key_value(F.lit(" export  NAME = 'va=lue' ")))) == ("NAME", "va=lue")
    assert tuple(one(spark, text.key_value(F.lit("alone")))) == ("alone", "")
    assert one(spark, text.first_match(F.lit("abc"), "x(y)")) is None
    assert one(spark, text.first_match(F.lit("abc"), "b(x?)")) == "" and one(spark, text.first_match(F.lit(None).cast("string"), "b(c)")) is None
    assert one(spark, text.first_match(F.lit("ab ac"), "a(.)")) == "b"
    assert one(spark, text.int_or(F.lit("12"))) == 12 and one(spark, text.int_or(F.lit("a"))) == 0
    assert one(spark, text.as_text(F.encode(F.lit("a\r\nb\rc"), "utf-8"))) == "a\nb\nc"
    assert one(spark, text.or_default(F.lit(""), "d")) == "d"
    assert one(spark, text.line_matches(F.lit("k: a\r\n\u00a0k: b\nk: c\u2028\nx k: d\nk:\n e"), r"^\s*k:\s*([a-z]+)\s*$")) == ["a", "b", "c", "e"]


FACTORS = {
    r"[a-z0-9._]+@[a-z0-9.]+\.[a-z]+": ["@"], 'key = "[0-9a-f]{40}"': ['key = "'], "-----BEGIN (?:A |B )?KEY-----": ["-----BEGIN "], "(ab|cd)+x?": ["ab", "cd"], "a*": [], "x?y?": [],
    "(?i)abc": [], r"\Qa+\E": [], "[a&&[b]]x": [], "x++y": [], r"\x41b": [], r"\vab": [], "a{0,3}": [], "a{2}b": ["a"], r"a\.b": ["a.b"], "(": [], r"\p{L}x": [], "^é+$": ["é"], "a|": [], "(?!x)yz": ["yz"],
}


@pytest.mark.parametrize("pattern", sorted(FACTORS))
def test_required_literals(pattern):
    assert required(pattern) == FACTORS[pattern]


PATTERNS = ["a+b", "ab|b(c|a)", "[ab]c{2,}", "(?:a|b)?c", "(?i)CA", "b.a", "^a", "c$", "a{2}", r"a\.c", "", "(ab|c)(a|bc)"]


def test_patterns_behind_literals_match_the_same(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choices("abc.", k=rng.randrange(7))) for _ in range(400)]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    sets = [rng.sample(PATTERNS, n) for n in (1, 1, 1, 2, 2, 3, 3, 4)] + [[p] for p in PATTERNS] + [[]]
    found = rows.select("t", *[text.any_pattern(F.col("t"), s).alias(str(k)) for k, s in enumerate(sets)]).collect()
    for r in found:
        for k, s in enumerate(sets):
            assert bool(r[str(k)]) == (r.t is not None and any(re.search(p, r.t) for p in s))


def test_literals_reach_the_tables_reader(spark, tmp_path):
    spark.createDataFrame([("x@y.z",), ("none",)], "t string").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t")).filter(text.any_pattern(F.col("t"), ["[a-z]+@[a-z.]+", 'k="[0-9]"']))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Or(StringContains(t,@),StringContains(t,k=" in plan and rows.count() == 1


def test_maps(spark):
    entries = F.create_map(F.lit("Host"), F.lit("h"), F.lit("B"), F.lit("2"))
    assert one(spark, maps.drop_keys(entries, ["host"])) == {"B": "2"}
    assert one(spark, maps.put(entries, "b", F.lit("3"))) == {"Host": "h", "b": "3"}
    assert one(spark, maps.put_default(entries, "b", F.lit("3"))) == {"Host": "h", "B": "2"}
    assert one(spark, maps.put_default(entries, "c", F.lit("3"))) == {"Host": "h", "B": "2", "c": "3"}


BODIES = [
    (b'{"model":"abc-1"}', True), (b'{"model":"xabc"}', False), (b'{"model":"ABC"}', False), (b"", False), (None, False), (b"{}", False), (b"null", False), (b"[]", False),
    (b"[1]", False), (b'"abc"', False), (b"{", False), (b'{"model":null}', False), (b'{"model":5}', False), (b"\xff", False),
]
ROUTE = Route(prefix="abc", match="one", default="two", match_url="https://one.example", default_url="https://two.example", versions=(("x-version", "1"),))
HEADERS = {"Host": "h", "HOST": "i", "Authorization": "dummy", "X-Api-Key": "dummy", "X-Version": "9", "accept": "a", "Content-Length": "7"}


def requests(spark):
    rows = [("POST", f"/p{i}", HEADERS, b) for i, (b, _) in enumerate(BODIES)] + [("GET", "/none", None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_routing(spark):
    found = {r.path: r for r in routed(requests(spark), ROUTE).collect()}
    for i, (_, hit) in enumerate(BODIES):
        r = found[f"/p{i}"]
        assert (r.destination == "one") == hit and r.url == f"https://{r.destination}.example/p{i}" and r.length == 7
        assert r.headers == ({"x-version": "9", "accept": "a"} if hit else {"authorization": "dummy", "x-api-key": "dummy", "x-version": "9", "accept": "a"})
    assert found["/none"].headers == {} and found["/none"].length == 0


def test_of_headers_that_differ_in_case_the_last_stands(spark):
    names = ["A", "b", "a", "B", "Host", "C"], [f"X{k}" for k in range(3000)] + [f"x{k}" for k in range(3000)]
    values = ["1", "2", "3", None, "h", "4"], [str(k) for k in range(6000)]
    rows = spark.createDataFrame(list(zip(("0", "1"), names, values, strict=True)), "path string, names array<string>, values array<string>")
    rows = rows.select(F.lit("POST").alias("method"), "path", F.map_from_arrays("names", "values").alias("headers"), F.lit(None).cast("binary").alias("body"))
    found = {r.path: r.headers for r in routed(rows, ROUTE).collect()}
    assert found == {"0": {"a": "3", "b": None, "c": "4"}, "1": {f"x{k}": str(3000 + k) for k in range(3000)}}


def test_one_name_for_both_destinations(spark):
    same = Route(prefix="abc", match="one", default="one")
    found = {r.path: r for r in routed(requests(spark), same).collect()}
    assert {r.destination for r in found.values()} == {"one"}
    assert [("authorization" in found[f"/p{i}"].headers) for i in range(len(BODIES))] == [not hit for _, hit in BODIES]


def test_stream_gives_what_the_table_gives(spark, tmp_path):
    data = requests(spark)
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    for part in data.randomSplit([0.5, 0.5], seed=1):
        part.write.mode("append").parquet(folder)
        log_decisions(read_requests(spark, folder), ROUTE, target, str(tmp_path / "state")).awaitTermination()
    log_decisions(read_requests(spark, folder), ROUTE, target, str(tmp_path / "state")).awaitTermination()  # nothing new
    both = [sorted(map(tuple, x.collect())) for x in (spark.read.parquet(target), decisions(routed(data, ROUTE)))]
    assert both[0] == both[1] and "dummy" not in str(both)
