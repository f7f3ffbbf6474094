"""The tree source and the consistency check on small trees that hold what tables don't."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringEndsWith, StringStartsWith
from pyspark.sql.types import StructType

from sievework.functions.text import as_text, whole_characters
from sievework.operators import findings
from sievework.plans.tree_check import Rules, check, judged, walked
from sievework.sources import trees
from sievework.sources.trees import TreeSource, depth, read_tree


def make(root, files: dict):
    for name, content in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())


def test_hidden_names_and_folders(spark, tmp_path):
    make(tmp_path, {".a/.b/_c/d.txt": "x", "_e/f.bin": b"\xff", "g": "", ".git/h/i/j/k": "deep"})
    (tmp_path / "x.json").mkdir()
    rows = {r.path: (r.is_file, None if r.content is None else bytes(r.content)) for r in read_tree(spark, str(tmp_path)).collect()}
    assert rows == {
        ".a": (False, None), ".a/.b": (False, None), ".a/.b/_c": (False, None), ".a/.b/_c/d.txt": (True, b"x"),
        "_e": (False, None), "_e/f.bin": (True, b"\xff"), "g": (True, b""), "x.json": (False, None),
        ".git": (False, None), ".git/h": (False, None), ".git/h/i": (False, None), ".git/h/i/j": (False, None), ".git/h/i/j/k": (True, b"deep"),
    }
    for levels in (0, 1, 5):
        assert {r.path for r in read_tree(spark, str(tmp_path), levels).collect()} == set(rows)


RULES = Rules(
    required=("need", "dir", "gone"),
    forbidden=("bad", "none"),
    originals=".own/skills",
    adapters=".other/skills",
    pointer=r"see `(\.own/skills/[^`]+/SKILL\.md)`",
    unadapted=(".own/skills/t/spare/SKILL.md",),
    roster="team.yaml",
    member=r"^\s*agent_type:\s*([a-z0-9-]+)\s*$",
    members="people",
    outside=("guest",),
    own="check.py",
)
TOKEN = "gh" + "p_" + "a" * 20


def tree() -> dict:
    return {
        "need": "", "dir/x": "", "bad/y": "",
        ".own/skills/t/one/SKILL.md": "", ".own/skills/t/spare/SKILL.md": "", ".own/skills/t/lost/SKILL.md": "", ".own/skills/SKILL.md": "", ".own/skills/t/u/v/SKILL.md": "",
        ".other/skills/t/one/SKILL.md": "see `.own/skills/t/one/SKILL.md`, not see `.own/skills/t/x/SKILL.md`",
        ".other/skills/t/none/SKILL.md": "nothing",
        ".other/skills/t/far/SKILL.md": "see `.own/skills/t/away/SKILL.md`",
        "people/a/alice.md": "", "people/bob.md": "", "people/a/b.c.md": "",
        "team.yaml": "  agent_type: alice\r\nagent_type:\n   carol  \n\u00a0agent_type: carol\nagent_type: guest\nagent_type: X\nnot agent_type: dave\nagent_type: eve\u2028\nagent_type: b.c\nagent_type: b\n",
        "ok.json": '{"a": NaN}', "bad.json": '{"a":1} x', "bytes.json": b"\xff", ".git/skip.json": "{", "__pycache__/seen.json": "[",
        "ok.py": "x = 1\n", "bad.py": "x = (", "empty.py": "", ".git/skip.py": "(",
        "check.py": "'/Users/'", "home.txt": "in /Users/me", "both.md": "/Users/ " + TOKEN + " " + TOKEN, "short.md": TOKEN[:-1],
        "key.txt": "-----BEGIN " + "EC PRIVATE KEY-----", "dsa.txt": "-----BEGIN " + "DSA PRIVATE KEY-----", "x.bin": TOKEN, "y.pyc": TOKEN, ".DS_Store": TOKEN, "__pycache__/z": TOKEN, "odd": b"\xff" + TOKEN.encode(),
    }


def test_check(spark, tmp_path):
    make(tmp_path, tree())
    rows, report = check(read_tree(spark, str(tmp_path)), RULES)
    found = sorted((r.kind, r.subject) for r in rows.collect())
    assert found == sorted([
        ("required", "gone"), ("forbidden", "bad"),
        ("pointer", ".other/skills/t/none/SKILL.md"), ("target", ".other/skills/t/far/SKILL.md"), ("unadapted", ".own/skills"),
        ("roster", "carol"), ("roster", "carol"), ("roster", "eve"), ("roster", "b"),
        ("json", "bad.json"), ("json", "bytes.json"), ("json", "__pycache__/seen.json"), ("python", "bad.py"),
        ("home", "home.txt"), ("home", "both.md"), ("secret", "both.md"), ("secret", "key.txt"),
    ])
    one = report.first()
    assert not one.ok and len(one.errors) == len(found)
    text = next(m for m in one.errors if m.startswith("originals that no adapter names"))
    assert text.endswith(": .own/skills/t/lost/SKILL.md, .own/skills/t/spare/SKILL.md")
    skipped = {".git/skip.json", "__pycache__/seen.json", ".git/skip.py", "x.bin", "y.pyc", ".DS_Store", "__pycache__/z"}
    assert one.counts == {"originals": 3, "adapters": 3, "members": 2, "python_files": 4, "files": len(set(tree()) - skipped)}
    assert findings.exit_code(report) == 1
    assert json.loads(findings.as_json(report).first().json)["ok"] is False


def test_clean_tree_and_missing_roster(spark, tmp_path):
    make(tmp_path, {"a/b.txt": "fine"})
    _, report = check(read_tree(spark, str(tmp_path)), Rules(required=("a/b.txt",), roster="none.yaml", member="(x)", members="a"))
    assert report.first().ok and findings.exit_code(report) == 0


def test_expected_original_absent_is_a_finding(spark, tmp_path):
    make(tmp_path, {"a": ""})
    rows, _ = check(read_tree(spark, str(tmp_path)), Rules(originals="o", adapters="p", pointer="(x)", unadapted=("o/a/b/SKILL.md",)))
    assert [(r.kind, r.message) for r in rows.collect()] == [("unadapted", "originals that no adapter names, other than allowed: ")]


def listing(root, columns, filters=(), **options):
    """What the source itself reads, without Spark; filters that it leaves to Spark."""
    schema = StructType()
    for c in columns:
        schema.add(c, "string")
    reader = TreeSource({"path": str(root), **options}).reader(schema)
    left = list(reader.pushFilters(list(filters)))
    return sorted((r for p in reader.partitions() for b in reader.read(p) for r in zip(*b.to_pydict().values(), strict=True)), key=str), left


@pytest.fixture
def entered(monkeypatch):
    """Names of the folders that are listed; opening a file fails."""
    names, scan = [], os.scandir

    def seen(path):
        names.append(os.path.basename(path))
        return scan(path)

    def never(*_, **__):
        raise AssertionError("a file is opened")

    monkeypatch.setattr(trees.os, "scandir", seen)
    monkeypatch.setattr("builtins.open", never)
    return names


TREE = {"a/b/c.txt": "12345", "a/d.md": "", "e/f.md": "x", ".git/objects/g": "x", "h.md": "x"}


def test_names_alone_open_no_file(tmp_path, entered):
    for name in TREE:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        os.close(os.open(tmp_path / name, os.O_CREAT | os.O_WRONLY))
    assert [r[0] for r in listing(tmp_path, ["path", "is_file", "size"])[0] if r[1]] == sorted(TREE)


def test_excluded_folders_are_not_entered(tmp_path, entered, monkeypatch):
    for name in TREE:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        os.close(os.open(tmp_path / name, os.O_CREAT | os.O_WRONLY))
    scan = trees.os.scandir

    def unreadable(path):
        if os.path.basename(path) == ".git":
            raise PermissionError(path)
        return scan(path)

    monkeypatch.setattr(trees.os, "scandir", unreadable)
    for levels in ("0", "3"):
        rows, _ = listing(tmp_path, ["path"], skip='[".git"]', levels=levels)
        assert [r[0] for r in rows] == [".git", "a", "a/b", "a/b/c.txt", "a/d.md", "e", "e/f.md", "h.md"]
        rows, _ = listing(tmp_path, ["path"], bases='["a/b", "e"]', levels=levels)
        assert [r[0] for r in rows] == ["a/b", "a/b/c.txt", "e", "e/f.md"]
    with pytest.raises(PermissionError):
        listing(tmp_path, ["path"])


@pytest.mark.parametrize("levels", ["0", "1", "4"])
def test_filters_are_taken_while_listing(tmp_path, entered, levels):
    for name in TREE:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        os.close(os.open(tmp_path / name, os.O_CREAT | os.O_WRONLY))
    path, size = ("path",), GreaterThan(("size",), 3)
    rows, left = listing(tmp_path, ["path"], [StringStartsWith(path, "a/"), StringEndsWith(path, ".txt"), EqualTo(("is_file",), True), size], levels=levels)
    assert rows == [("a/b/c.txt",)] and left == [size] and set(entered) == {"", "a", "b"}
    entered.clear()
    rows, left = listing(tmp_path, ["path"], [In(path, ("e/f.md", "h.md", "none/x"))], levels=levels)
    assert rows == [("e/f.md",), ("h.md",)] and not left and set(entered) == {"", "e"}


def test_spark_hands_its_filters_over(spark, tmp_path):
    make(tmp_path, TREE)
    found = read_tree(spark, str(tmp_path), columns=("path", "is_file")).filter(F.col("is_file") & F.startswith("path", F.lit("a/")) & (depth() == 2))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "StartsWith" not in plan and [tuple(r) for r in found.collect()] == [("a/d.md", True)]


def test_many_files_in_one_folder_are_many_partitions(spark, tmp_path):
    flat = tmp_path / "a" / "flat"
    flat.mkdir(parents=True)
    for i in range(100_000):
        os.close(os.open(flat / str(i), os.O_CREAT | os.O_WRONLY))
    tree = read_tree(spark, str(tmp_path))
    assert tree.rdd.getNumPartitions() >= 10
    sizes = [r[1] for r in tree.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 100_002 and max(sizes) < 15_000


def joined(rows):
    """Files put together again from their rows."""
    out = {}
    for r in sorted((r for r in rows if r.is_file), key=lambda r: r.at):
        out[r.path] = out.get(r.path, b"")[: r.at] + bytes(r.content)
    return out


def test_parts_make_up_their_file(spark, tmp_path):
    rng = random.Random(2)
    files = {f"{i % 3}/{i}": rng.randbytes(n) for i, n in enumerate((0, 1, 7, 8, 9, 16, 17, 100))}
    make(tmp_path, files)
    rows = read_tree(spark, str(tmp_path), part=8, overlap=4).collect()
    assert joined(rows) == files and max(len(r.content) for r in rows if r.is_file) == 12
    assert sorted((r.path, r.at) for r in rows if r.is_file) == sorted((p, k * 8) for p, b in files.items() for k in range(max(1, -(-len(b) // 8))))


def test_parts_are_text_if_their_file_is(spark, tmp_path):
    rng = random.Random(3)
    pieces = ["a", "é", "漢", "\U0001f600"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(30))).encode() for _ in range(150)]
    for i in range(50, 150):  # one byte put in, left out or changed
        t, at = texts[i], rng.randrange(len(texts[i]) + 1)
        texts[i] = t[:at] + rng.choice([b"", bytes([rng.choice([0x80, 0xBF, 0xC3, 0xE6, 0xF0, 0x61, 0xFF])])]) + t[at + rng.choice([0, 1]) :]
    make(tmp_path, {str(i): t for i, t in enumerate(texts)})

    def fine(t):
        try:
            t.decode()
        except UnicodeDecodeError:
            return False
        return True

    rows = read_tree(spark, str(tmp_path), part=8, overlap=4).filter("is_file")
    text = as_text(whole_characters(F.col("content"), F.col("at") == 0, F.col("at") + F.octet_length("content") >= F.col("size")))
    found = {r.path: r.ok for r in rows.groupBy("path").agg(F.min(text.isNotNull()).alias("ok")).collect()}
    assert found == {str(i): fine(t) for i, t in enumerate(texts)} and set(found.values()) == {True, False}


def test_three_gigabytes_in_rows_of_sixteen_megabytes(spark, tmp_path):
    part = 16 << 20
    with open(tmp_path / "big.txt", "wb") as file:
        file.truncate(3 << 30)  # zeros are text
        file.seek(5 * part - 1)
        file.write("é".encode())
        file.seek(9 * part - 10)
        file.write(TOKEN.encode())
    (tmp_path / "big.json").symlink_to(tmp_path / "big.txt")
    rows = walked(spark, str(tmp_path), Rules(), part=part).filter("path = 'big.txt'")
    assert rows.count() == 192 and rows.agg(F.max(F.octet_length("content"))).first()[0] == part + trees.OVERLAP
    found, _ = check(walked(spark, str(tmp_path), Rules(), part=part), Rules())
    assert sorted((r.kind, r.subject) for r in found.collect()) == [("secret", "big.json"), ("secret", "big.txt"), ("size", "big.json")]


def test_one_scan_and_no_contents_kept(spark, tmp_path):
    make(tmp_path, tree())
    plan = judged(walked(spark, str(tmp_path), RULES), RULES)
    assert plan._jdf.queryExecution().executedPlan().toString().count("BatchScan") == 1 and "content" not in plan.columns
    for out in check(walked(spark, str(tmp_path), RULES), RULES):
        assert "filetree" not in out._jdf.queryExecution().executedPlan().toString()


def test_check_in_small_parts_finds_the_same(spark, tmp_path):
    make(tmp_path, {k: v for k, v in tree().items() if k.endswith((".txt", ".md")) and "/" not in k})
    whole, parts = (sorted(map(tuple, check(read_tree(spark, str(tmp_path), part=n, overlap=64), Rules())[0].collect())) for n in (1 << 20, 16))
    assert whole == parts and whole
