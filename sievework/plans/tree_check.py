"""Consistency of a file tree: presence, pointers, rosters, syntax and contents.

Everything is a parameter.  What would stop a script halfway - a missing roster, bytes
that aren't text - is a finding here, and the report goes on.  Exclusions look at paths
relative to the root.

The tree is read once: one projection judges each row and keeps what it found and what it
refers to, but no contents; that is stored, and references, presence and counts are looked
up there.  A file may come as several rows (see sources.trees): contents are judged row by
row, and each kind is found once a file.  Syntax, pointers and rosters need a file in one
row; of larger ones it is a finding that they weren't judged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.syntax import json_error, python_error
from ..functions.text import any_pattern, as_text, first_match, line_matches, message, stem, whole_characters
from ..operators.findings import finding, report, union
from ..operators.membership import dangling, difference, found, listed, missing, mismatch, unknown
from ..sources.trees import below, literal, other_than, read_tree, without
from ..tables import stored

# Shapes of tokens and keys, and the home folder's path, that a content scan reports.
SECRETS = (
    r"gh[pousr]_[A-Za-z0-9]{20,}",
    r"sk-[A-Za-z0-9_-]{20,}",
    r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
)
HOME = "/Users/"


@dataclass(frozen=True)
class Rules:
    """What a tree must be like. Pointers and rosters are looked at if their folders are given."""

    required: tuple[str, ...] = ()
    forbidden: tuple[str, ...] = ()
    originals: str = ""
    adapters: str = ""
    marker: str = "SKILL.md"
    pointer: str = ""
    unadapted: tuple[str, ...] = ()
    roster: str = ""
    member: str = ""
    members: str = ""
    outside: tuple[str, ...] = ()
    secrets: tuple[str, ...] = SECRETS
    home: str = HOME
    own: str = ""
    # What isn't looked into.
    hidden: tuple[str, ...] = (".git",)
    skipped_folders: tuple[str, ...] = (".git", "__pycache__", ".pytest_cache")
    skipped_suffixes: tuple[str, ...] = (".bin", ".pyc")
    skipped_names: tuple[str, ...] = (".DS_Store",)


#: What a finding of each kind says of its subject and detail.
SAYS = {
    "required": "expected, but not there: {}",
    "forbidden": "not allowed, but there: {}",
    "pointer": "names no original: {}",
    "target": "names an original that is no file: {} -> {}",
    "unadapted": "originals that no adapter names, other than allowed: {}",
    "roster": "on the roster without a definition: {}",
    "json": "no JSON: {}: {}",
    "python": "no Python: {}: {}",
    "size": "too large to be judged whole: {}: {} bytes",
    "home": "a home folder is named: {}",
    "secret": "looks like a credential: {}",
}


def kind_of(rows: DataFrame, kind: str, subject: str, *details: str) -> DataFrame:
    values = details or (subject,)
    return finding(rows, kind, F.col(subject), message(SAYS[kind], *[F.col(v) for v in values]))


def none() -> Column:
    return F.lit(None).cast("string")


def judged(tree: DataFrame, rules: Rules) -> DataFrame:
    """(path, is_file, original, adapter, python, scanned, member, target, named, found) for each row of the tree.

    Without size and at (see sources.trees) a row is a whole file.
    """
    path, content = F.col("path"), F.col("content")
    size, at = (F.col(c) if c in tree.columns else F.lit(v).cast("long") for c, v in (("size", None), ("at", 0)))
    first, last = at == 0, F.coalesce(at + F.octet_length(content) >= size, F.lit(True))
    open_ = without(list(rules.hidden))
    ends = lambda e: F.col("is_file") & F.endswith(path, F.lit(e)) & open_
    deep = lambda base: F.col("is_file") & below(base, 3, "/" + rules.marker) if rules.pointer else F.lit(False)
    roster = F.col("is_file") & (path == rules.roster) if rules.member else F.lit(False)
    member = F.col("is_file") & below(rules.members, 2, ".md") if rules.member else F.lit(False)
    rows = tree.select(
        "path", "is_file", "content", first.alias("first"), last.alias("last"), F.coalesce(size, F.octet_length(content)).alias("size"),
        deep(rules.originals).alias("original"), deep(rules.adapters).alias("adapter"), roster.alias("roster"), F.when(member, stem(path)).alias("member"),
        ends(".json").alias("json"), ends(".py").alias("python"),
        (F.col("is_file") & without(list(rules.skipped_folders), list(rules.skipped_suffixes), list(rules.skipped_names))).alias("scanned"),
    )
    judges = F.col("json") | F.col("python") | F.col("adapter") | F.col("roster")
    whole = F.col("first") & F.col("last")
    text = F.when(judges | F.col("scanned"), as_text(whole_characters(content, F.col("first"), F.col("last"))))
    rows = rows.select("*", text.alias("text"), (judges & whole).alias("whole"), (judges & F.col("first") & ~whole).alias("large")).drop("content")
    # the text of other rows doesn't reach Python
    only = lambda flag: F.when(F.col(flag) & F.col("whole"), F.col("text"))
    rows = rows.withColumns({"json_error": json_error(only("json")), "python_error": python_error(only("python"))})
    broken = lambda flag: F.when(F.col(flag) & F.col("whole"), F.when(F.col("text").isNull(), F.lit("not UTF-8")).otherwise(F.col(f"{flag}_error")))
    looked = F.col("scanned") & other_than(rules.own)
    entry = lambda kind, detail: F.when(detail.isNotNull(), F.struct(F.lit(kind).alias("kind"), detail.alias("detail")))
    entries = F.array(
        entry("json", broken("json")),
        entry("python", broken("python")),
        entry("size", F.when(F.col("large"), F.col("size").cast("string"))),
        entry("home", F.when(looked & F.contains("text", F.lit(rules.home)), F.lit(""))),
        entry("secret", F.when(looked & any_pattern(F.col("text"), list(rules.secrets)), F.lit(""))),
    )
    target = F.when(F.col("adapter") & F.col("whole"), first_match(F.col("text"), rules.pointer)) if rules.pointer else none()
    named = F.when(F.col("roster") & F.col("whole"), line_matches(F.col("text"), rules.member)) if rules.member else F.array().cast("array<string>")
    return rows.select("path", "is_file", "first", "original", "adapter", "python", "scanned", "member", "whole", target.alias("target"), named.alias("named"), F.filter(entries, lambda e: e.isNotNull()).alias("found"))


def presence(seen: DataFrame, rules: Rules) -> list[DataFrame]:
    spark = seen.sparkSession
    need, ban = (literal(spark, "path", list(x)) for x in (rules.required, rules.forbidden))
    return [kind_of(missing(need, seen, "path"), "required", "path"), kind_of(found(ban, seen, "path"), "forbidden", "path")]


def contents(seen: DataFrame) -> list[DataFrame]:
    """What rows themselves showed, once for each file and kind."""
    own = seen.select("path", F.explode("found").alias("f")).groupBy("path", "f.kind").agg(F.min("f.detail").alias("detail"))
    says = F.coalesce(*[F.when(F.col("kind") == k, message(SAYS[k], *[F.col("path"), F.col("detail")][: SAYS[k].count("{}")])) for k in ("json", "python", "size", "home", "secret")])
    return [own.select("kind", F.col("path").alias("subject"), says.alias("message"))]


def pointers(seen: DataFrame, rules: Rules) -> list[DataFrame]:
    adapters, pointing = seen.filter("adapter and whole"), seen.filter("target is not null").select("path", "target")
    loose = difference(seen.filter("original").select("path"), pointing.select(F.col("target").alias("path")))
    wrong = mismatch(loose, literal(seen.sparkSession, "path", list(rules.unadapted))).limit(1)  # is there any?
    names = listed(loose, "path").join(wrong.select(F.lit(1)), how="left_semi").withColumn("originals", F.lit(rules.originals))
    return [
        kind_of(adapters.filter("target is null").select("path"), "pointer", "path"),
        kind_of(dangling(pointing, "target", seen.filter("is_file and first").select("path"), "path"), "target", "path", "path", "target"),
        kind_of(names, "unadapted", "originals", "path"),
    ]


def rosters(seen: DataFrame, rules: Rules) -> list[DataFrame]:
    named = seen.select(F.explode("named").alias("name"))
    local = seen.filter("member is not null").select(F.col("member").alias("name"))
    return [kind_of(unknown(named, "name", local, literal(seen.sparkSession, "name", list(rules.outside))), "roster", "name")]


def counts(seen: DataFrame) -> DataFrame:
    """One row of numbers: distinct originals and members; adapters, Python files and files looked at."""
    number = lambda flag, of: F.count(F.when(F.col(flag) & F.col("first"), F.lit(1))).alias(of)
    return seen.agg(F.count_distinct(F.when(F.col("original"), F.col("path"))).alias("originals"), number("adapter", "adapters"), F.count_distinct("member").alias("members"), number("python", "python_files"), number("scanned", "files"))


def checked(tree: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Findings (kind, subject, message) and the counts, one row of numbers, on (path, is_file, content); see judged."""
    seen = stored(judged(tree, rules))
    parts = presence(seen, rules) + contents(seen)
    if rules.pointer:
        parts += pointers(seen, rules)
    if rules.member:
        parts += rosters(seen, rules)
    return union(parts), counts(seen)


def check(tree: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Findings and the report (ok, counts, errors)."""
    findings, numbers = checked(tree, rules)
    return findings, report(findings, numbers)


def walked(spark: SparkSession, root: str, rules: Rules, **options) -> DataFrame:
    """The tree below root for these rules: folders that no rule looks into aren't entered."""
    looked = {part for p in (*rules.required, *rules.forbidden, rules.originals, rules.adapters, rules.members, rules.roster) for part in p.split("/")}
    skip = set(rules.skipped_folders) & set(rules.hidden) - looked
    return read_tree(spark, root, skip=sorted(skip), **options)
