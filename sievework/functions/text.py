"""Text expressions. All are Spark columns; a null stays null unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .factors import required


def as_text(content: Column) -> Column:
    """Bytes as text with line feeds as line ends; null if they aren't UTF-8."""
    return F.when(F.is_valid_utf8(content.cast("string")), F.regexp_replace(content.cast("string"), "\r\n?", "\n"))


def whole_characters(content: Column, first: Column, last: Column) -> Column:
    """A stretch of a UTF-8 file without the pieces of characters at its ends.

    first, last: whether the file begins or ends with it.  At most three bytes go on either
    side; bytes that aren't UTF-8 stay so in one of two stretches that overlap by four bytes.
    """
    byte = lambda at: F.substring(content, at, 1)
    going_on = lambda at: (byte(at) >= F.unhex(F.lit("80"))) & (byte(at) < F.unhex(F.lit("C0")))
    head = F.when(first | ~going_on(1), 0).when(~going_on(2), 1).when(~going_on(3), 2).otherwise(3)
    n = F.octet_length(content)
    opens = lambda k, least: (n >= k) & (byte(-k) >= F.unhex(F.lit(least)))
    tail = F.when(last, 0).when(opens(1, "C0"), 1).when(going_on(-1) & opens(2, "E0"), 2).when(going_on(-1) & going_on(-2) & opens(3, "F0"), 3).otherwise(0)
    return F.substring(content, head + 1, F.greatest(n - head - tail, F.lit(0)))


def relative(path: Column, root: str) -> Column:
    """path below root, without the root and the slash."""
    return F.substring(path, len(root.rstrip("/")) + 2, 1 << 30)


def stem(path: Column) -> Column:
    """The last name of a path, without its last suffix."""
    return F.regexp_replace(F.regexp_extract(path, "([^/]+)$", 1), r"(?<=.)\.[^.]*$", "")


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null if there is none. The pattern runs twice only where the group is empty or missing."""
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found).when(text.rlike(pattern), found)


def all_matches(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of every match, in order and with repeats."""
    return F.regexp_extract_all(text, F.lit(pattern), group)


def line_matches(text: Column, pattern: str) -> Column:
    """Like all_matches, where ^ and $ stand for line ends (line feeds only) and \\s for all white space."""
    return all_matches(text, f"(?mdU){pattern}")


def any_literal(text: Column, literals: list[str]) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(x)) for x in literals])


def any_pattern(text: Column, patterns: list[str]) -> Column:
    """Whether some pattern matches; one expression, so a text is found once.

    A pattern with required literals runs only on texts that have one of them; if all
    patterns have some, that test stands in front, where a table's reader gets it.
    """
    if not patterns:
        return F.lit(False) & text.isNotNull()
    needs = [required(p) for p in patterns]
    tests = [any_literal(text, need) & text.rlike(p) for p, need in zip(patterns, needs, strict=True) if need]
    if rest := [p for p, need in zip(patterns, needs, strict=True) if not need]:
        tests.append(text.rlike("|".join(f"(?:{p})" for p in rest)))
    out = reduce(Column.__or__, tests)
    return out if rest or len(tests) == 1 else any_literal(text, [x for need in needs for x in need]) & out


def strip(text: Column) -> Column:
    """text without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def or_default(text: Column, default: str = "") -> Column:
    """text, or the default where it is null or empty."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def int_or(text: Column, default: int = 0) -> Column:
    return F.coalesce(text.try_cast("int"), F.lit(default))


def key_value(line: Column) -> Column:
    """struct(key, value) of a `key=value` line: an `export ` prefix and quotes around the value are dropped."""
    bare = strip(F.regexp_replace(strip(line), "^export ", ""))
    at = F.instr(bare, "=")
    key = F.when(at > 0, F.substr(bare, F.lit(1), at - 1)).otherwise(bare)
    value = F.when(at > 0, F.substr(bare, at + 1)).otherwise(F.lit(""))
    return F.struct(strip(key).alias("key"), F.btrim(strip(value), F.lit("'\"")).alias("value"))


def message(template: str, *values: Column) -> Column:
    """The template with {} replaced by the values."""
    parts = template.split("{}")
    pieces = [F.lit(parts[0])]
    for v, rest in zip(values, parts[1:], strict=True):
        pieces += [v.cast("string"), F.lit(rest)]
    return F.concat(*pieces)
