"""Findings of all kinds as one relation, and the report on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finding(rows: DataFrame, kind: str, subject: Column, message: Column) -> DataFrame:
    """(kind, subject, message) for each row."""
    return rows.select(F.lit(kind).alias("kind"), subject.cast("string").alias("subject"), message.alias("message"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def summary(findings: DataFrame, counts: DataFrame) -> DataFrame:
    """One row (ok, n_errors, counts), summed where the findings are; counts: one row of numbers."""
    pairs = [x for c in counts.columns for x in (F.lit(c), F.col(c).cast("long"))]
    total = findings.agg(F.count("*").alias("n_errors"))
    return counts.select(F.create_map(*pairs).alias("counts")).crossJoin(total).select((F.col("n_errors") == 0).alias("ok"), "n_errors", "counts")  # one row by one row


def json_lines(findings: DataFrame) -> DataFrame:
    """Each finding as a JSON object, however many there are."""
    return findings.select(F.to_json(F.struct("kind", "subject", "message")).alias("json"))


def report(findings: DataFrame, counts: DataFrame) -> DataFrame:
    """One row (ok, counts, errors); counts: one row of numbers.

    The messages are one array, as a small report needs them; for many use summary and json_lines.
    """
    errors = findings.agg(F.array_sort(F.collect_list("message")).alias("errors"))
    pairs = [x for c in counts.columns for x in (F.lit(c), F.col(c).cast("long"))]
    return counts.select(F.create_map(*pairs).alias("counts")).crossJoin(errors).select((F.size("errors") == 0).alias("ok"), "counts", "errors")  # one row by one row


def as_json(report: DataFrame, pretty: bool = True) -> DataFrame:
    return report.select(F.to_json(F.struct("ok", "counts", "errors"), {"pretty": str(pretty).lower()}).alias("json"))


def exit_code(report: DataFrame) -> int:
    return 0 if report.first().ok else 1
