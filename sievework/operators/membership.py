"""Membership between relations: semi and anti joins and set differences.

None of these hints at a broadcast: Spark picks one when a side's size allows it.  Null
keys match nothing, so a null on the right doesn't empty an anti join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing(required: DataFrame, present: DataFrame, on: str) -> DataFrame:
    """Rows of required without a match; repeats stay."""
    return required.join(present.select(on), on, "left_anti")


def found(forbidden: DataFrame, present: DataFrame, on: str) -> DataFrame:
    """Rows of forbidden with a match, once each."""
    return forbidden.join(present.select(on), on, "left_semi")


def dangling(references: DataFrame, key: str, targets: DataFrame, target: str) -> DataFrame:
    """References whose target doesn't exist."""
    return references.join(targets.select(F.col(target).alias(key)), key, "left_anti")


def unknown(names: DataFrame, on: str, *known: DataFrame) -> DataFrame:
    """Names in none of the known sets; one row for each occurrence."""
    out = names
    for k in known:
        out = out.join(k.select(on), on, "left_anti")
    return out


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of a that aren't in b."""
    return a.subtract(b)


def mismatch(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows in only one of two sets, with the side they are on."""
    return actual.subtract(expected).withColumn("side", F.lit("unexpected")).unionByName(expected.subtract(actual).withColumn("side", F.lit("absent")))


def listed(rows: DataFrame, column: str, between: str = ", ", by: tuple[str, ...] = ()) -> DataFrame:
    """The distinct values in order, as one text, for each group; without groups one row, empty if there are none."""
    return rows.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_set(column)), between).alias(column))
