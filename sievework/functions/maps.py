"""Key/value maps. Keys are compared in lower case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def drop_keys(entries: Column, names: list[str]) -> Column:
    return F.map_filter(entries, lambda k, _: ~F.lower(k).isin([n.lower() for n in names]))


def put(entries: Column, key: str, value: Column) -> Column:
    """entries with the key set, whatever stood under it in any case."""
    return F.map_concat(drop_keys(entries, [key]), F.create_map(F.lit(key), value))


def put_default(entries: Column, key: str, value: Column) -> Column:
    """entries with the key set if it isn't there in any case."""
    there = F.exists(F.map_keys(entries), lambda k: F.lower(k) == key.lower())
    return F.when(there, entries).otherwise(put(entries, key, value))


def joined(entries: Column, between: str = "&") -> Column:
    """key=value texts in order."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(entries), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), between)
