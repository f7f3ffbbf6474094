"""Routing of request records by a field of their JSON body.

A map of each record on its own, so the same function serves tables and streams.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.maps import drop_keys, put_default
from ..functions.syntax import string_field
from ..functions.text import int_or

SCHEMA = "method string, path string, headers map<string,string>, body binary"

# Headers that concern one connection and aren't passed on; and those that carry credentials.
HOP_HEADERS = ("host", "content-length", "connection", "keep-alive", "transfer-encoding", "upgrade", "proxy-authorization")
CREDENTIALS = ("authorization", "x-api-key")


@dataclass(frozen=True)
class Route:
    """Records whose field begins with the prefix go to `match`, others to `default`.

    versions: headers that records to `match` get if they lack them.  Credentials of such
    records are dropped; none are put in.
    """

    prefix: str
    match: str
    default: str
    match_url: str = ""
    default_url: str = ""
    field: str = "model"
    versions: tuple[tuple[str, str], ...] = ()


def chosen(value: Column, route: Route) -> Column:
    """Where a record with this value goes; null goes to the default."""
    return F.when(F.startswith(value, F.lit(route.prefix)), F.lit(route.match)).otherwise(F.lit(route.default))


def lowered(headers: Column) -> Column:
    """The map with its keys in lower case; of keys that differ in case only the last stands."""
    entries = F.transform(F.map_entries(headers), lambda e, i: F.struct(F.lower(e["key"]).alias("key"), i.alias("i"), e["value"].alias("value")))
    last = lambda all_: F.filter(all_, lambda e, i: ~F.coalesce(F.get(all_, i + 1)["key"] == e["key"], F.lit(False)))
    kept = F.element_at(F.transform(F.array(F.array_sort(entries)), last), 1)  # sorted once, not for each entry
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"], e["value"])))


def routed(records: DataFrame, route: Route) -> DataFrame:
    """(method, path, destination, url, headers, model, length) for each record. Header names are in lower case."""
    body = F.when(F.is_valid_utf8(F.col("body").cast("string")), F.col("body").cast("string"))
    model = F.coalesce(string_field(body, route.field), F.lit(""))
    hit = F.startswith(F.col("model"), F.lit(route.prefix))
    low = lowered(F.coalesce("headers", F.create_map().cast("map<string,string>")))
    kept = drop_keys(F.col("low"), list(HOP_HEADERS))
    matched: Column = drop_keys(kept, list(CREDENTIALS))
    for name, value in route.versions:
        matched = put_default(matched, name, F.lit(value))
    rows = records.select("method", "path", low.alias("low"), model.alias("model")).withColumn("destination", chosen(F.col("model"), route))
    return rows.select(
        "method",
        "path",
        "destination",
        F.concat(F.when(hit, F.lit(route.match_url)).otherwise(F.lit(route.default_url)), F.coalesce("path", F.lit(""))).alias("url"),
        F.when(hit, matched).otherwise(kept).alias("headers"),
        "model",
        int_or(F.try_element_at("low", F.lit("content-length"))).alias("length"),
    )


def decisions(rows: DataFrame) -> DataFrame:
    """What may be logged: no headers, no bodies."""
    return rows.select("method", "path", F.coalesce(F.nullif("model", F.lit("")), F.lit("-")).alias("model"), "destination")
