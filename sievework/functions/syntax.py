"""Is a text well-formed JSON, is it valid Python?

Spark's JSON functions accept and reject other texts than a strict parser (trailing text,
NaN, repeated keys), and there is none for Python, so these two are Arrow UDFs.
"""

from __future__ import annotations

import ast
import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _error(parse, text: str) -> str | None:
    try:
        parse(text)
    except (ValueError, SyntaxError, RecursionError, MemoryError) as e:
        return str(e)
    return None


@F.arrow_udf(StringType())
def json_error(texts: pa.Array) -> pa.Array:
    """Why a text isn't JSON; null if it is, or if the text is null."""
    return pa.array([None if t is None else _error(json.loads, t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def python_error(texts: pa.Array) -> pa.Array:
    """Why a text isn't a Python module; null if it is, or if the text is null."""
    return pa.array([None if t is None else _error(ast.parse, t) for t in texts.to_pylist()], pa.string())


def string_field(body: Column, name: str) -> Column:
    """A text field of a JSON object by the strict parser; of repeated fields the last.

    Empty for anything else: null, no JSON, no object, no such field, a field of another kind.
    """

    def value(text: str | None) -> str:
        try:
            found = json.loads(text or "")
        except (ValueError, RecursionError):
            return ""
        field = found.get(name) if isinstance(found, dict) else None
        return field.encode("utf-8", "replace").decode() if isinstance(field, str) else ""  # half of a surrogate pair is no text

    @F.arrow_udf(StringType())
    def fields(texts: pa.Array) -> pa.Array:
        return pa.array([value(t) for t in texts.to_pylist()], pa.string())

    return fields(body)


def error_envelope(kind: Column, text: Column) -> Column:
    """{"type": "error", "error": {"type": kind, "message": text}}"""
    return F.to_json(F.struct(F.lit("error").alias("type"), F.struct(kind.alias("type"), text.alias("message")).alias("error")))
