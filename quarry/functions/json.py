"""Strict JSON checks on text columns.

Every Spark JSON path (reader, ``from_json``, ``parse_json``,
``json_object_keys``) accepts trailing content: ``{"a":1} junk`` parses
as ``{"a":1}``.  Wrapping the line in brackets and asking for an array of
exactly one element rejects trailing junk, ``}{`` pairs and blanks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strict_variant(line) -> Column:
    """The line as a VARIANT if it is exactly one JSON value, else null."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), _c(line), F.lit("]")))
    ok = F.coalesce(F.expr("1") == F.size(F.try_variant_get(wrapped, "$", "array<variant>")), F.lit(False))
    return F.when(ok, F.try_variant_get(wrapped, "$[0]", "variant"))


def variant_kind(v) -> Column:
    """'object', 'array', 'string', ... or null."""
    return F.schema_of_variant(_c(v))


def is_object(v) -> Column:
    return F.coalesce(F.schema_of_variant(_c(v)).startswith("OBJECT"), F.lit(False))


def object_keys(line) -> Column:
    """Top-level keys of a JSON object line (null for arrays/scalars)."""
    return F.json_object_keys(_c(line))
