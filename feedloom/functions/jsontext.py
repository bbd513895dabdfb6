"""Strict JSON parsing of generated text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_json(text: Column) -> Column:
    """The text as a variant if all of it is exactly one JSON value, else null.

    The built-in parser stops after the first value and ignores what follows. As
    the only element of a list and as the value of a field, nothing may follow.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    field = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    alone = F.size(F.try_variant_get(listed, "$", "array<variant>")) == 1
    return F.when(alone & field.isNotNull(), F.try_variant_get(listed, "$[0]", "variant"))


def of_kind(value: Column, kind: str) -> Column:
    """The variant if it is of the kind (OBJECT or ARRAY), else null."""
    return F.when(F.schema_of_variant(value).startswith(kind), value)


def embedded(text: Column, pattern: str) -> Column:
    """Strictly parsed text between the first opening and the last closing bracket."""
    return strict_json(F.regexp_extract(text, pattern, 0))


OBJECT_TEXT = r"(?s)\{.*\}"
ARRAY_TEXT = r"(?s)\[.*\]"
