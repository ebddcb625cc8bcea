"""Attribute text - JSON or a Python dict literal - to typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A quoted string with its escapes, a bare word, or any other single character.
# The loops are possessive, so long strings do not backtrack.
TOKENS = (
    r"'[^'\\]*+(?:\\[\s\S][^'\\]*+)*+'"
    r'|"[^"\\]*+(?:\\[\s\S][^"\\]*+)*+"'
    r"|[A-Za-z0-9_]++"
    r"|[\s\S]"
)

CORRUPT = "_corrupt"


def as_json(text: Column) -> Column:
    """Rewrite Python's None/True/False outside strings; a blank text is an empty object."""
    filled = F.when(text.isNull() | (F.trim(text) == ""), "{}").otherwise(text)
    tokens = F.regexp_extract_all(filled, F.lit(TOKENS), F.lit(0))
    rewritten = F.transform(
        tokens,
        lambda t: F.when(t == "None", "null")
        .when(t == "True", "true")
        .when(t == "False", "false")
        .otherwise(t),
    )
    return F.array_join(rewritten, "")


def parse_attributes(text: Column, schema: T.StructType, strict: bool = False) -> Column:
    """Struct of the declared fields. Unreadable text gives NULLs, or fails when strict."""
    options = {
        "allowSingleQuotes": "true",
        "allowBackslashEscapingAnyCharacter": "true",
        "allowUnquotedControlChars": "true",
    }
    if strict:
        options["mode"] = "FAILFAST"
        return F.from_json(as_json(text), schema, options)
    options["columnNameOfCorruptRecord"] = CORRUPT
    return F.from_json(as_json(text), T.StructType([*schema, T.StructField(CORRUPT, T.StringType())]), options)
