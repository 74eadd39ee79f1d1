"""Lenient reading of numbers and kinds in JSON payloads held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that counts as a number, and text that counts as a whole number.
_DECIMAL_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
_WHOLE_TEXT = r"^\s*[+-]?\d+\s*$"


def parse_sealed(text: Column) -> Column:
    """The JSON in ``text`` as VARIANT, inside an array that ends with the text's hash.

    ``try_parse_json`` stops after the first value and ignores what follows it. Parsed this way, a
    value followed by anything else loses its place; see ``unseal``.
    """
    seal = F.xxhash64(text).cast("string")
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), seal, F.lit("]")))


def unseal(pair: Column, text: Column) -> Column:
    """The JSON value of a sealed text, NULL unless the text is that value and no more."""
    whole = F.try_variant_get(pair, "$[1]", "bigint") == F.xxhash64(text)
    return F.when(whole, F.try_variant_get(pair, "$[0]", "variant"))


def members(body: Column, names: list[str]) -> Column:
    """Members of an object as a struct of VARIANTs, each NULL if absent; NULL for no object."""
    fields = ", ".join(f"{name}: variant" for name in names)
    return F.try_variant_get(body, "$", f"struct<{fields}>")


def type_of(value: Column) -> Column:
    """``OBJECT``, ``ARRAY``, ``STRING``, ``BOOLEAN``, ``VOID`` (a null) or a numeric type.

    NULL where there is no value at all.
    """
    return F.substring_index(F.schema_of_variant(value), "<", 1)


def to_int(value: Column, kind: Column, text_may_have_fraction: bool) -> Column:
    """A value of type ``kind`` as 32-bit int, cut toward zero; NULL if it is not such a number.

    Booleans count as 0 and 1. Text must spell a number, and a whole one unless
    ``text_may_have_fraction``.
    """
    text = F.try_variant_get(value, "$", "string")
    spelled = text.rlike(_DECIMAL_TEXT if text_may_have_fraction else _WHOLE_TEXT)
    readable = ~kind.isin("OBJECT", "ARRAY", "VOID") & ((kind != "STRING") | spelled)
    return F.when(readable, F.try_variant_get(value, "$", "double")).try_cast("int")


def to_kind(value: Column, kind: Column) -> Column:
    """The event kind: ``click`` if absent, the text ``None`` for a null, NULL if not a scalar."""
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(kind.isNull(), F.lit("click"))
        .when(kind == "VOID", F.lit("None"))
        .when(kind.isin("OBJECT", "ARRAY"), F.lit(None))
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )
