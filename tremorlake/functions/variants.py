"""Typed access to schemaless JSON values.

A key that is absent is SQL NULL; a JSON null is a variant null. Defaults apply to absent keys only.
"""

from pyspark.sql import Column, functions as F

from tremorlake.functions.text import float_text


def sealed(text: Column) -> Column:
    """The text's JSON value and the text's digest, as an array of variants; NULL when that isn't JSON.

    Only a text that is one JSON value as a whole leaves exactly two elements, the second of them the
    digest: no text holds its own digest, so none can close the array and go on by itself.
    """
    return F.from_json(F.concat(F.lit("["), text, F.lit(',"'), _digest(text), F.lit('"]')), "array<variant>")


def seal_holds(parsed: Column, text: Column) -> Column:
    """Whether a sealed text was one JSON value."""
    digest = F.try_variant_get(F.get(parsed, F.lit(1)), "$", "string")
    return F.coalesce((F.size(parsed) == 2) & (digest == _digest(text)), F.lit(False))


def _digest(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def shown(value: Column) -> Column:
    """A scalar as Python prints it: floats in their shortest form, True and False; NULL when absent or null."""
    text = F.try_variant_get(value, "$", "string")
    kind = F.schema_of_variant(value)
    # Whole numbers up to 64 bits are BIGINT; longer ones have 19 digits or more and no fraction.
    whole = (kind == "BIGINT") | kind.rlike(r"^DECIMAL\((19|[23]\d),0\)$")
    printed = (F.when(kind == "BOOLEAN", F.initcap(text))
               .when(whole | ~kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), text)
               .otherwise(float_text(F.try_variant_get(value, "$", "double"))))
    return F.when(text.rlike("^(-?[0-9]|true$|false$)"), printed).otherwise(text)


def text_of(value: Column) -> Column:
    """Text of a scalar (JSON null and absent both give NULL)."""
    return F.try_variant_get(value, "$", "string")


def is_text(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def text_or(value: Column, default: str | Column) -> Column:
    """Text of the value; the default only when the key is absent."""
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.when(value.isNull(), fallback).otherwise(text_of(value))
