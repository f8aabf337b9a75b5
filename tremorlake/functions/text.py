"""Lenient text-to-number rules and number-to-text rules of the feed."""

from pyspark.sql import Column, functions as F

# Every character that counts as white space when a field is trimmed.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
#: The same set as a regular-expression class.
WHITESPACE_CLASS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"

# The spellings of a float and of an integer that the feed may use.
FLOAT_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))$"
INTEGER_PATTERN = r"^[+-]?\d+$"


def strip(text: Column) -> Column:
    """Trim all Unicode white space (SQL ``trim`` only knows the blank)."""
    return F.btrim(text, F.lit(WHITESPACE))


def _trimmed_number(text: Column, pattern: str, kind: str) -> Column:
    def parse(trimmed: Column) -> Column:
        return F.when(trimmed.rlike(pattern), trimmed.try_cast(kind))

    # Most texts carry blanks at most; only the others pay for the wider trim.
    return F.coalesce(parse(F.trim(text)), parse(strip(text)))


def parse_float(text: Column) -> Column:
    """Double, or NULL when the trimmed text is not a number.

    The pattern keeps out spellings only the JVM accepts, such as ``1.0d``.
    """
    return _trimmed_number(text, FLOAT_PATTERN, "double")


def parse_integer(text: Column) -> Column:
    """Long, or NULL when the trimmed text is not a whole number (``10.5`` is not)."""
    return _trimmed_number(text, INTEGER_PATTERN, "bigint")


def float_text(value: Column) -> Column:
    """Shortest text of a double: plain from 1e-4 up to 1e16, scientific beyond.

    Spark switches to scientific notation at 1e-3 and 1e7 and writes the exponent differently, which
    would change every content id built from such a number.
    """
    size = F.abs(value)
    spark_text = value.cast("string")
    plain = F.regexp_replace(value.cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    scientific = F.replace(F.lower(spark_text), F.lit("infinity"), F.lit("inf"))
    for pattern, replacement in ((r"\.0e", "e"), (r"e(-?)(\d)$", "e$10$2"), (r"e(\d)", "e+$1")):
        scientific = F.regexp_replace(scientific, pattern, replacement)
    return (
        F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), spark_text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def or_na(text: Column) -> Column:
    """Text with the monitors' placeholder for a missing value."""
    return F.coalesce(text.cast("string"), F.lit("N/A"))
