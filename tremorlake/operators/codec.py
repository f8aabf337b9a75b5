"""JSON decoding and encoding of message-queue records."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tremorlake import schemas
from tremorlake.functions.variants import seal_holds, sealed, shown, text_of

#: Message fields that hold numbers.
NUMBERS = ("latitude", "longitude", "magnitude", "depth")


def decode_records(records: DataFrame, schema: T.StructType = schemas.STREAM_EVENT) -> DataFrame:
    """Typed events from record values.

    Permissive: malformed text becomes a row of NULLs, a value of the wrong type a NULL, and fields
    outside the schema are dropped.
    """
    return records.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def decode_strict(records: DataFrame, fields: list[str], *keep: str) -> DataFrame:
    """Record columns ``keep``, the message ``fields`` as text, and ``valid``.

    A value counts as valid when all of its text is one JSON object. Values of the fields that hold numbers are
    written as Python prints them.
    """
    value = F.col("value").cast("string")
    parsed = records.select(*keep, value.alias("_text"), sealed(value).alias("_parsed"))
    message = F.get("_parsed", F.lit(0))
    an_object = F.try_variant_get(message, "$", "struct<_: variant>").isNotNull()
    valid = seal_holds(F.col("_parsed"), F.col("_text")) & F.coalesce(an_object, F.lit(False))
    # One lambda for all numbers: written out for each, the generated method grows beyond what the JIT compiles.
    numbers = [name for name in fields if name in NUMBERS]
    written = F.transform(F.array(*[_field(message, name) for name in numbers]), shown) if numbers else F.lit(None)
    staged = parsed.select(*keep, message.alias("_message"), valid.alias("valid"), written.alias("_numbers"))
    return staged.select(*keep, *[
        (F.get("_numbers", F.lit(numbers.index(name))) if name in numbers else text_of(_field(F.col("_message"), name))).alias(name)
        for name in fields], "valid")


def _field(message: Column, name: str) -> Column:
    return F.try_variant_get(message, f"$.{name}", "variant")


def json_of(df: DataFrame) -> Column:
    """All columns of ``df`` as one JSON object; NULL fields are written, not left out."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def event_records(events: DataFrame) -> DataFrame:
    """Queue records of events: keyed by event id."""
    return events.select(F.col("event_id").alias("key"), json_of(events).alias("value"))


def log_records(logs: DataFrame) -> DataFrame:
    """Queue records of log lines: no key."""
    return logs.select(json_of(logs).alias("value"))
