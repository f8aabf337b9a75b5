"""Readable views of the two message topics."""

from pyspark.sql import Column, DataFrame, functions as F

from tremorlake.functions.clock import iso_text
from tremorlake.functions.filters import keep_where
from tremorlake.functions.text import or_na
from tremorlake.operators.codec import decode_strict

# The mark of each log level, and the one of any other level.
LEVEL_ICONS = {"INFO": "[i]", "WARNING": "[!]", "ERROR": "[X]", "CRITICAL": "[!!]"}
OTHER_ICON = "[i]"
# The parts of the summary lines.
EVENT_SUMMARY = ("Processed earthquake | id=", "... | mag=", " | lat=", " lon=", " | depth=", "km | region=", " | offset=")
LOG_SUMMARY = ("Processed log | level=", " | service=", " | type=", " | msg=", " | offset=")

EVENT_FIELDS = ["event_id", "datetime", "latitude", "longitude", "magnitude", "depth", "region",
                "felt_intensity", "source", "ingested_at"]
LOG_FIELDS = ["timestamp", "service", "log_type", "level", "message"]


def _or_none(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("None"))


def _summary(parts: tuple[str, ...], *values: Column) -> Column:
    return F.concat(*[c for part, value in zip(parts, values, strict=True) for c in (F.lit(part), value)])


def _messages(records: DataFrame, fields: list[str]) -> DataFrame:
    """Decoded messages next to their queue position; records that are no JSON object are left out."""
    positions = records.select(
        "value", F.col("topic").alias("_topic"), F.col("partition").alias("_partition"),
        F.col("offset").alias("_offset"), F.col("key").cast("string").alias("_key"),
        F.col("timestamp").alias("_time"))
    decoded = decode_strict(positions, fields, "_topic", "_partition", "_offset", "_key", "_time")
    return keep_where(decoded, F.col("valid"))


def malformed(records: DataFrame) -> DataFrame:
    """Records the views leave out, whole."""
    decoded = decode_strict(records, [], *records.columns)
    return keep_where(decoded, ~F.col("valid")).select(*records.columns)


def event_view(records: DataFrame) -> DataFrame:
    """All fields of every event message, with placeholders and a summary line."""
    m = _messages(records, EVENT_FIELDS)
    region = or_na(F.col("region"))
    event_id = or_na(F.col("event_id"))
    return m.select(
        F.col("_topic").alias("topic"), F.col("_partition").alias("partition"),
        F.col("_offset").alias("offset"), F.col("_key").alias("key"),
        iso_text(F.col("_time")).alias("record_time"),
        event_id.alias("event_id"),
        or_na(F.col("datetime")).alias("datetime"),
        or_na(F.col("magnitude")).alias("magnitude"),
        F.concat_ws(", ", or_na(F.col("latitude")), or_na(F.col("longitude"))).alias("location"),
        F.concat(or_na(F.col("depth")), F.lit(" km")).alias("depth"),
        region.alias("region"),
        or_na(F.col("felt_intensity")).alias("felt_intensity"),
        or_na(F.col("source")).alias("source"),
        or_na(F.col("ingested_at")).alias("ingested_at"),
        _summary(
            EVENT_SUMMARY, F.substring(event_id, 1, 8), _or_none(F.col("magnitude")), _or_none(F.col("latitude")),
            _or_none(F.col("longitude")), _or_none(F.col("depth")), F.substring(region, 1, 30), F.col("_offset").cast("string"),
        ).alias("summary"),
    )


def event_view_brief(records: DataFrame) -> DataFrame:
    """The main fields of every event message, without placeholders."""
    m = _messages(records, ["event_id", "datetime", "magnitude", "latitude", "longitude", "region"])
    return m.select(
        F.col("_topic").alias("topic"), F.col("_partition").alias("partition"),
        F.col("_offset").alias("offset"), F.col("_key").alias("key"),
        "event_id", "datetime", "magnitude",
        F.concat_ws(", ", _or_none(F.col("latitude")), _or_none(F.col("longitude"))).alias("location"),
        "region",
    )


def log_view(records: DataFrame) -> DataFrame:
    """All fields of every log message, with its level mark and a summary line."""
    m = _messages(records, LOG_FIELDS)
    level = F.coalesce("level", F.lit("INFO"))
    icons = F.create_map(*[F.lit(x) for pair in LEVEL_ICONS.items() for x in pair])
    icon = F.coalesce(F.try_element_at(icons, level), F.lit(OTHER_ICON))
    message = or_na(F.col("message"))
    return m.select(
        F.col("_topic").alias("topic"), F.col("_partition").alias("partition"),
        F.col("_offset").alias("offset"),
        level.alias("level"), icon.alias("icon"),
        F.concat(F.lit("["), icon, F.lit(" SYSTEM LOG - "), level, F.lit("]")).alias("title"),
        or_na(F.col("timestamp")).alias("timestamp"),
        or_na(F.col("service")).alias("service"),
        or_na(F.col("log_type")).alias("log_type"),
        message.alias("message"),
        _summary(
            LOG_SUMMARY, level, _or_none(F.col("service")), _or_none(F.col("log_type")), F.substring(message, 1, 50),
            F.col("_offset").cast("string"),
        ).alias("summary"),
    )


def log_view_brief(records: DataFrame) -> DataFrame:
    """Topic, level, service and message of every log message, without placeholders."""
    return _messages(records, ["level", "service", "message"]).select(
        F.col("_topic").alias("topic"), F.col("_offset").alias("offset"), "level", "service", "message")


def processed_counts(records: DataFrame) -> DataFrame:
    """Messages processed per topic."""
    return _messages(records, ["event_id"]).groupBy(F.col("_topic").alias("topic")).agg(
        F.count("*").alias("n_processed"))
