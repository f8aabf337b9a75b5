"""Raw feed events to typed events."""

from pyspark.sql import Column, DataFrame, functions as F

from tremorlake.functions import clock as clocks
from tremorlake.functions.clock import Clock
from tremorlake.functions.filters import keep_where
from tremorlake.functions.text import float_text, parse_float, parse_integer
from tremorlake.functions.variants import is_text, text_of, text_or

# The source tag, and the region of an event that names none.
SOURCE = "BMKG_REALTIME"
UNKNOWN_REGION = "Tidak diketahui"

# The keys of a raw event.
_KEYS = ("DateTime", "Tanggal", "Jam", "Coordinates", "Magnitude", "Kedalaman", "Wilayah",
         "Dirasakan", "Shakemap", "Potensi")

CONTENT_FIELDS = ("event_id", "datetime", "latitude", "longitude", "magnitude", "depth", "region",
                  "felt_intensity", "shakemap", "potensi", "source", "ingested_at")
TIME_ID_FIELDS = tuple(c for c in CONTENT_FIELDS if c not in ("shakemap", "potensi"))


def content_id(datetime: Column, latitude: Column, longitude: Column, magnitude: Column,
               depth: Column) -> Column:
    """Stable id: equal in these five fields means the same event."""
    return F.md5(F.concat_ws(
        "_", F.coalesce(datetime, F.lit("None")), float_text(latitude), float_text(longitude),
        float_text(magnitude), depth.cast("string"),
    ).cast("binary"))


def time_id(latitude: Column, longitude: Column, clock: Clock = None) -> Column:
    """Id from the ingest second and the place; not stable across fetches, by design."""
    return F.concat_ws("_", F.lit("BMKG"), clocks.compact(clock), float_text(latitude),
                       float_text(longitude))


def _number_text(value: Column, unit: str) -> Column:
    """The text of a textual number without its unit; NULL for anything else."""
    return F.when(is_text(value), F.replace(text_of(value), F.lit(unit), F.lit("")))


def _number_value(value: Column, kind: str) -> Column:
    """A JSON number as ``kind`` (cut to whole for ``bigint``); zero when the key is absent."""
    return (
        F.when(value.isNull(), F.lit(0).cast(kind))
        .when(~is_text(value), F.try_variant_get(value, "$", kind))
    )


def _read_fields(raw_events: DataFrame, raw: str, by_content: bool) -> DataFrame:
    """Typed fields plus ``_valid``; the raw event stays in its column.

    Each projection uses the costly results of the one before more than once, so Catalyst keeps them
    apart and every text is read a single time.
    """
    key = {name: F.col(f"_k.{name}") for name in _KEYS}
    keep = [c for c in raw_events.columns if c != raw] + [raw]
    shape = ", ".join(f"{name}: variant" for name in _KEYS)
    if by_content:
        # The day-and-time fallback is built even when unused, so a bad part of it spoils the event.
        parts_ok = ((key["Tanggal"].isNull() | is_text(key["Tanggal"]))
                    & (key["Jam"].isNull() | is_text(key["Jam"])))
        datetime = text_or(key["DateTime"],
                           F.concat_ws(" ", text_or(key["Tanggal"], ""), text_or(key["Jam"], "")))
    else:
        parts_ok = F.lit(True)
        datetime = text_or(key["DateTime"], "")
    place = F.col("_place")
    texts = (
        raw_events
        .withColumn("_k", F.try_variant_get(F.col(raw), "$", f"struct<{shape}>"))
        .select(
            *keep,
            datetime.alias("datetime"),
            F.when(key["Coordinates"].isNull(), F.lit("0,0"))
            .when(is_text(key["Coordinates"]), text_of(key["Coordinates"])).alias("_place"),
            _number_text(key["Magnitude"], "SR").alias("_size_text"),
            _number_value(key["Magnitude"], "double").alias("_size"),
            _number_text(key["Kedalaman"], "km").alias("_depth_text"),
            _number_value(key["Kedalaman"], "bigint").alias("_depth_value"),
            key["Wilayah"].isNotNull().alias("_has_region"),
            key["Dirasakan"].isNotNull().alias("_has_felt"),
            F.when(key["Wilayah"].isNotNull(), text_of(key["Wilayah"])).alias("_region"),
            text_or(key["Dirasakan"], "").alias("felt_intensity"),
            text_or(key["Shakemap"], "").alias("shakemap"),
            text_or(key["Potensi"], "").alias("potensi"),
            (F.col("_k").isNotNull() & parts_ok).alias("_shaped"),
        )
    )
    rest = F.substring_index(F.substring_index(place, ",", 2), ",", -1)
    parsed = (
        texts
        .withColumn("_lat", F.substring_index(place, ",", 1))
        .withColumn("_lon", F.when(place.contains(","), rest).otherwise(F.lit("0")))
        .select(
            *keep, "datetime", "felt_intensity", "shakemap", "potensi", "_shaped",
            parse_float(F.col("_lat")).alias("latitude"),
            parse_float(F.col("_lon")).alias("longitude"),
            F.coalesce(parse_float(F.col("_size_text")), F.col("_size")).alias("magnitude"),
            F.coalesce(parse_integer(F.col("_depth_text")), F.col("_depth_value")).alias("_depth"),
            F.when(F.col("_has_region"), F.col("_region"))
            .when(F.col("_has_felt"), F.col("felt_intensity"))
            .otherwise(F.lit(UNKNOWN_REGION)).alias("region"),
        )
    )
    return parsed.withColumn(
        "_valid", F.col("_shaped") & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
        & F.col("magnitude").isNotNull() & F.col("_depth").isNotNull())


def normalize(raw_events: DataFrame, raw: str = "raw", clock: Clock = None,
              by_content: bool = True) -> DataFrame:
    """Valid events, typed; other columns of the input are kept in front.

    ``by_content`` picks the stable content id and all twelve fields; without it the id is made from
    the ingest time and the datetime is read from one key only, as the one-shot ingest does.
    """
    keep = [c for c in raw_events.columns if c != raw]
    fields = keep_where(_read_fields(raw_events, raw, by_content), F.col("_valid"))
    return _finish(fields, keep, clock, by_content)


def _finish(fields: DataFrame, keep: list[str], clock: Clock, by_content: bool) -> DataFrame:
    place = F.col("latitude"), F.col("longitude")
    event_id = (
        content_id(F.col("datetime"), *place, F.col("magnitude"), F.col("_depth"))
        if by_content else time_id(*place, clock)
    )
    columns = {
        "event_id": event_id,
        "depth": F.col("_depth").try_cast("int"),
        "source": F.lit(SOURCE),
        "ingested_at": clocks.utc_iso(clock),
    }
    names = CONTENT_FIELDS if by_content else TIME_ID_FIELDS
    return fields.select(*keep, *[columns.get(n, F.col(n)).alias(n) for n in names])


def rejects(raw_events: DataFrame, raw: str = "raw", by_content: bool = True) -> DataFrame:
    """Events that do not normalise: the kept columns and the raw event as JSON text."""
    keep = [c for c in raw_events.columns if c != raw]
    return keep_where(_read_fields(raw_events, raw, by_content), ~F.col("_valid")).select(
        *keep, F.to_json(F.col(raw)).alias("raw"))


def judged(raw_events: DataFrame, raw: str = "raw", clock: Clock = None) -> DataFrame:
    """Every event with ``valid``: the kept columns, the typed fields of a valid one, the JSON text of any other as ``rejected``.

    Rows without an event stay, as neither.
    """
    keep = [c for c in raw_events.columns if c != raw]
    fields = _read_fields(raw_events, raw, by_content=True)
    valid = F.col("_valid")
    typed = _finish(fields, [*keep, "_valid", raw], clock, by_content=True)
    return typed.select(
        *keep, (valid & F.col(raw).isNotNull()).alias("valid"), *[F.when(valid, F.col(name)).alias(name) for name in CONTENT_FIELDS],
        F.when(~valid, F.to_json(F.col(raw))).alias("rejected"))


def event_ids(raw_events: DataFrame, raw: str = "raw") -> DataFrame:
    """The kept columns and the content id of every event, NULL for one that is rejected."""
    keep = [c for c in raw_events.columns if c != raw]
    fields = _read_fields(raw_events, raw, by_content=True)
    event_id = content_id(F.col("datetime"), F.col("latitude"), F.col("longitude"),
                          F.col("magnitude"), F.col("_depth"))
    return fields.select(*keep, F.when(F.col("_valid"), event_id).alias("event_id"))
