"""Feed payloads: outcome of a fetch, and one row per raw event."""

from pyspark.sql import DataFrame, functions as F

from tremorlake.functions.variants import sealed, seal_holds

# The outcomes of a fetch.
API_ERROR, FETCH_FAILED, NO_DATA, FETCH_SUCCESS = "API_ERROR", "FETCH_FAILED", "NO_DATA", "FETCH_SUCCESS"

def unwrap(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Replace the payload text by its ``outcome`` and its ``raw_events`` (array of variants).

    The envelope holds one event object or an array of them. Invalid JSON is an ``API_ERROR``, a
    null event list ``FETCH_FAILED``, a missing or empty one ``NO_DATA``.
    """
    keep = [c for c in payloads.columns if c != payload]
    gempa, items = F.col("_gempa"), F.col("_items")
    is_object = F.try_variant_get(gempa, "$", "struct<DateTime: variant>").isNotNull()
    empty_scalar = F.coalesce(F.try_variant_get(gempa, "$", "string"), F.lit("")).isin("", "0", "false")
    outcome = (
        F.when(~F.col("_whole"), API_ERROR)
        .when(gempa.isNull(), NO_DATA)
        .when(F.is_variant_null(gempa), FETCH_FAILED)
        .when(items.isNotNull(), F.when(F.size(items) > 0, FETCH_SUCCESS).otherwise(NO_DATA))
        .when(is_object, FETCH_SUCCESS)
        .when(empty_scalar, NO_DATA)
        .otherwise(FETCH_SUCCESS)
    )
    return (
        payloads.withColumn("_parsed", sealed(F.col(payload)))
        .select(*keep, seal_holds(F.col("_parsed"), F.col(payload)).alias("_whole"),
                F.try_variant_get(F.get("_parsed", F.lit(0)), "$.Infogempa.gempa", "variant").alias("_gempa"))
        .withColumn("_items", F.try_variant_get(gempa, "$", "array<variant>"))
        .withColumn("outcome", outcome)
        .select(*keep, "outcome",
                F.when(F.col("outcome") == FETCH_SUCCESS, F.coalesce(items, F.array(gempa)))
                .alias("raw_events"))
    )


def explode_events(unwrapped: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per raw event (``event_pos``, ``raw``), in payload order.

    With ``keep_empty`` a payload without events stays as one row of NULL position. The generator is
    always the outer one: for the inner one Catalyst infers a filter on the array and pushes it down,
    where it would parse every payload a second time.
    """
    keep = [c for c in unwrapped.columns if c != "raw_events"]
    rows = unwrapped.select(*keep, F.posexplode_outer("raw_events").alias("event_pos", "raw"))
    return rows if keep_empty else rows.filter(F.col("event_pos").isNotNull())
