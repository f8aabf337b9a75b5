"""Per-cycle ingest summaries and the structured log lines made from them."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorlake.functions import clock as clocks
from tremorlake.functions.clock import Clock
from tremorlake.operators import normalize, payload

#: Cycles per block of the two-level running total.
BLOCK = 100_000

# Level and text of every data-derived log line.
_LINES = {
    payload.API_ERROR: [("API_ERROR", "ERROR", "Response JSON tidak valid"),
                        ("FETCH_FAILED", "WARNING", "Gagal ambil data BMKG")],
    payload.FETCH_FAILED: [("FETCH_FAILED", "WARNING", "Gagal ambil data BMKG")],
    payload.NO_DATA: [("NO_DATA", "INFO", "API tidak return data gempa")],
}
SUMMARY = "Cycle: %d dikirim, %d dedup, total unique: %d"
SERVICE = "realtime_producer"
_OUTCOMES = (payload.API_ERROR, payload.FETCH_FAILED, payload.NO_DATA, payload.FETCH_SUCCESS)


def cycle_summary(events: DataFrame, cycle: str = "cycle", block: int = BLOCK) -> DataFrame:
    """Per cycle: events sent (first seen), skipped as repeats, and unique ids so far.

    ``events`` has one row per raw event: its cycle (a long) and its id, NULL for a rejected event.
    A cycle whose events are all rejected still has a summary.

    The events are read and shuffled once. Every branch below asks for the same columns of ``pairs``
    and of ``per_cycle``, so Spark reuses their exchanges; that is why the running total is taken as
    received minus skipped. It works in blocks of cycles, so no task walks through all cycles.
    """
    pairs = events.groupBy(F.col(cycle).alias("cycle"), "event_id").agg(F.count("*").alias("n"))
    known = F.col("event_id").isNotNull()
    valid = F.when(known, F.col("n")).otherwise(F.lit(0).cast("bigint"))
    # An id is sent once, however often it occurs: its first cycle gets one skip back.
    first = pairs.groupBy("event_id").agg(F.min("cycle").alias("cycle"), F.sum("n").alias("n")).select(
        "cycle", F.lit(0).cast("bigint").alias("received"),
        (-F.least(F.lit(1).cast("bigint"), valid)).alias("skipped"))
    per_cycle = (
        pairs.select("cycle", valid.alias("received"), valid.alias("skipped"))
        .unionByName(first)
        .groupBy("cycle").agg(F.sum("received").alias("received"), F.sum("skipped").alias("skipped"))
        # Never NULL, or the join on it would add a NULL filter to one branch and spoil the reuse.
        .withColumn("_block", F.coalesce(F.floor(F.col("cycle") / block), F.lit(0)))
    )
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_block").orderBy("cycle").rowsBetween(Window.unboundedPreceding, 0)

    def unique(window):
        return F.sum("received").over(window) - F.sum("skipped").over(window)

    offsets = (
        per_cycle.groupBy("_block")
        .agg(F.sum("received").alias("received"), F.sum("skipped").alias("skipped"))
        .select("_block", F.coalesce(unique(before), F.lit(0)).alias("_offset"))
    )
    return (
        per_cycle.withColumn("_running", unique(inside))
        .join(offsets, "_block")
        .select("cycle", (F.col("received") - F.col("skipped")).alias("sent"), "skipped",
                (F.col("_offset") + F.col("_running")).alias("total_unique"))
    )


def batch_summary(parsed: DataFrame, fresh: DataFrame, cycle: str, total_before: int, block: int = BLOCK) -> DataFrame:
    """Per cycle of one batch: ``outcome``, events sent, skipped as repeats, and unique ids with those of earlier batches.

    ``parsed`` has a row per event or payload without one, with ``outcome`` and ``valid``; ``fresh`` the events that are sent.
    Only the number of ids sent before is needed of earlier batches.
    """
    def rows(df: DataFrame, outcome: Column, received: Column, sent: Column) -> DataFrame:
        return df.select(F.col(cycle).alias("cycle"), outcome.alias("outcome"), received.cast("bigint").alias("received"),
                         sent.cast("bigint").alias("sent"))

    per_cycle = (
        rows(parsed, F.col("outcome"), F.col("valid"), F.lit(0))
        .unionByName(rows(fresh, F.lit(None).cast("string"), F.lit(0), F.lit(1)))
        .groupBy("cycle").agg(F.max("outcome").alias("outcome"), F.sum("received").alias("received"), F.sum("sent").alias("sent"))
        .withColumn("_block", F.coalesce(F.floor(F.col("cycle") / block), F.lit(0)))
    )
    inside = Window.partitionBy("_block").orderBy("cycle").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_cycle.groupBy("_block").agg(F.sum("sent").alias("sent")).select(
        "_block", F.coalesce(F.sum("sent").over(before), F.lit(0)).alias("_offset"))
    return per_cycle.withColumn("_running", F.sum("sent").over(inside)).join(offsets, "_block").select(
        "cycle", "outcome", "sent", (F.col("received") - F.col("sent")).alias("skipped"),
        (F.lit(total_before) + F.col("_offset") + F.col("_running")).alias("total_unique"))


def fixed_lines(outcome: str) -> list[tuple[str, str, str]]:
    """Type, level and text of the log lines of an outcome without events."""
    return _LINES[outcome]


def success_text(sent: int, skipped: int, total_unique: int) -> str:
    """Text of the summary line of a cycle with events."""
    return SUMMARY % (sent, skipped, total_unique)


def _line(log_type: str, level: str, message: Column) -> Column:
    return F.struct(F.lit(log_type).alias("log_type"), F.lit(level).alias("level"),
                    message.alias("message"))


def log_lines(cycles: DataFrame, clock: Clock = None, service: str = SERVICE) -> DataFrame:
    """Log lines of cycles that carry ``cycle``, ``outcome``, ``sent``, ``skipped``, ``total_unique``."""
    summary = F.format_string(SUMMARY, "sent", "skipped", "total_unique")
    lines = F.array(_line("FETCH_SUCCESS", "INFO", summary))
    for outcome, fixed in _LINES.items():
        lines = F.when(F.col("outcome") == outcome,
                       F.array(*[_line(t, lv, F.lit(text)) for t, lv, text in fixed])).otherwise(lines)
    return (
        cycles.select("cycle", F.inline_outer(lines))
        .select("cycle", clocks.utc_iso(clock).alias("timestamp"), F.lit(service).alias("service"),
                "log_type", "level", "message")
    )


def payload_logs(unwrapped: DataFrame, cycle: str, clock: Clock = None, service: str = SERVICE,
                 block: int = BLOCK) -> DataFrame:
    """Log lines of a run where every payload is one cycle, numbered by the long column ``cycle`` from 0."""
    events = normalize.event_ids(
        payload.explode_events(unwrapped, keep_empty=True).select(cycle, "outcome", "raw"))
    # The outcome travels in the low digits of the cycle number, which keeps the cycles in order.
    width = len(_OUTCOMES)
    code = F.lit(0)
    for number, outcome in enumerate(_OUTCOMES):
        code = F.when(F.col("outcome") == outcome, F.lit(number)).otherwise(code)
    numbered = events.select((F.col(cycle) * width + code).alias("cycle"), "event_id")
    summary = cycle_summary(numbered, block=block * width)
    outcome_of = F.element_at(F.array(*[F.lit(o) for o in _OUTCOMES]),
                              (F.pmod(F.col("cycle"), F.lit(width)) + 1).cast("int"))
    return log_lines(
        summary.select(F.floor(F.col("cycle") / width).alias("cycle"), outcome_of.alias("outcome"),
                       "sent", "skipped", "total_unique"),
        clock, service)
