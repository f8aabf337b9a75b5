"""The running queries: landing, debug view, ingest and monitoring.

Every query has a checkpoint of its own, which must lie on storage all executors share. An
``interval`` of None works off what is there and stops; a text such as ``30 seconds`` runs on.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tremorlake.operators import codec, monitor
from tremorlake.operators.dedup import first_seen_stream
from tremorlake.operators.normalize import normalize
from tremorlake.operators.payload import API_ERROR, FETCH_FAILED, NO_DATA, explode_events, unwrap

# How often each query looks for new data.
POLL_INTERVAL = "3 seconds"
DEBUG_INTERVAL = "10 seconds"
LANDING_INTERVAL = "30 seconds"


def timed(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Works off what is there and stops, or looks again every ``interval``."""
    return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)


def land(events: DataFrame, path: str, checkpoint: str, interval: str | None = LANDING_INTERVAL) -> StreamingQuery:
    """Append events to a Parquet table partitioned by source, each event exactly once."""
    writer = (
        events.writeStream.outputMode("append").format("parquet").partitionBy("source")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return timed(writer, interval).start()


def show(events: DataFrame, checkpoint: str, interval: str | None = DEBUG_INTERVAL,
         sink: str = "console", name: str | None = None, path: str | None = None) -> StreamingQuery:
    """Print events in full as they come (``memory`` keeps them in a table, a file format under ``path``)."""
    writer = (
        events.writeStream.outputMode("append").format(sink).option("truncate", "false")
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    if path:
        writer = writer.option("path", path)
    return timed(writer, interval).start()


def start_landing(records: DataFrame, path: str, checkpoint: str, debug: bool = True,
                  landing_interval: str | None = LANDING_INTERVAL,
                  debug_interval: str | None = DEBUG_INTERVAL) -> list[StreamingQuery]:
    """Decode queue records and land them; with ``debug`` a second query prints them."""
    events = codec.decode_records(records)
    queries = [land(events, path, f"{checkpoint}/landing", landing_interval)]
    if debug:
        queries.append(show(events, f"{checkpoint}/debug", debug_interval))
    return queries


def ingest_events(payloads: DataFrame, delay: str = "30 days", spread: int = 16) -> DataFrame:
    """Typed, first-seen events of a payload stream with an ``arrived_at`` column.

    Ids are remembered by the clock of the micro-batch that brought them, which is fixed when a batch is
    planned and never runs backwards, so no payload is late, however old its file. An id is forgotten
    ``delay`` after it was first seen, also when the feed still repeats it; it is then sent again.

    Counts of every micro-batch (outcomes, valid events, sent events) are observed on the way, so the
    cycle summary costs no pass of its own.
    """
    outcome = F.col("outcome")
    unwrapped = unwrap(payloads.withColumn("_seen_at", F.current_timestamp())).observe(
        "outcomes", *[F.count_if(outcome == o).alias(o) for o in (API_ERROR, FETCH_FAILED, NO_DATA)],
        F.count(F.lit(1)).alias("payloads"))
    raw = explode_events(unwrapped).select("arrived_at", "_seen_at", "event_pos", "raw")
    valid = normalize(raw).observe("valid", F.count(F.lit(1)).alias("n"))
    # Repeats of one event arrive at different times, which spreads a frequent id over the state.
    bucket = F.pmod(F.xxhash64("arrived_at", "event_pos"), F.lit(spread))
    unique = first_seen_stream(valid, "_seen_at", delay, bucket)
    return unique.observe("sent", F.count(F.lit(1)).alias("n")).drop("event_pos", "_seen_at")


def start_ingest(payloads: DataFrame, write_batch: Callable[[DataFrame, int], None], checkpoint: str,
                 interval: str | None = POLL_INTERVAL, **more) -> StreamingQuery:
    """Run the ingest, handing each micro-batch of new events to ``write_batch``."""
    writer = (
        ingest_events(payloads, **more).drop("arrived_at").writeStream.outputMode("append")
        .foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    )
    return timed(writer, interval).start()


def count_processed(records: DataFrame, checkpoint: str, name: str, interval: str | None = POLL_INTERVAL,
                    sink: str = "memory") -> StreamingQuery:
    """Running number of processed messages per topic."""
    writer = (
        monitor.processed_counts(records).writeStream.outputMode("complete").format(sink)
        .queryName(name).option("checkpointLocation", checkpoint)
    )
    return timed(writer, interval).start()


def upsert_counts(records: DataFrame, path: str, checkpoint: str, interval: str | None = POLL_INTERVAL) -> StreamingQuery:
    """Running number of processed messages per topic, kept as a table: each batch adds the topics whose number changed.

    A batch that is run again replaces its folder. :func:`latest_counts` reads the newest number of each topic.
    """
    def write(changed: DataFrame, number: int) -> None:
        # Not coalesced: that would run all state partitions in one task.
        changed.repartition(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = monitor.processed_counts(records).writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", checkpoint)
    return timed(writer, interval).start()


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest number of each topic from a table of :func:`upsert_counts`."""
    rows = spark.read.schema("topic string, n_processed bigint, batch bigint").parquet(path)
    return rows.groupBy("topic").agg(F.max_by("n_processed", "batch").alias("n_processed"))


def start_monitors(event_records: DataFrame, log_records: DataFrame, checkpoint: str,
                   interval: str | None = POLL_INTERVAL, sink: str = "console",
                   path: str | None = None) -> list[StreamingQuery]:
    """Both topics at once, each view in a query of its own (file formats write folders under ``path``)."""
    views = {"event_view": monitor.event_view(event_records), "log_view": monitor.log_view(log_records)}
    return [show(view, f"{checkpoint}/{name}", interval, sink, name, path and f"{path}/{name}")
            for name, view in views.items()]


def supervise(*running: StreamingQuery) -> None:
    """Block until all of these queries ended; when one fails, the others are stopped and its error is raised."""
    try:
        going = list(running)
        while going:
            for query in list(going):
                if query.awaitTermination(1):  # raises what ended it
                    going.remove(query)
    finally:
        for query in running:
            query.stop()


def wait(spark: SparkSession) -> None:
    """Block until any query stops; its error, if it failed, is raised here."""
    spark.streams.awaitAnyTermination()
