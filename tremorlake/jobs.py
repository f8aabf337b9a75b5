"""Batch and streaming jobs put together from sources, operators and sinks."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tremorlake import schemas, storage
from tremorlake.functions.clock import Clock
from tremorlake.operators import cycles, dedup, load, normalize, payload
from tremorlake.sinks import pages as page_sink
from tremorlake.sources import lake
from tremorlake.streaming import queries
from tremorlake.streaming.id_memory import IdMemory
from tremorlake.streaming.ledger import Ledger

#: Texts of the one-shot ingest.
SENT_OF = "Test selesai! %d dari %d event berhasil dikirim."
#: Why a single event was rejected; a whole payload has its outcome as reason.
REJECTED_EVENT = "EVENT"
FETCH_FAILED, NOTHING = "Gagal ambil data BMKG", "Tidak ada data gempa"


def load_events(spark: SparkSession, path: str, write: Callable[[DataFrame], None],
                check: Callable[[], dict]) -> dict:
    """Load landed events into a table and verify it.

    Returns rows written and what ``check`` finds: rows now in the table (total) and its newest rows. Without
    landed events nothing is written. The written rows are counted while they are written.
    """
    events = lake.read_events(spark, path)
    if events.isEmpty():
        return {"written": 0}
    written = Observation("written")
    write(load.warehouse_rows(events).observe(written, F.count(F.lit(1)).alias("n")))
    return {"written": written.get["n"], **check()}


def check_table(table: DataFrame) -> dict:
    """The check of :func:`load_events` for a table that Spark reads itself."""
    return {"total": table.count(), "newest": load.newest(table).collect()}


def extract_history(pages: DataFrame, root: str, run: datetime,
                    pages_per_folder: int = page_sink.PAGES_PER_FOLDER) -> dict[str, int]:
    """Archive the pages, extract their records and archive those; returns pages and records found."""
    page_sink.archive_html(pages, root)
    return page_sink.archive_records(pages, root, run, pages_per_folder)


def parse_batch(payloads: DataFrame, cycle: str, clock: Clock = None) -> DataFrame:
    """One parse of the payloads: a row for each event, and for each payload without one.

    ``kind`` is ``event``, ``reject`` (an event that does not normalise) or ``payload``; ``rejected`` is the text of a
    rejected event or of a payload that is no JSON.
    """
    unwrapped = payload.unwrap(payloads.select(cycle, "payload", F.col("payload").alias("_text")))
    rows = normalize.judged(payload.explode_events(unwrapped, keep_empty=True), clock=clock)
    kind = F.when(F.col("event_pos").isNull(), "payload").when(F.col("valid"), "event").otherwise("reject")
    return rows.withColumn("kind", kind).select(
        cycle, "outcome", "event_pos", "valid", *schemas.EVENT.fieldNames(),
        F.when(F.col("kind") == "reject", F.col("rejected")).when(F.col("outcome") == payload.API_ERROR, F.col("_text")).alias("rejected"),
        "kind")


def ingest(payloads: DataFrame, cycle: str, write_events: Callable[[DataFrame, int], None],
           write_logs: Callable[[DataFrame, int], None], folder: str, clock: Clock = None,
           interval: str | None = queries.POLL_INTERVAL, write_rejects: Callable[[DataFrame, int], None] | None = None,
           memory: IdMemory | None = None) -> StreamingQuery:
    """The running ingest: new events, the log lines of every payload and, if asked for, what was rejected.

    ``payloads`` has the payload text and its cycle, a long that grows with arrival. A micro-batch is parsed once, into a
    table by kind that all later steps read. Ids sent before are asked of ``memory``, by default one under ``folder`` that
    keeps them 30 days, and the running total is carried from batch to batch. A batch that is run again after a failure
    finds what it found before and makes the same rows. The writers get the batch's number and should replace what they wrote
    under it; rejects have the cycle, ``event_pos`` (NULL for a whole payload), ``reason`` and ``rejected``, the text.
    """
    spark = payloads.sparkSession
    memory = memory or IdMemory(spark, f"{folder}/ids")

    def batch(df: DataFrame, number: int) -> None:
        def stored(rows: DataFrame, part: str, *by: str) -> DataFrame:
            path = f"{folder}/{part}/batch={number}"
            rows.write.mode("overwrite").partitionBy(*by).parquet(path)
            return spark.read.schema(rows.schema).parquet(path)

        parsed = stored(parse_batch(df, cycle, clock), "parsed", "kind")
        events = parsed.filter("kind = 'event'")
        known = memory.known(events, number)
        fresh = stored(dedup.first_seen(events, cycle, "event_pos").join(known, "event_id", "left_anti").select(
            cycle, *schemas.EVENT.fieldNames()), "fresh")
        memory.remember(fresh, number)
        before = spark.read.schema("total bigint").parquet(f"{folder}/totals/batch={number - 1}").first().total if number else 0
        stored(fresh.agg((F.count(F.lit(1)) + before).alias("total")), "totals")
        write_events(fresh.select(*schemas.EVENT.fieldNames()), number)
        write_logs(cycles.log_lines(cycles.batch_summary(parsed, fresh, cycle, before), clock), number)
        if write_rejects is not None:
            write_rejects(parsed.filter("rejected IS NOT NULL").select(
                cycle, "event_pos", F.when(F.col("kind") == "reject", REJECTED_EVENT).otherwise(F.col("outcome")).alias("reason"),
                "rejected"), number)
        memory.settle(number)
        # The batch before can't be run again.
        for part in ("parsed", "fresh", "totals"):
            storage.remove(spark, f"{folder}/{part}/batch={number - (2 if part == 'totals' else 1)}")

    writer = payloads.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/checkpoint")
    return queries.timed(writer, interval).start()


def load_new(landed: DataFrame, write: Callable[[DataFrame, int], None], folder: str) -> int:
    """Load what was landed since the last load; returns the rows written.

    ``landed`` is the landed table read as a stream of files (``sources.lake.new_events``), whose checkpoint under ``folder`` is the
    bookmark. A load that failed is taken up at its batch; ``write`` gets the batch's number and should replace what it wrote
    under it, or leave out known ids. The rows and the time range of every batch are noted under ``folder``/zones while
    it is written, for :func:`newest_loaded`.
    """
    spark, written = landed.sparkSession, []
    ledger = Ledger(spark, f"{folder}/ledger")

    def batch(rows: DataFrame, number: int) -> None:
        if ledger.done("table", number):
            return
        counted = Observation(f"written-{number}")
        time = F.col("event_time")
        write(load.warehouse_rows(rows).observe(
            counted, F.count(F.lit(1)).alias("n"), F.count(time).alias("timed"), F.min(time).alias("earliest"), F.max(time).alias("latest")),
            number)
        zone = counted.get
        written.append(zone["n"])
        spark.createDataFrame([(zone["n"], zone["timed"], zone["earliest"], zone["latest"])], load.ZONE).coalesce(1).write.mode(
            "overwrite").parquet(f"{folder}/zones/batch={number}")
        ledger.mark("table", number)

    writer = landed.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/checkpoint")
    queries.timed(writer, None).start().awaitTermination()
    return sum(written)


def newest_loaded(table: DataFrame, folder: str, n: int = 5) -> DataFrame:
    """The newest rows of a table that :func:`load_new` wrote in folders by ``batch``, from the batches that can hold them alone."""
    zones = table.sparkSession.read.schema(f"{load.ZONE}, batch bigint").parquet(f"{folder}/zones")
    wanted = load.batches_of_newest(zones, n)
    return load.newest(table if wanted is None else table.filter(F.col("batch").isin(wanted)), n)


def send_once(payloads: DataFrame, write: Callable[[DataFrame], int], clock: Clock = None) -> dict:
    """The one-shot ingest: time-based ids, no dedup, and a line that says how many of the events found were sent.

    ``write`` sends the events and returns how many, as ``sinks.kafka.write_events`` with ``one_shot`` does. What
    was found is counted on the way, so the payloads are parsed once and both numbers are of that one reading.
    """
    seen = Observation("found")
    unwrapped = payload.unwrap(payloads).observe(
        seen, F.sum(F.coalesce(F.size("raw_events"), F.lit(0))).alias("found"),
        F.count_if(F.col("outcome").isin(payload.API_ERROR, payload.FETCH_FAILED)).alias("failed"))
    raw = payload.explode_events(unwrapped).select("raw")
    sent = write(normalize.normalize(raw, clock=clock, by_content=False))
    counts = seen.get
    if not counts["found"]:
        return {"sent": 0, "found": 0, "message": FETCH_FAILED if counts["failed"] else NOTHING}
    return {"sent": sent, "found": counts["found"], "message": SENT_OF % (sent, counts["found"])}
