"""The registered queries: each takes a session and a table folder and returns a frame."""

from datetime import datetime, timedelta, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tremorlake import jobs, schemas, storage
from tremorlake.operators import (codec, cycles, dedup, html_table, load, monitor, normalize, payload)
from tremorlake.plans import inputs
from tremorlake.session import work_folder
from tremorlake.sinks import pages as page_sink
from tremorlake.sources import lake, landing
from tremorlake.streaming import fan_out, queries as streams

#: The run clock of every registered query.
CLOCK = datetime(2026, 6, 1, tzinfo=timezone.utc)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    quakes = inputs.raw_quakes(inputs.events(spark, sf_dir)).select("seq", "payload")
    return payload.explode_events(payload.unwrap(quakes)).select("seq", "raw")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize(_raw(spark, sf_dir), clock=CLOCK)


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(*schemas.STREAM_EVENT.fieldNames())


def _kafka(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.kafka_quakes(inputs.events(spark, sf_dir))


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.kafka_logs(inputs.events(spark, sf_dir))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.quake_pages(inputs.events(spark, sf_dir))


def payload_unwrap(spark, sf_dir):
    mix = inputs.raw_payload_mix(inputs.events(spark, sf_dir))
    rows = payload.explode_events(payload.unwrap(mix))
    return rows.select("seq", "outcome", "event_pos", *[
        F.try_variant_get("raw", f"$.{key}", "string").alias(name)
        for key, name in (("DateTime", "datetime"), ("Coordinates", "coordinates"),
                          ("Magnitude", "magnitude"), ("Kedalaman", "depth"))])


def payload_outcome_logs(spark, sf_dir):
    mix = inputs.raw_payload_mix(inputs.events(spark, sf_dir))
    return cycles.payload_logs(payload.unwrap(mix), "seq", CLOCK)


def normalize_events(spark, sf_dir):
    return _events(spark, sf_dir)


def normalize_rejects(spark, sf_dir):
    return normalize.rejects(_raw(spark, sf_dir)).select("seq", *[
        F.get_json_object("raw", f"$.{key}").alias(name)
        for key, name in (("DateTime", "datetime"), ("Coordinates", "coordinates"), ("Kedalaman", "depth"))])


def normalize_time_id(spark, sf_dir):
    return normalize.normalize(_raw(spark, sf_dir), clock=CLOCK, by_content=False)


def event_id_md5(spark, sf_dir):
    return normalize.event_ids(_raw(spark, sf_dir))


def dedup_first_seen(spark, sf_dir):
    return dedup.first_seen(_events(spark, sf_dir), "seq")


def dedup_stream(spark, sf_dir):
    """Ids the streaming ingest keeps."""
    arriving = inputs.raw_quakes(inputs.events_stream(spark, sf_dir)).select("arrived_at", "payload")
    folder = work_folder(spark, "dedup")
    query = streams.start_ingest(
        arriving,
        lambda batch, _: batch.select("event_id").write.mode("append").parquet(f"{folder}/ids"),
        f"{folder}/checkpoint", interval=None)
    query.awaitTermination()
    return spark.read.schema("event_id string").parquet(f"{folder}/ids")


def _arriving(spark, slices, folder, start):
    """Lands the slices one after the other; after each, a streaming query works off what is new."""
    for part in slices:
        part.write.mode("append").parquet(folder)
        start(spark.readStream.schema(part.schema).parquet(folder)).awaitTermination()


def dedup_stream_batches(spark, sf_dir):
    """Ids the streaming ingest keeps when its payloads come in several micro-batches, out of order."""
    folder = work_folder(spark, "dedup-batches")
    _arriving(spark, inputs.event_slices(spark, sf_dir, 4, in_order=False), f"{folder}/events", lambda stream: streams.start_ingest(
        inputs.raw_quakes(stream).select("arrived_at", "payload"),
        lambda batch, _: batch.select("event_id").write.mode("append").parquet(f"{folder}/ids"),
        f"{folder}/checkpoint", interval=None))
    return spark.read.schema("event_id string").parquet(f"{folder}/ids")


def ingest_logs_stream(spark, sf_dir):
    """Log lines of every payload as the running ingest writes them, over several micro-batches."""
    folder = work_folder(spark, "ingest")

    def keep(part):
        return lambda df, number: df.write.mode("overwrite").parquet(f"{folder}/{part}/batch={number}")

    _arriving(spark, inputs.event_slices(spark, sf_dir, 3, in_order=True), f"{folder}/events", lambda stream: jobs.ingest(
        inputs.raw_payload_mix(stream), "seq", keep("sent"), keep("logs"), folder, CLOCK, interval=None))
    return spark.read.parquet(f"{folder}/logs").drop("batch")


def ingest_rejects_stream(spark, sf_dir):
    """What the running ingest rejects: single events and whole payloads, over several micro-batches."""
    folder = work_folder(spark, "rejects")

    def keep(part):
        return lambda df, number: df.write.mode("overwrite").parquet(f"{folder}/{part}/batch={number}")

    _arriving(spark, inputs.event_slices(spark, sf_dir, 3, in_order=True), f"{folder}/events", lambda stream: jobs.ingest(
        inputs.raw_payload_mix(stream), "seq", keep("sent"), keep("logs"), folder, CLOCK, interval=None,
        write_rejects=keep("rejects")))
    return spark.read.parquet(f"{folder}/rejects").select("seq", "event_pos", "reason", *[
        F.when(F.col("reason") == jobs.REJECTED_EVENT, F.get_json_object("rejected", f"$.{key}")).alias(name)
        for key, name in (("DateTime", "datetime"), ("Coordinates", "coordinates"), ("Kedalaman", "depth"))],
        F.when(F.col("reason") != jobs.REJECTED_EVENT, F.col("rejected")).alias("payload"))


def landing_fan_out(spark, sf_dir):
    """Records landed and shown by one query, which reads each of them once."""
    folder = work_folder(spark, "fan-out")
    sinks = {"landing": fan_out.landing(f"{folder}/events"), "view": lambda rows, number: rows.write.mode("overwrite").parquet(
        f"{folder}/view/batch={number}")}
    _arriving(spark, inputs.event_slices(spark, sf_dir, 3, in_order=True), f"{folder}/source", lambda stream: fan_out.fan_out(
        inputs.kafka_quakes(stream), sinks, folder, interval=None))
    landed = lake.read_events(spark, f"{folder}/events").withColumn("sink", F.lit("landing"))
    seen = spark.read.schema(schemas.STREAM_EVENT).parquet(f"{folder}/view").withColumn("sink", F.lit("view"))
    return landed.unionByName(seen.select(*landed.columns))


def recovered_landing(spark, sf_dir):
    """Records landed by a query that fails inside its second batch, stops the query beside it, and is started again."""
    folder = work_folder(spark, "recovered")
    for part in inputs.event_slices(spark, sf_dir, 3, in_order=True):
        part.write.mode("append").parquet(f"{folder}/source")
    # Every part has a file at least, so a third of the files leaves a second batch to fail in.
    third = -(-len(storage.children(spark, f"{folder}/source")) // 3)
    lost = []

    def view(rows, number):
        if number == 1 and not lost:
            lost.append(number)
            raise RuntimeError("the view is lost")
        rows.write.mode("overwrite").parquet(f"{folder}/view/batch={number}")

    def start(interval):
        source = spark.readStream.schema("seq bigint, user_id bigint, event_type string").option("maxFilesPerTrigger", third)
        landing_query = fan_out.fan_out(inputs.kafka_quakes(source.parquet(f"{folder}/source")), {
            "landing": fan_out.landing(f"{folder}/events"), "view": view}, f"{folder}/work", interval=None)
        beside = streams.upsert_counts(inputs.kafka_logs(source.parquet(f"{folder}/source")), f"{folder}/counts",
                                       f"{folder}/counts-checkpoint", interval)
        return landing_query, beside

    try:
        streams.supervise(*start("1 second"))
    except StreamingQueryException:
        streams.supervise(*start(None))
    return lake.read_events(spark, f"{folder}/events")


def processed_counts_stream(spark, sf_dir):
    """Messages processed per topic, kept up to date by a query that is started again for every part of its input."""
    folder = work_folder(spark, "counts")
    _arriving(spark, inputs.event_slices(spark, sf_dir, 3, in_order=True), f"{folder}/source", lambda stream: streams.upsert_counts(
        inputs.kafka_quakes(stream).unionByName(inputs.kafka_logs(stream)), f"{folder}/table", f"{folder}/checkpoint", None))
    return streams.latest_counts(spark, f"{folder}/table")


def send_once(spark, sf_dir):
    """Records of the one-shot ingest by key, with how many of the events found were sent."""
    folder = work_folder(spark, "send")
    sent = Observation("sent")

    def write(events):
        codec.event_records(events).observe(sent, F.count(F.lit(1)).alias("n")).write.parquet(folder)
        return sent.get["n"]

    quakes = inputs.raw_quakes(inputs.events(spark, sf_dir)).select("payload")
    summary = jobs.send_once(quakes, write, CLOCK)
    return spark.read.parquet(folder).groupBy("key").agg(F.count("*").alias("n_records")).select(
        "*", F.lit(summary["sent"]).cast("bigint").alias("sent"), F.lit(summary["found"]).cast("bigint").alias("found"))


def landing_payloads(spark, sf_dir):
    """Payload files of a thousand events each, landed and read back."""
    folder = work_folder(spark, "payloads")
    single = F.regexp_replace(F.col("payload"), r'^\{"Infogempa":\{"gempa":(.*)\}\}$', "$1")
    merged = inputs.raw_quakes(inputs.events(spark, sf_dir)).groupBy(F.expr("seq div 1000").alias("part")).agg(
        F.concat(F.lit('{"Infogempa":{"gempa":['), F.array_join(F.collect_list(single), ","), F.lit("]}}")).alias("value"))
    merged.repartition("part").write.partitionBy("part").text(folder)
    return payload.unwrap(landing.payloads(spark, folder)).groupBy("outcome").agg(
        F.count("*").alias("n_files"), F.sum(F.size("raw_events")).alias("n_raw"))


def monitor_streams(spark, sf_dir):
    """Both monitors running at once, landed as Parquet in place of a console."""
    folder = work_folder(spark, "monitors")
    quakes = inputs.kafka_quakes(inputs.events_stream(spark, sf_dir))
    logs = inputs.kafka_logs(inputs.events_stream(spark, sf_dir))
    for query in streams.start_monitors(quakes, logs, f"{folder}/checkpoint", None, "parquet", f"{folder}/views"):
        query.awaitTermination()
    views = [spark.read.parquet(f"{folder}/views/{name}").groupBy("topic").agg(F.count("*").alias("n_rows")).select(
        F.lit(name).alias("name"), "topic", "n_rows") for name in ("event_view", "log_view")]
    return views[0].unionByName(views[1])


def cycle_summary(spark, sf_dir):
    ids = normalize.event_ids(_raw(spark, sf_dir))
    return cycles.cycle_summary(ids.select(F.floor(F.col("seq") / 100).alias("cycle"), "event_id"))


def kafka_decode(spark, sf_dir):
    return codec.decode_records(_kafka(spark, sf_dir))


def kafka_encode(spark, sf_dir):
    return codec.event_records(_events(spark, sf_dir).select(*schemas.EVENT.fieldNames()))


def kafka_log_records(spark, sf_dir):
    """The log lines of every payload as queue records."""
    return codec.log_records(payload_outcome_logs(spark, sf_dir).drop("cycle"))


def kafka_malformed(spark, sf_dir):
    return monitor.malformed(_kafka(spark, sf_dir)).select("offset", F.col("value").cast("string").alias("value"))


def stream_to_parquet(spark, sf_dir):
    """Records landed by the streaming query, read back."""
    records = inputs.kafka_quakes(inputs.events_stream(spark, sf_dir))
    folder = work_folder(spark, "landing")
    for query in streams.start_landing(records, f"{folder}/events", f"{folder}/checkpoint", debug=False,
                                       landing_interval=None):
        query.awaitTermination()
    return lake.read_events(spark, f"{folder}/events")


def load_event_time(spark, sf_dir):
    return load.warehouse_rows(_landed(spark, sf_dir))


def load_original_time(spark, sf_dir):
    return load.with_event_time(_landed(spark, sf_dir)).select("event_id", "original_datetime", "event_time", "ingested_at")


def load_twice(spark, sf_dir):
    """The table after three loads: of a first part of the landed events, of what was landed since, and of nothing."""
    folder = work_folder(spark, "load-twice")
    landed, table = f"{folder}/landed", f"{folder}/table"
    for part in (*inputs.event_slices(spark, sf_dir, 2, in_order=True), None):
        if part is not None:
            quakes = inputs.raw_quakes(part).select("seq", "payload")
            raw = payload.explode_events(payload.unwrap(quakes)).select("raw")
            normalize.normalize(raw, clock=CLOCK).select(*schemas.STREAM_EVENT.fieldNames()).write.mode("append").partitionBy(
                "source").parquet(landed)
        jobs.load_new(lake.new_events(spark, landed), lambda rows, number: rows.write.mode("overwrite").parquet(
            f"{table}/batch={number}"), f"{folder}/work")
    return spark.read.schema(schemas.WAREHOUSE).parquet(table).select(*schemas.WAREHOUSE.fieldNames())


def load_newest_zones(spark, sf_dir):
    """The newest rows after four loads, read from the loads whose time range can hold them."""
    folder = work_folder(spark, "load-zones")
    for part in inputs.event_slices(spark, sf_dir, 4, in_order=True):
        raw = payload.explode_events(payload.unwrap(inputs.raw_quakes(part).select("payload")))
        normalize.normalize(raw.select("raw"), clock=CLOCK).select(*schemas.STREAM_EVENT.fieldNames()).write.mode("append").partitionBy(
            "source").parquet(f"{folder}/landed")
        jobs.load_new(lake.new_events(spark, f"{folder}/landed"), lambda rows, number: rows.write.mode("overwrite").parquet(
            f"{folder}/table/batch={number}"), f"{folder}/work")
    return jobs.newest_loaded(spark.read.parquet(f"{folder}/table"), f"{folder}/work")


def landed_summary(spark, sf_dir):
    """Rows and range of magnitudes of the landed table, answered from its files' footers."""
    folder = work_folder(spark, "footers")
    _landed(spark, sf_dir).write.partitionBy("source").parquet(folder)
    with lake.footers(spark):
        found = lake.footer_summary(spark, folder).collect()
    return spark.createDataFrame(found, "n_rows bigint, least double, largest double")


def load_sample(spark, sf_dir):
    return load.sample(_landed(spark, sf_dir))


def load_counts(spark, sf_dir):
    """What the load job reports: rows written, rows and newest rows of the table, and a load of nothing."""
    folder = work_folder(spark, "load")
    table = f"{folder}/table"
    _landed(spark, sf_dir).write.partitionBy("source").parquet(f"{folder}/events")

    def run(path):
        return jobs.load_events(spark, path, lambda rows: rows.write.parquet(table),
                                lambda: jobs.check_table(spark.read.schema(schemas.WAREHOUSE).parquet(table)))

    done, nothing = run(f"{folder}/events"), run(f"{folder}/missing")
    counted = [("written", done["written"]), ("table", done["total"]), ("newest", len(done["newest"])),
               ("nothing landed", nothing["written"])]
    return spark.createDataFrame(counted, "counted string, n_rows bigint")


def load_newest_5(spark, sf_dir):
    return load.newest(load.warehouse_rows(_landed(spark, sf_dir)))


def html_rows(spark, sf_dir):
    return html_table.table_rows(_pages(spark, sf_dir))


def html_cells(spark, sf_dir):
    return html_table.table_cells(_pages(spark, sf_dir)).select(
        "page_num", "row_pos", F.array_join("cells", "|").alias("cells"))


def html_records(spark, sf_dir):
    return html_table.records(_pages(spark, sf_dir), clock=CLOCK)


def html_union_totals(spark, sf_dir):
    return html_table.totals(_pages(spark, sf_dir).unionByName(inputs.web_pages(spark, sf_dir)))


def html_page_counts(spark, sf_dir):
    return html_table.page_counts(_pages(spark, sf_dir))


def html_wanted_page_counts(spark, sf_dir):
    """Counts for a list of wanted pages, some of which never arrived."""
    wanted = inputs.web_pages(spark, sf_dir).select("page_num")
    return html_table.page_counts(_pages(spark, sf_dir), wanted=wanted)


def html_web_page_counts(spark, sf_dir):
    """Counts over the given web pages, with a few bulletin rows behind each."""
    return html_table.page_counts(inputs.web_pages(spark, sf_dir))


def html_head_3(spark, sf_dir):
    return html_table.head(html_table.records(_pages(spark, sf_dir), clock=CLOCK))


def archive_html_roundtrip(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    folder = work_folder(spark, "html")
    page_sink.archive_html(pages, folder)
    return page_sink.read_html(spark, folder).select(
        "page_num", F.length("html").alias("n_chars"), F.md5(F.col("html").cast("binary")).alias("digest"))


def archive_html_range(spark, sf_dir):
    """Some consecutive pages of an archive."""
    folder = work_folder(spark, "html-range")
    page_sink.archive_html(_pages(spark, sf_dir), folder, 20)
    return page_sink.read_html(spark, folder, 31, 238).select(
        "page_num", F.length("html").alias("n_chars"), F.md5(F.col("html").cast("binary")).alias("digest"))


def archive_newest_run(spark, sf_dir):
    """Records by page of the newest run that was published: one of all pages, one of every third page (half of them empty by
    then), and one of every second page that was cut off before it was published."""
    folder = work_folder(spark, "runs")
    pages = _pages(spark, sf_dir)
    third = pages.filter("page_num % 3 = 0").withColumn("html", F.when(F.col("page_num") % 2 == 1, F.col("html")).otherwise(F.lit("")))
    for run, seen, whole in ((CLOCK, pages, True), (CLOCK + timedelta(days=1), third, True),
                             (CLOCK + timedelta(days=2), pages.filter("page_num % 2 = 0"), False)):
        page_sink.write_run(seen, folder, run)
        if whole:
            page_sink.publish(spark, folder, run)
    return page_sink.newest_records(spark, folder)


def archive_csv_roundtrip(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    folder = work_folder(spark, "csv")
    page_sink.archive_records(pages, folder, CLOCK)
    parts = {"per page": f"{folder}/raw_csv", "combined": f"{folder}/combined/*"}
    found = [page_sink.read_records(spark, path).withColumn("part", F.lit(part))
             for part, path in parts.items()]
    return html_table.union_runs(*found)


def monitor_events(spark, sf_dir):
    return monitor.event_view(_kafka(spark, sf_dir))


def monitor_events_brief(spark, sf_dir):
    return monitor.event_view_brief(_kafka(spark, sf_dir))


def monitor_logs(spark, sf_dir):
    return monitor.log_view(_logs(spark, sf_dir))


def monitor_logs_brief(spark, sf_dir):
    return monitor.log_view_brief(_logs(spark, sf_dir))


def monitor_counts(spark, sf_dir):
    return monitor.processed_counts(_kafka(spark, sf_dir).unionByName(_logs(spark, sf_dir)))


QUERIES = {
    query.__name__: query for query in (
        payload_unwrap, payload_outcome_logs, normalize_events, normalize_rejects, normalize_time_id,
        event_id_md5, dedup_first_seen, dedup_stream, dedup_stream_batches, cycle_summary, ingest_logs_stream, ingest_rejects_stream,
        landing_fan_out, recovered_landing, processed_counts_stream, send_once,
        landing_payloads, monitor_streams, kafka_decode, kafka_encode, kafka_log_records,
        kafka_malformed, stream_to_parquet, load_event_time, load_original_time, load_twice,
        load_newest_zones, landed_summary, load_sample, load_counts, load_newest_5,
        html_rows, html_cells, html_records, html_union_totals, html_page_counts,
        html_wanted_page_counts, html_web_page_counts, html_head_3, archive_html_roundtrip,
        archive_html_range, archive_newest_run, archive_csv_roundtrip, monitor_events, monitor_events_brief, monitor_logs, monitor_logs_brief,
        monitor_counts,
    )
}
