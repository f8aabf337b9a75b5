import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tremorlake import jobs, schemas
from tremorlake.operators import codec
from tremorlake.operators.dedup import first_seen_forever, first_seen_stream
from tremorlake.operators.normalize import normalize
from tremorlake.operators.payload import explode_events, unwrap
from tremorlake.sinks import kafka as kafka_sink
from tremorlake.sources import lake, landing
from tremorlake.streaming import queries
from tremorlake.streaming.cycle_log import CycleLog, lines_of

START = datetime(2026, 6, 1)


class Topic:
    """A folder of queue records, read as a stream."""

    def __init__(self, spark, path):
        self.spark, self.path, self.offset = spark, str(path), 0

    def send(self, *values, key=None, minutes=None, topic="earthquake-events"):
        rows = []
        for i, value in enumerate(values):
            stamp = START + timedelta(minutes=minutes[i] if minutes else self.offset)
            rows.append((key, value.encode(), topic, 0, self.offset, stamp, 0))
            self.offset += 1
        self.spark.createDataFrame(rows, schemas.KAFKA_RECORD).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(schemas.KAFKA_RECORD).option("maxFilesPerTrigger", 1).parquet(self.path)


def event(event_id, source="S"):
    return json.dumps({"event_id": event_id, "datetime": "d", "depth": 1, "source": source, "shakemap": "dropped"})


def finish(*started):
    for query in started:
        query.awaitTermination()


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def test_landing_resumes_after_restart(spark, topic, tmp_path):
    path, checkpoint = str(tmp_path / "lake"), str(tmp_path / "checkpoint")
    topic.send(event("a"), event("b", "T"), "{bad")

    def run():
        finish(*queries.start_landing(topic.stream(), path, checkpoint, landing_interval=None, debug_interval=None))

    run()
    landed = lake.read_events(spark, path)
    assert sorted((r.event_id or "", r.source or "") for r in landed.collect()) == [("", ""), ("a", "S"), ("b", "T")]
    assert landed.columns == schemas.STREAM_EVENT.fieldNames()
    topic.send(event("a"), event("c"))
    run()
    assert sorted(r.event_id or "" for r in lake.read_events(spark, path).collect()) == ["", "a", "a", "b", "c"]
    batch = codec.decode_records(spark.read.schema(schemas.KAFKA_RECORD).parquet(topic.path))
    assert sorted(map(str, batch.collect())) == sorted(map(str, lake.read_events(spark, path).collect()))


def test_show_keeps_whole_rows(spark, topic, tmp_path):
    topic.send(event("a"))
    finish(queries.show(codec.decode_records(topic.stream()), str(tmp_path / "c"), None, "memory", "shown"))
    assert [r.event_id for r in spark.table("shown").collect()] == ["a"]


def run_dedup(spark, df, folder):
    query = (df.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return sorted(r.event_id for r in spark.read.parquet(f"{folder}/out").collect())


@pytest.mark.parametrize("spread", [None, 4])
def test_stream_dedup(spark, topic, tmp_path, spread):
    def unique():
        decoded = topic.stream().select("timestamp", "offset", F.get_json_object(
            F.col("value").cast("string"), "$.event_id").alias("event_id"))
        bucket = None if spread is None else F.pmod(F.xxhash64("offset"), F.lit(spread))
        return first_seen_stream(decoded, "timestamp", "1 hour", bucket)

    topic.send(event("a"), event("a"), "{bad", event("b"), *[event("hot")] * 50, minutes=[0] * 54)
    topic.send(event("a"), event("hot"), event("c"), minutes=[5, 5, 5])
    assert run_dedup(spark, unique(), tmp_path / "run") == ["a", "b", "c", "hot"]
    # Restart from the checkpoint: ids are remembered.
    topic.send(event("b"), event("d"), minutes=[6, 6])
    assert run_dedup(spark, unique(), tmp_path / "run") == ["a", "b", "c", "d", "hot"]
    # Far later the old ids are forgotten, so one of them counts as new again.
    topic.send(event("e"), minutes=[600])
    topic.send(event("f"), minutes=[601])
    topic.send(event("a"), minutes=[602])
    assert run_dedup(spark, unique(), tmp_path / "run") == ["a", "a", "b", "c", "d", "e", "f", "hot"]


def test_unbounded_stream_dedup(spark, topic, tmp_path):
    topic.send(event("a"), event("a"), minutes=[0, 900])
    topic.send(event("a"), "{bad", event("b"), minutes=[5000, 0, 0])
    assert run_dedup(spark, first_seen_forever(codec.decode_records(topic.stream())), tmp_path / "run") == ["a", "b"]


def feed(*magnitudes):
    return json.dumps({"Infogempa": {"gempa": [{"Magnitude": m} for m in magnitudes]}})


def test_ingest_equals_batch_and_logs_its_cycles(spark, tmp_path):
    folder = tmp_path / "payloads"
    folder.mkdir()
    texts = [feed("1", "2", "x"), feed("2", "3", "3"), "{bad", '{"Infogempa":{"gempa":null}}', "{}"]
    for i, text in enumerate(texts):
        (folder / f"{i}.json").write_text(text)
        time.sleep(0.02)
    out, logged = str(tmp_path / "out"), []
    listener = CycleLog(logged.extend)
    spark.streams.addListener(listener)
    try:
        query = queries.start_ingest(
            landing.payload_stream(spark, str(folder), max_files=1),
            lambda batch, _: batch.write.mode("append").parquet(out), str(tmp_path / "checkpoint"), interval=None)
        query.awaitTermination()
        lines = [(x["log_type"], x["level"], x["message"]) for p in query.recentProgress for x in lines_of(p)]
        deadline = time.time() + 20
        while len(logged) < len(lines) and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    batch = normalize(explode_events(unwrap(landing.payloads(spark, str(folder)))).select("raw"))
    landed = spark.read.parquet(out)
    assert landed.columns == schemas.EVENT.fieldNames()
    assert sorted(r.event_id for r in landed.collect()) == sorted({r.event_id for r in batch.collect()})
    assert lines == [
        ("FETCH_SUCCESS", "INFO", "Cycle: 2 dikirim, 0 dedup, total unique: 2"),
        ("FETCH_SUCCESS", "INFO", "Cycle: 1 dikirim, 2 dedup, total unique: 3"),
        ("API_ERROR", "ERROR", "Response JSON tidak valid"),
        ("FETCH_FAILED", "WARNING", "Gagal ambil data BMKG"),
        ("FETCH_FAILED", "WARNING", "Gagal ambil data BMKG"),
        ("NO_DATA", "INFO", "API tidak return data gempa"),
    ]
    assert [(x["log_type"], x["message"]) for x in logged] == [(t, m) for t, _, m in lines]
    assert set(logged[0]) == set(schemas.LOG.fieldNames())


def test_old_files_are_kept(spark, tmp_path):
    folder = tmp_path / "payloads"
    folder.mkdir()
    now = time.time()
    for name, text, days in (("new", feed("1"), 0), ("old", feed("2"), 2), ("older", feed("3"), 9)):
        (folder / name).write_text(text)
        os.utime(folder / name, (now - days * 86400,) * 2)
    out = str(tmp_path / "out")
    for _ in range(2):  # one batch with all, then files that are older than anything seen
        query = queries.start_ingest(landing.payload_stream(spark, str(folder)), lambda batch, _: batch.write.mode("append").parquet(
            out), str(tmp_path / "checkpoint"), interval=None)
        query.awaitTermination()
        (folder / "oldest").write_text(feed("4", "1"))
        os.utime(folder / "oldest", (now - 30 * 86400,) * 2)
    assert sorted(r.magnitude for r in spark.read.parquet(out).collect()) == [1.0, 2.0, 3.0, 4.0]


def test_spread_does_not_change_the_result(spark, topic, tmp_path):
    for minute in (0, 50, 100, 170, 171, 240, 300):
        topic.send(event("a"), event("a"), event(f"m{minute}"), minutes=[minute] * 3)
    decoded = topic.stream().select("timestamp", "offset", F.get_json_object(
        F.col("value").cast("string"), "$.event_id").alias("event_id"))
    plain, one, many = (run_dedup(spark, first_seen_stream(decoded, "timestamp", "1 hour", bucket), tmp_path / f"run{n}")
                        for n, bucket in enumerate((None, F.lit(0), F.pmod(F.xxhash64("offset"), F.lit(16)))))
    assert plain == one == many and plain.count("a") > 1


def test_ingest_job_lines_and_replay(spark, tmp_path):
    folder, landed = str(tmp_path / "work"), str(tmp_path / "payloads")
    batches = [[feed("1", "2"), "{bad", feed("2", "x")], [feed("2", "3"), '{"Infogempa":{"gempa":null}}'], [feed("3")]]
    runs, seq = [], 0

    def start():
        stream = spark.readStream.schema("seq long, payload string").parquet(landed)
        return jobs.ingest(stream, "seq", write("sent"), write("logs"), folder, datetime(2026, 6, 1), interval=None)

    def write(name):
        def run(df, number):
            runs.append((name, number))
            if runs.count(("logs", 1)) == 1 and (name, number) == ("logs", 1):
                raise RuntimeError("lost")
            df.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
        return run

    for texts in batches:
        spark.createDataFrame([(seq + i, t) for i, t in enumerate(texts)], "seq long, payload string").coalesce(1).write.mode(
            "append").parquet(landed)
        seq += len(texts)
        try:
            start().awaitTermination()
        except Exception as error:  # the second batch fails once and is run again
            assert "lost" in str(error)
            start().awaitTermination()
    spark.streams.resetTerminated()
    assert runs.count(("sent", 1)) == 2
    sent = spark.read.parquet(f"{folder}/sent")
    assert sorted(r.magnitude for r in sent.collect()) == [1.0, 2.0, 3.0]
    lines = spark.read.parquet(f"{folder}/logs").orderBy("cycle", "log_type").collect()
    assert [(r.cycle, r.log_type, r.message) for r in lines if r.log_type == "FETCH_SUCCESS"] == [
        (0, "FETCH_SUCCESS", "Cycle: 2 dikirim, 0 dedup, total unique: 2"), (2, "FETCH_SUCCESS", "Cycle: 0 dikirim, 1 dedup, total unique: 2"),
        (3, "FETCH_SUCCESS", "Cycle: 1 dikirim, 1 dedup, total unique: 3"), (5, "FETCH_SUCCESS", "Cycle: 0 dikirim, 1 dedup, total unique: 3")]
    assert [r.cycle for r in lines if r.log_type == "API_ERROR"] == [1]
    assert set(lines[0].asDict()) >= set(schemas.LOG.fieldNames())
    kafka_sink.write_logs(spark.read.parquet(f"{folder}/logs").select(*schemas.LOG.fieldNames()), "h:1", sink="noop")


def test_one_shot_ingest(spark):
    frame = lambda text: spark.createDataFrame([(text,)], "payload string")
    write = lambda df: kafka_sink.write_events(df, "h:1", one_shot=True, sink="noop")
    assert jobs.send_once(frame(feed("1", "x", "1")), write)["message"] == "Test selesai! 2 dari 3 event berhasil dikirim."
    assert jobs.send_once(frame("{bad"), write) == {"sent": 0, "found": 0, "message": jobs.FETCH_FAILED}
    assert jobs.send_once(frame("{}"), write)["message"] == jobs.NOTHING


def test_two_monitors_and_counts(spark, tmp_path):
    quakes, logs = Topic(spark, tmp_path / "quakes"), Topic(spark, tmp_path / "logs")
    quakes.send(event("a"), "{bad", event("b"))
    logs.send('{"level":"ERROR","message":"m"}', topic="system-logs")
    finish(*queries.start_monitors(quakes.stream(), logs.stream(), str(tmp_path / "c"), None, "memory"))
    assert sorted(r.event_id for r in spark.table("event_view").collect()) == ["a", "b"]
    assert [r.icon for r in spark.table("log_view").collect()] == ["[X]"]
    finish(queries.count_processed(quakes.stream(), str(tmp_path / "n"), "processed", None))
    assert [tuple(r) for r in spark.table("processed").collect()] == [("earthquake-events", 2)]


def test_intervals_and_wait(spark, topic, tmp_path):
    topic.send(event("a"))
    query = queries.land(codec.decode_records(topic.stream()), str(tmp_path / "lake"), str(tmp_path / "c"), "1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and lake.read_events(spark, str(tmp_path / "lake")).count() == 1
    finally:
        query.stop()
    queries.wait(spark)
    spark.streams.resetTerminated()
    assert (queries.POLL_INTERVAL, queries.DEBUG_INTERVAL, queries.LANDING_INTERVAL) == (
        "3 seconds", "10 seconds", "30 seconds")
