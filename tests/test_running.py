"""What running jobs keep between batches: ids, marks, bookmarks, timers, counts."""

import os
import re
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tremorlake import jobs, schemas, storage
from tremorlake.operators import load
from tremorlake.plans import inputs, registry
from tremorlake.sinks import pages as page_sink
from tremorlake.sources import lake, landing
from tremorlake.streaming import fan_out, queries, silence
from tremorlake.streaming.id_memory import IdMemory
from tremorlake.streaming.ledger import Ledger


def _ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "event_id string")


class Days:
    """A clock that the test turns."""

    def __init__(self):
        self.day = date(2026, 6, 1)

    def __call__(self):
        return self.day


def test_memory_reads_only_its_buckets(spark, tmp_path):
    folder, days = str(tmp_path / "ids"), Days()
    memory = IdMemory(spark, folder, buckets=64, clock=days)
    for number in range(6):
        memory.remember(_ids(spark, *[f"id{number}-{i}" for i in range(40)]), number)
    asked = _ids(spark, "id0-7", "id4-9", "new")
    buckets = {r[0] for r in asked.select(memory._bucket("event_id")).collect()}
    found = memory.known(asked, 5)
    opened = {int(re.search(r"bucket=(\d+)", f)[1]) for f in found.inputFiles()}
    assert opened <= buckets and {"id0-7", "id4-9"} <= {r.event_id for r in found.collect()}
    assert not {f"id5-{i}" for i in range(40)} & {r.event_id for r in memory.known(memory._read([folder]), 5).collect()}  # not its own batch
    # A batch that is run again replaces its ids.
    memory.remember(_ids(spark, "other"), 5)
    memory.remember(_ids(spark, "other"), 5)
    assert [r.event_id for r in memory.known(_ids(spark, "other"), 6).filter("event_id = 'other'").collect()] == ["other"]


def test_memory_does_not_grow_with_batches(spark, tmp_path):
    folder, days = str(tmp_path / "ids"), Days()
    memory = IdMemory(spark, folder, days=3, buckets=2, clock=days)
    files, number = [], 0
    for _ in range(7):
        for _ in range(4):
            memory.remember(_ids(spark, f"a{number}", f"b{number}"), number)
            memory.settle(number)
            number += 1
        files.append(len(memory._read([folder]).inputFiles()))
        days.day += timedelta(days=1)
    assert max(files) <= 2 * (3 + 4)  # a folder for each past day and each batch of today, per bucket
    days.day -= timedelta(days=1)
    held = {r.event_id for r in memory.known(memory._read([folder]), number).collect()}
    assert held == {f"{c}{n}" for c in "ab" for n in range(3 * 4, number)}  # three days back and today


def test_merging_leaves_a_batch_that_may_run_again(spark, tmp_path):
    folder, days = str(tmp_path / "ids"), Days()
    memory = IdMemory(spark, folder, buckets=1, clock=days)
    for number in range(3):
        memory.remember(_ids(spark, f"a{number}"), number)
    days.day += timedelta(days=1)
    memory.settle(2)
    assert {r.event_id for r in memory.known(_ids(spark, "x"), 2).collect()} == {"a0", "a1"}
    assert {r.event_id for r in memory.known(_ids(spark, "x"), 3).collect()} == {"a0", "a1", "a2"}
    again = IdMemory(spark, folder, buckets=1, clock=days)
    days.day += timedelta(days=1)
    again.settle(3)
    assert sorted(r.event_id for r in again.known(_ids(spark, "x"), 3).collect()) == ["a0", "a1", "a2"]
    assert IdMemory(spark, str(tmp_path / "none"), clock=days).known(_ids(spark, "x"), 0).count() == 0


def test_payloads_are_parsed_once(spark, sf_dir):
    rows = jobs.parse_batch(inputs.raw_payload_mix(inputs.events(spark, sf_dir)), "seq")
    assert rows._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    kinds = {(r.kind, r.outcome): r["count"] for r in rows.groupBy("kind", "outcome").count().collect()}
    assert sum(kinds.values()) == 1100 and ("payload", "API_ERROR") in kinds and ("reject", "FETCH_SUCCESS") in kinds


def test_ledger_keeps_the_last_mark(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    assert ledger.last("a") == -1 and not ledger.done("a", 0)
    for number in range(5):
        ledger.mark("a", number)
    again = Ledger(spark, str(tmp_path))
    assert again.last("a") == 4 and again.done("a", 4) and not again.done("a", 5) and again.last("b") == -1
    storage.remove(spark, f"{tmp_path}/a/slot=0/")
    assert Ledger(spark, str(tmp_path)).last("a") == 3


def test_a_replayed_batch_adds_nothing(spark, tmp_path, capsys):
    taken = []
    sinks = {"landing": fan_out.landing(f"{tmp_path}/events"), "count": lambda rows, number: taken.append((number, rows.count()))}
    rows = spark.createDataFrame([("a", "S"), ("b", None)], "event_id string, source string").select(
        *[F.col(f.name) if f.name in ("event_id", "source") else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.STREAM_EVENT.fields])
    run = fan_out.batch_runner(sinks, str(tmp_path / "work"))
    run(rows, 0)
    run(rows, 1)
    run(rows, 1)
    fan_out.batch_runner(sinks, str(tmp_path / "work"))(rows, 1)  # as after a restart
    assert taken == [(0, 2), (1, 2)]
    fan_out.landing(f"{tmp_path}/events")(rows, 1)  # written, but lost before its mark
    landed = lake.read_events(spark, f"{tmp_path}/events")
    assert sorted(r.event_id for r in landed.collect()) == ["a", "a", "b", "b"]
    assert storage.children(spark, f"{tmp_path}/work/staged") == []
    fan_out.printed()(rows, 0)
    assert "event_id" in capsys.readouterr().out


def test_one_read_for_all_sinks(spark, tmp_path, sf_dir):
    inputs.events(spark, sf_dir).write.parquet(f"{tmp_path}/source")
    stream = spark.readStream.schema("seq bigint, user_id bigint, event_type string").parquet(f"{tmp_path}/source")
    query = fan_out.fan_out(inputs.kafka_quakes(stream), {
        name: lambda rows, number, name=name: rows.write.parquet(f"{tmp_path}/{name}") for name in "abc"}, str(tmp_path / "w"), None)
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [1000]
    assert [spark.read.parquet(f"{tmp_path}/{name}").count() for name in "abc"] == [1000] * 3


def test_a_failing_query_stops_the_one_beside_it(spark, tmp_path):
    inputs.events(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/source")
    stream = spark.readStream.schema("seq bigint, user_id bigint, event_type string").parquet(f"{tmp_path}/source")

    def lost(rows, number):
        raise RuntimeError("lost")

    beside = queries.upsert_counts(inputs.kafka_logs(stream), f"{tmp_path}/counts", f"{tmp_path}/c", "1 second")
    failing = fan_out.fan_out(inputs.kafka_quakes(stream), {"a": lost}, str(tmp_path / "w"), None)
    with pytest.raises(StreamingQueryException, match="lost"):
        queries.supervise(failing, beside)
    assert not beside.isActive and not failing.isActive
    spark.streams.resetTerminated()


def test_recovered_landing_has_failed(spark, sf_dir, monkeypatch):
    seen, supervise = [], queries.supervise

    def watched(*running):
        try:
            supervise(*running)
            seen.append("ended")
        except StreamingQueryException:
            seen.append("failed")
            raise

    monkeypatch.setattr(registry.streams, "supervise", watched)
    assert registry.recovered_landing(spark, sf_dir).count() == 1000 and seen == ["failed", "ended"]
    spark.streams.resetTerminated()


def test_load_is_taken_up_where_it_failed(spark, tmp_path):
    def land(*names):
        spark.createDataFrame([(n, "2026-06-01T00:00:00+00:00", "S") for n in names], "event_id string, datetime string, source string").select(
            *[F.col(f.name) if f.name in ("event_id", "datetime", "source") else F.lit(None).cast(f.dataType).alias(f.name)
              for f in schemas.STREAM_EVENT.fields]).coalesce(1).write.mode("append").partitionBy("source").parquet(f"{tmp_path}/landed")

    def run(fail=False):
        def write(rows, number):
            rows.write.mode("overwrite").parquet(f"{tmp_path}/table/batch={number}")
            if fail:
                raise RuntimeError("lost")
        return jobs.load_new(lake.new_events(spark, f"{tmp_path}/landed", max_files=10), write, str(tmp_path / "work"))

    land("a", "b")
    assert run() == 2 and run() == 0
    land("c")
    with pytest.raises(StreamingQueryException):
        run(fail=True)
    land("d")
    assert run() == 2 and run() == 0
    table = spark.read.parquet(f"{tmp_path}/table")
    assert sorted((r.event_id, r.event_time) for r in table.collect()) == [(n, datetime(2026, 6, 1)) for n in "abcd"]
    spark.streams.resetTerminated()


def test_silent_polls(spark, tmp_path):
    source, out = tmp_path / "payloads", str(tmp_path / "lines")
    source.mkdir()
    (source / "first").write_text("{}")

    def start():
        lines = silence.silent_polls(landing.payload_stream(spark, str(source)), 2)
        return queries.timed(lines.writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", str(tmp_path / "c")), "200 milliseconds").start()

    def lines():
        found = spark.read.schema("silent bigint, log_type string, level string, message string").parquet(out)
        return sorted(tuple(r) for r in found.collect())

    def until(n):
        end = time.time() + 90
        while time.time() < end and (not storage.children(spark, out) or len(lines()) < n):
            time.sleep(0.2)
        return lines()

    query = start()
    first = until(1)
    query.stop()
    query.awaitTermination()
    again = start()
    try:
        found = until(len(first) + 1)
    finally:
        again.stop()
    assert [n for n, *_ in found] == list(range(1, len(found) + 1))  # none twice, none left out
    assert {tuple(line[1:]) for line in found} == {("FETCH_FAILED", "WARNING", "Gagal ambil data BMKG")}


def test_counts_survive_a_replayed_batch(spark, tmp_path):
    folder = str(tmp_path / "counts")
    for number, (quakes, logs) in enumerate([(2, 5), (3, None), (3, None)]):
        rows = [("q", quakes)] + ([("l", logs)] if logs else [])
        spark.createDataFrame(rows, "topic string, n_processed bigint").write.mode("overwrite").parquet(f"{folder}/batch={min(number, 1)}")
    assert {r.topic: r.n_processed for r in queries.latest_counts(spark, folder).collect()} == {"q": 3, "l": 5}


def test_page_ranges_open_only_their_folders(spark, tmp_path):
    pages = spark.range(1, 301).selectExpr("id AS page_num", "concat('<p>', id) AS html")
    page_sink.archive_html(pages, str(tmp_path), 50)
    assert page_sink.read_html(spark, str(tmp_path)).count() == 300
    for first, last, folders in ((1, 238, 5), (120, 130, 1), (None, 49, 1), (250, None, 2), (400, 500, 0)):
        found = page_sink.read_html(spark, str(tmp_path), first, last)
        wanted = [n for n in range(1, 301) if (first or 1) <= n <= (last or 300)]
        assert sorted(r.page_num for r in found.collect()) == wanted
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull" in plan
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numPartitions").value() == folders


def test_runs_are_seen_when_published(spark, tmp_path):
    row = "<tr><td>1</td><td>01/06/2026</td><td>12:00</td><td>1.5 LS</td><td>100.2 BT</td><td>10 km</td><td>5.0</td></tr>"
    table = lambda *pages: spark.createDataFrame([(p, f"<table>{row * n}</table>") for p, n in pages], "page_num bigint, html string")
    root, runs = str(tmp_path), [datetime(2026, 6, d) for d in (1, 2, 3)]
    held = lambda: sorted((r.page_num, r.row_pos, r.run) for r in page_sink.newest_records(spark, root).collect())
    page_sink.write_run(table((1, 2), (2, 1), (3, 1)), root, runs[0])
    page_sink.publish(spark, root, runs[0])
    before = held()
    page_sink.write_run(table((2, 2), (3, 0)), root, runs[1])
    assert held() == before
    page_sink.write_run(table((2, 2), (3, 0)), root, runs[1])  # again, after a loss
    page_sink.publish(spark, root, runs[1])
    page_sink.publish(spark, root, runs[1])
    page_sink.write_run(table((1, 1)), root, runs[2])
    first, second = "20260601_000000", "20260602_000000"
    assert held() == [(1, 0, first), (1, 1, first), (2, 0, second), (2, 1, second)]


def test_renamed_event_time(spark):

    df = spark.createDataFrame([("a", "07 Jun 2026 13:06:08 WIB", "s")], "event_id string, datetime string, source string")
    out = load.with_event_time(df)
    assert out.columns == ["event_id", "original_datetime", "source", "event_time"]
    assert out.first().event_time == datetime(2026, 6, 7, 6, 6, 8)


def test_newest_rows_open_only_loads_that_can_hold_them(spark, tmp_path):
    times = [[datetime(2026, 6, d, h) for h in range(4)] for d in (1, 2, 9, 10)] + [[None, datetime(2026, 6, 9, 23)], [None]]
    zones, rows = [], []
    for number, own in enumerate(times):
        given = [t for t in own if t]
        zones.append((len(own), len(given), min(given, default=None), max(given, default=None), number))
        rows += [(f"e{number}-{i}", t, number) for i, t in enumerate(own)]
    frame = spark.createDataFrame(zones, f"{load.ZONE}, batch bigint")
    assert load.batches_of_newest(frame, 5) == [3, 4]  # ten o'clock of the tenth, and the late one of the ninth
    assert load.batches_of_newest(frame, 3) == [3] and load.batches_of_newest(frame, 17) == [0, 1, 2, 3, 4]
    assert load.batches_of_newest(frame, 18) is None and load.batches_of_newest(frame.limit(0), 1) is None
    table = spark.createDataFrame(rows, "event_id string, event_time timestamp, batch bigint").selectExpr(
        "event_id", "event_time", "1.0D AS magnitude", "'r' AS region", "'s' AS source", "batch")
    table.write.partitionBy("batch").parquet(f"{tmp_path}/table")
    frame.write.partitionBy("batch").parquet(f"{tmp_path}/zones")
    written = spark.read.parquet(f"{tmp_path}/table")
    for n in (3, 5, 17, 18, 50):
        found = jobs.newest_loaded(written, str(tmp_path), n)
        assert found.collect() == load.newest(written, n).collect()
        if n == 5:
            scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
            assert "PartitionFilters: [" in str(scan) and scan.metrics().apply("numPartitions").value() == 2


def test_counts_come_from_footers(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id / 10.0D AS magnitude", "concat('s', id % 3) AS source").write.partitionBy("source").parquet(
        str(tmp_path / "t"))
    listed = spark.conf.get("spark.sql.sources.useV1SourceList")
    with lake.footers(spark):
        found = lake.footer_summary(spark, str(tmp_path / "t"))
        assert "PushedAggregation: [COUNT(*), MIN(magnitude), MAX(magnitude)]" in found._jdf.queryExecution().toString()
        assert tuple(found.first()) == (1000, 0.0, 99.9)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == listed


def test_page_range_asks_for_its_folders_alone(spark, tmp_path, monkeypatch):
    """Folders of two widths, replaced ones, and an archive without notes of its widths give the same pages."""
    def pages(first, last, text):
        return spark.range(first, last + 1).select(F.col("id").alias("page_num"), F.concat(F.lit(text), "id").alias("html"))

    def found(root, first, last):
        return sorted((r.page_num, r.html) for r in page_sink.read_html(spark, root, first, last).collect())

    root = f"{tmp_path}/noted"
    page_sink.archive_html(pages(-30, 300, "a"), root, 20)
    page_sink.archive_html(pages(41, 45, "b"), root, 20)
    page_sink.archive_html(pages(1000, 1150, "c"), root, 100)
    assert not [name for name in os.listdir(root) if "staged" in name]
    ranges = [(31, 238), (41, 41), (-25, 3), (290, 1010), (400, 900), (9, 2)]
    named = [found(root, *r) for r in ranges]
    assert named[0] == sorted([(n, f"a{n}") for n in [*range(31, 40), *range(60, 239)]] + [(n, f"b{n}") for n in range(41, 46)])
    assert len(page_sink._folders_of(spark, root, 31, 238)) == 11 and page_sink._folders_of(spark, root, 0, 10**6) is None
    monkeypatch.setattr(page_sink, "FOLDERS_ASKED", 0)
    assert [found(root, *r) for r in ranges] == named
    monkeypatch.undo()

    pages(0, 39, "old").withColumn("first_page", F.lit(0)).withColumn("last_page", F.lit(39)).write.partitionBy(
        "first_page", "last_page").parquet(f"{tmp_path}/plain/raw_html")
    page_sink.archive_html(pages(40, 79, "new"), f"{tmp_path}/plain", 20)
    assert [n for n, _ in found(f"{tmp_path}/plain", 35, 60)] == list(range(35, 61))


def test_parts_of_the_input_are_dealt_over_the_cores(spark, tmp_path):
    """A range of a table that lies in one split still gives every core a file, and the recovered query takes a part a batch."""
    spark.range(1000).selectExpr("id AS event_id", "timestamp'2026-06-01' AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.0D AS value",
                                 "'' AS props").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    parts = inputs.event_slices(spark, str(tmp_path), 3, in_order=True)
    assert [p.count() for p in parts] == [334, 333, 333]
    for number, part in enumerate(parts):
        part.write.parquet(f"{tmp_path}/part{number}")
        sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/part{number}").groupBy(F.input_file_name()).count().collect()]
        assert len(sizes) == cores and max(sizes) < 2 * min(sizes)


def test_buckets_of_few_ids_are_written_by_all_cores(spark, tmp_path):
    memory = IdMemory(spark, f"{tmp_path}/ids")
    memory.remember(spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("event_id")), 0)
    writers = {name.split("-")[1] for _, _, names in os.walk(f"{tmp_path}/ids") for name in names if name.startswith("part-")}
    assert len(writers) > 1
    ids = spark.range(4000, 6000).select(F.md5(F.col("id").cast("string")).alias("event_id"))
    assert memory.known(ids, 1).join(ids, "event_id").count() == 1000
