import json
from collections import Counter
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tremorlake.operators import cycles, dedup, payload


def test_first_seen_keeps_the_earliest(spark):
    rows = [("a", 3, "late"), ("a", 1, "early"), ("b", 2, "only"), (None, 0, "no id"), ("a", 2, "middle")]
    df = spark.createDataFrame(rows, "event_id string, seq int, note string")
    assert {(r.event_id, r.note) for r in dedup.first_seen(df, "seq").collect()} == {("a", "early"), ("b", "only")}


def test_first_seen_with_one_id_holding_most_rows(spark):
    df = spark.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("seq"))
    first = dedup.first_seen(df, "seq")
    assert first.count() == 66_668
    assert first.filter("event_id = 'hot'").first().seq == 1


def test_first_seen_cuts_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("event_id"), F.col("id").alias("seq"))
    plan = dedup.first_seen(df, "seq")._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def expected_summary(events):
    """Cycle summaries by walking the events in order."""
    seen, out = set(), {}
    for cycle in sorted({c for c, _ in events}):
        sent = skipped = 0
        for event_id in (i for c, i in events if c == cycle and i is not None):
            if event_id in seen:
                skipped += 1
            else:
                seen.add(event_id)
                sent += 1
        out[cycle] = (sent, skipped, len(seen))
    return out


@pytest.mark.parametrize("block", [1, 3, 10, 1000])
def test_cycle_summary(spark, block):
    events = [((i * 7) % 40 + (60 if i % 11 == 0 else 0), None if i % 5 == 0 else f"e{(i * i) % 23}")
              for i in range(300)] + [(c, "hot") for c in range(25, 130, 2) for _ in range(4)] + [(200, None)]
    df = spark.createDataFrame(events, "cycle bigint, event_id string")
    got = {r.cycle: (r.sent, r.skipped, r.total_unique) for r in cycles.cycle_summary(df, block=block).collect()}
    assert got == expected_summary(events)


def test_cycle_summary_reads_its_input_once(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 50).alias("cycle"), (F.col("id") % 70).cast("string").alias("event_id")
                             ).write.parquet(str(tmp_path / "ids"))
    summary = cycles.cycle_summary(spark.read.parquet(str(tmp_path / "ids")), block=7)
    summary.collect()
    final = summary._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert "ReusedExchange" in final


def test_payload_logs(spark):
    def feed(*magnitudes):
        return json.dumps({"Infogempa": {"gempa": [{"Magnitude": m} for m in magnitudes]}})

    texts = ["{bad", "{}", '{"Infogempa":{"gempa":null}}', feed("1", "2", "x"), feed("2", "3", "3"), feed("x"),
             '{"Infogempa":{"gempa":[]}}']
    logs = cycles.payload_logs(
        payload.unwrap(spark.createDataFrame(list(enumerate(texts)), "i bigint, payload string")), "i",
        datetime(2026, 6, 1, tzinfo=timezone.utc), service="svc", block=2)
    got = Counter((r.cycle, r.log_type, r.level, r.message) for r in logs.collect())
    assert got == Counter([
        (0, "API_ERROR", "ERROR", "Response JSON tidak valid"),
        (0, "FETCH_FAILED", "WARNING", "Gagal ambil data BMKG"),
        (1, "NO_DATA", "INFO", "API tidak return data gempa"),
        (2, "FETCH_FAILED", "WARNING", "Gagal ambil data BMKG"),
        (3, "FETCH_SUCCESS", "INFO", "Cycle: 2 dikirim, 0 dedup, total unique: 2"),
        (4, "FETCH_SUCCESS", "INFO", "Cycle: 1 dikirim, 2 dedup, total unique: 3"),
        (5, "FETCH_SUCCESS", "INFO", "Cycle: 0 dikirim, 0 dedup, total unique: 3"),
        (6, "NO_DATA", "INFO", "API tidak return data gempa")])
    assert {(r.timestamp, r.service) for r in logs.collect()} == {("2026-06-01T00:00:00+00:00", "svc")}
