"""Plans the queries are expected to keep."""

import contextlib
import io
import re

import pytest

from tremorlake.plans.registry import QUERIES


def queries():
    return QUERIES


#: HotSpot leaves methods beyond this many bytes of code uncompiled.
JIT_LIMIT = 8000
NOT_LAZY = {"dedup_stream", "dedup_stream_batches", "ingest_logs_stream", "send_once", "landing_payloads", "monitor_streams",
            "stream_to_parquet", "load_counts", "load_twice", "load_newest_zones", "landed_summary", "ingest_rejects_stream", "landing_fan_out", "recovered_landing",
            "processed_counts_stream", "archive_html_range", "archive_newest_run", "archive_csv_roundtrip", "archive_html_roundtrip"}
LAZY = sorted(set(queries()) - NOT_LAZY)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_stays_in_the_jvm_without_cross_joins(spark, sf_dir, name):
    plan = physical(queries()[name](spark, sf_dir))
    assert not re.search("Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize("name", [
    "payload_unwrap", "normalize_events", "normalize_rejects", "event_id_md5", "dedup_first_seen", "kafka_decode",
    "kafka_malformed", "load_event_time", "monitor_events", "monitor_logs"])
def test_parses_each_text_once(spark, sf_dir, name):
    assert physical(queries()[name](spark, sf_dir)).count("from_json(") == 1


@pytest.mark.parametrize("name, shuffles", [
    # Pages are put together with the one shuffle of the html queries.
    ("normalize_events", 0), ("kafka_decode", 0), ("monitor_events", 0), ("load_event_time", 0),
    ("dedup_first_seen", 1), ("html_records", 1), ("html_page_counts", 1)])
def test_no_more_shuffles_than_needed(spark, sf_dir, name, shuffles):
    assert len(re.findall(r"Exchange (?:hash|RoundRobin|single)", physical(queries()[name](spark, sf_dir)))) == shuffles


@pytest.mark.parametrize("name", ["normalize_events", "html_records", "monitor_events", "dedup_first_seen"])
def test_generated_methods_can_be_compiled(spark, sf_dir, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        printed = io.StringIO()
        with contextlib.redirect_stdout(printed):
            queries()[name](spark, sf_dir).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", printed.getvalue())]
    assert sizes and max(sizes) < JIT_LIMIT


@pytest.mark.parametrize("name", ["cycle_summary", "payload_outcome_logs"])
def test_summaries_read_their_input_once(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and final.count("from_json(") == 1


def test_scans_read_only_what_is_needed(spark, sf_dir):
    assert "ReadSchema: struct<event_id:bigint>" in physical(queries()["normalize_events"](spark, sf_dir))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in physical(
        queries()["html_web_page_counts"](spark, sf_dir))
