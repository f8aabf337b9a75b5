import hashlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tremorlake.functions import clock
from tremorlake.functions.text import WHITESPACE, float_text, parse_float, parse_integer, strip
from tremorlake.operators.normalize import content_id


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_float_text_is_the_shortest_text(spark):
    values = [0.0, -0.0, 5.0, -8.12, 107.89, 0.001, 0.0005, -0.00012, 0.00099999, 9999999.5, 1e7, 12345678.25,
              1e15, 123456789012345.6, 1e16, 1.5e16, 1e-5, 1.25e-7, 1e22, 1.5e300,
              float("nan"), float("inf"), float("-inf")]
    assert column(spark, values, "double", float_text) == [repr(v) for v in values]


def test_float_text_over_the_value_range(spark):
    cents = spark.range(-18000, 18001).select((F.col("id") / 100).alias("v"))
    got = {r.v: r.t for r in cents.select("v", float_text(F.col("v")).alias("t")).collect()}
    assert all(text == repr(v) for v, text in got.items())


def test_strip_takes_all_unicode_white_space(spark):
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert column(spark, ["  x ", "\t\n", "a b", None], "string", strip) == ["x", "", "a b", None]


def test_parse_float(spark):
    values = ["5", " -8.12 ", "+.5", "5.", "1e3", " 7 ", "nan", "-Infinity",
              "", ".", "1.2.3", "1.0d", "0x1p3", "1_0", "a", None]
    got = column(spark, values, "string", parse_float)
    assert got[:6] == [5.0, -8.12, 0.5, 5.0, 1000.0, 7.0]
    assert got[6] != got[6] and got[7] == float("-inf")
    assert got[8:] == [None] * 8


def test_parse_integer(spark):
    values = ["10", " -3 ", "+7", "\t4\n", "10.5", "", "1e3", "99999999999999999999", None]
    assert column(spark, values, "string", parse_integer) == [10, -3, 7, 4, None, None, None, None, None]


@pytest.mark.parametrize("latitude, longitude, magnitude, depth", [
    (5.0, 95.0, 5.2, 10), (-8.12, 107.89, 0.0005, 0), (-0.0, 0.0, 1e7, 600)])
def test_content_id(spark, latitude, longitude, magnitude, depth):
    for when in ("2026-06-07T13:06:08+00:00", None):
        got = spark.createDataFrame([(when, latitude, longitude, magnitude, depth)],
                                    "d string, a double, o double, m double, k bigint").select(
            content_id(*[F.col(c) for c in "daomk"]).alias("id")).first().id
        text = f"{when}_{latitude}_{longitude}_{magnitude}_{depth}"
        assert got == hashlib.md5(text.encode()).hexdigest()


def test_content_id_golden(spark):
    got = spark.sql("select 'x' d, 1.0D a, 2.5D o, 5.2D m, 10L k").select(
        content_id(*[F.col(c) for c in "daomk"]).alias("id")).first().id
    assert got == hashlib.md5(b"x_1.0_2.5_5.2_10").hexdigest()


def test_event_time_in_any_session_zone(spark):
    values = ["2026-06-07T13:06:08+00:00", "2026-06-07T13:06:08Z", "2026-06-07T13:06:08", "07 Jun 2026 13:06:08 WIB",
              "07 Agu 2026 13:06:08 WIB", "2026-13-07T13:06:08", "2026-06-07", " ", None]
    noon, wib = 1780837568, 1780837568 - 7 * 3600
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Asia/Jakarta", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            got = column(spark, values, "string", lambda c: F.unix_seconds(clock.event_time(c)))
            assert got == [noon, noon, noon, wib, None, None, None, None, None]
            assert column(spark, [1780837568000, 1780837568123], "bigint", lambda c: clock.iso_text(clock.record_time(c))) == [
                "2026-06-07T13:06:08", "2026-06-07T13:06:08.123000"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_clock_texts(spark):
    fixed = datetime(2026, 6, 7, 13, 6, 8, tzinfo=timezone.utc)
    row = spark.range(1).select(clock.utc_iso(fixed).alias("a"), clock.naive_iso(fixed).alias("b"),
                                clock.compact(fixed).alias("c"), clock.utc_iso().alias("d"),
                                clock.naive_iso().alias("e"), clock.compact().alias("f")).first()
    assert (row.a, row.b, row.c) == ("2026-06-07T13:06:08+00:00", "2026-06-07T13:06:08", "20260607130608")
    now = datetime.now(timezone.utc)
    assert abs((now - datetime.fromisoformat(row.d)).total_seconds()) < 120
    assert abs((now.replace(tzinfo=None) - datetime.fromisoformat(row.e)).total_seconds()) < 120
    assert len(row.f) == 14
