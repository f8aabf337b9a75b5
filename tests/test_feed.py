"""Payload unwrapping and normalisation, on literal edge rows."""

import json
from collections import Counter
from datetime import datetime, timezone

from tremorlake import schemas
from tremorlake.operators import normalize, payload

CLOCK = datetime(2026, 6, 1, 1, 2, 3, tzinfo=timezone.utc)
FULL = {"DateTime": "2026-06-07T13:06:08+00:00", "Coordinates": "-8.12,107.89", "Magnitude": "5.2",
        "Kedalaman": "10 km", "Wilayah": "W", "Dirasakan": "III", "Shakemap": "s.jpg", "Potensi": "P"}


def without(*keys, **changes):
    return {k: v for k, v in {**FULL, **changes}.items() if k not in keys}


def unwrapped(spark, *texts):
    return payload.unwrap(spark.createDataFrame(list(enumerate(texts)), "i int, payload string"))


def normalized(spark, *events, **options):
    text = json.dumps({"Infogempa": {"gempa": list(events)}})
    raw = payload.explode_events(unwrapped(spark, text)).select("event_pos", "raw")
    return {r.event_pos: r for r in normalize.normalize(raw, clock=CLOCK, **options).collect()}


OUTCOMES = [
    ('{"Infogempa":{"gempa":{"a":1}}}', "FETCH_SUCCESS", 1),
    ('{"Infogempa":{"gempa":{}}}', "FETCH_SUCCESS", 1),
    ('{"Infogempa":{"gempa":[{"a":1},{"a":2},{"a":3}]}}', "FETCH_SUCCESS", 3),
    ('{"Infogempa":{"gempa":[null]}}', "FETCH_SUCCESS", 1),
    ('{"Infogempa":{"gempa":[]}}', "NO_DATA", 0),
    ('{"Infogempa":{"gempa":""}}', "NO_DATA", 0),
    ('{"Infogempa":{"gempa":"text"}}', "FETCH_SUCCESS", 1),
    ('{"Infogempa":{"gempa":null}}', "FETCH_FAILED", 0),
    ('{"Infogempa":{}}', "NO_DATA", 0),
    ("{}", "NO_DATA", 0),
    ("[1]", "NO_DATA", 0),
    ("[]", "NO_DATA", 0),
    (' {"Infogempa": {"other": 1, "gempa": {"a": 1}}} \n', "FETCH_SUCCESS", 1),
    ("{bad", "API_ERROR", 0),
    ("", "API_ERROR", 0),
    ("  ", "API_ERROR", 0),
    (None, "API_ERROR", 0),
    ('{"Infogempa":{"gempa":{"a":1}}} tail', "API_ERROR", 0),
    ('{"Infogempa":{"gempa":{"a":1}}}{}', "API_ERROR", 0),
    ('{"Infogempa":{"gempa":{"a":1', "API_ERROR", 0),
]


def test_outcome_and_events(spark):
    rows = unwrapped(spark, *[text for text, _, _ in OUTCOMES]).cache()
    outcomes = {r.i: r.outcome for r in rows.collect()}
    events = Counter(r.i for r in payload.explode_events(rows).collect())
    kept = Counter(r.i for r in payload.explode_events(rows, keep_empty=True).collect())
    for i, (text, outcome, n) in enumerate(OUTCOMES):
        assert (outcomes[i], events[i], kept[i]) == (outcome, n, max(n, 1)), text


def test_events_keep_their_order(spark):
    rows = unwrapped(spark, '{"Infogempa":{"gempa":[{"Magnitude":"1"},{"Magnitude":"2"}]}}')
    raw = payload.explode_events(rows).select("event_pos", "raw")
    assert [(r.event_pos, r.magnitude) for r in normalize.normalize(raw).orderBy("event_pos").collect()] == [
        (0, 1.0), (1, 2.0)]


def test_full_event(spark):
    row = normalized(spark, FULL)[0].asDict()
    assert row.pop("event_pos") == 0
    assert list(row) == schemas.EVENT.fieldNames()
    row.pop("event_id")
    assert row == {
        "datetime": FULL["DateTime"], "latitude": -8.12, "longitude": 107.89, "magnitude": 5.2, "depth": 10,
        "region": "W", "felt_intensity": "III", "shakemap": "s.jpg", "potensi": "P",
        "source": "BMKG_REALTIME", "ingested_at": "2026-06-01T01:02:03+00:00"}


def test_empty_event_is_valid(spark):
    row = normalized(spark, {})[0]
    assert (row.datetime, row.latitude, row.longitude, row.magnitude, row.depth, row.region, row.felt_intensity) == (
        " ", 0.0, 0.0, 0.0, 0, "Tidak diketahui", "")


COORDINATES = [
    ("-8.12,107.89", (-8.12, 107.89)), (" -8.12 , 107.89 ", (-8.12, 107.89)), ("1", (1.0, 0.0)),
    ("1,2,3", (1.0, 2.0)), (" 1 ,2", (1.0, 2.0)), ("1e1,+2", (10.0, 2.0)),
    ("", None), ("a,b", None), ("1,", None), (",1", None), ("1;2", None), (5, None), (None, None), ([1, 2], None)]


def test_coordinates(spark):
    rows = normalized(spark, *[without(Coordinates=text) for text, _ in COORDINATES])
    got = [(rows[i].latitude, rows[i].longitude) if i in rows else None for i in range(len(COORDINATES))]
    assert got == [expected for _, expected in COORDINATES]


MAGNITUDES = [
    ("5.2", 5.2), ("5.2 SR", 5.2), ("SR 5.2SR", 5.2), (5.2, 5.2), (5, 5.0), (True, 1.0), ("1e0", 1.0),
    ("SR", None), ("", None), ("5,2", None), (None, None), ([5], None), ({"a": 5}, None)]


def test_magnitude(spark):
    rows = normalized(spark, *[without(Magnitude=value) for value, _ in MAGNITUDES])
    got = [rows[i].magnitude if i in rows else None for i in range(len(MAGNITUDES))]
    assert got == [expected for _, expected in MAGNITUDES]


DEPTHS = [
    ("10 km", 10), ("10", 10), ("km10km", 10), (" +7 ", 7), (10, 10), (10.7, 10), (-10.7, -10), (1e2, 100),
    (True, 1), ("10.5 km", None), ("", None), ("1e2", None), (None, None), ([10], None)]


def test_depth(spark):
    rows = normalized(spark, *[without(Kedalaman=value) for value, _ in DEPTHS])
    got = [rows[i].depth if i in rows else None for i in range(len(DEPTHS))]
    assert got == [expected for _, expected in DEPTHS]


def test_absent_numbers_are_zero(spark):
    row = normalized(spark, without("Coordinates", "Magnitude", "Kedalaman"))[0]
    assert (row.latitude, row.longitude, row.magnitude, row.depth) == (0.0, 0.0, 0.0, 0)


def test_depth_beyond_int_keeps_its_row(spark):
    row = normalized(spark, without(Kedalaman="5000000000"))[0]
    assert row.depth is None and row.event_id


DATETIMES = [
    (without(), "2026-06-07T13:06:08+00:00"),
    (without("DateTime"), " "),
    (without("DateTime", Tanggal="07 Jun 2026", Jam="13:06:08 WIB"), "07 Jun 2026 13:06:08 WIB"),
    (without("DateTime", Tanggal="07 Jun 2026"), "07 Jun 2026 "),
    (without("DateTime", Jam="13:06"), " 13:06"),
    (without(DateTime=""), ""),
    (without(DateTime=None), None),
]


def test_datetime_text(spark):
    rows = normalized(spark, *[event for event, _ in DATETIMES])
    assert [rows[i].datetime for i in range(len(DATETIMES))] == [expected for _, expected in DATETIMES]


REJECTED = [
    without(Tanggal=None), without(Jam=None), without("DateTime", Tanggal=None, Jam="x"), without(Tanggal=7),
    "text", 5, None, [1]]


def test_rejected_events(spark):
    assert normalized(spark, *REJECTED, FULL).keys() == {len(REJECTED)}


def test_rejects_hold_the_raw_event(spark):
    raw = payload.explode_events(unwrapped(spark, json.dumps(
        {"Infogempa": {"gempa": [FULL, without(Kedalaman="10.5 km")]}}))).select("event_pos", "raw")
    rejected = normalize.rejects(raw).collect()
    assert [(r.event_pos, json.loads(r.raw)["Kedalaman"]) for r in rejected] == [(1, "10.5 km")]
    ids = {r.event_pos: r.event_id for r in normalize.event_ids(raw).collect()}
    assert ids[1] is None and ids[0] == normalize.normalize(raw).first().event_id


DEFAULTS = [
    (without(), "W", "III"), (without("Wilayah"), "III", "III"),
    (without("Wilayah", "Dirasakan"), "Tidak diketahui", ""), (without(Wilayah=""), "", "III"),
    (without(Wilayah=None), None, "III"), (without("Wilayah", Dirasakan=None), None, None),
    (without("Wilayah", Dirasakan=""), "", "")]


def test_defaults_apply_to_absent_keys_only(spark):
    rows = normalized(spark, *[event for event, _, _ in DEFAULTS])
    got = [(rows[i].region, rows[i].felt_intensity) for i in range(len(DEFAULTS))]
    assert got == [(region, felt) for _, region, felt in DEFAULTS]


def test_time_id_variant(spark):
    rows = normalized(spark, FULL, without("DateTime", Tanggal="t", Jam="j"), without(Tanggal=None), by_content=False)
    assert [f for f in rows[0].asDict() if f != "event_pos"] == schemas.STREAM_EVENT.fieldNames()
    assert rows[0].event_id == "BMKG_20260601010203_-8.12_107.89"
    assert rows[1].datetime == ""
    assert 2 in rows


def test_equal_in_five_fields_means_the_same_event(spark):
    rows = normalized(spark, FULL, without("Shakemap", Wilayah="other", Dirasakan="I"), without(Magnitude="5.3"),
                      without(Magnitude=5.2, Kedalaman=10))
    assert rows[0].event_id == rows[1].event_id == rows[3].event_id != rows[2].event_id


def test_repeated_key_keeps_the_last(spark):
    raw = payload.explode_events(unwrapped(spark, '{"Infogempa":{"gempa":{"Magnitude":"1","Magnitude":"2"}}}'))
    assert normalize.normalize(raw.select("raw")).first().magnitude == 2.0


def test_a_repeated_key(spark):
    from tremorlake.operators.payload import unwrap

    rows = spark.createDataFrame([('{"Infogempa":{"gempa":{"Magnitude":"1","Magnitude":"2"}}}',)], "payload string")
    setting = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "true")
        row = unwrap(rows).selectExpr("outcome", "try_variant_get(raw_events[0], '$.Magnitude', 'string') AS m").first()
        assert (row.outcome, row.m) == ("FETCH_SUCCESS", "2")
        spark.conf.set(setting, "false")
        assert unwrap(rows).first().outcome == "API_ERROR"
    finally:
        spark.conf.set(setting, before)


def test_text_around_a_payload_makes_it_invalid(spark):
    from tremorlake.operators.payload import unwrap

    good = '{"Infogempa":{"gempa":{"a":1}}}'
    texts = [good, f" {good}\n", good + ',"x":1', good[:-1] + '},"end":true} junk', '1,"x":2', good + good, f"{good},{good}", "", "  "]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, payload string")
    assert [r.outcome for r in unwrap(rows).orderBy("i").collect()] == ["FETCH_SUCCESS"] * 2 + ["API_ERROR"] * 7
