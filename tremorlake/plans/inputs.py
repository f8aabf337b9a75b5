"""Quake-shaped inputs, derived row by row from the given ``events`` and ``pages`` tables.

Every value is integer arithmetic on the event number, so an SQL engine can derive the same rows.
The functions take a batch or a streaming ``events`` frame alike.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

#: A caller's choice: deal the tables that inputs are derived from over so many tasks. Unset, scans stay as they are.
INPUT_TASKS = "spark.tremorlake.inputTasks"

EVENTS_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
ROWS_PER_PAGE = 15
#: A row added to the given web pages.
BULLETIN_ROW = ("<tr><td>1</td><td>01/06/2026</td><td>12:00:00</td><td>1.50 LS</td><td>100.25 BT</td><td>10 km</td>"
                "<td>5.0</td><td>Laut</td></tr>")
#: Event minutes are counted from this day.
FIRST_DAY = "2026-06-01"
FIRST_SECOND = 1780272000


def _event_columns(df: DataFrame) -> DataFrame:
    return df.select(F.col("event_id").alias("seq"), "user_id", "event_type")


def _dealt(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    # A repeated key in a payload keeps its last value, whatever session the query is given.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    tasks = spark.conf.get(INPUT_TASKS, "")
    return df.repartition(int(tasks)) if tasks else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dealt(_event_columns(spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a stream of files.

    The name is given as a pattern, because a file stream takes no plain path to a single file.
    """
    path = f"{sf_dir}/{{events.parquet}}"
    return _dealt(_event_columns(spark.readStream.schema(EVENTS_SCHEMA).parquet(path)))


def event_slices(spark: SparkSession, sf_dir: str, slices: int, in_order: bool) -> list[DataFrame]:
    """The events table in parts that arrive one after the other.

    In order, a part is a range of event numbers; else it holds every ``slices``-th event, so arrival
    times of a later part lie before those of an earlier one. A range lies in few splits of the table, so
    the narrow rows of a part are dealt over all cores before anything is made of them.
    """
    columns = events(spark, sf_dir)
    last = columns.agg(F.max("seq")).first()[0] or 0
    place = F.floor(F.col("seq") * slices / (last + 1)) if in_order else F.pmod(F.lit(slices - 1) - F.col("seq"), F.lit(slices))
    tasks = max(2, spark.sparkContext.defaultParallelism)
    return [columns.filter(place == number).repartition(tasks) for number in range(slices)]


def _text(value: str) -> str:
    return f"string({value})"


def _scaled(value: str, digits: int) -> str:
    """``value / 10**digits`` with exactly that many decimals."""
    return f"string(decimal({value}) * {10 ** -digits:.{digits}f}BD)"


def _day(minute: str) -> str:
    return f"date_add(date'{FIRST_DAY}', int(({minute}) div 1440))"


def _clock(minute: str) -> str:
    return (f"concat(lpad(string(({minute}) % 1440 div 60), 2, '0'), ':', "
            f"lpad(string(({minute}) % 60), 2, '0'), ':00')")


def _iso(minute: str) -> str:
    return f"concat(string({_day(minute)}), 'T', {_clock(minute)})"


def _instant(minute: str) -> str:
    return f"timestamp_seconds({FIRST_SECOND} + ({minute}) * 60)"


def _latitude(n: str) -> str:
    return f"(({n}) * 37 % 1700 - 1100)"


def _longitude(n: str) -> str:
    return f"(9500 + ({n}) * 53 % 4600)"


def _magnitude(n: str) -> str:
    return _scaled(f"20 + ({n}) * 7 % 60", 1)


def _depth(n: str) -> str:
    return _text(f"5 + ({n}) * 11 % 600")


def quake_object(k: str) -> str:
    """JSON text of raw quake ``k``; ``k % 20`` picks the variation of its spelling."""
    kind, iso, clock = f"({k}) % 20", _iso(k), _clock(k)
    written = f"date_format({_day(k)}, 'dd MMM yyyy')"
    lat, lon, mag, dep = _scaled(_latitude(k), 2), _scaled(_longitude(k), 2), _magnitude(k), _depth(k)
    return f"""concat('{{',
        CASE {kind}
            WHEN 3 THEN concat('"DateTime":"', {iso}, '"')
            WHEN 4 THEN concat('"DateTime":"', {written}, ' ', {clock}, ' WIB"')
            WHEN 5 THEN concat('"Tanggal":"', {written}, '","Jam":"', {clock}, ' WIB"')
            ELSE concat('"DateTime":"', {iso}, '+00:00"') END,
        CASE {kind}
            WHEN 9 THEN ',"Coordinates":"abc,1"'
            WHEN 10 THEN concat(',"Coordinates":"', {lat}, '"')
            WHEN 11 THEN ''
            ELSE concat(',"Coordinates":"', {lat}, ',', {lon}, '"') END,
        CASE WHEN {kind} = 6 THEN concat(',"Magnitude":', {mag})
            WHEN ({k}) % 3 = 0 THEN concat(',"Magnitude":"', {mag}, ' SR"')
            ELSE concat(',"Magnitude":"', {mag}, '"') END,
        CASE {kind}
            WHEN 7 THEN concat(',"Kedalaman":', {dep}, '.7')
            WHEN 8 THEN concat(',"Kedalaman":"', {dep}, '.5 km"')
            ELSE concat(',"Kedalaman":"', {dep}, ' km"') END,
        CASE WHEN {kind} = 12 THEN ',"Dirasakan":"II-III"'
            ELSE ',"Wilayah":"Pusat gempa","Dirasakan":""' END,
        '}}')"""


def _envelope(gempa: str) -> str:
    return f"""concat('{{"Infogempa":{{"gempa":', {gempa}, '}}}}')"""


def raw_quakes(events_df: DataFrame) -> DataFrame:
    """One payload per event; events ``2k`` and ``2k+1`` carry the same quake."""
    return events_df.selectExpr("seq", f"{_envelope(quake_object('seq div 2'))} AS payload",
                                f"{_instant('seq')} AS arrived_at")


def raw_payload_mix(events_df: DataFrame) -> DataFrame:
    """Payloads of every outcome, by the last digit of the event number."""
    one, two = quake_object("seq div 2"), quake_object("seq div 2 + 1")
    return events_df.selectExpr("seq", f"""CASE seq % 10
        WHEN 0 THEN '{{bad'
        WHEN 1 THEN '{{}}'
        WHEN 2 THEN '{{"Infogempa":{{"gempa":[]}}}}'
        WHEN 3 THEN '{{"Infogempa":{{"gempa":null}}}}'
        WHEN 4 THEN {_envelope(f"concat('[', {one}, ',', {two}, ']')")}
        WHEN 5 THEN '{{"Infogempa":{{}}}}'
        WHEN 6 THEN CASE seq % 50
            WHEN 6 THEN '{{"Infogempa":{{"gempa":{{"a":1}}}}}},"x":1'
            WHEN 16 THEN '{{"Infogempa":{{"gempa":{{"a":1}}}}}},"end":true}} junk'
            WHEN 26 THEN '1,"x":2'
            WHEN 36 THEN '{{"Infogempa":{{"gempa":null}}}},"payload":{{"Infogempa":{{"gempa":[1]}}}}'
            ELSE {_envelope(one)} END
        ELSE {_envelope(one)} END AS payload""")


def _records(events_df: DataFrame, topic: str, key: str, value: str) -> DataFrame:
    return events_df.selectExpr(
        f"binary({key}) AS key", f"binary({value}) AS value", f"'{topic}' AS topic", "0 AS partition",
        "seq AS offset", f"{_instant('seq')} + make_dt_interval(0, 0, 0, seq % 4 * 0.041) AS timestamp", "0 AS timestampType")


def kafka_quakes(events_df: DataFrame) -> DataFrame:
    """Event-topic records: normalised events as JSON, some malformed or incomplete."""
    k = "seq div 2"
    value = f"""CASE WHEN seq % 50 = 7 THEN '{{bad' WHEN seq % 50 = 17 THEN '{{"event_id":"a"}},"x":1'
        WHEN seq % 50 = 27 THEN '{{"event_id":"a"}},"end":true}} junk' ELSE concat(
        '{{"event_id":"', md5(binary(string({k}))), '","datetime":"', {_iso(k)}, '+00:00"',
        ',"latitude":', {_scaled(_latitude(k), 2)}, ',"longitude":', {_scaled(_longitude(k), 2)},
        ',"magnitude":', CASE seq % 50 WHEN 21 THEN '0.00001' WHEN 31 THEN '12345678.9' WHEN 41 THEN 'true'
            ELSE {_magnitude(k)} END, ',"depth":', {_depth(k)}, IF(seq % 50 = 13, '.5', ''),
        IF(seq % 50 = 11, '', ',"region":"Pusat gempa di laut sebelah barat"'),
        ',"felt_intensity":"","shakemap":"","potensi":"","source":"BMKG_REALTIME"',
        ',"ingested_at":"', {_iso('seq')}, '+00:00"}}') END"""
    return _records(events_df, "earthquake-events", _text(k), value)


def kafka_logs(events_df: DataFrame) -> DataFrame:
    """Log-topic records; the level follows the event type and is absent for clicks."""
    value = f"""concat(
        '{{"timestamp":"', {_iso('seq')}, '+00:00","service":"realtime_producer","log_type":"FETCH_SUCCESS"',
        CASE WHEN seq % 50 = 3 THEN ',"level":"DEBUG"' WHEN event_type = 'error' THEN ',"level":"ERROR"'
            WHEN event_type = 'signup' THEN ',"level":"WARNING"'
            WHEN event_type = 'purchase' THEN ',"level":"CRITICAL"'
            WHEN event_type = 'view' THEN ',"level":"INFO"' ELSE '' END,
        ',"message":"Cycle: ', string(seq % 5), ' dikirim, ', string(user_id), ' dedup, total unique: ', string(seq),
        IF(seq % 7 = 0, ' (siklus panjang)', ''), '"}}')"""
    return _records(events_df, "system-logs", "CAST(NULL AS STRING)", value)


def _page_row() -> str:
    c, east = _latitude("seq"), "(9500 + seq * 53 % 9000)"
    return f"""concat('<tr class="r">\n<td>', string(seq % {ROWS_PER_PAGE} + 1),
        '</td><td>', IF(seq % 19 = 0, '', '01/06/2026'), '</td><td>12:00:00</td><td><b>',
        CASE WHEN seq % 23 = 0 THEN '2.5' WHEN seq % 29 = 0 THEN '1.2.3 LS'
            ELSE concat({_scaled(f"abs({c})", 2)}, IF({c} < 0, ' LS', ' LU')) END,
        '</b></td><td> ',
        IF({east} > 18000, concat({_scaled(f"36000 - {east}", 2)}, ' BB'), concat({_scaled(east, 2)}, ' BT')),
        ' </td>',
        IF(seq % 31 = 0, '', concat('<td>', {_depth('seq')}, ' km</td><td>',
            IF(seq % 37 = 0, '-', {_magnitude('seq')}), '</td>')),
        IF(seq % 5 = 0, '', '<td>Laut &amp; <i>Darat</i></td>'), '</tr>')"""


def quake_pages(events_df: DataFrame) -> DataFrame:
    """HTML pages of a bulletin, fifteen event rows each."""
    header = "".join(f"<td>{name}</td>" for name in (
        "NO", "TANGGAL", "WAKTU", "LINTANG", "BUJUR", "KEDALAMAN", "MAG", "WILAYAH"))
    rows = F.expr(f"array_sort(collect_list(struct(seq AS pos, {_page_row()} AS row))).row")
    return events_df.groupBy(F.expr(f"seq div {ROWS_PER_PAGE} + 1").alias("page_num")).agg(
        F.concat(F.lit(f"<table><tr>{header}</tr>"), F.array_join(rows, ""), F.lit("</table>")).alias("html"))


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given web pages, each with a bulletin table of up to three rows behind its own text."""
    pages = spark.read.schema("page_id bigint, html string").parquet(f"{sf_dir}/pages.parquet")
    return _dealt(pages.select(F.col("page_id").alias("page_num"), F.concat(
        "html", F.lit("<table>"), F.expr(f"repeat('{BULLETIN_ROW}', int(page_id % 4))"), F.lit("</table>")).alias("html")))
