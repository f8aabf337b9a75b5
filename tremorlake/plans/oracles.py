"""The registered queries in DuckDB's SQL, from the same tables and the same derivation rules."""

_CLOCK = "2026-06-01T00:00:00"
_FIRST_SECOND = 1780272000


def _day(minute: str) -> str:
    return f"(DATE '2026-06-01' + CAST(({minute}) // 1440 AS INTEGER))"


def _clock(minute: str) -> str:
    return f"printf('%02d:%02d:00', (({minute}) % 1440) // 60, ({minute}) % 60)"


def _iso(minute: str) -> str:
    return f"strftime({_day(minute)}, '%Y-%m-%d') || 'T' || {_clock(minute)}"


def _lat(n: str) -> str:
    return f"printf('%.2f', ((({n}) * 37) % 1700 - 1100) / 100.0)"


def _lon(n: str) -> str:
    return f"printf('%.2f', (9500 + (({n}) * 53) % 4600) / 100.0)"


def _mag(n: str) -> str:
    return f"printf('%.1f', (20 + (({n}) * 7) % 60) / 10.0)"


def _dep(n: str) -> str:
    return f"CAST(5 + (({n}) * 11) % 600 AS VARCHAR)"


def _quake(k: str) -> str:
    written = f"strftime({_day(k)}, '%d %b %Y')"
    return f"""('{{' || CASE ({k}) % 20
        WHEN 3 THEN '"DateTime":"' || {_iso(k)} || '"'
        WHEN 4 THEN '"DateTime":"' || {written} || ' ' || {_clock(k)} || ' WIB"'
        WHEN 5 THEN '"Tanggal":"' || {written} || '","Jam":"' || {_clock(k)} || ' WIB"'
        ELSE '"DateTime":"' || {_iso(k)} || '+00:00"' END
      || CASE ({k}) % 20
        WHEN 9 THEN ',"Coordinates":"abc,1"'
        WHEN 10 THEN ',"Coordinates":"' || {_lat(k)} || '"'
        WHEN 11 THEN ''
        ELSE ',"Coordinates":"' || {_lat(k)} || ',' || {_lon(k)} || '"' END
      || CASE WHEN ({k}) % 20 = 6 THEN ',"Magnitude":' || {_mag(k)}
        WHEN ({k}) % 3 = 0 THEN ',"Magnitude":"' || {_mag(k)} || ' SR"'
        ELSE ',"Magnitude":"' || {_mag(k)} || '"' END
      || CASE ({k}) % 20
        WHEN 7 THEN ',"Kedalaman":' || {_dep(k)} || '.7'
        WHEN 8 THEN ',"Kedalaman":"' || {_dep(k)} || '.5 km"'
        ELSE ',"Kedalaman":"' || {_dep(k)} || ' km"' END
      || CASE WHEN ({k}) % 20 = 12 THEN ',"Dirasakan":"II-III"'
        ELSE ',"Wilayah":"Pusat gempa","Dirasakan":""' END || '}}')"""


def _envelope(gempa: str) -> str:
    return f"""('{{"Infogempa":{{"gempa":' || {gempa} || '}}}}')"""


_RAW_QUAKES = f"payloads AS (SELECT event_id AS seq, {_envelope(_quake('event_id // 2'))} AS payload FROM events)"

_PAYLOAD_MIX = f"""payloads AS (SELECT event_id AS seq, CASE event_id % 10
    WHEN 0 THEN '{{bad' WHEN 1 THEN '{{}}'
    WHEN 2 THEN '{{"Infogempa":{{"gempa":[]}}}}' WHEN 3 THEN '{{"Infogempa":{{"gempa":null}}}}'
    WHEN 4 THEN {_envelope("'[' || " + _quake('event_id // 2') + " || ',' || " + _quake('event_id // 2 + 1') + " || ']'")}
    WHEN 5 THEN '{{"Infogempa":{{}}}}'
    WHEN 6 THEN CASE event_id % 50 WHEN 6 THEN '{{"Infogempa":{{"gempa":{{"a":1}}}}}},"x":1'
        WHEN 16 THEN '{{"Infogempa":{{"gempa":{{"a":1}}}}}},"end":true}} junk' WHEN 26 THEN '1,"x":2'
        WHEN 36 THEN '{{"Infogempa":{{"gempa":null}}}},"payload":{{"Infogempa":{{"gempa":[1]}}}}'
        ELSE {_envelope(_quake('event_id // 2'))} END
    ELSE {_envelope(_quake('event_id // 2'))} END AS payload FROM events)"""

#: From ``payloads``: outcome per payload, and ``raw_events``.
_UNWRAP = """
envelopes AS (SELECT seq, json_valid(payload) AS ok,
    CASE WHEN json_valid(payload) THEN json_extract(payload, '$.Infogempa.gempa') END AS g FROM payloads),
outcomes AS (SELECT seq, g, CASE WHEN NOT ok THEN 'API_ERROR' WHEN g IS NULL THEN 'NO_DATA'
    WHEN json_type(g) = 'NULL' THEN 'FETCH_FAILED'
    WHEN json_type(g) = 'ARRAY' AND json_array_length(g) = 0 THEN 'NO_DATA'
    ELSE 'FETCH_SUCCESS' END AS outcome FROM envelopes),
lists AS (SELECT seq, outcome, CASE WHEN json_type(g) = 'ARRAY' THEN g ELSE json_array(g) END AS items
    FROM outcomes WHERE outcome = 'FETCH_SUCCESS'),
positions AS (SELECT seq, outcome, items, unnest(range(CAST(json_array_length(items) AS BIGINT))) AS event_pos
    FROM lists),
raw_events AS (SELECT seq, outcome, CAST(event_pos AS INTEGER) AS event_pos,
    json_extract(items, '$[' || event_pos || ']') AS j FROM positions)"""

_FLOAT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)$"

#: From ``raw_events``: ``fields`` of every event and ``normalized`` ones.
_NORMALIZE = f"""
texts AS (SELECT seq, event_pos,
    coalesce(j ->> 'DateTime', coalesce(j ->> 'Tanggal', '') || ' ' || coalesce(j ->> 'Jam', '')) AS datetime,
    coalesce(j ->> 'DateTime', '') AS datetime_only,
    coalesce(j ->> 'Coordinates', '0,0') AS place,
    trim(replace(j ->> 'Magnitude', 'SR', '')) AS mag_text,
    json_type(j -> 'Kedalaman') AS depth_type,
    trim(replace(j ->> 'Kedalaman', 'km', '')) AS depth_text,
    coalesce(j ->> 'Wilayah', j ->> 'Dirasakan', 'Tidak diketahui') AS region,
    coalesce(j ->> 'Dirasakan', '') AS felt_intensity FROM raw_events),
cut AS (SELECT *, trim(split_part(place, ',', 1)) AS lat_text,
    CASE WHEN contains(place, ',') THEN trim(split_part(place, ',', 2)) ELSE '0' END AS lon_text FROM texts),
numbers AS (SELECT *,
    CASE WHEN regexp_matches(lat_text, '{_FLOAT}') THEN CAST(lat_text AS DOUBLE) END AS latitude,
    CASE WHEN regexp_matches(lon_text, '{_FLOAT}') THEN CAST(lon_text AS DOUBLE) END AS longitude,
    CASE WHEN regexp_matches(mag_text, '{_FLOAT}') THEN CAST(mag_text AS DOUBLE) END AS magnitude,
    CASE WHEN depth_type <> 'VARCHAR' THEN CAST(trunc(CAST(depth_text AS DOUBLE)) AS INTEGER)
        WHEN regexp_matches(depth_text, '^[+-]?\\d+$') THEN CAST(depth_text AS INTEGER) END AS depth FROM cut),
fields AS (SELECT *, (latitude IS NOT NULL AND longitude IS NOT NULL AND magnitude IS NOT NULL
    AND depth IS NOT NULL) AS valid FROM numbers),
normalized AS (SELECT seq, event_pos, md5(datetime || '_' || CAST(latitude AS VARCHAR) || '_' || CAST(longitude AS VARCHAR)
    || '_' || CAST(magnitude AS VARCHAR) || '_' || CAST(depth AS VARCHAR)) AS event_id,
    datetime, datetime_only, latitude, longitude, magnitude, depth, region, felt_intensity, '' AS shakemap,
    '' AS potensi, 'BMKG_REALTIME' AS source, '{_CLOCK}+00:00' AS ingested_at FROM fields WHERE valid)"""

_EVENTS = f"WITH {_RAW_QUAKES}, {_UNWRAP}, {_NORMALIZE}"
_MIX_EVENTS = f"WITH {_PAYLOAD_MIX}, {_UNWRAP}, {_NORMALIZE}"
_T1 = ("event_id, datetime, latitude, longitude, magnitude, depth, region, felt_intensity, shakemap, potensi, "
       "source, ingested_at")

_EVENT_TIME = """CASE
    WHEN datetime LIKE '%WIB' THEN strptime(replace(datetime, ' WIB', ''), '%d %b %Y %H:%M:%S') - INTERVAL 7 HOUR
    ELSE strptime(replace(datetime, '+00:00', ''), '%Y-%m-%dT%H:%M:%S') END"""

_WAREHOUSE = f"""{_EVENTS}, warehouse AS (SELECT event_id, {_EVENT_TIME} AS event_time, latitude, longitude,
    magnitude, depth, region, felt_intensity, source, ingested_at FROM normalized)"""


def _cycles(cycle: str) -> str:
    """From ``cycle_events(cycle, event_id)`` (id NULL for a rejected event): ``cycles``."""
    return f"""
cycle_events AS ({cycle}),
firsts AS (SELECT min(cycle) AS cycle FROM cycle_events WHERE event_id IS NOT NULL GROUP BY event_id),
sents AS (SELECT cycle, count(*) AS sent FROM firsts GROUP BY cycle),
counts AS (SELECT cycle, count(event_id) AS received FROM cycle_events GROUP BY cycle),
cycles AS (SELECT cycle, CAST(coalesce(sent, 0) AS BIGINT) AS sent,
    CAST(received - coalesce(sent, 0) AS BIGINT) AS skipped,
    CAST(sum(coalesce(sent, 0)) OVER (ORDER BY cycle) AS BIGINT) AS total_unique
    FROM counts LEFT JOIN sents USING (cycle))"""


_PAGE_ROWS = r"""
cells AS (SELECT event_id AS seq, event_id // 15 + 1 AS page_num, event_id % 15 AS pos,
    (event_id * 37) % 1700 - 1100 AS c, 9500 + (event_id * 53) % 9000 AS e FROM events),
page_rows AS (SELECT page_num, pos, '<tr class="r">' || chr(10) || '<td>' || (pos + 1) ||
    '</td><td>' || CASE WHEN seq % 19 = 0 THEN '' ELSE '01/06/2026' END || '</td><td>12:00:00</td><td><b>' ||
    CASE WHEN seq % 23 = 0 THEN '2.5' WHEN seq % 29 = 0 THEN '1.2.3 LS'
        ELSE printf('%.2f', abs(c) / 100.0) || CASE WHEN c < 0 THEN ' LS' ELSE ' LU' END END ||
    '</b></td><td> ' ||
    CASE WHEN e > 18000 THEN printf('%.2f', (36000 - e) / 100.0) || ' BB'
        ELSE printf('%.2f', e / 100.0) || ' BT' END || ' </td>' ||
    CASE WHEN seq % 31 = 0 THEN '' ELSE '<td>' || (5 + (seq * 11) % 600) || ' km</td><td>' ||
        CASE WHEN seq % 37 = 0 THEN '-' ELSE printf('%.1f', (20 + (seq * 7) % 60) / 10.0) END || '</td>' END ||
    CASE WHEN seq % 5 = 0 THEN '' ELSE '<td>Laut &amp; <i>Darat</i></td>' END || '</tr>' AS row_html FROM cells),
quake_pages AS (SELECT page_num, '<table><tr><td>NO</td><td>TANGGAL</td><td>WAKTU</td><td>LINTANG</td>' ||
    '<td>BUJUR</td><td>KEDALAMAN</td><td>MAG</td><td>WILAYAH</td></tr>' ||
    string_agg(row_html, '' ORDER BY pos) || '</table>' AS html FROM page_rows GROUP BY page_num)"""

#: From ``html_pages(page_num, html)``: ``trs``, ``data_rows`` and ``found`` records.
_EXTRACT = rf"""
tr_lists AS (SELECT page_num, regexp_extract_all(html, '(?s)<tr[^>]*>(.*?)</tr>', 1) AS rows_ FROM html_pages),
trs AS (SELECT page_num, CAST(unnest(range(len(rows_))) AS INTEGER) AS row_pos, unnest(rows_) AS tr FROM tr_lists),
tds AS (SELECT page_num, row_pos, regexp_extract_all(tr, '(?s)<td[^>]*>(.*?)</td>', 1) AS raw_cells FROM trs),
data_rows AS (SELECT * FROM (SELECT page_num, row_pos,
    list_transform(raw_cells, lambda x: regexp_replace(regexp_replace(x, '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g')) AS cells
    FROM tds WHERE len(raw_cells) >= 7) WHERE cells[1] NOT IN ('', 'NO')),
tokens AS (SELECT page_num, row_pos, cells,
    regexp_extract(cells[4], '^([\d.]+)\s+(LU|LS)', 1) AS lat, regexp_extract(cells[4], '^([\d.]+)\s+(LU|LS)', 2) AS ns,
    regexp_extract(cells[5], '^([\d.]+)\s+(BT|BB)', 1) AS lon, regexp_extract(cells[5], '^([\d.]+)\s+(BT|BB)', 2) AS ew,
    regexp_extract(cells[6], '([\d.]+)', 1) AS dep, regexp_extract(cells[7], '([\d.]+)', 1) AS mag FROM data_rows),
found AS (SELECT page_num, row_pos, cells[1] AS no, cells[2] AS tanggal, cells[3] AS waktu,
    try_cast(nullif(lat, '') AS DOUBLE) * CASE WHEN ns = 'LS' THEN -1 ELSE 1 END AS latitude,
    try_cast(nullif(lon, '') AS DOUBLE) * CASE WHEN ew = 'BB' THEN -1 ELSE 1 END AS longitude,
    try_cast(nullif(dep, '') AS DOUBLE) AS kedalaman_km, try_cast(nullif(mag, '') AS DOUBLE) AS magnitudo,
    CASE WHEN len(cells) > 7 THEN cells[8] ELSE 'pusat' END AS wilayah, 'berita_gempa' AS source,
    '{_CLOCK}' AS scraped_at FROM tokens
    WHERE (lat = '' OR try_cast(lat AS DOUBLE) IS NOT NULL) AND (lon = '' OR try_cast(lon AS DOUBLE) IS NOT NULL)
    AND (dep = '' OR try_cast(dep AS DOUBLE) IS NOT NULL) AND (mag = '' OR try_cast(mag AS DOUBLE) IS NOT NULL))"""

_QUAKE_PAGES = f"{_PAGE_ROWS}, html_pages AS (SELECT page_num, html FROM quake_pages)"
_BULLETIN = """html || '<table>' || repeat('<tr><td>1</td><td>01/06/2026</td><td>12:00:00</td><td>1.50 LS</td>' ||
    '<td>100.25 BT</td><td>10 km</td><td>5.0</td><td>Laut</td></tr>', page_id % 4) || '</table>'"""
_WEB_PAGES = f"html_pages AS (SELECT page_id AS page_num, {_BULLETIN} AS html FROM pages)"
_BOTH_PAGES = (f"{_PAGE_ROWS}, html_pages AS (SELECT page_num, html FROM quake_pages "
               f"UNION ALL SELECT page_id, {_BULLETIN} FROM pages)")
_RECORDS = f"WITH {_QUAKE_PAGES}, {_EXTRACT}"
_T4 = ("page_num, row_pos, no, tanggal, waktu, latitude, longitude, kedalaman_km, magnitudo, wilayah, source, "
       "scraped_at")
_COUNTS = """SELECT p.page_num, count(f.page_num) AS n_records FROM html_pages p
    LEFT JOIN found f USING (page_num) GROUP BY p.page_num"""

_K = "event_id // 2"
_KAFKA = f"""WITH records AS (SELECT event_id AS "offset", event_id // 2 AS k, event_id % 50 AS slot,
    'earthquake-events' AS topic, 0 AS partition_, CAST({_K} AS VARCHAR) AS key,
    {_iso('event_id')} || (['', '.041000', '.082000', '.123000'])[event_id % 4 + 1] AS record_time,
    CASE WHEN event_id % 50 IN (7, 17, 27) THEN 'bad' ELSE '' END AS state,
    md5(CAST({_K} AS VARCHAR)) AS event_id, {_iso(_K)} || '+00:00' AS datetime,
    CAST({_lat(_K)} AS DOUBLE) AS latitude, CAST({_lon(_K)} AS DOUBLE) AS longitude,
    CASE event_id % 50 WHEN 21 THEN 0.00001::DOUBLE WHEN 31 THEN 12345678.9::DOUBLE WHEN 41 THEN NULL
        ELSE CAST({_mag(_K)} AS DOUBLE) END AS magnitude,
    CASE event_id % 50 WHEN 41 THEN 'True' WHEN 21 THEN '1e-05' WHEN 31 THEN '12345678.9'
        ELSE CAST(CAST({_mag(_K)} AS DOUBLE) AS VARCHAR) END AS magnitude_text,
    {_dep(_K)} || CASE WHEN event_id % 50 = 13 THEN '.5' ELSE '' END AS depth,
    CASE WHEN event_id % 50 <> 11 THEN 'Pusat gempa di laut sebelah barat' END AS region,
    '' AS felt_intensity, 'BMKG_REALTIME' AS source, {_iso('event_id')} || '+00:00' AS ingested_at FROM events)"""

_T2_SELECT = f"""{_KAFKA} SELECT CASE WHEN slot IN (17, 27) THEN 'a' WHEN slot <> 7 THEN event_id END AS event_id,
    CASE WHEN state = '' THEN datetime END AS datetime, CASE WHEN state = '' THEN latitude END AS latitude,
    CASE WHEN state = '' THEN longitude END AS longitude, CASE WHEN state = '' THEN magnitude END AS magnitude,
    CASE WHEN state = '' AND slot <> 13 THEN CAST(depth AS INTEGER) END AS depth,
    CASE WHEN state = '' THEN region END AS region, CASE WHEN state = '' THEN felt_intensity END AS felt_intensity,
    CASE WHEN state = '' THEN source END AS source, CASE WHEN state = '' THEN ingested_at END AS ingested_at
    FROM records"""

_LOGS = f"""WITH logs AS (SELECT event_id AS "offset", 'system-logs' AS topic, 0 AS partition_,
    {_iso('event_id')} || '+00:00' AS "timestamp", 'realtime_producer' AS service, 'FETCH_SUCCESS' AS log_type,
    CASE WHEN event_id % 50 = 3 THEN 'DEBUG' WHEN event_type = 'error' THEN 'ERROR'
        WHEN event_type = 'signup' THEN 'WARNING' WHEN event_type = 'purchase' THEN 'CRITICAL'
        WHEN event_type = 'view' THEN 'INFO' END AS level,
    'Cycle: ' || (event_id % 5) || ' dikirim, ' || user_id || ' dedup, total unique: ' || event_id ||
        CASE WHEN event_id % 7 = 0 THEN ' (siklus panjang)' ELSE '' END AS message FROM events),
marked AS (SELECT *, coalesce(level, 'INFO') AS shown, CASE coalesce(level, 'INFO') WHEN 'WARNING' THEN '[!]'
    WHEN 'ERROR' THEN '[X]' WHEN 'CRITICAL' THEN '[!!]' ELSE '[i]' END AS icon FROM logs)"""

ORACLES = {
    "payload_unwrap": f"""WITH {_PAYLOAD_MIX}, {_UNWRAP} SELECT seq, outcome, event_pos, j ->> 'DateTime' AS datetime,
        j ->> 'Coordinates' AS coordinates, j ->> 'Magnitude' AS magnitude, j ->> 'Kedalaman' AS depth
        FROM raw_events""",
    "payload_outcome_logs": f"""{_MIX_EVENTS}, {_cycles('''
        SELECT o.seq AS cycle, n.event_id FROM outcomes o LEFT JOIN normalized n ON n.seq = o.seq''')},
        lines(outcome, log_type, level, message) AS (VALUES
            ('API_ERROR', 'API_ERROR', 'ERROR', 'Response JSON tidak valid'),
            ('API_ERROR', 'FETCH_FAILED', 'WARNING', 'Gagal ambil data BMKG'),
            ('FETCH_FAILED', 'FETCH_FAILED', 'WARNING', 'Gagal ambil data BMKG'),
            ('NO_DATA', 'NO_DATA', 'INFO', 'API tidak return data gempa'),
            ('FETCH_SUCCESS', 'FETCH_SUCCESS', 'INFO', NULL))
        SELECT cycle, '{_CLOCK}+00:00' AS "timestamp", 'realtime_producer' AS service, log_type, level,
            coalesce(message, 'Cycle: ' || sent || ' dikirim, ' || skipped || ' dedup, total unique: ' || total_unique)
            AS message
        FROM cycles JOIN outcomes ON outcomes.seq = cycles.cycle JOIN lines ON lines.outcome = outcomes.outcome""",
    "normalize_events": f"{_EVENTS} SELECT seq, {_T1} FROM normalized",
    "normalize_rejects": f"""{_EVENTS} SELECT f.seq, r.j ->> 'DateTime' AS datetime, r.j ->> 'Coordinates' AS coordinates,
        r.j ->> 'Kedalaman' AS depth FROM fields f JOIN raw_events r ON r.seq = f.seq WHERE NOT f.valid""",
    "normalize_time_id": f"""{_EVENTS} SELECT seq, 'BMKG_20260601000000_' || CAST(latitude AS VARCHAR) || '_' ||
        CAST(longitude AS VARCHAR) AS event_id, datetime_only AS datetime, latitude, longitude, magnitude, depth,
        region, felt_intensity, source, ingested_at FROM normalized""",
    "event_id_md5": f"""{_EVENTS} SELECT f.seq, n.event_id FROM fields f LEFT JOIN normalized n ON n.seq = f.seq""",
    "dedup_first_seen": f"""{_EVENTS} SELECT seq, {_T1} FROM (SELECT *, row_number() OVER (PARTITION BY event_id
        ORDER BY seq) AS arrival FROM normalized) WHERE arrival = 1""",
    "dedup_stream": f"{_EVENTS} SELECT DISTINCT event_id FROM normalized",
    "dedup_stream_batches": f"{_EVENTS} SELECT DISTINCT event_id FROM normalized",
    "send_once": f"""{_EVENTS}, sent AS (SELECT 'BMKG_20260601000000_' || CAST(latitude AS VARCHAR) || '_' ||
        CAST(longitude AS VARCHAR) AS key FROM normalized)
        SELECT key, count(*) AS n_records, (SELECT count(*) FROM sent) AS sent, (SELECT count(*) FROM raw_events) AS found
        FROM sent GROUP BY key""",
    "landing_payloads": f"""{_EVENTS} SELECT 'FETCH_SUCCESS' AS outcome, count(DISTINCT seq // 1000) AS n_files,
        count(*) AS n_raw FROM raw_events""",
    "monitor_streams": """SELECT 'event_view' AS name, 'earthquake-events' AS topic, count(*) AS n_rows FROM events
        WHERE event_id % 50 NOT IN (7, 17, 27) UNION ALL SELECT 'log_view', 'system-logs', count(*) FROM events""",
    "cycle_summary": f"""{_EVENTS}, {_cycles('''
        SELECT f.seq // 100 AS cycle, n.event_id FROM fields f LEFT JOIN normalized n ON n.seq = f.seq''')}
        SELECT cycle, sent, skipped, total_unique FROM cycles""",
    "kafka_decode": _T2_SELECT,
    "kafka_encode": f"""{_EVENTS} SELECT event_id AS key, '{{"event_id":"' || event_id || '","datetime":"' || datetime ||
        '","latitude":' || CAST(latitude AS VARCHAR) || ',"longitude":' || CAST(longitude AS VARCHAR) ||
        ',"magnitude":' || CAST(magnitude AS VARCHAR) || ',"depth":' || depth || ',"region":"' || region ||
        '","felt_intensity":"' || felt_intensity || '","shakemap":"","potensi":"","source":"' || source ||
        '","ingested_at":"' || ingested_at || '"}}' AS value FROM normalized""",
    "kafka_malformed": """SELECT event_id AS "offset", CASE event_id % 50 WHEN 7 THEN '{bad'
        WHEN 17 THEN '{"event_id":"a"},"x":1' ELSE '{"event_id":"a"},"end":true} junk' END AS value
        FROM events WHERE event_id % 50 IN (7, 17, 27)""",
    "stream_to_parquet": _T2_SELECT,
    "load_event_time": f"{_WAREHOUSE} SELECT * FROM warehouse",
    "load_sample": f"""{_EVENTS} SELECT event_id, datetime, magnitude, latitude, longitude, source FROM normalized
        ORDER BY event_id, datetime LIMIT 5""",
    "load_counts": f"""{_EVENTS} SELECT 'written' AS counted, count(*) AS n_rows FROM normalized
        UNION ALL SELECT 'table', count(*) FROM normalized UNION ALL SELECT 'newest', least(5, count(*)) FROM normalized
        UNION ALL SELECT 'nothing landed', 0""",
    "load_newest_5": f"""{_WAREHOUSE} SELECT event_id, event_time, magnitude, region, source FROM warehouse
        ORDER BY event_time DESC NULLS LAST, event_id LIMIT 5""",
    "html_rows": f"{_RECORDS} SELECT page_num, row_pos, CAST(len(raw_cells) AS INTEGER) AS n_cells FROM tds",
    "html_cells": f"{_RECORDS} SELECT page_num, row_pos, array_to_string(cells, '|') AS cells FROM data_rows",
    "html_records": f"{_RECORDS} SELECT {_T4} FROM found",
    "html_union_totals": f"""WITH {_BOTH_PAGES}, {_EXTRACT}
        SELECT count(DISTINCT page_num) AS pages, count(*) AS records FROM found""",
    "html_page_counts": f"{_RECORDS} {_COUNTS}",
    "html_wanted_page_counts": f"""{_RECORDS} SELECT w.page_id AS page_num, count(f.page_num) AS n_records
        FROM pages w LEFT JOIN found f ON f.page_num = w.page_id GROUP BY w.page_id""",
    "html_web_page_counts": f"WITH {_WEB_PAGES}, {_EXTRACT} {_COUNTS}",
    "html_head_3": f"""{_RECORDS} SELECT no, tanggal, waktu, latitude, longitude, magnitudo, kedalaman_km, wilayah
        FROM found ORDER BY page_num, row_pos LIMIT 3""",
    "archive_html_roundtrip": f"""WITH {_QUAKE_PAGES} SELECT page_num, CAST(length(html) AS INTEGER) AS n_chars,
        md5(html) AS digest FROM html_pages""",
    "archive_csv_roundtrip": f"""{_RECORDS} SELECT {_T4}, part FROM found
        CROSS JOIN (VALUES ('per page'), ('combined')) AS parts(part)""",
    "monitor_events": f"""{_KAFKA} SELECT topic, partition_ AS "partition", "offset", key, record_time, event_id, datetime,
        magnitude_text AS magnitude, CAST(latitude AS VARCHAR) || ', ' || CAST(longitude AS VARCHAR) AS location,
        depth || ' km' AS depth, coalesce(region, 'N/A') AS region, felt_intensity, source, ingested_at,
        'Processed earthquake | id=' || left(event_id, 8) || '... | mag=' || magnitude_text ||
        ' | lat=' || CAST(latitude AS VARCHAR) || ' lon=' || CAST(longitude AS VARCHAR) || ' | depth=' || depth ||
        'km | region=' || left(coalesce(region, 'N/A'), 30) || ' | offset=' || "offset" AS summary
        FROM records WHERE state = ''""",
    "monitor_events_brief": f"""{_KAFKA} SELECT topic, partition_ AS "partition", "offset", key, event_id, datetime,
        magnitude_text AS magnitude, CAST(latitude AS VARCHAR) || ', ' || CAST(longitude AS VARCHAR) AS location,
        region FROM records WHERE state = ''""",
    "monitor_logs": f"""{_LOGS} SELECT topic, partition_ AS "partition", "offset", shown AS level, icon,
        '[' || icon || ' SYSTEM LOG - ' || shown || ']' AS title, "timestamp", service, log_type, message,
        'Processed log | level=' || shown || ' | service=' || service || ' | type=' || log_type || ' | msg=' ||
        left(message, 50) || ' | offset=' || "offset" AS summary FROM marked""",
    "monitor_logs_brief": f"""{_LOGS} SELECT topic, "offset", level, service, message FROM logs""",
    "monitor_counts": """SELECT 'earthquake-events' AS topic, count(*) AS n_processed FROM events
        WHERE event_id % 50 NOT IN (7, 17, 27)
        UNION ALL SELECT 'system-logs', count(*) FROM events""",
}
# The streaming ingest writes the lines that the batch query makes.
ORACLES["ingest_logs_stream"] = ORACLES["payload_outcome_logs"]
ORACLES["recovered_landing"] = _T2_SELECT
ORACLES["landing_fan_out"] = f"SELECT t.*, sink FROM ({_T2_SELECT}) t CROSS JOIN (VALUES ('landing'), ('view')) AS s(sink)"
ORACLES["processed_counts_stream"] = ORACLES["monitor_counts"]
ORACLES["load_twice"] = ORACLES["load_event_time"]
ORACLES["load_original_time"] = f"""{_EVENTS} SELECT event_id, datetime AS original_datetime, {_EVENT_TIME} AS event_time,
    ingested_at FROM normalized"""
ORACLES["archive_html_range"] = ORACLES["archive_html_roundtrip"] + " WHERE page_num BETWEEN 31 AND 238"
ORACLES["archive_newest_run"] = f"""{_RECORDS} SELECT * REPLACE (
    CASE WHEN page_num % 3 = 0 THEN '2026-06-02T00:00:00' ELSE scraped_at END AS scraped_at),
    CASE WHEN page_num % 3 = 0 THEN '20260602_000000' ELSE '20260601_000000' END AS run
    FROM (SELECT {_T4} FROM found) WHERE page_num % 6 <> 0"""
ORACLES["ingest_rejects_stream"] = f"""{_MIX_EVENTS} SELECT f.seq, f.event_pos, 'EVENT' AS reason, r.j ->> 'DateTime' AS datetime,
    r.j ->> 'Coordinates' AS coordinates, r.j ->> 'Kedalaman' AS depth, NULL AS payload
    FROM fields f JOIN raw_events r ON r.seq = f.seq AND r.event_pos = f.event_pos WHERE NOT f.valid
    UNION ALL SELECT o.seq, NULL, outcome, NULL, NULL, NULL, p.payload FROM outcomes o JOIN payloads p ON p.seq = o.seq WHERE outcome = 'API_ERROR'"""
ORACLES["load_newest_zones"] = ORACLES["load_newest_5"]
ORACLES["landed_summary"] = f"{_EVENTS} SELECT count(*) AS n_rows, min(magnitude) AS least, max(magnitude) AS largest FROM normalized"
ORACLES["kafka_log_records"] = f"""SELECT '{{"timestamp":"' || "timestamp" || '","service":"' || service || '","log_type":"' || log_type ||
    '","level":"' || level || '","message":"' || message || '"}}' AS value FROM ({ORACLES["payload_outcome_logs"]})"""
