from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tremorlake import jobs, schemas
from tremorlake.operators import html_table
from tremorlake.sinks import pages as page_sink
from tremorlake.sources import landing

CLOCK = datetime(2026, 6, 1, 1, 2, 3)
PLAIN = ["1", "01/06/2026", "12:00:00", "8.12 LS", "107.89 BT", "10 km", "5.1", "Laut"]


def tr(*cells, tag="tr", attributes=""):
    return f"<{tag}{attributes}>" + "".join(f"<td>{c}</td>" for c in cells) + f"</{tag}>"


def changed(**by_position):
    cells = list(PLAIN)
    for position, text in by_position.items():
        cells[int(position[1:])] = text
    return cells


def page_frame(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls, 1)), "page_num bigint, html string")


def extract(spark, *rows):
    found = html_table.records(page_frame(spark, "<table>" + "".join(rows) + "</table>"), clock=CLOCK)
    return {r.row_pos: r for r in found.collect()}


def test_full_record(spark):
    row = extract(spark, tr(*PLAIN))[0].asDict()
    assert list(row) == ["page_num", "row_pos"] + schemas.HISTORICAL.fieldNames()
    assert list(row.values())[2:] == ["1", "01/06/2026", "12:00:00", -8.12, 107.89, 10.0, 5.1, "Laut",
                                      "berita_gempa", "2026-06-01T01:02:03"]


ROWS = [
    (tr(*PLAIN), True),
    (tr(*PLAIN[:7]), True),
    (tr(*PLAIN[:6]), False),
    (tr(*PLAIN, "ninth"), True),
    (tr(*PLAIN, attributes=' class="r" id=1'), True),
    (tr(*PLAIN, tag="TR"), False),
    (tr(*PLAIN).replace("td>", "TD>"), False),
    (tr(*PLAIN).replace("<td>8.12", "<td>\n8.12\n"), True),
    ("<tr\n>" + tr(*PLAIN)[4:], True),
    (tr(*changed(c0="NO")), False),
    (tr(*changed(c0="")), False),
    (tr(*changed(c0=" <b> </b> ")), False),
    (tr(*changed(c0="no")), True),
    (tr(*changed(c0="<b>7</b>")), True),
    (tr(*changed(c0="&nbsp;")), True),
    (tr(*changed(c3="1.2.3 LS")), False),
    (tr(*changed(c3=". LU")), False),
    (tr(*changed(c4="1.2.3 BT")), False),
    (tr(*changed(c5="1.2.3")), False),
    (tr(*changed(c6="..")), False),
    (tr(*changed(c3="LS 1.2.3")), True),
]


def test_which_rows_become_records(spark):
    found = extract(spark, *[row for row, _ in ROWS])
    # Rows in capitals are no rows at all, so positions count the others.
    lower = [kept for row, kept in ROWS if "<TR" not in row]
    assert sorted(found) == [i for i, kept in enumerate(lower) if kept]


CELLS = [
    (dict(c3="8.12 LS"), "latitude", -8.12), (dict(c3="2.5 LU"), "latitude", 2.5),
    (dict(c3="2.5  LU"), "latitude", 2.5), (dict(c3="2.5LU"), "latitude", None), (dict(c3="2.5"), "latitude", None),
    (dict(c3=""), "latitude", None), (dict(c3="x 2.5 LU"), "latitude", None), (dict(c3="-2.5 LU"), "latitude", None),
    (dict(c3="<b>8.12</b> LSx"), "latitude", -8.12), (dict(c3="0 LS"), "latitude", 0.0),
    (dict(c4="96.13 BT"), "longitude", 96.13), (dict(c4=" 107.89 BB "), "longitude", -107.89),
    (dict(c4="107.89 bb"), "longitude", None),
    (dict(c5="10 km"), "kedalaman_km", 10.0), (dict(c5="-10 km"), "kedalaman_km", 10.0),
    (dict(c5="km 7. or 8"), "kedalaman_km", 7.0), (dict(c5="deep"), "kedalaman_km", None),
    (dict(c6="± 5.1"), "magnitudo", 5.1), (dict(c6="-"), "magnitudo", None), (dict(c6=".5 SR"), "magnitudo", 0.5),
    (dict(c7=""), "wilayah", ""), (dict(c7="Laut &amp; <i>Darat</i>\n"), "wilayah", "Laut &amp; Darat"),
    (dict(c1=" 1/6 "), "tanggal", "1/6"), (dict(c2="<i></i>"), "waktu", ""),
]


def test_cell_values(spark):
    found = extract(spark, *[tr(*changed(**change)) for change, _, _ in CELLS])
    assert [(name, found[i][name]) for i, (_, name, _) in enumerate(CELLS)] == [(n, v) for _, n, v in CELLS]


def test_region_default(spark):
    assert extract(spark, tr(*PLAIN[:7]))[0].wilayah == "pusat"


@pytest.fixture(scope="module")
def some_pages(spark):
    return page_frame(spark, "<table>" + tr(*PLAIN) + tr(*changed(c0="2")) + "</table>", "no table", "", None,
                      tr(*changed(c7='say "hi",\nall')))


def test_totals_and_counts(spark, some_pages):
    assert html_table.totals(some_pages).first().asDict() == {"pages": 2, "records": 3}
    counts = {r.page_num: r.n_records for r in html_table.page_counts(some_pages).collect()}
    assert counts == {1: 2, 2: 0, 3: 0, 4: 0, 5: 1}
    wanted = spark.range(1, 8).withColumnRenamed("id", "page_num")
    counts = {r.page_num: r.n_records for r in html_table.page_counts(some_pages, wanted=wanted).collect()}
    assert counts == {1: 2, 2: 0, 3: 0, 4: 0, 5: 1, 6: 0, 7: 0}
    empty = html_table.totals(some_pages.filter("page_num = 2")).first().asDict()
    assert empty == {"pages": 0, "records": 0}


def test_head_and_union(spark, some_pages):
    found = html_table.records(some_pages, clock=CLOCK)
    assert [r.no for r in html_table.head(found).collect()] == ["1", "2", "1"]
    assert html_table.head(found.drop("wilayah")).columns == list(html_table.SAMPLE_COLUMNS)[:-1]
    assert html_table.union_runs(found, found, found).count() == 9


def test_extraction_needs_no_shuffle(some_pages):
    plan = html_table.records(some_pages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # The costly extraction stands once in the plan, not again in a filter pushed below it.
    assert plan.count("regexp_extract_all(html") == 1


def test_archive(spark, some_pages, tmp_path):
    root = str(tmp_path / "archive")
    assert jobs.extract_history(some_pages, root, CLOCK, 1) == {"pages": 2, "records": 3}
    assert {r.page_num for r in page_sink.read_html(spark, root).collect()} == {1, 2, 5}
    assert sorted(p.name for p in (tmp_path / "archive/raw_csv").glob("folder=*")) == ["folder=1", "folder=5"]
    assert len(list((tmp_path / "archive/raw_csv/folder=1").glob("part-*.csv"))) == 1
    expected = sorted(map(tuple, html_table.records(some_pages, clock=CLOCK).collect()))
    for folder in ("raw_csv", "combined/all_pages_combined_20260601_010203"):
        assert sorted(map(tuple, page_sink.read_records(spark, f"{root}/{folder}").collect())) == expected
    # A later run over one page replaces that page only.
    later = datetime(2026, 6, 2)
    again = some_pages.filter("page_num = 5")
    assert page_sink.archive_records(again, root, later, 1) == {"pages": 1, "records": 1}
    stamps = {r.page_num: r.scraped_at for r in page_sink.read_records(spark, f"{root}/raw_csv").collect()}
    assert stamps == {1: "2026-06-01T01:02:03", 5: "2026-06-02T00:00:00"}


def test_archive_of_nothing_writes_nothing(spark, tmp_path):
    root = str(tmp_path / "archive")
    assert page_sink.archive_records(page_frame(spark, "no table"), root, CLOCK) == {"pages": 0, "records": 0}
    assert not (tmp_path / "archive").exists()


def test_landed_pages_in_range(spark, tmp_path):
    for number in (0, 1, 7, 238, 239):
        (tmp_path / f"page_{number:04d}.html").write_text(f"line {number}\nnext\n")
    (tmp_path / "index.html").write_text("other")
    (tmp_path / "page_0300.html").mkdir()
    (tmp_path / "page_0300.html" / "part-0.txt").write_text("line 300\nnext\n")
    assert {r.page_num for r in landing.pages(spark, f"{tmp_path}/*").collect()} == {0, 1, 7, 238, 239, 300}
    found = landing.pages(spark, str(tmp_path), *landing.HISTORICAL_PAGES)
    assert {r.page_num: r.html for r in found.collect()} == {
        n: f"line {n}\nnext\n" for n in (1, 7, 238)}
    assert landing.pages(spark, str(tmp_path)).count() == 5  # page 239 is read
    assert landing.in_range(found, 7, 100).select("page_num").collect()[0].page_num == 7


def test_empty_cells_come_back(spark, tmp_path):
    cells = "".join(f"<td>{c}</td>" for c in ("1", "", "", "1.0 LS", "2.0 BT", "x", "", ""))
    pages = page_frame(spark, f"<table><tr>{cells}</tr></table>")
    page_sink.archive_records(pages, str(tmp_path / "a"), CLOCK)
    row = page_sink.read_records(spark, str(tmp_path / "a/raw_csv")).first()
    assert (row.tanggal, row.waktu, row.wilayah, row.magnitudo) == ("", "", "", None)
    assert row == html_table.records(pages, clock=CLOCK).first()


def test_ranges(spark):
    numbers = spark.range(0, 500).select(F.col("id").alias("page_num"))
    assert landing.in_range(numbers).count() == 500
    bounds = landing.in_range(numbers, *landing.HISTORICAL_PAGES).agg(F.min("page_num"), F.max("page_num"), F.count("*")).first()
    assert tuple(bounds) == (1, 238, 238)
