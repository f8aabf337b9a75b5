"""Historical records from the tables of HTML pages."""

from pyspark.sql import Column, DataFrame, functions as F

from tremorlake.functions import clock as clocks
from tremorlake.functions.clock import Clock
from tremorlake.functions.filters import keep_where
from tremorlake.functions.text import WHITESPACE_CLASS, strip

# Table markup, row shape and wording of the bulletin pages.
ROW = r"(?s)<tr[^>]*>(.*?)</tr>"
CELL = r"(?s)<td[^>]*>(.*?)</td>"
TAG = r"<[^>]+>"
MIN_CELLS = 7
HEADER_CELLS = ("", "NO")
DEFAULT_REGION = "pusat"
SOURCE = "berita_gempa"
NUMBER = r"([\d.]+)"
COORDINATE = rf"^{NUMBER}{WHITESPACE_CLASS}+"
LATITUDE_SIDES, LONGITUDE_SIDES = "(LU|LS)", "(BT|BB)"
SOUTH, WEST = "LS", "BB"
#: Columns of the printed sample.
SAMPLE_COLUMNS = ("no", "tanggal", "waktu", "latitude", "longitude", "magnitudo", "kedalaman_km", "wilayah")


def _rows(pages: DataFrame, html: str) -> DataFrame:
    """One row per table row with its raw cells; a page without rows stays as one row of NULL position.

    All rows of a page stay in the task that reads the page.
    """
    keep = [c for c in pages.columns if c != html]
    rows = F.regexp_extract_all(F.col(html), F.lit(ROW), F.lit(1))
    return (
        pages.select(*keep, F.posexplode_outer(rows).alias("row_pos", "_row"))
        .select(*keep, "row_pos", F.regexp_extract_all("_row", F.lit(CELL), F.lit(1)).alias("_raw"))
    )


def _clean(cell: Column) -> Column:
    return strip(F.when(cell.contains("<"), F.regexp_replace(cell, TAG, "")).otherwise(cell))


def _is_data(n_cells: Column, first: Column) -> Column:
    return F.coalesce((n_cells >= MIN_CELLS) & ~first.isin(*HEADER_CELLS), F.lit(False))


#: Position of each cell a record is read from.
_CELLS = {"no": 0, "tanggal": 1, "waktu": 2, "lat_cell": 3, "lon_cell": 4, "depth_cell": 5, "mag_cell": 6,
          "region_cell": 7}
#: Number token of each measured field.
_TOKENS = {"lat": "latitude", "lon": "longitude", "depth": "kedalaman_km", "mag": "magnitudo"}


def _is_negative(cell: str, direction: str) -> Column:
    return F.col(cell).rlike(COORDINATE + direction)


def _read_rows(pages: DataFrame, html: str) -> DataFrame:
    """Record fields of every table row plus ``is_record``, false for rows that are none."""
    keep = [c for c in pages.columns if c != html] + ["row_pos"]
    cells = _rows(pages, html).select(
        *keep, F.size("_raw").alias("n_cells"),
        *[_clean(F.get("_raw", F.lit(i))).alias(name) for name, i in _CELLS.items()])
    tokens = cells.select(
        *keep, "no", "tanggal", "waktu", "lat_cell", "lon_cell",
        _is_data(F.col("n_cells"), F.col("no")).alias("is_data"),
        F.when(F.col("n_cells") > MIN_CELLS, F.col("region_cell")).otherwise(F.lit(DEFAULT_REGION)).alias("wilayah"),
        F.regexp_extract("lat_cell", COORDINATE + LATITUDE_SIDES, 1).alias("lat"),
        F.regexp_extract("lon_cell", COORDINATE + LONGITUDE_SIDES, 1).alias("lon"),
        F.regexp_extract("depth_cell", NUMBER, 1).alias("depth"),
        F.regexp_extract("mag_cell", NUMBER, 1).alias("mag"))
    # No token at all ('') leaves the field NULL; a token that is no number spoils the row.
    values = tokens.withColumns(
        {name: F.when(F.col(token) != "", F.col(token).try_cast("double")) for token, name in _TOKENS.items()})
    sound = F.col("is_data")
    for token, name in _TOKENS.items():
        sound = sound & ((F.col(token) == "") | F.col(name).isNotNull())
    signed = {
        "latitude": F.when(_is_negative("lat_cell", SOUTH), -F.col("latitude")).otherwise(F.col("latitude")),
        "longitude": F.when(_is_negative("lon_cell", WEST), -F.col("longitude")).otherwise(F.col("longitude")),
    }
    return values.withColumn("is_record", F.coalesce(sound, F.lit(False))).withColumns(signed)


def table_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every table row of every page with its raw cell count."""
    keep = [c for c in pages.columns if c != html]
    return _rows(pages, html).filter(F.col("row_pos").isNotNull()).select(
        *keep, "row_pos", F.size("_raw").alias("n_cells"))


def table_cells(pages: DataFrame, html: str = "html") -> DataFrame:
    """Cleaned cells of the data rows."""
    cells = _rows(pages, html).withColumn("cells", F.transform("_raw", _clean)).drop("_raw")
    return keep_where(cells, _is_data(F.size("cells"), F.get("cells", F.lit(0))))


def records(pages: DataFrame, html: str = "html", clock: Clock = None) -> DataFrame:
    """Historical records; ``row_pos`` orders them within their page."""
    keep = [c for c in pages.columns if c != html]
    return keep_where(_read_rows(pages, html), F.col("is_record")).select(
        *keep, "row_pos", "no", "tanggal", "waktu", "latitude", "longitude", "kedalaman_km", "magnitudo", "wilayah",
        F.lit(SOURCE).alias("source"), clocks.naive_iso(clock).alias("scraped_at"))


def page_counts(pages: DataFrame, html: str = "html", page: str = "page_num",
                wanted: DataFrame | None = None) -> DataFrame:
    """Records per page, zero included; ``wanted`` (page numbers) adds the pages that never arrived."""
    counts = _read_rows(pages, html).groupBy(page).agg(F.count_if("is_record").alias("n_records"))
    if wanted is None:
        return counts
    return wanted.select(page).join(counts, page, "left").select(
        page, F.coalesce("n_records", F.lit(0)).alias("n_records"))


def totals(pages: DataFrame, html: str = "html", page: str = "page_num") -> DataFrame:
    """One row: pages with at least one record, and records."""
    return count_totals(page_counts(pages, html, page))


def count_totals(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count_if(F.col("n_records") > 0).alias("pages"),
                      F.coalesce(F.sum("n_records"), F.lit(0)).alias("records"))


def union_runs(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Records of several extraction runs as one bag."""
    for other in others:
        first = first.unionByName(other)
    return first


def head(found: DataFrame, n: int = 3, page: str = "page_num") -> DataFrame:
    """First ``n`` records in page order, in the sample columns that exist."""
    return found.orderBy(page, "row_pos").limit(n).select(
        *[c for c in SAMPLE_COLUMNS if c in found.columns])
