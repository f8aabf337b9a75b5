"""Archive of a page extraction: raw HTML, records per page and all records combined."""

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tremorlake import schemas, storage
from tremorlake.operators import html_table
from tremorlake.sources import landing

#: Consecutive pages in one folder of an archive.
PAGES_PER_FOLDER = 10_000
#: A range of more folders than these is found by listing the archive.
FOLDERS_ASKED = 1000

_CSV = {"header": "true", "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false"}
_CSV_SCHEMA = "page_num bigint, row_pos int, " + ", ".join(
    f"{f.name} {f.dataType.simpleString()}" for f in schemas.HISTORICAL.fields)


def _in_folders(df: DataFrame, pages_per_folder: int) -> DataFrame:
    """Add the folder. Folders of many pages are gathered, or every task would write a file to each.

    The rebalance leaves sizes to adaptive execution, which splits a folder that is too large.
    """
    foldered = df.withColumn("folder", F.floor(F.col("page_num") / pages_per_folder))
    return foldered if pages_per_folder == 1 else foldered.hint("rebalance", "folder")


def archive_html(pages: DataFrame, root: str, pages_per_folder: int = PAGES_PER_FOLDER) -> None:
    """Raw HTML as a table in folders of consecutive pages, named by the first and last page; empty bodies are skipped.

    Folders written again are replaced, others stay. An archive that is not there yet is written beside its place and
    named in one step, as replacing costs the driver several steps for each folder. The widths of an archive's folders are noted, for :func:`read_html`; those of an
    archive that was begun without notes are not.
    """
    spark, place, widths = pages.sparkSession, f"{root}/raw_html", f"{root}/raw_html_widths"
    fresh = not storage.exists(spark, place)
    if fresh or storage.exists(spark, widths):
        storage.mark(spark, f"{widths}/{pages_per_folder}")
    first = F.col("page_num") - F.pmod("page_num", F.lit(pages_per_folder))
    foldered = pages.filter(F.length("html") > 0).withColumns(
        {"first_page": first, "last_page": first + (pages_per_folder - 1)})
    gathered = foldered if pages_per_folder == 1 else foldered.hint("rebalance", "first_page")

    def write(mode: str, path: str) -> None:
        gathered.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("first_page", "last_page").parquet(path)

    if fresh:
        staged = f"{place}_staged-{uuid.uuid4().hex}"
        try:
            write("static", staged)
            if storage.move(spark, staged, place):
                return
        finally:
            storage.remove(spark, staged)
    write("dynamic", place)


def _folders_of(spark: SparkSession, root: str, first: int | None, last: int | None) -> list[str] | None:
    """The folders that can hold a range of pages, by their names; None where the archive has to be listed."""
    widths = [int(name) for name in storage.children(spark, f"{root}/raw_html_widths")]
    if first is None or last is None or not widths or sum((last - first) // w + 2 for w in widths) > FOLDERS_ASKED:
        return None
    named = [f"{root}/raw_html/first_page={at}/last_page={at + w - 1}" for w in widths for at in range(first - first % w, last + 1, w)]
    return [path for path in named if storage.exists(spark, path)]


def read_html(spark: SparkSession, root: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Archived pages, all or those of a range, such as ``*HISTORICAL_PAGES``; folders outside the range aren't opened.

    The folders of a closed range of moderate length are asked for by name; for any other, or where none is there, the whole archive is listed.
    """
    paths = _folders_of(spark, root, first, last)
    found = spark.read.schema("page_num bigint, html string, first_page bigint, last_page bigint").option(
        "basePath", f"{root}/raw_html").parquet(*(paths or [f"{root}/raw_html"]))
    if first is not None:
        found = found.filter(F.col("last_page") >= first)
    if last is not None:
        found = found.filter(F.col("first_page") <= last)
    return landing.in_range(found, first, last).select("page_num", "html")


def archive_records(pages: DataFrame, root: str, run: datetime,
                    pages_per_folder: int = PAGES_PER_FOLDER) -> dict[str, int]:
    """Records as CSV, per page and combined under the run's time; returns pages and records.

    Nothing is written when there are no records. Records are extracted once, for the combined table; the
    folders of consecutive pages and the counts are made from that table. With one page per folder every page is
    a folder of its own, all of which the driver lists.
    """
    rows = html_table.records(pages, clock=run)
    if rows.isEmpty():
        return {"pages": 0, "records": 0}
    combined = f"{root}/combined/all_pages_combined_{run.strftime('%Y%m%d_%H%M%S')}"
    rows.write.mode("errorifexists").options(**_CSV).csv(combined)
    written = read_records(rows.sparkSession, combined)
    (
        _in_folders(written, pages_per_folder).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("folder").options(**_CSV).csv(f"{root}/raw_csv")
    )
    return html_table.count_totals(
        written.groupBy("page_num").agg(F.count("*").alias("n_records"))).first().asDict()


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records from a CSV folder written above. Text fields are never NULL there, so an empty one is the empty text."""
    read = spark.read.schema(_CSV_SCHEMA).options(**_CSV, multiLine="true").csv(folder)
    return read.select("page_num", "row_pos", *[
        F.coalesce(f.name, F.lit("")).alias(f.name) if f.dataType == T.StringType() else F.col(f.name)
        for f in schemas.HISTORICAL.fields])


def _stamp(run: datetime) -> str:
    return run.strftime("%Y%m%d_%H%M%S")


def write_run(pages: DataFrame, root: str, run: datetime) -> None:
    """The pages a run saw, with their number of records, and the records; nobody reads them before :func:`publish`.

    A run written again is replaced.
    """
    stamp = _stamp(run)
    html_table.records(pages, clock=run).write.mode("overwrite").parquet(f"{root}/run_records/run={stamp}")
    found = pages.sparkSession.read.parquet(f"{root}/run_records/run={stamp}").groupBy("page_num").agg(
        F.count("*").alias("n_records"))
    pages.select("page_num").distinct().join(found, "page_num", "left").select(
        "page_num", F.coalesce("n_records", F.lit(0).cast("bigint")).alias("n_records")).write.mode("overwrite").parquet(
        f"{root}/run_pages/run={stamp}")


def publish(spark: SparkSession, root: str, run: datetime) -> None:
    """Make a run that was written in full visible, by one new file."""
    spark.createDataFrame([(_stamp(run),)], "run string").coalesce(1).write.mode("append").parquet(f"{root}/published")


def newest_records(spark: SparkSession, root: str) -> DataFrame:
    """Of each page the records of the newest published run that saw it; none if that run found none on it."""
    published = spark.read.schema("run string").parquet(f"{root}/published").distinct()
    seen = spark.read.schema("page_num bigint, n_records bigint, run string").parquet(f"{root}/run_pages").join(published, "run")
    newest = seen.groupBy("page_num").agg(F.max("run").alias("run"))
    schema = "page_num bigint, row_pos int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.HISTORICAL.fields)
    records = spark.read.schema(f"{schema}, run string").parquet(f"{root}/run_records")
    return records.join(newest, ["page_num", "run"]).select("page_num", "row_pos", *schemas.HISTORICAL.fieldNames(), "run")
