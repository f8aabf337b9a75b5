"""Landing folders: feed payloads and HTML pages, one document per file."""

from pyspark.sql import DataFrame, SparkSession, functions as F

# The pages the historical bulletin once had, and the name of a page's file (or of a folder Spark wrote it to).
HISTORICAL_PAGES = (1, 238)
PAGE_FILE = r"page_(\d+)\.html(?:/[^/]*)?$"

#: Files of any age are taken up; Spark's own default leaves out those a week older than the newest.
MAX_FILE_AGE = "36500d"

_ARRIVAL = "_metadata.file_modification_time"


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payload text of every file with its arrival time."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("payload"), F.col(_ARRIVAL).alias("arrived_at"))


def payload_stream(spark: SparkSession, path: str, max_files: int | None = None,
                   max_file_age: str = MAX_FILE_AGE, archive: str | None = None) -> DataFrame:
    """New payload files as they land, however old.

    With ``archive`` finished files are moved there, so the folder the driver lists stays short.
    """
    reader = spark.readStream.format("text").option("wholetext", True).option("maxFileAge", max_file_age)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path).select(F.col("value").alias("payload"), F.col(_ARRIVAL).alias("arrived_at"))


def pages(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """HTML pages by page number; a bound of None leaves that end open."""
    number = F.regexp_extract(F.col("_metadata.file_path"), PAGE_FILE, 1)
    found = spark.read.text(path, wholetext=True).select(
        number.try_cast("bigint").alias("page_num"), F.col("value").alias("html"))
    return in_range(found.filter(F.col("page_num").isNotNull()), first, last)


def in_range(found: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Pages whose number lies in the range, such as ``*HISTORICAL_PAGES``."""
    if first is not None:
        found = found.filter(F.col("page_num") >= first)
    if last is not None:
        found = found.filter(F.col("page_num") <= last)
    return found
