"""The landed event table."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tremorlake import schemas
from tremorlake.sources.landing import MAX_FILE_AGE

#: Conditions that mean "nothing landed yet"; any other failure is a failure.
_NOTHING_THERE = ("PATH_NOT_FOUND",)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Landed events, partition folders included; empty when nothing has landed."""
    names = schemas.STREAM_EVENT.fieldNames()
    try:
        # Partition discovery moves the partition column last, so columns are picked by name.
        return spark.read.schema(schemas.STREAM_EVENT).parquet(path).select(*names)
    except AnalysisException as error:
        if error.getCondition() not in _NOTHING_THERE:
            raise
        return spark.createDataFrame([], schemas.STREAM_EVENT)


def new_events(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: str | None = None) -> DataFrame:
    """The landed table as a stream: its files in the order they came, at most so many files or bytes to a batch."""
    reader = spark.readStream.schema(schemas.STREAM_EVENT).option("maxFileAge", MAX_FILE_AGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path).select(*schemas.STREAM_EVENT.fieldNames())


@contextmanager
def footers(spark: SparkSession) -> Iterator[None]:
    """Within, Spark answers counts, and minima and maxima of numbers, from the footers of Parquet files.

    Only what is read and run inside is: the two settings are put back at the end.
    """
    listed = spark.conf.get("spark.sql.sources.useV1SourceList")
    changed = {"spark.sql.sources.useV1SourceList": ",".join(n for n in listed.split(",") if n != "parquet"),
               "spark.sql.parquet.aggregatePushdown": "true"}
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def footer_summary(spark: SparkSession, path: str, number: str = "magnitude") -> DataFrame:
    """Rows of a Parquet table and the least and largest value of a number; run it within :func:`footers`."""
    return spark.read.parquet(path).agg(F.count("*").alias("n_rows"), F.min(number).alias("least"), F.max(number).alias("largest"))
