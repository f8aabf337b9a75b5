"""The relational table, read back."""

from pyspark.sql import DataFrame, SparkSession

from tremorlake.operators.load import NEWEST_COLUMNS

TABLE = "earthquakes"


def read_table(spark: SparkSession, url: str, properties: dict[str, str], split: tuple[str, str, str, int],
               table: str = TABLE) -> DataFrame:
    """The whole table; ``split`` = (column, lower, upper, partitions) reads it in parallel ranges.

    Rows outside the bounds are read too, by the first and last range.
    """
    column, lower, upper, partitions = split
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, **properties)
    return reader.load()


def query(spark: SparkSession, url: str, properties: dict[str, str], sql: str) -> DataFrame:
    """The result of a query that the database itself runs; meant for small results."""
    return spark.read.format("jdbc").options(url=url, query=sql, **properties).load()


def check(spark: SparkSession, url: str, properties: dict[str, str], table: str = TABLE, n: int = 5) -> dict:
    """Rows of the table and its newest rows, both worked out by the database."""
    total = query(spark, url, properties, f"SELECT count(*) AS n_rows FROM {table}").first()["n_rows"]
    newest = query(spark, url, properties,
                   f"SELECT {', '.join(NEWEST_COLUMNS)} FROM {table} "
                   f"ORDER BY event_time DESC NULLS LAST, event_id LIMIT {n}").collect()
    return {"total": total, "newest": newest}
