"""The relational table, appended to."""

from pyspark.sql import DataFrame

from tremorlake.sources.jdbc import TABLE


def options(connections: int | None = None, batch_rows: int = 10_000) -> dict[str, str]:
    """Write options: rows per statement and, if given, a bound on parallel connections."""
    chosen = {"batchsize": str(batch_rows)}
    if connections is not None:
        chosen["numPartitions"] = str(connections)
    return chosen


def append(rows: DataFrame, url: str, properties: dict[str, str], table: str = TABLE, **more) -> None:
    """Append all rows. A second run over the same input appends them again, unless it leaves out ``known`` ids first.

    A bound on connections deals the finished rows anew; Spark's own way, merging partitions, would make
    the parse above as narrow as the write.
    """
    chosen = options(**more)
    if "numPartitions" in chosen:
        rows = rows.repartition(int(chosen["numPartitions"]))
    rows.write.mode("append").options(**chosen).jdbc(url, table, properties=properties)


def without_known(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose event id is not in ``known``, for a rerun."""
    return rows.join(known.select("event_id"), "event_id", "left_anti").select(*rows.columns)
