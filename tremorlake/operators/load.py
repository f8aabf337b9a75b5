"""From landed events to rows of the relational table."""

from pyspark.sql import DataFrame, Window, functions as F

from tremorlake import schemas
from tremorlake.functions.clock import event_time


# The columns of the printed sample and of the check after a load.
SAMPLE_COLUMNS = ("event_id", "datetime", "magnitude", "latitude", "longitude", "source")
NEWEST_COLUMNS = ("event_id", "event_time", "magnitude", "region", "source")


#: What is noted of a load: its rows, those with a time, and the range of their times.
ZONE = "n_rows bigint, timed bigint, earliest timestamp, latest timestamp"


def with_event_time(events: DataFrame) -> DataFrame:
    """Events with the parsed ``event_time`` behind their other columns; the text goes on as ``original_datetime``."""
    text = F.col("datetime")
    return events.select(*[text.alias("original_datetime") if name == "datetime" else F.col(name) for name in events.columns],
                         event_time(text).alias("event_time"))


def warehouse_rows(events: DataFrame) -> DataFrame:
    """Events in the layout of the relational table."""
    return events.select(*[event_time(F.col("datetime")).alias(name) if name == "event_time" else F.col(name)
                           for name in schemas.WAREHOUSE.fieldNames()])


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def sample(events: DataFrame, n: int = 5) -> DataFrame:
    """A few events in six columns, the same ones on every run."""
    return events.select(*SAMPLE_COLUMNS).orderBy(
        "event_id", "datetime").limit(n)


def newest(rows: DataFrame, n: int = 5) -> DataFrame:
    """The latest events; those without a time come last, equal times go by id."""
    return rows.select(*NEWEST_COLUMNS).orderBy(
        F.col("event_time").desc_nulls_last(), "event_id").limit(n)


def batches_of_newest(zones: DataFrame, n: int = 5) -> list[int] | None:
    """Numbers of the loads (rows of ``ZONE`` and ``batch``) that can hold one of the ``n`` latest events; None where any can.

    Loads that begin latest and hold ``n`` timed rows together give a time that all of these rows reach, so a load that ends before
    it holds none of the latest. One row a load is looked at.
    """
    timed = zones.filter("timed > 0")
    by_begin = Window.orderBy(F.col("earliest").desc()).rowsBetween(Window.unboundedPreceding, 0)
    reached = timed.withColumn("held", F.sum("timed").over(by_begin)).filter(F.col("held") >= n).agg(F.max("earliest").alias("t"))
    since = reached.first().t
    if since is None:
        return None
    return sorted(r.batch for r in timed.filter(F.col("latest") >= since).select("batch").collect())
