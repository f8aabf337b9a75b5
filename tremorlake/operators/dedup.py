"""First-seen removal of repeated events, in batch and in streams."""

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_seen(events: DataFrame, *arrival: str, key: str = "event_id") -> DataFrame:
    """The earliest arrival of each key; rows without a key are left out.

    Rank one per key is cut inside every map task before the shuffle, so a key that holds a large
    share of all rows sends at most one row per task.
    """
    by_arrival = Window.partitionBy(key).orderBy(*arrival)
    return (
        events.filter(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(by_arrival))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def first_seen_stream(events: DataFrame, time: str, delay: str, spread: Column | None = None,
                      key: str = "event_id") -> DataFrame:
    """Stream dedup whose memory is bounded by ``time``: ids are forgotten after ``delay``.

    ``spread`` is a small integer that varies among repeats (say, a hash of the offset modulo 16).
    With it, repeats within one minute of ``time`` are first removed per (key, spread, minute), so one
    frequent key is worked off by that many state partitions. The last step alone decides between
    minutes, so the result is the same with and without ``spread``.
    """
    keyed = events.filter(F.col(key).isNotNull()).withWatermark(time, delay)
    if spread is not None:
        keyed = (
            keyed.withColumns({"_spread": spread, "_minute": F.date_trunc("minute", F.col(time))})
            .dropDuplicatesWithinWatermark([key, "_spread", "_minute"])
            .drop("_spread", "_minute")
        )
    return keyed.dropDuplicatesWithinWatermark([key])


def first_seen_forever(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Stream dedup that never forgets an id; state grows with the number of distinct ids."""
    return events.filter(F.col(key).isNotNull()).dropDuplicates([key])
