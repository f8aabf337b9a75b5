"""Ids a running ingest has sent, remembered for some days and read in part.

Ids lie in folders by hash bucket, day and batch. A batch looks only into the buckets its own ids fall into, so what it reads
grows with the batch and with the ids of the days remembered, not with the number of batches before it. When a day is over,
its batches are merged into one folder per bucket, and days older than ``days`` are deleted.
"""

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tremorlake.storage import children, remove

#: Hash buckets of a memory; must stay as they are for as long as its folder does.
BUCKETS = 256


def today() -> date:
    return datetime.now(timezone.utc).date()


class IdMemory:
    """The ids sent before a batch, under a folder of shared storage."""

    def __init__(self, spark: SparkSession, folder: str, days: int = 30, buckets: int = BUCKETS, clock=today):
        self._spark, self._folder, self._days, self._buckets, self._clock = spark, folder, days, buckets, clock
        self._settled = None

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self._buckets)).cast("int")

    def _read(self, paths: list[str]) -> DataFrame:
        schema = "event_id string, bucket int, day int, batch long"
        if not paths:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).option("basePath", self._folder).parquet(*paths)

    def known(self, ids: DataFrame, number: int, key: str = "event_id") -> DataFrame:
        """Remembered ids of earlier batches, from the buckets of ``ids`` alone."""
        wanted = {f"bucket={r.bucket}" for r in ids.select(self._bucket(key).alias("bucket")).distinct().collect()}
        paths = [f"{self._folder}/{name}" for name in children(self._spark, self._folder) if name in wanted]
        oldest = self._clock().toordinal() - self._days
        return self._read(paths).filter((F.col("batch") < number) & (F.col("day") >= oldest)).select("event_id")

    def remember(self, ids: DataFrame, number: int, key: str = "event_id") -> None:
        """Keep a batch's ids; a batch that is run again replaces what it kept."""
        rows = ids.select(F.col(key).alias("event_id"), self._bucket(key).alias("bucket"),
                          F.lit(self._clock().toordinal()).alias("day"), F.lit(number).cast("long").alias("batch"))
        self._write(rows)

    def _write(self, rows: DataFrame) -> None:
        # A fixed number of tasks: few ids would else be gathered in one that writes all buckets.
        tasks = min(self._buckets, max(2, self._spark.sparkContext.defaultParallelism))
        rows.repartition(tasks, "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "bucket", "day", "batch").parquet(self._folder)

    def settle(self, number: int) -> None:
        """Once a day: merge the days that are over and delete those that are forgotten.

        Batches from ``number`` on stay as they are, as they may be run again.
        """
        day = self._clock().toordinal()
        if self._settled == day:
            return
        loose = []
        for bucket in children(self._spark, self._folder):
            for name in children(self._spark, f"{self._folder}/{bucket}"):
                path, own = f"{self._folder}/{bucket}/{name}", int(name.removeprefix("day="))
                if own < day - self._days:
                    remove(self._spark, path)
                elif own < day:
                    batches = [b for b in children(self._spark, path) if int(b.removeprefix("batch=")) < number]
                    if len(batches) > 1:
                        loose += [f"{path}/{b}" for b in batches]
        if loose:
            # A number no folder has yet, below all batches: what is merged counts as sent before any of them.
            lowest = min(int(path.rpartition("=")[2]) for path in loose)
            merged = self._read(loose).select("event_id", "bucket", "day", F.lit(min(lowest, 0) - 1).cast("long").alias("batch"))
            self._write(merged.distinct())
            for path in loose:
                remove(self._spark, path)
        self._settled = day
