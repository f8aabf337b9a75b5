"""Which batch each sink of a query has taken in full."""

from pyspark.sql import SparkSession

from tremorlake.storage import children


class Ledger:
    """The last batch that a sink finished, kept in two alternating folders.

    A mark replaces the older of the two, so one is whole at any time, and neither reading nor marking gets dearer
    with the number of batches. A sink that failed between its write and its mark is asked again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder, self._last = spark, folder, {}

    def last(self, sink: str) -> int:
        """Number of the last finished batch, -1 before the first."""
        if sink not in self._last:
            path = f"{self._folder}/{sink}"
            slots = [f"{path}/{slot}" for slot in children(self._spark, path) if self._whole(f"{path}/{slot}")]
            marks = self._spark.read.schema("batch long").parquet(*slots).collect() if slots else []
            self._last[sink] = max((m.batch for m in marks), default=-1)
        return self._last[sink]

    def _whole(self, slot: str) -> bool:
        return bool([name for name in children(self._spark, slot) if name.endswith(".parquet")])

    def done(self, sink: str, number: int) -> bool:
        return self.last(sink) >= number

    def mark(self, sink: str, number: int) -> None:
        self._spark.createDataFrame([(number,)], "batch long").coalesce(1).write.mode("overwrite").parquet(
            f"{self._folder}/{sink}/slot={number % 2}")
        self._last[sink] = number
