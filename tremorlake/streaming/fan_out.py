"""One read of a source for several sinks."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tremorlake.operators import codec
from tremorlake.storage import remove
from tremorlake.streaming.ledger import Ledger
from tremorlake.streaming.queries import LANDING_INTERVAL, timed

#: Takes the rows of a micro-batch and its number.
Sink = Callable[[DataFrame, int], None]


def batch_runner(sinks: dict[str, Sink], folder: str) -> Sink:
    """What a query does with each micro-batch: reads and decodes it once and hands it to every sink that has not had it.

    The rows are written under ``folder`` once and read back by the sinks. A batch that is run again after a failure is passed on only
    to the sinks whose mark is missing in the ledger.
    """
    ledger = None

    def run(rows: DataFrame, number: int) -> None:
        nonlocal ledger
        ledger = ledger or Ledger(rows.sparkSession, f"{folder}/ledger")
        waiting = [name for name in sinks if not ledger.done(name, number)]
        if not waiting:
            return
        staged = f"{folder}/staged/batch={number}"
        rows.write.mode("overwrite").parquet(staged)
        for name in waiting:
            sinks[name](rows.sparkSession.read.schema(rows.schema).parquet(staged), number)
            ledger.mark(name, number)
        remove(rows.sparkSession, staged)

    return run


def fan_out(records: DataFrame, sinks: dict[str, Sink], folder: str, interval: str | None = LANDING_INTERVAL,
            decode: Callable[[DataFrame], DataFrame] = codec.decode_records) -> StreamingQuery:
    """Decode queue records and hand every micro-batch to all sinks."""
    writer = decode(records).writeStream.foreachBatch(batch_runner(sinks, folder)).option(
        "checkpointLocation", f"{folder}/checkpoint")
    return timed(writer, interval).start()


def landing(path: str) -> Sink:
    """A Parquet table in folders by source and batch; a batch that is written again replaces its folders."""
    def write(rows: DataFrame, number: int) -> None:
        rows.selectExpr("*", f"bigint({number}) AS batch").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("source", "batch").parquet(path)

    return write


def printed(n: int = 20) -> Sink:
    """The first rows of a batch in full, on the console."""
    return lambda rows, number: rows.show(n, truncate=False)
