"""Polls that bring nothing: a log line for every interval in which no payload came."""

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tremorlake.functions import clock as clocks
from tremorlake.operators import payload
from tremorlake.operators.cycles import SERVICE, fixed_lines


def silent_polls(payloads: DataFrame, seconds: float = 3, service: str = SERVICE) -> DataFrame:
    """Log lines of a payload stream's silent intervals, from the first payload on.

    A timer of the stream's state, set anew by every batch with payloads, runs out after ``seconds`` without one; it then gives the
    lines of a failed fetch and is set again. The timer is part of the checkpoint, so a stop is one silent interval
    however long it lasts, and no interval is reported twice.
    """
    wait = int(seconds * 1000)

    def one(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:  # that something came is all that counts
            if len(batch):
                yield batch.head(1)
                return

    def watch(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        silent = state.get[0] if state.exists else 0
        if state.hasTimedOut:
            silent += 1
            yield pd.DataFrame({"feed": [key[0]], "silent": [silent]})
        else:
            for _ in frames:
                pass
        state.update((silent,))
        state.setTimeoutDuration(wait)

    beats = payloads.select(F.lit("feed").alias("feed")).mapInPandas(one, "feed string")
    silent = beats.groupBy("feed").applyInPandasWithState(
        watch, "feed string, silent bigint", "silent bigint", "append", GroupStateTimeout.ProcessingTimeTimeout)
    lines = F.array(*[F.struct(F.lit(kind).alias("log_type"), F.lit(level).alias("level"), F.lit(text).alias("message"))
                      for kind, level, text in fixed_lines(payload.FETCH_FAILED)])
    return silent.select(F.inline(lines), "silent").select(
        clocks.utc_iso(None).alias("timestamp"), F.lit(service).alias("service"), "log_type", "level", "message", "silent")
