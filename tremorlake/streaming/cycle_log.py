"""Cycle log lines of a running ingest, taken from the progress of its micro-batches."""

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql.streaming import StreamingQueryListener

from tremorlake.operators.cycles import SERVICE, fixed_lines, success_text


#: Text of the line that reports rows which came after their id's memory was gone.
LATE = "%d event terlambat dibuang"


def lines_of(progress, service: str = SERVICE) -> list[dict[str, str]]:
    """Log lines of one micro-batch: one set per outcome that occurred, then the cycle summary."""
    metrics = progress.observedMetrics
    if "outcomes" not in metrics:
        return []
    outcomes = metrics["outcomes"].asDict()
    payloads = outcomes.pop("payloads")
    if not payloads:
        return []
    lines = [line for outcome, n in outcomes.items() if n for line in fixed_lines(outcome)]
    if payloads > sum(outcomes.values()):
        valid, sent = metrics["valid"]["n"], metrics["sent"]["n"]
        # The last dedup step holds one row per id; an earlier, spread one holds more.
        held = min((op.numRowsTotal for op in progress.stateOperators), default=sent)
        lines.append(("FETCH_SUCCESS", "INFO", success_text(sent, valid - sent, held)))
    if late := sum(op.numRowsDroppedByWatermark for op in progress.stateOperators):
        lines.append(("LATE_DROPPED", "WARNING", LATE % late))
    now = datetime.now(timezone.utc).isoformat()
    return [{"timestamp": now, "service": service, "log_type": log_type, "level": level, "message": message}
            for log_type, level, message in lines]


class CycleLog(StreamingQueryListener):
    """Hands the log lines of every micro-batch of one query to ``emit``."""

    def __init__(self, emit: Callable[[list[dict[str, str]]], None], query_id: str | None = None,
                 service: str = SERVICE):
        self._emit = emit
        self._query_id = query_id
        self._service = service

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if self._query_id is None or str(event.progress.id) == self._query_id:
            lines = lines_of(event.progress, self._service)
            if lines:
                self._emit(lines)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
