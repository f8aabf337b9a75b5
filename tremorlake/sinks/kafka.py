"""Message-queue sinks. The ``kafka`` connector must be on the session's class path.

Delivery is at least once: a retried task may send records again, and readers dedup by event id.
"""

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from tremorlake.operators.codec import event_records, log_records
from tremorlake.sources.kafka import EVENT_TOPIC, LOG_TOPIC


# Delivery settings of the running and of the one-shot ingest.
RUNNING = {"kafka.acks": "all", "kafka.retries": "5", "kafka.retry.backoff.ms": "1000", "kafka.compression.type": "gzip"}
ONE_SHOT = {"kafka.acks": "all", "kafka.retries": "3"}


def options(servers: str, topic: str, one_shot: bool = False) -> dict[str, str]:
    """Sink options: full acknowledgement; the one-shot ingest retries less and does not compress."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, **(ONE_SHOT if one_shot else RUNNING)}


def write_events(events: DataFrame, servers: str, topic: str = EVENT_TOPIC, one_shot: bool = False,
                 sink: str = "kafka") -> int:
    """Send a batch of events, keyed by event id; returns how many were sent."""
    sent = Observation("sent")
    records = event_records(events).observe(sent, F.count(F.lit(1)).alias("n"))
    records.write.format(sink).options(**options(servers, topic, one_shot)).mode("append").save()
    return sent.get["n"]


def write_logs(logs: DataFrame, servers: str, topic: str = LOG_TOPIC, sink: str = "kafka") -> None:
    """Send a batch of log lines, without a key."""
    log_records(logs).write.format(sink).options(**options(servers, topic)).mode("append").save()


def stream_events(events: DataFrame, servers: str, checkpoint: str, interval: str = "3 seconds",
                  topic: str = EVENT_TOPIC) -> StreamingQuery:
    """Send a stream of events as they come."""
    return (
        event_records(events).writeStream.format("kafka").options(**options(servers, topic))
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(processingTime=interval).start()
    )
