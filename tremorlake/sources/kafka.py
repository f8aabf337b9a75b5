"""Message-queue sources. The ``kafka`` connector must be on the session's class path."""

from pyspark.sql import DataFrame, SparkSession

EVENT_TOPIC = "earthquake-events"
LOG_TOPIC = "system-logs"


def options(servers: str, *topics: str, starting: str, group: str | None = None,
            max_per_trigger: int | None = None, min_partitions: int | None = None) -> dict[str, str]:
    """Source options; ``min_partitions`` splits large topic partitions over several tasks."""
    chosen = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "kafka.group.id": group,
        "maxOffsetsPerTrigger": max_per_trigger,
        "minPartitions": min_partitions,
    }
    return {k: str(v) for k, v in chosen.items() if v is not None}


def stream(spark: SparkSession, servers: str, *topics: str, starting: str = "latest", **more) -> DataFrame:
    """Unbounded records of the topics; from the latest offset unless told otherwise."""
    return spark.readStream.format("kafka").options(
        **options(servers, *topics, starting=starting, **more)).load()


def batch(spark: SparkSession, servers: str, *topics: str, **more) -> DataFrame:
    """All records of the topics up to now, without a consumer group."""
    return spark.read.format("kafka").options(**options(servers, *topics, starting="earliest", **more)).load()


def monitor_streams(spark: SparkSession, servers: str, group: str,
                    max_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Event and log records from the earliest offset, each topic in a group of its own.

    A bound per trigger is a rate limit, so there is none unless the caller sets one.
    """
    return tuple(
        stream(spark, servers, topic, starting="earliest", group=f"{group}-{suffix}",
               max_per_trigger=max_per_trigger)
        for topic, suffix in ((EVENT_TOPIC, "earthquake"), (LOG_TOPIC, "logs")))
