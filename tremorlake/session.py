"""Session defaults and the shared work folder."""

import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dedup state lives off-heap and on disk, so it is not bounded by executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Recording the Python call site of every column expression slows down building large plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A repeated key in a payload keeps its last value instead of spoiling the payload.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def builder(app_name: str = "tremorlake", **extra: str) -> SparkSession.Builder:
    """A session builder with this library's defaults; cluster sizing is left to the deployment."""
    b = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **extra}.items():
        b = b.config(key, value)
    return b


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``, or where that is unset under the session's warehouse, which
    executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
