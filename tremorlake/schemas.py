"""Record layouts shared by sources, operators and sinks."""

from pyspark.sql import types as T

_S, _D = T.StringType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


#: A normalised event as the ingest side produces it.
EVENT = _struct(
    event_id=_S, datetime=_S, latitude=_D, longitude=_D, magnitude=_D, depth=T.IntegerType(),
    region=_S, felt_intensity=_S, shakemap=_S, potensi=_S, source=_S, ingested_at=_S,
)

#: What the streaming hop keeps of an event.
STREAM_EVENT = T.StructType([f for f in EVENT.fields if f.name not in ("shakemap", "potensi")])

#: One structured log line.
LOG = _struct(timestamp=_S, service=_S, log_type=_S, level=_S, message=_S)

#: One row of a historical HTML table.
HISTORICAL = _struct(
    no=_S, tanggal=_S, waktu=_S, latitude=_D, longitude=_D, kedalaman_km=_D, magnitudo=_D,
    wilayah=_S, source=_S, scraped_at=_S,
)

#: A row of the relational table.
WAREHOUSE = _struct(
    event_id=_S, event_time=T.TimestampType(), latitude=_D, longitude=_D, magnitude=_D,
    depth=T.IntegerType(), region=_S, felt_intensity=_S, source=_S, ingested_at=_S,
)

#: A message-queue record, as Spark's Kafka source delivers it.
KAFKA_RECORD = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
])
