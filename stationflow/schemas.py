"""Entities: field types, topic names and topic settings.

The names, sizes and limits below are fixed values of the wire contract.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


READING = _struct(
    ("sensor_id", T.StringType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("temp_c", T.DoubleType()),
    ("ts", T.TimestampType()),
)

AGGREGATE = _struct(
    ("scope", T.StringType()),
    ("window_start", T.TimestampType()),
    ("window_end", T.TimestampType()),
    ("avg_temp_c", T.DoubleType()),
    ("min_temp_c", T.DoubleType()),
    ("max_temp_c", T.DoubleType()),
    ("count", T.LongType()),
)

DEAD_LETTER = _struct(
    ("source_topic", T.StringType()),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
    ("reason", T.StringType()),
    ("failed_at", T.TimestampType()),
    ("payload", T.BinaryType()),
)

# interval_ns holds a duration in nanoseconds, so no text form loses digits.
SENSOR = _struct(
    ("id", T.StringType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("start_temp_c", T.DoubleType()),
    ("pattern", T.StringType()),
    ("interval_ns", T.LongType()),
    ("created_at", T.TimestampType()),
)

STORED_SENSOR = _struct(
    *[
        (name, T.StringType())
        for name in ("id", "lat", "lon", "start_temp_c", "pattern", "interval", "created_at")
    ]
)

# The row shape of Spark's Kafka source; file topics use the same columns.
TOPIC_ROW = _struct(
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("topic", T.StringType()),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
    ("timestamp", T.TimestampType()),
)

HISTORY = T.StructType(
    READING.fields
    + [T.StructField("event_date", T.DateType()), T.StructField("batch", T.StringType())]
)


@dataclass(frozen=True)
class Topic:
    name: str
    partitions: int
    retention: timedelta


READINGS_TOPIC = Topic("sensor.readings", 6, timedelta(hours=24))
CLEAN_TOPIC = Topic("sensor.readings.clean", 6, timedelta(hours=24))
DEAD_LETTER_TOPIC = Topic("sensor.readings.dlq", 1, timedelta(days=7))
AGGREGATES_TOPIC = Topic("weather.aggregates", 3, timedelta(hours=1))

TOPICS = (READINGS_TOPIC, CLEAN_TOPIC, DEAD_LETTER_TOPIC, AGGREGATES_TOPIC)

PATTERNS = ("steady", "rising", "falling", "noisy")


@dataclass(frozen=True)
class Limits:
    """Inclusive plausibility limits for readings and sensors."""

    min_lat: float = 45.7
    max_lat: float = 48.6
    min_lon: float = 16.1
    max_lon: float = 22.9
    min_temp_c: float = -50.0
    max_temp_c: float = 60.0
    min_interval_ns: int = 1_000_000_000
    max_interval_ns: int = 30_000_000_000
    region: str = "Hungary"


@dataclass(frozen=True)
class RegistrationDefaults:
    start_temp_c: float = 15.0
    pattern: str = "noisy"
    interval: str = "5s"


WINDOW_SIZE = timedelta(seconds=10)
GRACE = timedelta(seconds=2)
FLUSH_PERIOD = timedelta(seconds=1)
NATIONAL = "national"
MAX_READING_BYTES = 200
