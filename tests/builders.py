"""Small literal inputs for the tests."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from stationflow import schemas as S

BASE = datetime(2025, 3, 9, 12, 0, 0, tzinfo=timezone.utc)
READING = {"sensor_id": "sensor-0417", "lat": 46.9036, "lon": 19.6877, "temp_c": 17.25, "ts": BASE}
SENSOR = {
    "id": "sensor-0417",
    "lat": 46.9036,
    "lon": 19.6877,
    "start_temp_c": 11.75,
    "pattern": "falling",
    "interval_ns": 12_000_000_000,
    "created_at": BASE,
}
DEAD_LETTER = {
    "source_topic": "sensor.readings",
    "partition": 4,
    "offset": 117,
    "reason": "unmarshal: invalid JSON",
    "failed_at": BASE,
    "payload": b"not json at all",
}
AGGREGATE = {
    "scope": "national",
    "window_start": BASE,
    "window_end": BASE + timedelta(seconds=10),
    "avg_temp_c": 21.0,
    "min_temp_c": 20.0,
    "max_temp_c": 22.0,
    "count": 3,
}


def frame(spark, schema, *rows):
    names = schema.names
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], schema)


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def wire(reading):
    ts = reading["ts"].strftime("%Y-%m-%dT%H:%M:%SZ")
    return json.dumps({**reading, "ts": ts}).encode()


def topic(spark, values, partition=0, start=0, key=b"sensor-0417", when=BASE):
    rows = [
        (key, value, S.READINGS_TOPIC.name, partition, start + n, when) for n, value in enumerate(values)
    ]
    return spark.createDataFrame(rows, S.TOPIC_ROW)
