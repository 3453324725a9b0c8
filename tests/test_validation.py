import math

import pytest
from builders import AGGREGATE, BASE, DEAD_LETTER, READING, SENSOR, frame

from stationflow import schemas as S
from stationflow.operators import validation as V


def verdicts(spark, entity, base, changes):
    # "reason" is a field of the dead letter itself, so codes are compared.
    rows = [{**base, **change, "n": n} for n, change in enumerate(changes)]
    schema = S.T.StructType(entity.schema.fields + [S.T.StructField("n", S.T.IntegerType())])
    checked = V.validate(frame(spark, schema, *rows), entity).orderBy("n")
    return [(row.reason_code, row.reason) for row in checked.select("reason_code", "reason").collect()]


def test_reading_rules(spark):
    cases = [
        ({}, None, None),
        ({"sensor_id": ""}, "missing_id", "sensor id is required"),
        ({"sensor_id": None}, "missing_id", "sensor id is required"),
        ({"ts": None}, "missing_time", "timestamp is required"),
        ({"temp_c": 9999.0}, "temperature", "temperature out of plausible range: 9999.0°C"),
        ({"temp_c": math.nan}, "temperature", "temperature out of plausible range: NaN°C"),
        ({"temp_c": math.inf}, "temperature", "temperature out of plausible range: +Inf°C"),
        ({"temp_c": -math.inf}, "temperature", "temperature out of plausible range: -Inf°C"),
        ({"temp_c": 60.25}, "temperature", "temperature out of plausible range: 60.2°C"),
        ({"temp_c": 61.15}, "temperature", "temperature out of plausible range: 61.1°C"),
        ({"lat": 52.5}, "coordinates", "coordinates outside Hungary: (52.5000, 19.6877)"),
        ({"lat": math.nan}, "coordinates", "coordinates outside Hungary: (NaN, 19.6877)"),
        ({"lon": math.nan}, "coordinates", "coordinates outside Hungary: (46.9036, NaN)"),
        ({"lon": 2.35}, "coordinates", "coordinates outside Hungary: (46.9036, 2.3500)"),
        ({"lat": None, "lon": None}, "coordinates", "coordinates outside Hungary: (0.0000, 0.0000)"),
        ({"temp_c": -28.0}, None, None),
        ({"temp_c": None}, None, None),
        ({"temp_c": -50.0}, None, None),
        ({"temp_c": 60.0}, None, None),
        ({"lat": 45.7, "lon": 16.1}, None, None),
        ({"lat": 48.6, "lon": 22.9}, None, None),
        ({"temp_c": 60.000001}, "temperature", "temperature out of plausible range: 60.0°C"),
        ({"sensor_id": "", "temp_c": 9999.0, "lat": 0.0}, "missing_id", "sensor id is required"),
    ]
    got = verdicts(spark, V.READING, READING, [c[0] for c in cases])
    assert got == [(code, reason) for _, code, reason in cases]


def test_aggregate_rules(spark):
    cases = [
        ({}, None),
        ({"scope": ""}, "missing_scope"),
        ({"window_end": BASE}, "window"),
        ({"count": 0}, "empty_window"),
        ({"count": -1}, "empty_window"),
        ({"min_temp_c": 23.0}, "min_over_max"),
        ({"min_temp_c": math.nan}, None),
        ({"max_temp_c": math.nan}, None),
    ]
    got = verdicts(spark, V.AGGREGATE, AGGREGATE, [c[0] for c in cases])
    assert [g[0] for g in got] == [c[1] for c in cases]
    assert got[5][1] == "min 23.0 exceeds max 22.0"


def test_dead_letter_rules(spark):
    cases = [
        ({}, None),
        ({"source_topic": ""}, "missing_topic"),
        ({"reason": ""}, "missing_reason"),
        ({"failed_at": None}, "missing_failed_at"),
        ({"payload": b""}, None),
        ({"payload": None}, None),
    ]
    got = verdicts(spark, V.DEAD_LETTER, DEAD_LETTER, [c[0] for c in cases])
    assert [g[0] for g in got] == [c[1] for c in cases]


def test_sensor_rules(spark):
    second = 1_000_000_000
    cases = [
        ({}, None, None),
        ({"id": ""}, "missing_id", "sensor id is required"),
        ({"lat": 52.52, "lon": 13.405}, "coordinates", "coordinates outside Hungary: (52.5200, 13.4050)"),
        ({"start_temp_c": 100.0}, "temperature", "temperature out of plausible range: 100.0°C"),
        (
            {"pattern": "sideways"},
            "pattern",
            'unknown drift pattern: "sideways" (want steady, rising, falling or noisy)',
        ),
        ({"pattern": ""}, "pattern", 'unknown drift pattern: "" (want steady, rising, falling or noisy)'),
        ({"interval_ns": second // 2}, "interval", "interval outside 1s-30s: got 500ms"),
        ({"interval_ns": 60 * second}, "interval", "interval outside 1s-30s: got 1m0s"),
        ({"interval_ns": second}, None, None),
        ({"interval_ns": 30 * second}, None, None),
        ({"interval_ns": 30 * second + 1}, "interval", "interval outside 1s-30s: got 30.000000001s"),
    ]
    got = verdicts(spark, V.SENSOR, SENSOR, [c[0] for c in cases])
    assert got == [(code, reason) for _, code, reason in cases]


def test_valid_rows_agree_with_reasons(spark):
    rows = [{**READING, "temp_c": t, "lat": lat} for t in (20.0, 99.0, math.nan) for lat in (47.0, 50.0)]
    df = frame(spark, S.READING, *rows)
    assert V.valid_rows(df, V.READING).count() == 1


def test_limits_are_parameters(spark):
    wide = V.reading_entity(S.Limits(max_lat=60.0, region="the map"))
    got = verdicts(spark, wide, READING, [{"lat": 52.5}, {"lat": 61.0}])
    assert got[0] == (None, None)
    assert got[1][1] == "coordinates outside the map: (61.0000, 19.6877)"


@pytest.mark.parametrize("pattern,known", [("steady", True), ("noisy", True), ("Steady", False), ("", False)])
def test_pattern_membership(spark, pattern, known):
    df = spark.createDataFrame([(pattern,)], "p string")
    assert df.select(V.is_known_pattern(df.p)).first()[0] is known
