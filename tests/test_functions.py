import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationflow.functions import durations, numbers, times

NANOS = [
    (0, "0s"),
    (1, "1ns"),
    (1_500, "1.5µs"),
    (10_000_000, "10ms"),
    (500_000_000, "500ms"),
    (5_000_000_000, "5s"),
    (1_500_000_000, "1.5s"),
    (60_000_000_000, "1m0s"),
    (90_000_000_000, "1m30s"),
    (3_600_000_000_000, "1h0m0s"),
    (-90_000_000_000, "-1m30s"),
    (2**63 - 1, "2562047h47m16.854775807s"),
    (-(2**63), "-2562047h47m16.854775808s"),
]


def column(spark, values, kind, make):
    df = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
    return [r.out for r in df.select("n", make(F.col("v")).alias("out")).orderBy("n").collect()]


def test_duration_text(spark):
    assert column(spark, [n for n, _ in NANOS] + [None], "bigint", durations.format_duration) == [
        t for _, t in NANOS
    ] + [None]


def test_duration_parse(spark):
    second = 1_000_000_000
    cases = [(t, n) for n, t in NANOS] + [
        ("+5s", 5 * second),
        ("0", 0),
        ("1h30m", 5400 * second),
        (".5s", second // 2),
        ("1.s", second),
        ("1s1s", 2 * second),
        ("1us", 1_000),
        ("1μs", 1_000),
        ("1.0000000001s", second),
        ("", None),
        ("s", None),
        ("5", None),
        (".s", None),
        ("fast", None),
        ("5 s", None),
        (" 5s", None),
        ("--5s", None),
        ("1d", None),
        ("1e3s", None),
        ("9223372036854775808ns", None),
        ("2562048h", None),
        ("99999999999999999999999999ns", None),
        (None, None),
    ]
    got = column(spark, [c[0] for c in cases], "string", durations.parse_duration)
    assert got == [c[1] for c in cases]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=40))
def test_duration_round_trip(spark, values):
    assert (
        column(spark, values, "bigint", lambda c: durations.parse_duration(durations.format_duration(c)))
        == values
    )


def test_rfc3339(spark):
    micros = column(
        spark,
        [
            "1970-01-01T00:00:01Z",
            "1970-01-01T00:00:01.5Z",
            "1970-01-01T02:00:01+02:00",
            "1969-12-31T00:30:00-23:30",
            "1970-01-01T00:00:00,5Z",
            "1970-01-01T0:00:00Z",
            "1970-13-01T00:00:00Z",
            "1970-01-01",
            "",
            None,
        ],
        "string",
        lambda c: F.unix_micros(times.parse_rfc3339(c)),
    )
    assert micros == [1_000_000, 1_500_000, 1_000_000, 0] + [None] * 6
    texts = column(
        spark,
        [0, 1, 500_000, 123_456_789],
        "bigint",
        lambda c: times.format_rfc3339(F.timestamp_micros(c)),
    )
    assert texts == [
        "1970-01-01T00:00:00Z",
        "1970-01-01T00:00:00.000001Z",
        "1970-01-01T00:00:00.5Z",
        "1970-01-01T00:02:03.456789Z",
    ]


def test_float_text(spark):
    cases = [
        ("46.9036", 46.9036),
        ("-1e3", -1000.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("Infinity", math.inf),
        ("-inf", -math.inf),
        ("garbage", None),
        ("", None),
        (" 1", None),
        ("1.0d", None),
        ("1f", None),
        ("1e999", None),
        ("1,5", None),
        (None, None),
    ]
    assert column(spark, [c[0] for c in cases], "string", numbers.parse_float) == [c[1] for c in cases]
    values = [0.1, 46.90360000000001, 1e-7, 1e21, 5.0, -0.25]
    assert column(spark, values, "double", lambda c: numbers.parse_float(numbers.float_text(c))) == values


@pytest.mark.parametrize(
    "value,one,four",
    [
        (0.25, "0.2", "0.2500"),
        (61.15, "61.1", "61.1500"),
        (-0.04, "-0.0", "-0.0400"),
        (1234.5, "1234.5", "1234.5000"),
    ],
)
def test_fixed_decimals(spark, value, one, four):
    assert column(spark, [value], "double", lambda c: numbers.fixed_decimals(c, 1)) == [one]
    assert column(spark, [value], "double", lambda c: numbers.fixed_decimals(c, 4)) == [four]


def test_round_half_away(spark):
    values = [1.005, 2.345, -2.345, 0.125, -0.125, 21.0, -0.001]
    want = [1.0, 2.35, -2.35, 0.13, -0.13, 21.0, 0.0]
    assert column(spark, values, "double", numbers.round_half_away) == want
