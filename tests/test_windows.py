import random
from datetime import datetime, timedelta, timezone

from builders import READING, at, frame
from pyspark.sql import functions as F

from stationflow import schemas as S
from stationflow.functions.times import YEAR_ONE_SECONDS
from stationflow.operators import windows as W

SIZE, GRACE = timedelta(seconds=10), timedelta(seconds=2)


def readings(spark, *rows):
    """(event second, temperature, arrival second)"""
    df = spark.createDataFrame(
        [("s", 47.5, 19.0, float(t), at(ts), at(arrival)) for ts, t, arrival in rows],
        "sensor_id string, lat double, lon double, temp_c double, ts timestamp, arrival_ts timestamp",
    )
    return df




def test_two_windows_close_in_turn(spark):
    df = readings(spark, (1, 20, 1), (5, 22, 5), (9, 21, 9), (11, 30, 11))
    summary = W.summarise(df, SIZE)

    def closed(second):
        rows = W.closed(summary, F.lit(at(second)), GRACE).orderBy("window_start")
        return [
            (r.scope, r.avg_temp_c, r.min_temp_c, r.max_temp_c, r["count"]) for r in rows.collect()
        ]

    first = ("national", 21.0, 20.0, 22.0, 3)
    second = ("national", 30.0, 30.0, 30.0, 1)
    assert closed(11) == []
    assert closed(12) == [first]
    assert closed(22) == [first, second]


def test_boundary_opens_the_later_window(spark):
    row = W.summarise(readings(spark, (10, 20, 10)), SIZE).select(
        F.unix_seconds("window_start"), F.unix_seconds("window_end")
    ).first()
    assert tuple(row) == (int(at(10).timestamp()), int(at(20).timestamp()))


def test_late_rows(spark):
    df = readings(spark, (5, 20, 13), (9, 21, 11), (9, 22, 12))
    assert [r.temp_c for r in W.on_time(df, SIZE, GRACE).collect()] == [21.0]
    assert W.late_count(df, SIZE, GRACE).first().late == 2


def test_no_rows_no_windows(spark):
    assert W.summarise(readings(spark, (1, 1, 1)).where("false"), SIZE).count() == 0


def test_conservation(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(60), rng.random() * 30, rng.randrange(90)) for _ in range(4000)]
    df = readings(spark, *rows)
    row = W.conservation(df, SIZE, GRACE).first()
    assert row.offered == 4000 and row.balanced
    kept = W.summarise(W.on_time(df, SIZE, GRACE), SIZE).agg(F.sum("count")).first()[0]
    assert kept == row.stored


def test_window_origin_matches_counting_from_year_one(spark):
    moments = [
        datetime(2025, 3, 9, 12, 0, 3, 250_000, tzinfo=timezone.utc),
        datetime(1969, 12, 31, 23, 59, 59, 999_999, tzinfo=timezone.utc),
        datetime(1970, 1, 1, tzinfo=timezone.utc),
        datetime(1, 1, 2, tzinfo=timezone.utc),
        datetime(1905, 3, 4, 5, 6, 7, tzinfo=timezone.utc),
    ]
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    micro = timedelta(microseconds=1)
    for size in (timedelta(seconds=7), timedelta(days=7), timedelta(seconds=10), timedelta(milliseconds=1500)):
        df = spark.createDataFrame(
            [((m - epoch) // micro,) for m in moments], "us bigint"
        ).withColumn("ts", F.timestamp_micros("us"))
        got = df.select(
            "us",
            F.unix_micros(W.tumbling(size)["start"]).alias("a"),
            F.unix_micros(W.window_start(size)).alias("b"),
        ).collect()
        step, shift = size // micro, YEAR_ONE_SECONDS * 1_000_000
        for row in got:
            want = (row.us + shift) // step * step - shift
            assert (row.a, row.b) == (want, want)


def test_average_does_not_depend_on_order(spark):
    rng = random.Random(3)
    temps = [round(rng.uniform(-50, 60), 2) for _ in range(3001)]
    results = set()
    for parts in (1, 3, 7):
        rng.shuffle(temps)
        df = readings(spark, *[(1, t, 1) for t in temps]).repartition(parts)
        results.add(W.summarise(df, SIZE).first().avg_temp_c)
    assert len(results) == 1


def test_rounding_halves_away_from_zero(spark):
    for temps, want in (([1.0, 1.25], 1.13), ([-1.0, -1.25], -1.13), ([0.01, 0.0], 0.01), ([1.005], 1.0)):
        df = readings(spark, *[(1, t, 1) for t in temps])
        assert W.summarise(df, SIZE).first().avg_temp_c == want


def test_hot_window_keeps_one_row_per_task(spark):
    """A window with nearly all rows is merged before the shuffle."""
    df = readings(spark, *[(1, 20, 1)] * 500 + [(11, 30, 11)])
    plan = W.summarise(df, SIZE)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") == 1


def test_scope_column(spark):
    df = frame(spark, S.READING, READING, {**READING, "lat": 46.0}).withColumn(
        "region", F.when(F.col("lat") > 46.5, "north").otherwise("south")
    )
    rows = W.summarise(df, SIZE, F.col("region")).orderBy("scope").collect()
    assert [(r.scope, r["count"]) for r in rows] == [("north", 1), ("south", 1)]


def test_a_hot_sensor_lifts_the_average(spark):
    normal = [(t, 20.0 + t % 3, t) for t in range(50)]
    hot = [(t, 45.0, t) for t in range(50) if t % 5 == 0]
    before = {r.window_start: r.avg_temp_c for r in W.summarise(readings(spark, *normal), SIZE).collect()}
    after = {r.window_start: r.avg_temp_c for r in W.summarise(readings(spark, *normal, *hot), SIZE).collect()}
    assert len(after) == 5
    assert all(after[w] - before[w] > 0.5 for w in after)
