"""Tumbling windows over event time, with a grace period for late rows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow import schemas as S
from stationflow.functions.numbers import round_half_away
from stationflow.functions.times import interval, micros, window_origin

# Temperatures are added as whole millionths of a degree. Whole numbers add up
# to the same total in any order, so the average does not depend on how rows
# were split over tasks, and a task that is run again changes nothing. Totals
# hold 1.5e11 readings of 60 °C in one window; beyond that Spark raises an
# error (ANSI mode), and a coarser scale can be passed.
SUM_SCALE = 1_000_000


def tumbling(size: timedelta, ts: Column | str = "ts") -> Column:
    """``struct<start, end>`` of the window ``[start, end)`` holding ``ts``.

    A row on a boundary opens the later window. Boundaries count from year 1,
    which matters only for sizes that do not divide a day evenly.
    """
    width = f"{micros(size)} microseconds"
    return F.window(ts, width, width, f"{window_origin(size)} microseconds")


def window_start(size: timedelta, ts: Column | str = "ts") -> Column:
    """Start of the window holding ``ts``, as arithmetic on microseconds.

    Use it where only the bounds are needed: unlike ``window`` it is an ordinary
    expression and may appear in any projection or filter.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    since = F.unix_micros(ts)
    return F.timestamp_micros(since - F.pmod(since - window_origin(size), F.lit(micros(size))))


def is_late(
    size: timedelta = S.WINDOW_SIZE,
    grace: timedelta = S.GRACE,
    ts: Column | str = "ts",
    arrival: Column | str = "arrival_ts",
) -> Column:
    """True when the row came after its window closed (end plus grace)."""
    arrival = F.col(arrival) if isinstance(arrival, str) else arrival
    return arrival >= window_start(size, ts) + interval(size + grace)


def on_time(df: DataFrame, size: timedelta = S.WINDOW_SIZE, grace: timedelta = S.GRACE) -> DataFrame:
    """Rows that may still count towards their window."""
    return df.where(~is_late(size, grace))


def partial_columns(temp: Column | str = "temp_c", scale: int = SUM_SCALE) -> list[Column]:
    """The mergeable part of a window: scaled total, min, max and count."""
    temp = F.col(temp) if isinstance(temp, str) else temp
    return [
        F.sum(F.rint(temp * F.lit(float(scale))).cast("bigint")).alias("total"),
        F.min(temp).alias("min_temp_c"),
        F.max(temp).alias("max_temp_c"),
        F.count(F.lit(1)).alias("count"),
    ]


def average(total: Column, count: Column, scale: int = SUM_SCALE) -> Column:
    """Mean with two decimals, halves away from zero."""
    return round_half_away(total.cast("double") / F.lit(float(scale)) / count.cast("double"), 2)


def summarise(
    df: DataFrame,
    size: timedelta = S.WINDOW_SIZE,
    scope: Column | None = None,
    scale: int = SUM_SCALE,
) -> DataFrame:
    """One row per scope and window: average, minimum, maximum and count.

    Rows are grouped map-side first, so one task sends one small row per window
    it met, however many readings share the window. Windows without readings
    give no row. Expects valid readings.
    """
    scope = F.lit(S.NATIONAL) if scope is None else scope
    # A stream needs window() so that the watermark can close its groups. A
    # batch groups by the start alone: a plain key hashes faster than a struct.
    window = tumbling(size) if df.isStreaming else window_start(size)
    start = F.col("_w.start") if df.isStreaming else F.col("_w")
    grouped = df.groupBy(scope.alias("scope"), window.alias("_w")).agg(*partial_columns(scale=scale))
    return _finished(grouped, start, size, scale)


def _finished(grouped: DataFrame, start: Column, size: timedelta, scale: int) -> DataFrame:
    return grouped.select(
        "scope",
        start.alias("window_start"),
        (start + interval(size)).alias("window_end"),
        average(F.col("total"), F.col("count"), scale).alias("avg_temp_c"),
        "min_temp_c",
        "max_temp_c",
        "count",
    )


def merge_partials(partials: DataFrame, size: timedelta = S.WINDOW_SIZE, scale: int = SUM_SCALE) -> DataFrame:
    """The aggregates of ``partial_columns`` rows with ``scope`` and ``window_start``.

    Equal to ``summarise`` over all their readings, in whatever parts they came.
    """
    merged = partials.groupBy("scope", "window_start").agg(
        F.sum("total").alias("total"),
        F.min("min_temp_c").alias("min_temp_c"),
        F.max("max_temp_c").alias("max_temp_c"),
        F.sum("count").alias("count"),
    )
    return _finished(merged, F.col("window_start"), size, scale)


def late_count(df: DataFrame, size: timedelta = S.WINDOW_SIZE, grace: timedelta = S.GRACE) -> DataFrame:
    """Rows dropped as late, in total."""
    return df.agg(F.count_if(is_late(size, grace)).alias("late"))


def conservation(df: DataFrame, size: timedelta = S.WINDOW_SIZE, grace: timedelta = S.GRACE) -> DataFrame:
    """Readings offered, counted in the windows that come out, and late: the last two add up to the first."""
    stored = summarise(on_time(df, size, grace), size).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("stored"))
    counts = df.agg(F.count(F.lit(1)).alias("offered"), F.count_if(is_late(size, grace)).alias("late"))
    return counts.select("offered", stored.scalar().alias("stored"), "late").withColumn(
        "balanced", F.col("stored") + F.col("late") == F.col("offered")
    )


def closed(windows: DataFrame, now: Column, grace: timedelta = S.GRACE) -> DataFrame:
    """Windows whose grace period is over at ``now``."""
    return windows.where(F.col("window_end") + interval(grace) <= now)
