"""Clean readings to window aggregates, closed by the wall clock.

The watermark form waits for newer data before it closes a window, so a silent
topic keeps its last window open. Here a processing-time timer closes it.

Python sees partials only: each Arrow batch of readings shrinks to one row per
scope and window inside the map task, and those few rows are shuffled to the
state of their window.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stationflow import schemas as S
from stationflow.functions.times import interval, micros
from stationflow.operators.windows import SUM_SCALE, average, window_start
from stationflow.session import use_rocksdb

_PARTIAL = T.StructType(
    [
        T.StructField("scope", T.StringType()),
        T.StructField("window_us", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("min_temp_c", T.DoubleType()),
        T.StructField("max_temp_c", T.DoubleType()),
        T.StructField("count", T.LongType()),
    ]
)


def _partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per scope and window of each Arrow batch."""
    for rows in batches:
        if len(rows):
            yield (
                rows.groupby(["scope", "window_us"], as_index=False)
                .agg(
                    total=("units", "sum"),
                    min_temp_c=("temp_c", "min"),
                    max_temp_c=("temp_c", "max"),
                    count=("units", "size"),
                )
                .loc[:, _PARTIAL.names]
            )


class _WindowState(StatefulProcessor):
    """Merges the partials of one window and emits them when its timer fires."""

    def __init__(self, close_after_us: int) -> None:
        self._close_after_us = close_after_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._merged = handle.getValueState(
            "merged", "total long, min_temp_c double, max_temp_c double, count long"
        )

    def handleInputRows(self, key, rows, timerValues):
        total, low, high, count = 0, float("inf"), float("-inf"), 0
        known = self._merged.exists()
        if known:
            total, low, high, count = self._merged.get()
        for part in rows:
            total += int(part["total"].sum())
            low = min(low, float(part["min_temp_c"].min()))
            high = max(high, float(part["max_temp_c"].max()))
            count += int(part["count"].sum())
        self._merged.update((total, low, high, count))
        if not known:
            # Round up: a timer must not fire before the grace period is over.
            self._handle.registerTimer(-(-(key[1] + self._close_after_us) // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self._merged.exists():
            total, low, high, count = self._merged.get()
            self._merged.clear()
            yield pd.DataFrame([[key[0], key[1], total, low, high, count]], columns=_PARTIAL.names)

    def close(self) -> None:
        pass


def wall_clock_stream(
    readings: DataFrame,
    size: timedelta = S.WINDOW_SIZE,
    grace: timedelta = S.GRACE,
    scope: Column | None = None,
    seen: str = "lateness",
) -> DataFrame:
    """Window aggregates of a stream with ``ts, temp_c``, for append mode.

    A row handled at or after ``end + grace`` is late: dropped and counted under
    ``seen``. All others are merged until the clock passes that moment.
    """
    use_rocksdb(readings.sparkSession)
    close_after = size + grace
    # The clock of a micro-batch: current_timestamp() is one value per batch.
    late = F.current_timestamp() >= window_start(size) + interval(close_after)
    rows = (
        readings.observe(seen, F.count(F.lit(1)).alias("offered"), F.count_if(late).alias("late"))
        .where(~late)
        .select(
            (F.lit(S.NATIONAL) if scope is None else scope).alias("scope"),
            F.unix_micros(window_start(size)).alias("window_us"),
            F.rint(F.col("temp_c") * F.lit(float(SUM_SCALE))).cast("bigint").alias("units"),
            "temp_c",
        )
    )
    merged = (
        rows.mapInPandas(_partials, _PARTIAL)
        .groupBy("scope", "window_us")
        .transformWithStateInPandas(
            statefulProcessor=_WindowState(micros(close_after)),
            outputStructType=_PARTIAL,
            outputMode="Append",
            timeMode="ProcessingTime",
        )
    )
    return merged.select(
        "scope",
        F.timestamp_micros("window_us").alias("window_start"),
        F.timestamp_micros(F.col("window_us") + micros(size)).alias("window_end"),
        average(F.col("total"), F.col("count")).alias("avg_temp_c"),
        "min_temp_c",
        "max_temp_c",
        "count",
    )
