"""Clean readings to window aggregates, closed by the watermark.

Rows are judged late by their own arrival time, exactly as in the batch form,
so a replay drops the same rows. Spark's watermark only decides when a window
is finished; it is set far enough back never to drop a row that was on time.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow import schemas as S
from stationflow.functions.times import interval, micros
from stationflow.operators.codec import decode, encode
from stationflow.operators.dedup import READING_KEY
from stationflow.operators.routing import skip_rejected
from stationflow.operators.validation import AGGREGATE, READING, valid_rows
from stationflow.operators.windows import is_late, summarise
from stationflow.session import use_rocksdb
from stationflow.sources.topics import append_topic, topic_rows
from stationflow.streaming.batches import named_batches

# Readings dated this much after their arrival would push the watermark past
# live data. They are set aside by the stream; batch queries keep them.
MAX_SKEW = timedelta(minutes=1)

# How far the partitions of a topic may be apart in arrival time.
PARTITION_SKEW = timedelta(minutes=1)


def is_future(max_skew: timedelta = MAX_SKEW) -> Column:
    return F.col("ts") > F.col("arrival_ts") + interval(max_skew)


def future_rows(readings: DataFrame, max_skew: timedelta = MAX_SKEW) -> DataFrame:
    """The rows the stream sets aside."""
    return readings.where(is_future(max_skew))


def readings_from_topic(rows: DataFrame, seen: str = "clean") -> DataFrame:
    """Clean topic rows as readings with the time they arrived.

    The topic was validated when it was written, so a row that does not decode
    is a fault upstream: it is skipped and counted under ``seen``.
    """
    good = skip_rejected(decode(rows, READING), seen)
    return good.select("event.*", F.col("timestamp").alias("arrival_ts"))


def aggregate_stream(
    readings: DataFrame,
    size: timedelta = S.WINDOW_SIZE,
    grace: timedelta = S.GRACE,
    scope: Column | None = None,
    max_skew: timedelta = MAX_SKEW,
    partition_skew: timedelta = PARTITION_SKEW,
    drop_duplicates: bool = False,
    seen: str = "lateness",
) -> DataFrame:
    """Window aggregates of a stream with ``ts, temp_c, arrival_ts``.

    For append mode: each window comes out once. Duplicates count unless
    ``drop_duplicates`` is set. Progress reports carry ``offered``, ``late`` and
    ``future`` under the name ``seen``.
    """
    late, future = is_late(size, grace), is_future(max_skew)
    delay = micros(grace + max_skew + partition_skew)
    kept = (
        readings.observe(
            seen,
            F.count(F.lit(1)).alias("offered"),
            F.count_if(late & ~future).alias("late"),
            F.count_if(future).alias("future"),
        )
        .where(~late & ~future)
        .withWatermark("ts", f"{delay} microseconds")
    )
    if drop_duplicates:
        # One state entry per reading inside the watermark.
        use_rocksdb(readings.sparkSession)
        kept = kept.dropDuplicatesWithinWatermark(list(READING_KEY))
    return summarise(kept, size, scope)


def aggregates_topic(windows: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """Valid aggregates as topic rows, one series per scope.

    The window start in microseconds serves as the offset: it rises along each
    series.
    """
    return topic_rows(
        valid_rows(windows, AGGREGATE),
        S.AGGREGATES_TOPIC,
        F.col("scope"),
        encode(AGGREGATE),
        F.unix_micros("window_start"),
        timestamp,
    )


def start_aggregates(
    windows: DataFrame, path: str, checkpoint: str, once: bool = False, period: timedelta = S.FLUSH_PERIOD
) -> StreamingQuery:
    """Write finished windows to the aggregates topic."""

    def body(batch: DataFrame, name: str) -> None:
        append_topic(aggregates_topic(batch), path, name)

    run = named_batches(windows.sparkSession, checkpoint, body)
    writer = windows.writeStream.outputMode("append").foreachBatch(run)
    trigger = {"availableNow": True} if once else {"processingTime": f"{period.total_seconds()} seconds"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
