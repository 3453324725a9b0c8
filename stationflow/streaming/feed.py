"""The live feed: every subscriber's own copy of the aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow.operators.codec import decode, encode
from stationflow.operators.routing import accepted, skip_rejected
from stationflow.operators.validation import AGGREGATE
from stationflow.sources.topics import after_offsets


def feed_messages(rows: DataFrame, seen: str | None = None) -> DataFrame:
    """Aggregate rows decoded, validated, and encoded again as ``message``.

    What goes out is what passed validation. Rejected rows are skipped: the
    aggregates topic has no dead letters.
    """
    decoded = decode(rows, AGGREGATE)
    good = accepted(decoded) if seen is None else skip_rejected(decoded, seen)
    return good.select(
        F.col("event.scope").alias("scope"),
        F.col("event.window_start").alias("window_start"),
        encode(AGGREGATE, "event").alias("message"),
    )


def live_feed(rows: DataFrame, backlog_end: DataFrame) -> DataFrame:
    """Messages newer than the backlog: a new subscriber sees live data only."""
    return feed_messages(after_offsets(rows, backlog_end))


def start_feed(
    rows: DataFrame, subscriber: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Send messages to one subscriber. Each subscriber has its own checkpoint.

    Windows that closed together arrive sorted.
    """

    def run(batch: DataFrame, number: int) -> None:
        subscriber(batch.orderBy("scope", "window_start"), number)

    writer = feed_messages(rows, "feed").writeStream.foreachBatch(run)
    trigger = {"availableNow": True} if once else {"processingTime": "1 second"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
