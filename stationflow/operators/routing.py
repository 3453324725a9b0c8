"""Where decoded rows go: on to the handler, or to the dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def accepted(decoded: DataFrame) -> DataFrame:
    """Rows with a valid event; a handler sees only these."""
    return decoded.where(F.col("reason").isNull()).drop("reason", "reason_code")


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNotNull())


def dead_letters(decoded: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Envelopes of the rejected rows: position, reason, original bytes."""
    return rejected(decoded).select(
        F.col("topic").alias("source_topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        "reason",
        (F.current_timestamp() if failed_at is None else failed_at).alias("failed_at"),
        F.col("value").cast("binary").alias("payload"),
    )


def skip_rejected(decoded: DataFrame, seen: Observation | str) -> DataFrame:
    """Drop rejected rows and report how many there were.

    For topics without dead letters: the counts arrive in the observation (or
    under that name in a stream's progress) when the rows have been read.
    """
    counted = decoded.observe(
        seen,
        F.count(F.lit(1)).alias("offered"),
        F.count_if(F.col("reason").isNotNull()).alias("skipped"),
    )
    return accepted(counted)


def failure_class(reason: Column) -> Column:
    """``bad_data`` for a row that can never succeed, NULL for a good row.

    Trouble with stores and brokers is not a value: it is raised, the job
    stops, and the batch is read again.
    """
    return F.when(reason.isNotNull(), F.lit("bad_data"))
