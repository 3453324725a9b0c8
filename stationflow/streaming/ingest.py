"""Raw topic to dead letters, history and clean topic.

One micro-batch is: decode and validate once, then write the dead letters, the
history and the clean topic in this order. The checkpoint moves on only after
all three are written. Any error stops the query, and the batch runs again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow import schemas as S
from stationflow.operators.codec import decode, encode
from stationflow.operators.routing import accepted, dead_letters
from stationflow.operators.validation import DEAD_LETTER, READING, Entity
from stationflow.sources.history import append_ignore, ensure_history
from stationflow.sources.topics import append_kafka, append_topic, kafka_sink_options, topic_rows
from stationflow.streaming.batches import named_batches

Handler = Callable[[DataFrame], DataFrame]
Writer = Callable[[DataFrame, str], None]


@dataclass(frozen=True)
class Outputs:
    """Where a batch is written: each writer takes the rows and a batch name.

    A writer that is called again with the same name must replace its rows, or
    its readers must accept them twice.
    """

    dead_letters: Writer | None
    history: Writer
    clean: Writer
    audit: Writer | None = None


def file_outputs(spark: SparkSession, root: str) -> Outputs:
    """Parquet folders below ``root``: history, clean, dead_letters, audit."""
    ensure_history(spark, f"{root}/history")
    return Outputs(
        dead_letters=lambda rows, batch: append_topic(rows, f"{root}/dead_letters", batch),
        history=lambda rows, batch: append_ignore(rows.sparkSession, f"{root}/history", rows, batch),
        clean=lambda rows, batch: append_topic(rows, f"{root}/clean", batch),
        audit=audit_folder(f"{root}/audit"),
    )


def audit_folder(path: str) -> Writer:
    """A writer of audit rows, one folder for each batch."""

    def audit(rows: DataFrame, batch: str) -> None:
        (
            rows.withColumn("batch", F.lit(batch))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(path)
        )

    return audit


def kafka_outputs(spark: SparkSession, brokers: str, history_path: str, audit_path: str | None = None) -> Outputs:
    """History as a Parquet table, dead letters and clean readings to Kafka.

    With ``audit_path`` each batch leaves its counts there once its rows were sent.

    Kafka rows of a batch that is run again are sent again, so their readers
    have to bear duplicates; the history does not get any.
    """
    ensure_history(spark, history_path)

    def topic(spec: S.Topic) -> Writer:
        options = kafka_sink_options(brokers, spec.name)
        return lambda rows, batch: append_kafka(rows, options)

    return Outputs(
        dead_letters=topic(S.DEAD_LETTER_TOPIC),
        history=lambda rows, batch: append_ignore(rows.sparkSession, history_path, rows, batch),
        clean=topic(S.CLEAN_TOPIC),
        audit=audit_folder(audit_path) if audit_path else None,
    )


def dead_letter_topic(letters: DataFrame) -> DataFrame:
    """Envelopes as rows of the dead-letter topic, in source order."""
    return topic_rows(
        letters,
        S.DEAD_LETTER_TOPIC,
        F.col("source_topic"),
        encode(DEAD_LETTER),
        F.col("offset"),
        F.col("failed_at"),
    )


def clean_topic(good: DataFrame, entity: Entity = READING) -> DataFrame:
    """Accepted events as rows of the clean topic: same key, same offset order."""
    return topic_rows(
        good,
        S.CLEAN_TOPIC,
        F.col(f"event.{entity.key}"),
        encode(entity, "event"),
        F.col("offset"),
        F.col("timestamp"),
    )


def ingest_batch(
    batch: DataFrame,
    name: str,
    outputs: Outputs,
    entity: Entity = READING,
    handler: Handler | None = None,
) -> None:
    """Process one batch of topic rows."""
    _ingest_decoded(decode(batch, entity), name, outputs, entity, handler)


def _ingest_decoded(
    decoded: DataFrame, name: str, outputs: Outputs, entity: Entity, handler: Handler | None
) -> None:
    """Write one batch of decoded rows.

    ``handler`` may change the accepted rows (with their ``event`` struct)
    before they are stored; it never sees a rejected row. It runs once a batch, and
    the rows it returns are those stored, published and counted as processed.
    """
    decoded = decoded.persist()
    good = accepted(decoded)
    if handler is not None:
        good = handler(good).persist()
    try:
        if outputs.dead_letters is not None:
            outputs.dead_letters(dead_letter_topic(dead_letters(decoded)), name)
        outputs.history(good.select("event.*", "partition", "offset"), name)
        outputs.clean(clean_topic(good, entity), name)
        if outputs.audit is not None:
            # Written last: these rows were stored and published.
            outputs.audit(
                decoded.agg(
                    F.count(F.lit(1)).alias("offered"),
                    F.count_if(F.col("reason").isNotNull()).alias("rejected"),
                    F.lit(good.count()).alias("processed"),
                ),
                name,
            )
    finally:
        if handler is not None:
            good.unpersist()
        decoded.unpersist()


def start_ingest(
    rows: DataFrame,
    outputs: Outputs,
    checkpoint: str,
    entity: Entity = READING,
    handler: Handler | None = None,
    once: bool = False,
    period: str = "1 second",
    seen: str = "ingest",
) -> StreamingQuery:
    """Run ``ingest_batch`` on each batch of a stream of topic rows.

    A batch is cached while it is written, so bound it at the source:
    ``max_files`` of a file topic, ``max_offsets`` of a Kafka topic. Progress reports carry
    ``offered``, ``rejected`` and ``accepted`` under the name ``seen``, whatever the outputs
    are. They are for watching: rows of a cached block that was lost are counted again.
    The audit rows of ``outputs`` are exact.
    """
    decoded = decode(rows, entity).observe(
        seen,
        F.count(F.lit(1)).alias("offered"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
        F.count_if(F.col("reason").isNull()).alias("accepted"),
    )

    def body(batch: DataFrame, name: str) -> None:
        _ingest_decoded(batch, name, outputs, entity, handler)

    run = named_batches(rows.sparkSession, checkpoint, body)
    writer = decoded.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": period}
    return writer.trigger(**trigger).start()
