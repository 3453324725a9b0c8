"""Topics: keyed append-only logs of JSON values.

Two forms with the same columns (``key, value, topic, partition, offset,
timestamp``): Kafka, through Spark's connector, and Parquet folders, for places
without a broker. Operators never see the difference.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow import schemas as S
from stationflow.functions.times import interval

_FILE = "_metadata.file_path"

# Files of a backlog that a filter names: some megabytes of a plan.
LISTED_FILES = 50_000

TOPIC_FILE = T.StructType(
    S.TOPIC_ROW.fields
    + [T.StructField("day", T.DateType()), T.StructField("batch", T.StringType())]
)


def kafka_source_options(
    brokers: str, topic: str, from_latest: bool = False, max_offsets: int | None = None
) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``.

    Without a checkpoint a query starts at the earliest retained row, or, with
    ``from_latest``, after the newest one. With a checkpoint it resumes where it
    stopped. Each full-copy reader has its own checkpoint; work is shared among
    the tasks of one query.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "latest" if from_latest else "earliest",
        "failOnDataLoss": "true",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_sink_options(brokers: str, topic: str) -> dict[str, str]:
    """Options for writing ``key, value``: all replicas confirm, short batches."""
    return {
        "kafka.bootstrap.servers": brokers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.linger.ms": "10",
    }


def stream_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A Kafka topic as a stream. Needs Spark's Kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**options).load().select(*S.TOPIC_ROW.names)


def append_kafka(rows: DataFrame, options: dict[str, str]) -> None:
    """Append one batch to a Kafka topic; Kafka places each row by its key."""
    rows.select("key", "value").write.format("kafka").options(**options).save()


def read_topic(
    spark: SparkSession, path: str, retention: timedelta | None = None, now: datetime | None = None
) -> DataFrame:
    """The rows of a file topic; with ``retention`` those that are young enough at ``now``.

    ``purge_days`` drops whole days; the rows of a day that are older than the limit are left
    out here, and earlier days are not opened.
    """
    rows = spark.read.schema(TOPIC_FILE).parquet(path)
    if retention is not None:
        moment = F.current_timestamp() if now is None else F.lit(now)
        rows = rows.where(is_retained(retention, moment))
        if now is not None:
            rows = rows.where(F.col("day") >= F.lit((now - retention).astimezone(timezone.utc).date()))
    return rows.select(*S.TOPIC_ROW.names)


def end_files(spark: SparkSession, path: str) -> DataFrame:
    """The files a file topic has now: "latest" begins behind them.

    Offsets of a derived topic are those of its source and may repeat within a
    partition; files do not. Files are listed, not read. Store the result: it is the place
    to resume from.
    """
    found = spark.read.schema(TOPIC_FILE).parquet(path).inputFiles()
    # Rows name a local file with one slash, lists with three.
    names = [(re.sub("^file:/+", "file:/", name),) for name in found]
    return spark.createDataFrame(names, "file string")


def stream_topic(
    spark: SparkSession, path: str, max_files: int | None = None, backlog: DataFrame | None = None
) -> DataFrame:
    """A file topic as a stream, from the earliest retained row.

    With ``backlog`` (from ``end_files``) it begins at latest: those files are passed over,
    all others come. Up to ``LISTED_FILES`` of them are named in a filter on the file,
    which Spark applies to its list of files: none of them is opened. More are matched by
    their name while they are read.

    ``max_files`` bounds a batch, so that a backlog is worked off in batches the
    cluster can hold. Files of one write have no order among them: read windows
    with ``rollup``, which takes them in any order. A watermark moved by the
    first file would close windows the next still fill.
    """
    reader = spark.readStream.schema(TOPIC_FILE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(path)
    if backlog is not None:
        names = [row.file for row in backlog.limit(LISTED_FILES + 1).collect()]
        if len(names) <= LISTED_FILES:
            rows = rows.where(~F.col(_FILE).isin(names)) if names else rows
        else:
            rows = rows.withColumn("file", F.col(_FILE)).join(backlog, "file", "left_anti")
    return rows.select(*S.TOPIC_ROW.names)


def topic_rows(
    df: DataFrame,
    topic: S.Topic,
    key: Column,
    value: Column,
    offset: Column,
    timestamp: Column | None = None,
) -> DataFrame:
    """Rows of a topic: the same key always gets the same partition number.

    No shuffle: the number is a column. ``offset`` has to rise along each key;
    rows made from another topic take over its offset.
    """
    return df.select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic.name).alias("topic"),
        F.pmod(F.xxhash64(key), F.lit(topic.partitions)).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        (F.current_timestamp() if timestamp is None else timestamp).alias("timestamp"),
    )


def append_topic(rows: DataFrame, path: str, batch: str) -> None:
    """Write one batch; writing a batch of the same name again replaces it."""
    (
        rows.withColumns({"day": F.to_date("timestamp"), "batch": F.lit(batch)})
        .sortWithinPartitions("day", "partition", "offset")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "batch")
        .parquet(path)
    )


def end_offsets(rows: DataFrame) -> DataFrame:
    """The newest offset per topic and partition: where "latest" begins."""
    return rows.groupBy("topic", "partition").agg(F.max("offset").alias("end_offset"))


def after_offsets(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows behind the given end offsets; unlisted partitions are read whole.

    For topics whose offsets are positions; for a derived file topic use ``end_files``.

    ``ends`` has one row per partition of the topic. It becomes one small map
    that every task looks into, so the rows are only filtered.
    """
    at = F.struct("topic", "partition")
    pairs = F.collect_list(F.struct(at.alias("at"), F.col("end_offset")))
    known = ends.agg(F.map_from_entries(pairs)).scalar()
    return rows.where(F.col("offset") > F.coalesce(F.try_element_at(known, at), F.lit(-1)))


def is_retained(retention: timedelta, now: Column, ts: str = "timestamp") -> Column:
    """True for rows young enough to be kept at ``now``."""
    return F.col(ts) >= now - interval(retention)


def purge_days(spark: SparkSession, path: str, column: str, now: datetime, retention: timedelta) -> list[str]:
    """Delete the day folders that hold no retained row; return their days.

    A folder ``column=YYYY-MM-DD`` goes once its whole day is older than the
    limit. Rows are not read: this lists the day folders and drops old ones.
    """
    oldest = (now - retention).date().isoformat()
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    gone = []
    for status in files.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{column}="):
            day = name.split("=", 1)[1]
            if len(day) == 10 and day < oldest:
                files.delete(status.getPath(), True)
                gone.append(day)
    return sorted(gone)
