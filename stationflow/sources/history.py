"""The history table: every reading once, in daily Parquet partitions.

Layout ``event_date=<day>/batch=<name>``. A batch writes only its own folders,
so a batch that is run again after a crash replaces what it wrote before. Batch
names must never be used again for other rows. One writer per table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow import schemas as S
from stationflow.operators.dedup import READING_KEY, first_by_position, not_stored
from stationflow.plans.layout import BROADCAST_ROWS, broadcast_if_small, spread

# Up to this many touched days become a list of folders to read. A batch that
# touches more is matched against all days from its first to its last one.
MAX_LISTED_DAYS = 1_000

COMPACTED = "compacted"

COLUMNS = tuple(S.READING.names)

# Files are sorted by sensor and time (behind the folders' columns, or the writer would sort
# by those anew and lose the rest), so row groups have narrow ranges of sensors; where a
# range holds a sensor that has no row, its Bloom filter says so.
_SKIPPING = {"parquet.bloom.filter.enabled#sensor_id": "true", "parquet.bloom.filter.expected.ndv#sensor_id": "100000"}


def ensure_history(spark: SparkSession, path: str) -> None:
    """Create the table folder; an existing table stays as it is."""
    (
        spark.createDataFrame([], S.HISTORY)
        .write.mode("ignore")
        .partitionBy("event_date", "batch")
        .parquet(path)
    )


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All stored readings with their partition columns."""
    return spark.read.schema(S.HISTORY).parquet(path)


def scan_range(spark: SparkSession, path: str, start: datetime, end: datetime) -> DataFrame:
    """Stored readings with ``start <= ts < end`` (naive UTC times)."""
    return between(scan(spark, path), start, end).select(*COLUMNS)


def between(history: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows with ``start <= ts < end``, reading only the days concerned.

    A range on ``ts`` does not prune folders of a derived date by itself, so
    the days are stated beside it.
    """
    low, high = (F.lit(t.isoformat(sep=" ") + "Z").cast("timestamp") for t in (start, end))
    days = F.col("event_date").between(F.lit(start.date()), F.lit(end.date()))
    return history.where(days & (F.col("ts") >= low) & (F.col("ts") < high))


def count_for(history: DataFrame, sensor_id: str) -> DataFrame:
    """How many readings of one sensor are stored."""
    return history.where(F.col("sensor_id") == sensor_id).agg(F.count(F.lit(1)).alias("count"))


def counts_by_sensor(history: DataFrame) -> DataFrame:
    return history.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("count"))


@dataclass(frozen=True)
class Days:
    """What a batch touches: its bounds in time, and its days unless there are too many."""

    first_us: int
    last_us: int
    listed: tuple[date, ...] = ()


def touched_days(offered: DataFrame, most: int = MAX_LISTED_DAYS) -> Days | None:
    """One job as a rule: the rows shrink to one for each day."""
    ends = F.unix_micros(F.min("ts")).alias("first"), F.unix_micros(F.max("ts")).alias("last")
    days = offered.where(F.col("ts").isNotNull()).groupBy(F.to_date("ts").alias("day")).agg(*ends)
    found = days.limit(most + 1).collect()
    if not found:
        return None
    if len(found) > most:
        both = offered.agg(*ends).first()
        return Days(both["first"], both["last"])
    return Days(min(d["first"] for d in found), max(d["last"] for d in found), tuple(sorted(d.day for d in found)))


def _stored_keys(spark: SparkSession, path: str, days: Days, batch: str) -> DataFrame:
    """Keys of other batches within the bounds: files of other times are skipped by their statistics."""
    reader = spark.read.schema(S.HISTORY).option("basePath", path)
    first, last = (F.timestamp_micros(F.lit(us)) for us in (days.first_us, days.last_us))
    if days.listed:
        # Listing only the touched folders keeps planning time independent of
        # the age of the table.
        names = ",".join(day.isoformat() for day in days.listed)
        try:
            rows = reader.parquet(f"{path}/event_date={{{names}}}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], S.READING).select(*READING_KEY)
    else:
        rows = reader.parquet(path).where(F.col("event_date").between(F.to_date(first), F.to_date(last)))
    return rows.where((F.col("batch") != batch) & F.col("ts").between(first, last)).select(*READING_KEY)


def append_ignore(spark: SparkSession, path: str, offered: DataFrame, batch: str) -> None:
    """Store each new ``(sensor_id, ts)`` once; keys already stored are skipped.

    ``offered`` has the reading columns plus ``partition`` and ``offset``; the
    first delivery of a key wins. Keep ``offered`` persisted: its days are read
    before its rows.
    """
    days = touched_days(offered)
    if days is None:
        return
    key = list(READING_KEY)
    first = first_by_position(offered).persist()
    new = None
    try:
        rows = first.count()
        stored = _stored_keys(spark, path, days, batch)
        if rows <= BROADCAST_ROWS:
            # A small batch against a big day: shrink the stored side to the
            # keys at stake instead of shuffling all of it.
            stored = stored.join(broadcast_if_small(first.select(*key), rows), key, "left_semi")
        new = not_stored(first, stored).withColumns(
            {"event_date": F.to_date("ts"), "batch": F.lit(batch)}
        ).persist()
        (
            spread(new, new.count(), "event_date", "batch", "sensor_id", "ts")
            .select(*S.HISTORY.names)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(**_SKIPPING)
            .partitionBy("event_date", "batch")
            .parquet(path)
        )
    finally:
        first.unpersist()
        if new is not None:
            new.unpersist()


def compact(spark: SparkSession, path: str, target: str, first: date | None = None, last: date | None = None) -> None:
    """Copy the days from ``first`` to ``last`` (all without them) to ``target``, each with its batches merged.

    Days that no batch will touch any more can be compacted while the writer goes on with
    others. The old table stays as it is; point readers and the writer at the copy once it
    is complete. A batch that is run again afterwards finds its rows stored and adds nothing.
    """
    rows = scan(spark, path).withColumn("batch", F.lit(COMPACTED))
    if first is not None:
        rows = rows.where(F.col("event_date") >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col("event_date") <= F.lit(last))
    (
        spread(rows, rows.count(), "event_date", "batch", "sensor_id", "ts")
        .write.mode("errorifexists")
        .options(**_SKIPPING)
        .partitionBy("event_date", "batch")
        .parquet(target)
    )
