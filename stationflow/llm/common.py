"""Helpers the text operators share: reliable cut points, row order, Arrow batches."""

from __future__ import annotations

import contextlib
import sys
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from stationflow.session import CHECKPOINT_DIR_KEY

# Functions of this package travel with the job: executors need no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

BATCH_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000
READ_ROWS_KEY = "spark.sql.parquet.columnarReaderBatchSize"
READ_ROWS = 256
#: Rows of a file of a checkpoint whose size is known, and files that are not too many for any.
FILE_ROWS, FILES = 50_000, 48
#: Bits that monotonically_increasing_id() uses for the place within a partition.
PLACE_BITS = 33


def checkpointed(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    The folder is the one ``spark.checkpoint.dir`` names. Only a local master without
    that setting gets a temporary folder. ``rows`` (at most so many short ones) lets partitions of
    a few rows share a file: on a local file system each file starts several child processes.
    """
    use_checkpoint_dir(df.sparkSession)
    if rows is not None:
        df = df.coalesce(max(FILES, -(-rows // FILE_ROWS)))
    return df.checkpoint()


def use_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get(CHECKPOINT_DIR_KEY, None)
    if not folder:
        if not context.master.startswith("local") or "cluster" in context.master:
            raise ValueError(f"set {CHECKPOINT_DIR_KEY} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    context.setCheckpointDir(folder)


def packed(names: list[str]) -> Column:
    """The named columns as one struct: whatever their names, none meets a column of an operator."""
    return F.struct(*[F.col(f"`{name}`") for name in names]) if names else F.struct(F.lit(0).alias("none"))


def unpacked(names: list[str], column: str = "_kept") -> list[Column]:
    """The columns of a struct that ``packed`` made."""
    return [F.col(f"{column}.`{name}`").alias(name) for name in names]


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add."""
    taken = {name.lower() for name in names}
    return df.drop(*[name for name in df.columns if name.lower() in taken])


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """Sort all rows and mark each with its place: ``_part`` (sorted range) and ``_at`` (place in it).

    Ranges are cut between any two rows, equal ones too, so a key that many rows share
    spreads over several of them. The result is written once: both marks stay as they are.
    """
    marked = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "_tie")
        .sortWithinPartitions(*keys, "_tie")
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", PLACE_BITS))
        .withColumn("_at", F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
        .drop("_place")
    )
    return checkpointed(marked)


def before(parts: DataFrame, value: Column) -> Column:
    """``value`` aggregated over all earlier ranges; ``parts`` has one row for each range."""
    return value.over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch: whole texts are long rows."""
    if int(spark.conf.get(BATCH_ROWS_KEY)) > BATCH_ROWS:
        spark.conf.set(BATCH_ROWS_KEY, str(BATCH_ROWS))


def small_reads(spark: SparkSession) -> None:
    """Lower the session's rows per Parquet batch, for whole texts that are read after the caller has returned."""
    if int(spark.conf.get(READ_ROWS_KEY)) > READ_ROWS:
        spark.conf.set(READ_ROWS_KEY, str(READ_ROWS))


@contextlib.contextmanager
def short_reads(spark: SparkSession) -> Iterator[None]:
    """What runs inside reads Parquet in batches of few rows: the texts of a batch lie in one array on the heap."""
    rows = spark.conf.get(READ_ROWS_KEY)
    spark.conf.set(READ_ROWS_KEY, str(min(int(rows), READ_ROWS)))
    try:
        yield
    finally:
        spark.conf.set(READ_ROWS_KEY, rows)


def with_columns(
    df: DataFrame,
    reads: list[str],
    added: StructType,
    make: Callable[[Iterator[dict]], Iterator[dict]],
    regroup: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None,
) -> DataFrame:
    """Add columns that Python computes, one Arrow batch at a time.

    ``make`` gets the batches as dicts of the columns in ``reads`` and yields one dict of
    the columns in ``added`` for each. A column that exists already is replaced in place.
    ``regroup`` may cut the stream of batches anew first.
    """
    small_batches(df.sparkSession)
    fresh = {field.name.lower(): field for field in added}
    fields = [fresh.pop(field.name.lower(), field) for field in df.schema] + list(fresh.values())
    made = set(added.names)
    names = [field.name for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def inputs():
            for batch in regroup(batches) if regroup else batches:
                held.append(batch)
                yield {name: batch.column(batch.schema.get_field_index(name)) for name in reads}

        for out in make(inputs()):
            batch = held.pop(0)
            columns = [
                out[name] if name in made else batch.column(batch.schema.get_field_index(name)) for name in names
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, StructType(fields))


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null reads as the empty text."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    return [value or "" for value in column.to_pylist()]
