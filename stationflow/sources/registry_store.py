"""The registry on disk: snapshots, and changes on top of the newest one.

A snapshot is a folder ``version=N`` that is written once. Upserts and removals are small
folders ``changes/version=N/number=M`` on top of it: readers merge them, and ``fold`` writes
the next snapshot when the changes outgrow it. One writer per registry.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow import schemas as S
from stationflow.operators.dedup import last_by
from stationflow.operators.registry import SENSOR_COLUMNS, from_stored, from_stored_strict, to_stored
from stationflow.operators.validation import SENSOR, Entity, valid_rows
from stationflow.sources import files

# Changes are folded into a new snapshot when they are so many times its rows.
OUTGROWN = 1.0

_STORED = tuple(S.STORED_SENSOR.names)
_CHANGE = ", ".join(f"`{name}` string" for name in _STORED) + ", removed boolean, seq bigint, number bigint"


def write_snapshot(sensors: DataFrame, path: str, version: int) -> None:
    """Write a version; an existing one is never overwritten.

    Writing a new folder lets the job read the version it replaces.
    """
    to_stored(sensors).write.mode("errorifexists").parquet(f"{path}/version={version}")


def current_version(spark: SparkSession, path: str) -> int | None:
    """The highest version that was written to its end; None if there is none.

    A folder without the writer's ``_SUCCESS`` mark is still being written or was left by
    a job that failed.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    marks = hadoop.Path(f"{path}/version=*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks) or []
    names = [status.getPath().getParent().getName().split("=", 1)[1] for status in found]
    return max((int(name) for name in names if name.isdecimal()), default=None)


def read_snapshot(spark: SparkSession, path: str, version: int, strict: bool = True) -> DataFrame:
    """Sensors of one version.

    Strict reading fails on a corrupt row. Otherwise corrupt rows come back
    with ``bad_field`` set.
    """
    stored = spark.read.schema(S.STORED_SENSOR).parquet(f"{path}/version={version}")
    return from_stored_strict(stored) if strict else from_stored(stored)


def _changes(spark: SparkSession, path: str, version: int) -> DataFrame:
    """Changes on top of a snapshot, with ``number`` and, within a change, ``seq``."""
    try:
        return spark.read.schema(_CHANGE).parquet(f"{path}/changes/version={version}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _CHANGE)


def _append(spark: SparkSession, path: str, rows: DataFrame) -> int:
    version = current_version(spark, path)
    if version is None:
        raise ValueError("write a first snapshot (it may be empty) before changes")
    folder = f"{path}/changes/version={version}"
    done = [name.split("=", 1)[1] for name in files.names(spark, folder) if name.startswith("number=")]
    done = [int(n) for n in done if "_SUCCESS" in files.names(spark, f"{folder}/number={n}")]
    number = max(done, default=0) + 1
    # A folder that a writer left unfinished has no mark: it is written over.
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/number={number}")
    return number


def append_upserts(spark: SparkSession, path: str, changes: DataFrame, seq: str = "seq", entity: Entity = SENSOR) -> int:
    """Add a batch of registrations; the last valid one of each id counts. Returns the number of the change.

    Only the batch is written, whatever the size of the registry.
    """
    order = F.col(seq).cast("bigint").alias("_seq")
    last = last_by(valid_rows(changes, entity).select(*SENSOR_COLUMNS, order), "id", "_seq")
    stored = to_stored(last.select(*SENSOR_COLUMNS))
    return _append(spark, path, stored.select(*_STORED, F.lit(False).alias("removed"), F.lit(0).cast("bigint").alias("seq")))


def append_removals(spark: SparkSession, path: str, ids: DataFrame) -> int:
    """Remove ids; unknown ones change nothing. Returns the number of the change."""
    none = [F.lit(None).cast("string").alias(name) for name in _STORED if name != "id"]
    gone = ids.select("id").distinct().select("id", *none, F.lit(True).alias("removed"), F.lit(0).cast("bigint").alias("seq"))
    return _append(spark, path, gone.select(*_STORED, "removed", "seq"))


def _current_stored(spark: SparkSession, path: str, version: int) -> DataFrame:
    base = spark.read.schema(S.STORED_SENSOR).parquet(f"{path}/version={version}")
    # Change files without the writer's mark belong to no change.
    folder = f"{path}/changes/version={version}"
    whole = [n.split("=", 1)[1] for n in files.names(spark, folder) if n.startswith("number=")]
    whole = [int(n) for n in whole if "_SUCCESS" in files.names(spark, f"{folder}/number={n}")]
    if not whole:
        return base
    last = last_by(_changes(spark, path, version).where(F.col("number").isin(whole)), "id", "number")
    kept = base.join(last.select("id"), "id", "left_anti").select(*_STORED)
    return kept.unionByName(last.where(~F.col("removed")).select(*_STORED))


def read_current(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """The registry as it is now: the newest snapshot with its changes merged in."""
    version = current_version(spark, path)
    if version is None:
        return spark.createDataFrame([], S.SENSOR)
    stored = _current_stored(spark, path, version)
    return from_stored_strict(stored) if strict else from_stored(stored)


def fold(spark: SparkSession, path: str, outgrown: float = OUTGROWN) -> int | None:
    """Write the next snapshot if the changes have more than ``outgrown`` times the rows of this one.

    Returns its version, or None. A fold that broke off left a folder without a mark; readers
    pass over it, and the next fold writes the version after it.
    """
    version = current_version(spark, path)
    if version is None:
        return None
    base = spark.read.schema(S.STORED_SENSOR).parquet(f"{path}/version={version}").count()
    if _changes(spark, path, version).count() <= outgrown * base:
        return None
    taken = [int(n.split("=", 1)[1]) for n in files.names(spark, path) if n.startswith("version=")]
    following = max(taken) + 1
    _current_stored(spark, path, version).write.mode("errorifexists").parquet(f"{path}/version={following}")
    return following
