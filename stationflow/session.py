"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"

_REQUIRED = {
    # Wire times are written in UTC, and date partitions are UTC days.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of spoiling the payload.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Times in files get statistics, so that scans can skip by them.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator in this package assumes."""
    for key, value in _REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB: off the heap, and needed by timers."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Without the setting only a
    local master (tests, one machine) gets a temporary folder.
    """
    base = spark.conf.get(CHECKPOINT_DIR_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError(f"set {CHECKPOINT_DIR_KEY} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base.rstrip('/')}/stationflow/{name}-{uuid.uuid4().hex}"
