"""Checked broadcasts and even writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side may hold at most this many narrow rows (about 20 MB of keys).
BROADCAST_ROWS = 250_000

# Rows per output file, and so per writing task: some tens of megabytes.
ROWS_PER_FILE = 1_000_000


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when its counted rows stay under the limit.

    Above it the frame comes back unmarked and Spark shuffles both sides.
    """
    return F.broadcast(df) if rows <= limit else df


def spread(df: DataFrame, rows: int, *order: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Cut ``rows`` rows into even, ordered pieces for a partitioned write.

    Range partitioning on a unique order gives pieces of equal size whatever day
    or sensor dominates, and every file covers a narrow range of the order, so
    its statistics let later scans skip it.
    """
    files = max(1, -(-rows // rows_per_file))
    placed = df.coalesce(1) if files == 1 else df.repartitionByRange(files, *order)
    return placed.sortWithinPartitions(*order)
