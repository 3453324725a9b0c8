"""First row per key, and inserts that ignore keys already stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

READING_KEY = ("sensor_id", "ts")

_OFFSET_BITS = 47


def _position(partition: str, offset: str) -> Column:
    """(partition, offset) as one ordered bigint; an error if it does not fit."""
    p, o = F.col(partition).cast("bigint"), F.col(offset).cast("bigint")
    fits = p.between(0, 2 ** (63 - _OFFSET_BITS) - 1) & o.between(0, 2**_OFFSET_BITS - 1)
    return F.when(fits, F.shiftleft(p, _OFFSET_BITS) + o).otherwise(
        F.raise_error(F.lit("position does not fit 16 + 47 bits: pass packed=False"))
    )


def first_by_position(
    df: DataFrame,
    key: Sequence[str] = READING_KEY,
    values: Sequence[str] = ("lat", "lon", "temp_c"),
    position: tuple[str, str] = ("partition", "offset"),
    packed: bool = True,
) -> DataFrame:
    """The row delivered first for each key.

    An aggregate rather than a ranking window: copies of one key shrink to one
    row inside each map task, so a key that holds a third of all rows never
    meets in one task. With the position packed into a bigint the buffers are
    fixed-width and Spark hashes; ``packed=False`` takes any position and sorts.
    """
    if packed:
        return (
            df.select(*key, *values, _position(*position).alias("_at"))
            .groupBy(*key)
            .agg(*[F.min_by(F.col(v), F.col("_at")).alias(v) for v in values])
        )
    first = F.min(F.struct(*position, *values)).alias("_first")
    return df.groupBy(*key).agg(first).select(*key, *[F.col(f"_first.{v}").alias(v) for v in values])


def last_by(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` (bigint) of each key; of equal ones the one with the greatest hash.

    Both maxima are fixed-width, so Spark hashes: no row is sorted. Rows alike in all
    columns are one.
    """
    rows = rows.withColumn("_hash", F.xxhash64(*[F.col(name) for name in rows.columns]))
    top = rows.groupBy(key).agg(F.max(order).alias("_top"))
    upmost = rows.join(top, key).where(F.col(order).eqNullSafe(F.col("_top"))).drop("_top")
    one = upmost.groupBy(key).agg(F.max("_hash").alias("_one"))
    return upmost.join(one, key).where(F.col("_hash") == F.col("_one")).drop("_hash", "_one").distinct()


def not_stored(new: DataFrame, stored: DataFrame, key: Sequence[str] = READING_KEY) -> DataFrame:
    """New rows whose key is not stored yet.

    An outer join and a test for no match. Spark would move an anti join below
    the aggregate that made ``new``, and so bring all copies of a hot key
    together; an outer join stays above it and uses its partitioning.
    """
    known = stored.select(*key, F.lit(True).alias("_stored"))
    return new.join(known, list(key), "left_outer").where(F.col("_stored").isNull()).drop("_stored")


def insert_ignore(
    stored: DataFrame, offered: DataFrame, key: Sequence[str] = READING_KEY
) -> DataFrame:
    """Rows to append so that every key is kept once and stored rows win."""
    return not_stored(first_by_position(offered, key), stored, key)
