"""Typed access to the fields of an event, with absent values filled in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.functions.times import zero_time

Fields = Callable[[str], Column]


def zero_value(kind: T.DataType) -> Column:
    """The value an absent or null field has: '', 0 or the zero time."""
    if isinstance(kind, T.TimestampType):
        return zero_time()
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BinaryType):
        return F.lit(None).cast("binary")
    return F.lit(0).cast(kind)


def fields_of(struct: str | None = None) -> Fields:
    """Field access on flat columns, or inside the struct column ``struct``."""
    return lambda name: F.col(f"{struct}.{name}" if struct else name)


def fill_absent(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Replace NULL in the columns of ``schema`` by the zero value."""
    return df.withColumns(
        {f.name: F.coalesce(F.col(f.name), zero_value(f.dataType)) for f in schema.fields}
    )
