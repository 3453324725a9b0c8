"""Number text and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOAT_TEXT = r"^[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))$|^(?i:nan)$"


def round_half_away(value: Column, digits: int = 2) -> Column:
    """Scale, round to a whole number with halves away from zero, scale back.

    ``round(value, 2)`` is not the same: Spark rounds the shortest decimal text
    of the double there, so 1.005 becomes 1.01. Scaling first gives 1.0.
    Adding 0.0 turns a negative zero into zero.
    """
    factor = float(10**digits)
    return F.round(value * F.lit(factor), 0) / F.lit(factor) + F.lit(0.0)


def fixed_decimals(value: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, rounding the exact binary value.

    ``format_string('%.1f')`` rounds the shortest decimal text half up (61.15
    becomes 61.2); ``format_number`` with a pattern rounds the stored value.
    """
    pattern = "0." + "0" * digits
    infinity = F.lit(float("inf"))
    return (
        F.when(F.isnan(value), F.lit("NaN"))
        .when(value == infinity, F.lit("+Inf"))
        .when(value == -infinity, F.lit("-Inf"))
        .otherwise(F.call_function("format_number", value, F.lit(pattern)))
    )


def parse_float(text: Column) -> Column:
    """Text to double; NULL for anything that is not a plain decimal float.

    Spark's cast also takes blanks around a number and a type suffix (``1.0d``)
    and turns overflow into infinity; all three are NULL here.
    """
    number = text.try_cast("double")
    overflow = (F.abs(number) == F.lit(float("inf"))) & text.rlike("[0-9]")
    return F.when(text.rlike(FLOAT_TEXT) & ~overflow, number)


def float_text(value: Column) -> Column:
    """Double to text that casts back to the same double."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")
