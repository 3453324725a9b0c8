"""RFC 3339 text and the zero time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strict form: capital T and Z, two-digit fields, offset hours up to 23.
RFC3339 = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?"
    r"(Z|[+-]([01][0-9]|2[0-3]):[0-5][0-9])$"
)

ZERO_TIME = "0001-01-01 00:00:00"

# Seconds from year 1 to 1970; window boundaries count from year 1.
YEAR_ONE_SECONDS = 62_135_596_800


def zero_time() -> Column:
    return F.lit(ZERO_TIME).cast("timestamp")


def parse_rfc3339(text: Column) -> Column:
    """Text to timestamp; NULL unless the text is strict RFC 3339.

    Digits below a microsecond are cut. Text in UTC is cast as it stands. Other
    offsets are subtracted by hand because Spark stops at 18 hours.
    """
    local = F.concat(F.substring(text, 1, 10), F.lit(" "), F.regexp_extract(text, r"T([0-9:.]+)", 1))
    sign = F.when(F.substring(text, -6, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    minutes = F.substring(text, -5, 2).try_cast("int") * 60 + F.substring(text, -2, 2).try_cast("int")
    shifted = F.timestamp_micros(
        F.unix_micros(F.concat(local, F.lit("Z")).try_cast("timestamp"))
        - (sign * minutes).cast("bigint") * F.lit(60_000_000)
    )
    return F.when(
        text.rlike(RFC3339),
        F.when(F.endswith(text, F.lit("Z")), text.try_cast("timestamp")).otherwise(shifted),
    )


def format_rfc3339(ts: Column) -> Column:
    """Timestamp to UTC text with the shortest fraction (session zone is UTC)."""
    return F.concat(F.translate(ts.cast("string"), " ", "T"), F.lit("Z"))


def micros(span: timedelta) -> int:
    return (span.days * 86_400 + span.seconds) * 1_000_000 + span.microseconds


def interval(span: timedelta) -> Column:
    """A literal interval, added to or taken from timestamps."""
    return F.expr(f"INTERVAL '{micros(span) // 1_000_000}.{micros(span) % 1_000_000:06d}' SECOND")


def window_origin(size: timedelta) -> int:
    """Microseconds after 1970 of a boundary when windows count from year 1."""
    return (-YEAR_ONE_SECONDS * 1_000_000) % micros(size)
