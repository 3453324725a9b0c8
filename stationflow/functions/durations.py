"""Duration text such as ``5s``, ``1m30s`` or ``-1.5h``, held as nanoseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names and their length in nanoseconds. Both micro signs.
UNIT_NANOS = {
    "ns": 1,
    "us": 1_000,
    "µs": 1_000,
    "μs": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60_000_000_000,
    "h": 3_600_000_000_000,
}

_UNITS = "|".join(UNIT_NANOS)
_TERM = rf"([0-9]+(\.[0-9]*)?|\.[0-9]+)({_UNITS})"
_DURATION = rf"^[+-]?(0|({_TERM})+)$"
_MAX = 2**63 - 1


def _term_nanos(piece: Column) -> Column:
    """One number with its unit, such as ``1.5h``, in nanoseconds."""
    number = F.regexp_extract(piece, "^[0-9.]+", 0)
    nanos = F.element_at(
        F.create_map(*[F.lit(part) for item in UNIT_NANOS.items() for part in item]),
        F.regexp_extract(piece, "[^0-9.]+$", 0),
    )
    whole = F.concat(F.lit("0"), F.regexp_extract(number, "^[0-9]*", 0)).try_cast("decimal(20,0)")
    # Eighteen digits are more than a nanosecond of any unit needs.
    digits = F.regexp_extract(number, r"\.([0-9]{0,18})", 1)
    part = F.concat(F.lit("0"), digits).cast("double") * (
        nanos.cast("double") / F.pow(F.lit(10.0), F.length(digits).cast("double"))
    )
    return (whole * nanos.cast("decimal(14,0)") + F.floor(part).cast("decimal(14,0)")).cast("decimal(38,0)")


def parse_duration(text: Column) -> Column:
    """Text to nanoseconds (bigint); NULL when it is not a duration."""
    zero = F.lit(0).cast("decimal(38,0)")
    negative = F.startswith(text, F.lit("-"))

    def signed(total: Column) -> Column:
        most = F.lit(_MAX).cast("decimal(38,0)") + F.when(negative, F.lit(1)).otherwise(F.lit(0))
        return F.when(total <= most, F.when(negative, -total).otherwise(total).cast("bigint"))

    # The lambdas name each intermediate value once, however often it is used.
    total = F.aggregate(
        F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)),
        zero,
        lambda sum_, piece: (sum_ + _term_nanos(piece)).cast("decimal(38,0)"),
        signed,
    )
    return F.when(text.rlike(_DURATION), total)


def _whole(value: Column, divisor: int) -> Column:
    """Integer division towards zero."""
    return F.call_function("div", value, F.lit(divisor))


def _trimmed(value: Column, digits: int) -> Column:
    """``value`` (a bigint, not negative) over 10**digits, without trailing zeros."""
    scale = 10**digits
    text = F.format_string(f"%d.%0{digits}d", _whole(value, scale), value % scale)
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def format_duration(nanos: Column) -> Column:
    """Nanoseconds to text: ``0s``, ``500ms``, ``1.5s``, ``1m30s``, ``1h0m0s``."""
    second, minute, hour = (UNIT_NANOS[unit] for unit in ("s", "m", "h"))

    def text(size: Column) -> Column:
        # Parts first, sign after: the most negative bigint has no abs.
        hours, minutes, rest = (
            F.abs(part) for part in (_whole(size, hour), _whole(size % hour, minute), size % minute)
        )
        below_second = (
            F.when(size == 0, F.lit("0s"))
            .when(rest < UNIT_NANOS["us"], F.concat(rest.cast("string"), F.lit("ns")))
            .when(rest < UNIT_NANOS["ms"], F.concat(_trimmed(rest, 3), F.lit("µs")))
            .otherwise(F.concat(_trimmed(rest, 6), F.lit("ms")))
        )
        long = F.concat(
            F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h"))).otherwise(F.lit("")),
            F.when((hours > 0) | (minutes > 0), F.concat(minutes.cast("string"), F.lit("m"))).otherwise(
                F.lit("")
            ),
            _trimmed(rest, 9),
            F.lit("s"),
        )
        short = (hours == 0) & (minutes == 0) & (rest < second)
        sign = F.when(size < 0, F.lit("-")).otherwise(F.lit(""))
        return F.concat(sign, F.when(short, below_second).otherwise(long))

    # A lambda binds the value once; the expression above uses it many times.
    bound = F.element_at(F.transform(F.array(nanos.cast("bigint")), text), 1)
    return F.when(nanos.isNotNull(), bound)
