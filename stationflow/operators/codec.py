"""JSON payloads to typed events and back.

Decoding is strict: one JSON object per payload, numbers only where numbers
belong, times only as RFC 3339 text. ``from_json`` is laxer than that, so the
payload goes through Spark's variant parser, and each field's type is checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.functions.fields import fields_of, zero_value
from stationflow.functions.times import format_rfc3339, parse_rfc3339
from stationflow.operators.validation import Entity, first_code, first_reason

BAD_JSON = "unmarshal: invalid JSON"
NOT_OBJECT = "unmarshal: not a JSON object"

_KINDS = {
    "string": "a string",
    "double": "a number",
    "int": "a whole number",
    "bigint": "a whole number",
    "timestamp": "an RFC 3339 time",
    "binary": "base64 text",
}


def _parse(text: Column) -> Column:
    """Variant array ``[payload, hash]``; NULL unless the text parses.

    The variant parser stops at the end of the first value and ignores what
    follows. Closing the array with a hash of the payload shows whether the
    payload was exactly one value: anything else moves or drops the hash.
    """
    return F.try_parse_json(
        F.concat(F.lit("["), text, F.lit(","), F.xxhash64(text).cast("string"), F.lit("]"))
    )


# JSON text of a value of each type, as this package's encoder writes it. Kept
# narrow on purpose: no escapes, no exponents, no more digits than always fit.
_NUMBER = r"-?(?:0|[1-9][0-9]{0,15})"
_PLAIN = {
    "string": r'"[^"\\\p{Cntrl}]*"',
    "double": _NUMBER + r"(?:\.[0-9]{1,17})?",
    "int": r"-?(?:0|[1-9][0-9]{0,8})",
    "bigint": _NUMBER,
    "timestamp": r'"[0-9T:.-]+Z"',
    "binary": r'"[A-Za-z0-9+/=]*"',
}


def _plain_form(entity: Entity) -> str:
    """Pattern of a payload with exactly the entity's fields in their order."""
    fields = [f'"{f.name}":{_PLAIN[f.dataType.simpleString()]}' for f in entity.schema.fields]
    return r"^\{" + ",".join(fields) + r"\}\z"


def _wanted(spec: T.StructField) -> str:
    kind = spec.dataType.simpleString()
    return kind if kind in ("double", "int", "bigint") else "string"


def _raw(spec: T.StructField) -> Column:
    """The field as the parser holds it; NULL when absent or of no use."""
    found = F.try_variant_get("_variant", f"$[0].{spec.name}", _wanted(spec))
    return F.when(F.col("_is_plain"), F.col(f"_plain.{spec.name}")).otherwise(found)


def _kind(spec: T.StructField) -> Column:
    """Type name of the field: NULL for absent, VOID for an explicit null."""
    plain = {"double": "DOUBLE", "int": "BIGINT", "bigint": "BIGINT"}.get(_wanted(spec), "STRING")
    found = F.schema_of_variant(F.try_variant_get("_variant", f"$[0].{spec.name}", "variant"))
    return F.when(F.col("_is_plain"), F.lit(plain)).otherwise(found)


def _typed(spec: T.StructField) -> Column:
    raw = F.col(f"_raw_{spec.name}")
    kind = spec.dataType.simpleString()
    if kind == "timestamp":
        return parse_rfc3339(raw)
    if kind == "binary":
        return F.try_to_binary(raw, F.lit("base64"))
    return raw


def _is_wrong(spec: T.StructField) -> Column:
    """True when the field is set and is not of its type."""
    found, value = F.col(f"_kind_{spec.name}"), F.col(f"_value_{spec.name}")
    kind = spec.dataType.simpleString()
    if kind == "double":
        # A number too large for a double comes out as infinity.
        fits = found.isin("BIGINT", "DOUBLE") | F.startswith(found, F.lit("DECIMAL"))
        fits = fits & (F.abs(value) != F.lit(float("inf")))
    elif kind in ("int", "bigint"):
        fits = found == "BIGINT"
    else:
        fits = found == "STRING"
    return found.isNotNull() & (found != "VOID") & ~(fits & value.isNotNull())


def decode(df: DataFrame, entity: Entity, value: str = "value") -> DataFrame:
    """Add ``event`` (a struct of the entity's fields) and ``reason``.

    ``event`` is NULL for a payload that does not decode. ``reason`` is NULL
    for a valid event, ``unmarshal: ...`` for a payload that does not decode and
    ``validate: ...`` for an event that breaks a rule; ``reason_code`` is its
    class. Bytes that are not UTF-8 are replaced, as JSON readers do; unknown
    keys are ignored; absent keys give zero values.

    A payload in the plain form of the encoder needs no checks, and ``from_json``
    reads it; any other goes through the variant parser. The work is cut into
    several projections on purpose: each becomes a method small enough for the
    JVM to compile, which one big projection would not.
    """
    fields = entity.schema.fields
    kept = df.columns
    text = F.col("_text")
    reader = ", ".join(f"`{spec.name}` {_wanted(spec)}" for spec in fields)
    parsed = (
        df.withColumn("_text", F.make_valid_utf8(F.col(value).cast("string")))
        .withColumn("_is_plain", F.coalesce(text.rlike(_plain_form(entity)), F.lit(False)))
        .withColumns(
            {
                "_plain": F.when(F.col("_is_plain"), F.from_json(text, reader)),
                "_variant": F.when(~F.col("_is_plain"), _parse(text)),
            }
        )
    )
    whole = F.try_variant_get("_variant", "$[1]", "bigint") == F.xxhash64("_text")
    found = parsed.select(
        *kept,
        (F.col("_is_plain") | F.coalesce(whole, F.lit(False))).alias("_whole"),
        # A payload that parses shows its type in its first character.
        F.substring(F.ltrim("_text", F.lit(" \t\r\n")), 1, 1).alias("_first"),
        *[_raw(spec).alias(f"_raw_{spec.name}") for spec in fields],
        *[_kind(spec).alias(f"_kind_{spec.name}") for spec in fields],
    )
    typed = found.withColumns({f"_value_{spec.name}": _typed(spec) for spec in fields})
    failure = F.coalesce(
        F.when(~F.col("_whole"), F.lit(BAD_JSON)),
        # A JSON null is a no-op: every field keeps its zero value.
        F.when(~F.col("_first").isin("{", "n"), F.lit(NOT_OBJECT)),
        *[
            F.when(
                _is_wrong(spec),
                F.lit(f"unmarshal: field {spec.name} is not {_KINDS[spec.dataType.simpleString()]}"),
            )
            for spec in fields
        ],
    )
    event = F.struct(
        *[
            F.coalesce(F.col(f"_value_{spec.name}"), zero_value(spec.dataType))
            .cast(spec.dataType)
            .alias(spec.name)
            for spec in fields
        ]
    )
    row = F.struct(event.alias("event"), failure.alias("_failure"))
    # inline() keeps the optimizer from copying the parse into every filter
    # that later looks at the decoded columns.
    decoded = typed.select(*kept, row.alias("_row")).select(*kept, F.inline(F.array("_row")))
    at = fields_of("event")
    failed = F.col("_failure").isNotNull()
    return decoded.select(
        *kept,
        F.when(~failed, F.col("event")).alias("event"),
        F.coalesce(
            F.col("_failure"), F.concat(F.lit("validate: "), first_reason(entity.rules, at))
        ).alias("reason"),
        F.when(failed, F.lit("unmarshal")).otherwise(first_code(entity.rules, at)).alias("reason_code"),
    )


_WIRE: dict[str, Callable[[Column], Column]] = {"timestamp": format_rfc3339}


def encode(entity: Entity, struct: str | None = None) -> Column:
    """JSON text with exactly the entity's fields; bytes become base64."""
    at = fields_of(struct)
    return F.to_json(
        F.struct(
            *[
                _WIRE.get(f.dataType.simpleString(), lambda c: c)(at(f.name)).alias(f.name)
                for f in entity.schema.fields
            ]
        ),
        {"ignoreNullFields": "false"},
    )


def normalise(df: DataFrame, entity: Entity, value: str = "value") -> DataFrame:
    """Decode, keep valid events, encode again: unknown keys are dropped."""
    return (
        decode(df, entity, value)
        .where(F.col("reason").isNull())
        .withColumn(value, encode(entity, "event").cast("binary"))
        .drop("event", "reason", "reason_code")
    )


def with_wire_size(df: DataFrame, limit: int, value: str = "value") -> DataFrame:
    """Add the encoded size in bytes and whether it keeps within ``limit``."""
    size = F.octet_length(value)
    return df.withColumns({"wire_bytes": size, "within_budget": size <= limit})
