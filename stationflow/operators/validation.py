"""Ordered validation rules.

Each entity has a list of rules. A row is judged by the first rule it breaks;
its message is the reason, its code the class used for counting. Rules are
plain Columns, so they stay inside whole-stage codegen.

Messages and codes are fixed values of the contract.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow import schemas as S
from stationflow.functions.durations import format_duration
from stationflow.functions.fields import Fields, fields_of, fill_absent
from stationflow.functions.numbers import fixed_decimals
from stationflow.functions.times import format_rfc3339, zero_time


@dataclass(frozen=True)
class Rule:
    code: str
    broken: Callable[[Fields], Column]
    message: Callable[[Fields], Column]


@dataclass(frozen=True)
class Entity:
    """What an event type needs: field types, rules, and its topic key."""

    name: str
    schema: T.StructType
    key: str
    rules: tuple[Rule, ...] = field(default=())


def first_reason(rules: tuple[Rule, ...], at: Fields) -> Column:
    """Message of the first broken rule, NULL for a valid row."""
    return F.coalesce(*[F.when(r.broken(at), r.message(at)) for r in rules])


def first_code(rules: tuple[Rule, ...], at: Fields) -> Column:
    return F.coalesce(*[F.when(r.broken(at), F.lit(r.code)) for r in rules])


def _text(message: str) -> Callable[[Fields], Column]:
    return lambda at: F.lit(message)


def _outside(value: Column, low: float, high: float) -> Column:
    # Spark orders NaN above every number, so say what is meant.
    return F.isnan(value) | (value < low) | (value > high)


def reading_rules(limits: S.Limits = S.Limits()) -> tuple[Rule, ...]:
    return (
        Rule("missing_id", lambda at: at("sensor_id") == "", _text("sensor id is required")),
        Rule("missing_time", lambda at: at("ts") == zero_time(), _text("timestamp is required")),
        *_place_rules(limits, "temp_c"),
    )


def _place_rules(limits: S.Limits, temp_field: str) -> tuple[Rule, ...]:
    return (
        Rule(
            "temperature",
            lambda at: _outside(at(temp_field), limits.min_temp_c, limits.max_temp_c),
            lambda at: F.concat(
                F.lit("temperature out of plausible range: "), fixed_decimals(at(temp_field), 1), F.lit("°C")
            ),
        ),
        Rule(
            "coordinates",
            lambda at: _outside(at("lat"), limits.min_lat, limits.max_lat)
            | _outside(at("lon"), limits.min_lon, limits.max_lon),
            lambda at: F.concat(
                F.lit(f"coordinates outside {limits.region}: ("),
                fixed_decimals(at("lat"), 4),
                F.lit(", "),
                fixed_decimals(at("lon"), 4),
                F.lit(")"),
            ),
        ),
    )


def aggregate_rules() -> tuple[Rule, ...]:
    return (
        Rule("missing_scope", lambda at: at("scope") == "", _text("scope is required")),
        Rule(
            "window",
            lambda at: at("window_end") <= at("window_start"),
            lambda at: F.concat(
                F.lit("window end must be after start: start "),
                format_rfc3339(at("window_start")),
                F.lit(", end "),
                format_rfc3339(at("window_end")),
            ),
        ),
        Rule("empty_window", lambda at: at("count") <= 0, _text("aggregate of zero readings")),
        Rule(
            "min_over_max",
            lambda at: ~F.isnan(at("min_temp_c")) & (at("min_temp_c") > at("max_temp_c")),
            lambda at: F.concat(
                F.lit("min "),
                fixed_decimals(at("min_temp_c"), 1),
                F.lit(" exceeds max "),
                fixed_decimals(at("max_temp_c"), 1),
            ),
        ),
    )


def dead_letter_rules() -> tuple[Rule, ...]:
    return (
        Rule("missing_topic", lambda at: at("source_topic") == "", _text("source topic is required")),
        Rule("missing_reason", lambda at: at("reason") == "", _text("reason is required")),
        Rule(
            "missing_failed_at",
            lambda at: at("failed_at") == zero_time(),
            lambda at: F.concat(
                F.lit("dead letter from "), at("source_topic"), F.lit(": failed_at timestamp is required")
            ),
        ),
    )


def sensor_rules(limits: S.Limits = S.Limits()) -> tuple[Rule, ...]:
    low, high = (f"{ns // 1_000_000_000}s" for ns in (limits.min_interval_ns, limits.max_interval_ns))
    return (
        Rule("missing_id", lambda at: at("id") == "", _text("sensor id is required")),
        *_place_rules(limits, "start_temp_c"),
        Rule(
            "pattern",
            lambda at: ~is_known_pattern(at("pattern")),
            lambda at: F.concat(
                F.lit('unknown drift pattern: "'),
                at("pattern"),
                F.lit('" (want steady, rising, falling or noisy)'),
            ),
        ),
        Rule(
            "interval",
            lambda at: (at("interval_ns") < limits.min_interval_ns)
            | (at("interval_ns") > limits.max_interval_ns),
            lambda at: F.concat(
                F.lit(f"interval outside {low}-{high}: got "), format_duration(at("interval_ns"))
            ),
        ),
    )


def is_known_pattern(pattern: Column) -> Column:
    return pattern.isin(*S.PATTERNS)


def reading_entity(limits: S.Limits = S.Limits()) -> Entity:
    return Entity("reading", S.READING, "sensor_id", reading_rules(limits))


def sensor_entity(limits: S.Limits = S.Limits()) -> Entity:
    return Entity("sensor", S.SENSOR, "id", sensor_rules(limits))


READING = reading_entity()
AGGREGATE = Entity("aggregate", S.AGGREGATE, "scope", aggregate_rules())
DEAD_LETTER = Entity("dead_letter", S.DEAD_LETTER, "source_topic", dead_letter_rules())
SENSOR = sensor_entity()


def validate(df: DataFrame, entity: Entity) -> DataFrame:
    """Add ``reason`` and ``reason_code`` to rows holding the entity's columns.

    NULL in an entity column counts as absent and becomes the zero value.
    """
    at = fields_of()
    return fill_absent(df, entity.schema).withColumns(
        {"reason": first_reason(entity.rules, at), "reason_code": first_code(entity.rules, at)}
    )


def valid_rows(df: DataFrame, entity: Entity) -> DataFrame:
    """Only the rows that break no rule, without the two reason columns."""
    filled = fill_absent(df, entity.schema)
    broken = F.lit(False)
    for rule in entity.rules:
        broken = broken | rule.broken(fields_of())
    return filled.where(~broken)
