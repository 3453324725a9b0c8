"""The sensor registry: registration, snapshots, upserts, removals and diffs.

A registry is a table with one row per sensor. Changes make a new table; the
old one is never edited in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow import schemas as S
from stationflow.functions.durations import format_duration, parse_duration
from stationflow.functions.fields import fields_of
from stationflow.functions.numbers import float_text, parse_float
from stationflow.functions.times import format_rfc3339, parse_rfc3339
from stationflow.operators.dedup import last_by
from stationflow.operators.validation import SENSOR, Entity, first_code, first_reason, valid_rows

SENSOR_COLUMNS = tuple(S.SENSOR.names)


def to_stored(sensors: DataFrame) -> DataFrame:
    """Sensors as the all-text rows the registry keeps."""
    return sensors.select(
        "id",
        *[float_text(F.col(c)).alias(c) for c in ("lat", "lon", "start_temp_c")],
        "pattern",
        format_duration(F.col("interval_ns")).alias("interval"),
        format_rfc3339(F.col("created_at")).alias("created_at"),
    )


def from_stored(stored: DataFrame) -> DataFrame:
    """Typed sensors plus ``bad_field``, the first field that does not parse.

    Quarantine form: a corrupt row keeps its id and says what is wrong.
    """
    parsed = {
        "lat": parse_float(F.col("lat")),
        "lon": parse_float(F.col("lon")),
        "start_temp_c": parse_float(F.col("start_temp_c")),
        "interval": parse_duration(F.col("interval")),
        "created_at": parse_rfc3339(F.col("created_at")),
    }
    bad = F.coalesce(*[F.when(value.isNull(), F.lit(name)) for name, value in parsed.items()])
    return stored.select(
        F.coalesce(F.col("id"), F.lit("")).alias("id"),
        parsed["lat"].alias("lat"),
        parsed["lon"].alias("lon"),
        parsed["start_temp_c"].alias("start_temp_c"),
        F.coalesce(F.col("pattern"), F.lit("")).alias("pattern"),
        parsed["interval"].alias("interval_ns"),
        parsed["created_at"].alias("created_at"),
        bad.alias("bad_field"),
    )


def from_stored_strict(stored: DataFrame) -> DataFrame:
    """Typed sensors; one corrupt row fails the whole read."""
    rows = from_stored(stored)
    failed = F.raise_error(F.concat(F.lit("sensor "), F.col("id"), F.lit(": field "), F.col("bad_field")))
    # The check feeds a column that is kept, so pruning cannot drop it.
    checked = F.when(F.col("bad_field").isNull(), F.col("id")).otherwise(failed)
    return rows.withColumn("id", checked).select(*SENSOR_COLUMNS)


def lookup(registry: DataFrame, sensor_id: str) -> DataFrame:
    """The sensor with this id; no row means not found."""
    return registry.where(F.col("id") == sensor_id)


def list_registered(ids: DataFrame, records: DataFrame) -> DataFrame:
    """Records of the indexed ids; an id without a record is skipped."""
    return ids.select("id").distinct().join(records, "id", "inner")


def sensor_id_for(request_key: Column, digits: int = 8) -> Column:
    """``sensor-`` and hex digits, the same for the same request on a replay.

    Eight digits serve thousands of sensors. Bulk loads take ``unique_ids``, or more digits
    checked with ``id_collisions``.
    """
    return F.concat(F.lit("sensor-"), F.substring(F.sha2(request_key.cast("string"), 256), 1, digits))


def id_collisions(registered: DataFrame) -> DataFrame:
    """Ids given to more than one request."""
    return (
        registered.groupBy("id")
        .agg(F.min("request_key").alias("first_request"), F.max("request_key").alias("last_request"))
        .where(F.col("first_request") != F.col("last_request"))
    )


def unique_ids(requests: DataFrame, registered: DataFrame | None = None, digits: int = 8) -> DataFrame:
    """(request_key, id) for each different key: the digits of its hash, as many as tell it from all others.

    A key that shares its first ``digits`` with another one gets more, up to one more than
    they share, so no two keys get one id. Keys of ``registered`` (``request_key, id``) keep
    the id they have, and new ones are told from them too. The same requests get the same
    ids in any order. Null keys are left out.
    """
    digest = F.sha2(F.col("request_key").cast("string"), 256)
    key = F.col("request_key").cast("string").alias("request_key")
    new = requests.where(F.col("request_key").isNotNull()).select(key, digest.alias("_digest"), F.lit(None).cast("string").alias("_id"))
    known = None if registered is None else registered.select(key, digest.alias("_digest"), F.col("id").alias("_id"))
    both = (new if known is None else new.unionByName(known)).groupBy("request_key", "_digest").agg(F.max("_id").alias("_id"))
    # Neighbours in the order of the digests share the most; few keys share their first digits.
    near = Window.partitionBy(F.substring("_digest", 1, digits)).orderBy("_digest")

    def shared(other: Column) -> Column:
        same = F.filter(F.sequence(F.lit(1), F.lit(64)), lambda n: F.substr(F.col("_digest"), F.lit(1), n) == F.substr(other, F.lit(1), n))
        return F.coalesce(F.when(other.isNotNull(), F.size(same)), F.lit(0))

    lengths = both.withColumns({"_before": F.lag("_digest").over(near), "_after": F.lead("_digest").over(near)})
    length = F.greatest(F.lit(digits), shared(F.col("_before")) + 1, shared(F.col("_after")) + 1)
    own = F.concat(F.lit("sensor-"), F.substr(F.col("_digest"), F.lit(1), length))
    return lengths.select("request_key", F.coalesce("_id", own).alias("id"))


def register(
    requests: DataFrame,
    created_at: Column | None = None,
    entity: Entity = SENSOR,
    defaults: S.RegistrationDefaults = S.RegistrationDefaults(),
    id_digits: int = 8,
) -> DataFrame:
    """Requests to sensors: fill defaults, give an id and a time, validate.

    Needs ``request_key, lat, lon, start_temp_c, pattern, interval``. An absent
    start temperature takes the default, an explicit 0 is kept. Rejected rows
    stay, with a ``reason``.
    """
    text = F.coalesce(F.nullif(F.col("interval"), F.lit("")), F.lit(defaults.interval))
    filled = requests.select(
        "request_key",
        sensor_id_for(F.col("request_key"), id_digits).alias("id"),
        F.coalesce(F.col("lat"), F.lit(0.0)).alias("lat"),
        F.coalesce(F.col("lon"), F.lit(0.0)).alias("lon"),
        F.coalesce(F.col("start_temp_c"), F.lit(defaults.start_temp_c)).alias("start_temp_c"),
        F.coalesce(F.nullif(F.col("pattern"), F.lit("")), F.lit(defaults.pattern)).alias("pattern"),
        text.alias("_interval"),
        parse_duration(text).alias("interval_ns"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
    )
    at = fields_of()
    unparsed = F.col("interval_ns").isNull()
    return filled.select(
        "request_key",
        *SENSOR_COLUMNS,
        F.coalesce(
            F.when(
                unparsed,
                F.concat(F.lit('interval: "'), F.col("_interval"), F.lit('" is not a duration (try "5s")')),
            ),
            first_reason(entity.rules, at),
        ).alias("reason"),
        F.when(unparsed, F.lit("duration")).otherwise(first_code(entity.rules, at)).alias("reason_code"),
    )


def response(sensors: DataFrame) -> DataFrame:
    """Sensors as callers see them: the interval is text again."""
    return sensors.select(
        "id",
        "lat",
        "lon",
        "start_temp_c",
        "pattern",
        format_duration(F.col("interval_ns")).alias("interval"),
        "created_at",
    )


def upsert(registry: DataFrame, changes: DataFrame, seq: str = "seq", entity: Entity = SENSOR) -> DataFrame:
    """A new registry in which the last valid change of each id replaces its row.

    Changes need a ``seq``; rows already registered come before all of them. A change
    that breaks a rule changes nothing; ``validate`` tells which and why.
    """
    changed = valid_rows(changes, entity).select(*SENSOR_COLUMNS, F.col(seq).cast("bigint").alias("_seq"))
    last = last_by(changed, "id", "_seq").select(*SENSOR_COLUMNS)
    kept = registry.select(*SENSOR_COLUMNS).join(last.select("id"), "id", "left_anti")
    return kept.unionByName(last)


def remove(registry: DataFrame, ids: DataFrame) -> DataFrame:
    """A new registry without these ids; unknown ids change nothing."""
    return registry.join(ids.select("id"), "id", "left_anti")


def removal_report(registry: DataFrame, ids: DataFrame) -> DataFrame:
    """For each requested id, whether it was registered."""
    known = registry.select("id", F.lit(True).alias("_known")).distinct()
    return (
        ids.select("id")
        .distinct()
        .join(known, "id", "left")
        .select("id", F.coalesce("_known", F.lit(False)).alias("existed"))
    )


def reconcile(desired: DataFrame, running: DataFrame, report_changes: bool = False) -> DataFrame:
    """What to do so that the running set becomes the desired set.

    ``start`` ids only desired, ``stop`` ids only running, ``keep`` the rest. A
    sensor whose settings changed is kept as it runs; ``report_changes`` calls
    it ``changed`` instead.
    """
    settings = [c for c in SENSOR_COLUMNS if c not in ("id", "created_at")]

    def side(df: DataFrame, name: str) -> DataFrame:
        if not report_changes:
            return df.select("id", F.lit(True).alias(name)).distinct()
        # One row for an id: of several settings the greatest.
        return df.groupBy("id").agg(F.max(F.struct(*settings)).alias(name))

    both = side(desired, "_want").join(side(running, "_have"), "id", "full_outer")
    kept = F.lit("keep")
    if report_changes:
        kept = F.when(~F.col("_want").eqNullSafe(F.col("_have")), F.lit("changed")).otherwise(kept)
    return both.select(
        "id",
        F.when(F.col("_have").isNull(), F.lit("start"))
        .when(F.col("_want").isNull(), F.lit("stop"))
        .otherwise(kept)
        .alias("action"),
    )
