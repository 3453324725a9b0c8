"""The given ``events`` table seen as sensors, readings and topic rows.

Every view keeps all events. ``arrival_ts`` is when a reading was handled: up
to five seconds after it was taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow import schemas as S
from stationflow.operators.codec import encode
from stationflow.operators.registry import to_stored
from stationflow.operators.validation import READING, valid_rows


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _sensor_id() -> Column:
    # At least four digits; lpad alone would cut longer numbers.
    number = F.col("user_id").cast("string")
    return F.concat(
        F.lit("sensor-"), F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    )


def as_readings(rows: DataFrame) -> DataFrame:
    """Readings of the sensor each user stands for; works on a stream too."""
    user, event = F.col("user_id"), F.col("event_id")
    return rows.select(
        _sensor_id().alias("sensor_id"),
        ((user % 32 + 455).cast("double") / 10).alias("lat"),
        ((user % 70 + 160).cast("double") / 10).alias("lon"),
        (F.col("value") - 10).alias("temp_c"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.timestamp_micros(
            F.unix_micros(F.col("ts").cast("timestamp")) + event % 6 * 1_000_000
        ).alias("arrival_ts"),
        (user % 6).cast("int").alias("partition"),
        (event * 2).alias("offset"),
        "event_id",
        "user_id",
        "event_type",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(events(spark, sf_dir))


def clean_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid readings: what the clean topic holds."""
    return valid_rows(readings(spark, sf_dir), READING)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid readings, with purchases delivered a second time.

    The second copy has the next offset and a temperature one degree higher, so
    it shows which copy was kept.
    """
    copies = F.when(F.col("event_type") == "purchase", F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return (
        clean_readings(spark, sf_dir)
        .withColumn("copy", F.explode(copies))
        .withColumns({"temp_c": F.col("temp_c") + F.col("copy"), "offset": F.col("offset") + F.col("copy")})
    )


# What to find in a good payload, and what to put there. The last three still
# decode: no temperature, an unknown key, and a key that comes twice.
_FAULTS = (
    ("^.*$", "not json at all"),
    ("^.*$", ""),
    ("^.*$", "null"),
    ("^.*$", "[]"),
    ("}$", "} trailing"),
    ('"sensor_id":"[^"]*"', '"sensor_id":5'),
    ('"lat":[^,]*', '"lat":"47.5"'),
    ('"ts":"([^T]*)[^"]*"', '"ts":"$1"'),
    (',"ts":"[^"]*"', ""),
    (',"temp_c":[^,]*', ""),
    ("}$", ',"extra":"v2"}'),
    ("^.", '{"sensor_id":"first",'),
)


def _faulty(good: Column) -> Column:
    """The payload with the fault numbered by the user."""
    number = (F.col("user_id") % len(_FAULTS) + 1).cast("int")
    find, put = (F.element_at(F.array(*[F.lit(f[i]) for f in _FAULTS]), number) for i in (0, 1))
    return F.regexp_replace(good, find, put)


def as_topic(rows: DataFrame) -> DataFrame:
    """Raw topic rows, one per event; error events carry a faulty payload."""
    good = F.col("_good")
    payload = F.when(F.col("event_type") == "error", _faulty(good)).otherwise(good)
    return as_readings(rows).withColumn("_good", encode(READING)).select(
        F.col("sensor_id").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit(S.READINGS_TOPIC.name).alias("topic"),
        "partition",
        "offset",
        F.col("arrival_ts").alias("timestamp"),
    )


def raw_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_topic(events(spark, sf_dir))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, be it one file or a folder of part files."""
    # A pattern matches both; a plain path would have to be a folder.
    return spark.readStream.schema(events(spark, sf_dir).schema).parquet(f"{sf_dir}/events.parque[t]")


def _sensor_settings(rows: DataFrame) -> DataFrame:
    user = F.col("user_id")
    names = F.array(*[F.lit(p) for p in (*S.PATTERNS, "sideways")])
    return rows.select(
        "user_id",
        _sensor_id().alias("id"),
        ((user % 32 + 455).cast("double") / 10).alias("lat"),
        ((user % 70 + 160).cast("double") / 10).alias("lon"),
        (F.col("value") - 10).alias("start_temp_c"),
        F.element_at(names, (user % 5 + 1).cast("int")).alias("pattern"),
        ((user % 40) * 1_000_000_000).alias("interval_ns"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("event_id").alias("seq"),
    )


def sensor_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registration per event: sensors register again and again."""
    return _sensor_settings(events(spark, sf_dir))


def _registrations(spark: SparkSession, sf_dir: str, pick) -> DataFrame:
    """Per sensor the event ``pick`` (min or max) finds by event number."""
    picked = pick(F.struct("event_id", "value", "ts", "event_type")).alias("picked")
    return events(spark, sf_dir).groupBy("user_id").agg(picked).select("user_id", "picked.*")


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first registration of every sensor."""
    return _sensor_settings(_registrations(spark, sf_dir, F.min))


def running_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First registrations, without sensors that began with a click."""
    return _sensor_settings(_registrations(spark, sf_dir, F.min).where("event_type != 'click'"))


def desired_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last registrations, without sensors that ended with a signup."""
    return _sensor_settings(_registrations(spark, sf_dir, F.max).where("event_type != 'signup'"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registration request per sensor, some with fields left out."""
    rows = sensors(spark, sf_dir)
    user = F.col("user_id")
    text = (
        F.when(user % 7 == 0, F.lit(None))
        .when(user % 7 == 1, F.lit(""))
        .when(user % 7 == 2, F.lit("fast"))
        .otherwise(F.concat((user % 40).cast("string"), F.lit("s")))
    )
    return rows.select(
        F.col("id").alias("request_key"),
        "lat",
        "lon",
        F.when(user % 3 == 0, F.lit(None).cast("double"))
        .when(user % 3 == 1, F.lit(0.0))
        .otherwise(F.col("start_temp_c"))
        .alias("start_temp_c"),
        F.when(user % 4 == 0, F.lit(None))
        .when(user % 4 == 1, F.lit(""))
        .otherwise(F.col("pattern"))
        .alias("pattern"),
        text.alias("interval"),
    )


def stored_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows as text; sensors that began with an error are corrupt."""
    first = _registrations(spark, sf_dir, F.min)
    corrupt = first.where("event_type = 'error'").select(
        _sensor_id().alias("id"), (F.col("user_id") % 5).alias("_fault")
    )
    rows = to_stored(_sensor_settings(first)).join(corrupt, "id", "left")
    spoiled = {
        name: F.when(F.col("_fault") == n, F.lit("garbage")).otherwise(F.col(name))
        for n, name in enumerate(("lat", "lon", "start_temp_c", "interval", "created_at"))
    }
    return rows.withColumns(spoiled).drop("_fault")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One north-south stripe of the country per nation."""
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    west = F.col("n_nationkey").cast("double")
    return nations.select(
        F.col("n_name").alias("scope"),
        F.lit(45.7).alias("min_lat"),
        F.lit(48.65).alias("max_lat"),
        (west / 4 + 16).alias("min_lon"),
        ((west + 1) / 4 + 16).alias("max_lon"),
    )
