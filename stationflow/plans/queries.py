"""The registered queries: each runs one operator over the given tables.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame over all rows of
its tables. Times come out as ``timestamp_ntz`` in UTC.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow import schemas as S
from stationflow.functions.durations import format_duration, parse_duration
from stationflow.functions.numbers import round_half_away
from stationflow.functions.times import format_rfc3339, interval, parse_rfc3339
from stationflow.operators import codec, dedup, metrics, registry, routing, windows
from stationflow.operators.regions import with_region
from stationflow.operators.validation import (
    AGGREGATE,
    DEAD_LETTER,
    READING,
    SENSOR,
    is_known_pattern,
    validate,
)
from stationflow.plans import views
from stationflow.session import configure, scratch_path
from stationflow.sources import history, registry_store, topics
from stationflow.streaming import rollup
from stationflow.streaming.audit import AuditListener, metric_totals, read_audit, rows_behind
from stationflow.streaming.aggregate import aggregates_topic, future_rows, readings_from_topic
from stationflow.streaming.feed import feed_messages, live_feed, start_feed
from stationflow.streaming.ingest import (
    clean_topic,
    dead_letter_topic,
    file_outputs,
    ingest_batch,
    start_ingest,
)

Query = Callable[[SparkSession, str], DataFrame]

HOUR = timedelta(hours=1)
TEN_SECONDS = timedelta(seconds=10)

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query under its function name."""

    @wraps(run)
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_times(run(configure(spark), sf_dir))

    QUERIES[run.__name__] = prepared
    return prepared


def _plain_times(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _count(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


# Windows -------------------------------------------------------------------


@query
def tumbling_10s(spark, sf_dir):
    return windows.summarise(views.clean_readings(spark, sf_dir), TEN_SECONDS)


@query
def tumbling_1h(spark, sf_dir):
    return windows.summarise(views.clean_readings(spark, sf_dir), HOUR)


@query
def tumbling_7d(spark, sf_dir):
    """Weeks start on a Monday because boundaries count from year 1."""
    return windows.summarise(views.clean_readings(spark, sf_dir), timedelta(days=7))


@query
def tumbling_7s(spark, sf_dir):
    return windows.summarise(views.clean_readings(spark, sf_dir), timedelta(seconds=7))


@query
def tumbling_10s_on_time(spark, sf_dir):
    return windows.summarise(windows.on_time(views.clean_readings(spark, sf_dir)), TEN_SECONDS)


@query
def window_assignment(spark, sf_dir):
    """Each reading with its window and whether it came too late."""
    start = windows.window_start(TEN_SECONDS)
    return views.readings(spark, sf_dir).select(
        "event_id",
        start.alias("window_start"),
        (start + interval(TEN_SECONDS)).alias("window_end"),
        windows.is_late().alias("late"),
    )


@query
def late_count(spark, sf_dir):
    return windows.late_count(views.clean_readings(spark, sf_dir))


@query
def conservation(spark, sf_dir):
    return windows.conservation(views.clean_readings(spark, sf_dir))


@query
def closed_windows(spark, sf_dir):
    """Hourly windows closed when the newest reading came in, grace two hours."""
    clean = views.clean_readings(spark, sf_dir)
    grace = timedelta(hours=2)
    now = clean.agg(F.max("ts")).scalar()
    return windows.closed(windows.summarise(clean, HOUR), now, grace)


@query
def tumbling_with_duplicates(spark, sf_dir):
    """Redelivered readings count in the windows."""
    return windows.summarise(views.deliveries(spark, sf_dir), HOUR)


@query
def tumbling_first_deliveries(spark, sf_dir):
    return windows.summarise(dedup.first_by_position(views.deliveries(spark, sf_dir)), HOUR)


@query
def future_readings(spark, sf_dir):
    """Readings dated over a minute after their arrival.

    The arrival of purchases is moved back by an hour to make some.
    """
    moved = views.readings(spark, sf_dir).withColumn(
        "arrival_ts",
        F.col("arrival_ts")
        - F.when(F.col("event_type") == "purchase", interval(HOUR)).otherwise(interval(timedelta(0))),
    )
    return future_rows(moved).select("event_id", "ts", "arrival_ts")


# Validation ----------------------------------------------------------------


@query
def validate_readings(spark, sf_dir):
    checked = validate(views.readings(spark, sf_dir), READING)
    return checked.select("event_id", "reason", "reason_code")


@query
def reject_reasons(spark, sf_dir):
    checked = validate(views.readings(spark, sf_dir), READING)
    return checked.where(F.col("reason").isNotNull()).groupBy("reason").agg(_count())


@query
def reject_classes(spark, sf_dir):
    return metrics.reason_counts(validate(views.readings(spark, sf_dir), READING))


@query
def validate_aggregates(spark, sf_dir):
    """Ten-second windows, some spoiled, against the aggregate rules."""
    rows = windows.summarise(views.clean_readings(spark, sf_dir), TEN_SECONDS)
    second = F.second("window_start")
    minute = F.minute("window_start")
    spoiled = rows.select(
        F.when(minute == 0, F.lit("")).otherwise(F.col("scope")).alias("scope"),
        "window_start",
        F.when(minute == 1, F.col("window_start")).otherwise(F.col("window_end")).alias("window_end"),
        "avg_temp_c",
        F.when(minute == 3, F.col("max_temp_c") + 1).otherwise(F.col("min_temp_c")).alias("min_temp_c"),
        "max_temp_c",
        F.when((minute == 2) & (second < 30), F.lit(0)).otherwise(F.col("count")).alias("count"),
    )
    return validate(spoiled, AGGREGATE).select("window_start", "reason", "reason_code")


@query
def validate_dead_letters(spark, sf_dir):
    """Envelopes made from all events, some incomplete."""
    rows = views.readings(spark, sf_dir)
    kind = F.col("event_type")
    letters = rows.select(
        F.when(kind == "view", F.lit("")).otherwise(F.lit(S.READINGS_TOPIC.name)).alias("source_topic"),
        "partition",
        "offset",
        F.when(kind == "click", F.lit("")).otherwise(F.lit("unmarshal: invalid JSON")).alias("reason"),
        F.when(kind == "signup", F.lit(None)).otherwise(F.col("arrival_ts")).alias("failed_at"),
        F.lit("").cast("binary").alias("payload"),
    )
    # The envelope has a reason of its own; the verdict replaces it here.
    return validate(letters, DEAD_LETTER).select("offset", "reason_code")


@query
def validate_sensors(spark, sf_dir):
    changes = views.sensor_changes(spark, sf_dir)
    return validate(changes, SENSOR).select("seq", "id", "reason", "reason_code")


@query
def pattern_membership(spark, sf_dir):
    rows = views.sensor_changes(spark, sf_dir)
    return rows.groupBy("pattern").agg(_count(), F.first(is_known_pattern(F.col("pattern"))).alias("known"))


@query
def failure_classes(spark, sf_dir):
    checked = validate(views.readings(spark, sf_dir), READING)
    return checked.groupBy(
        F.coalesce(routing.failure_class(F.col("reason")), F.lit("none")).alias("failure")
    ).agg(_count())


# Decode, encode, dead letters ------------------------------------------------


@query
def decode_readings(spark, sf_dir):
    rows = codec.decode(views.raw_topic(spark, sf_dir), READING)
    good = F.col("reason").isNull()
    return rows.select(
        "partition",
        "offset",
        "reason",
        "reason_code",
        *[F.when(good, F.col(f"event.{c}")).alias(c) for c in S.READING.names],
    )


@query
def poison_split(spark, sf_dir):
    rows = codec.decode(views.raw_topic(spark, sf_dir), READING)
    return rows.groupBy("partition").agg(
        F.count_if(F.col("reason").isNull()).alias("delivered"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
    )


@query
def rejection_metrics(spark, sf_dir):
    return metrics.reason_counts(codec.decode(views.raw_topic(spark, sf_dir), READING))


@query
def log_and_skip(spark, sf_dir):
    """Only deliverable rows go on; nothing is kept of the others."""
    rows = routing.skip_rejected(codec.decode(views.raw_topic(spark, sf_dir), READING), "skipped")
    return rows.select("partition", "offset", "event.sensor_id", "event.temp_c")


@query
def dlq_envelopes(spark, sf_dir):
    letters = routing.dead_letters(codec.decode(views.raw_topic(spark, sf_dir), READING))
    # base64() breaks lines after 76 characters.
    text = F.translate(F.base64("payload"), "\r\n", "").alias("payload_base64")
    return letters.select("source_topic", "partition", "offset", "reason", text)


@query
def dlq_read_back(spark, sf_dir):
    """Dead letters encoded to their topic, read back and decoded."""
    letters = routing.dead_letters(codec.decode(views.raw_topic(spark, sf_dir), READING), F.col("timestamp"))
    rows = codec.decode(dead_letter_topic(letters), DEAD_LETTER)
    return routing.accepted(rows).select(
        F.col("event.source_topic").alias("source_topic"),
        F.col("event.partition").alias("partition"),
        F.col("event.offset").alias("offset"),
        F.col("event.reason").alias("reason"),
        F.col("event.failed_at").alias("failed_at"),
        F.col("event.payload").cast("string").alias("payload"),
    )


@query
def clean_encode(spark, sf_dir):
    """Normalised payloads, parsed again: exactly five known fields."""
    rows = codec.normalise(views.raw_topic(spark, sf_dir), READING)
    text = F.col("value").cast("string")
    keys = F.array_join(F.array_sort(F.json_object_keys(text)), ",")
    parsed = F.from_json(text, "sensor_id string, lat double, lon double, temp_c double, ts string")
    return (
        codec.with_wire_size(rows, S.MAX_READING_BYTES)
        .select("offset", keys.alias("fields"), "within_budget", parsed.alias("p"))
        .select("offset", "fields", "within_budget", "p.*")
    )


@query
def clean_topic_rows(spark, sf_dir):
    """Rows of the clean topic: key, and one partition per key."""
    good = routing.accepted(codec.decode(views.raw_topic(spark, sf_dir), READING))
    rows = clean_topic(good).withColumn("sensor_id", F.col("key").cast("string"))
    return rows.groupBy("sensor_id", "topic").agg(
        _count(),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        (F.min("partition") == F.max("partition")).alias("one_partition"),
    )


@query
def rfc3339_round_trip(spark, sf_dir):
    rows = views.readings(spark, sf_dir)
    text = format_rfc3339(F.col("ts"))
    east = F.concat(F.substring_index(text, "Z", 1), F.lit("+02:00"))
    far_west = F.concat(F.substring_index(text, "Z", 1), F.lit("-23:30"))
    return rows.select(
        "event_id",
        text.alias("text"),
        parse_rfc3339(text).alias("utc"),
        parse_rfc3339(east).alias("east"),
        parse_rfc3339(far_west).alias("far_west"),
        parse_rfc3339(F.substring(text, 1, 10)).isNull().alias("date_refused"),
    )


@query
def duration_round_trip(spark, sf_dir):
    """Durations made from event times and values, printed and parsed."""
    rows = views.readings(spark, sf_dir)
    nanos = (F.unix_micros("ts") % 7_200_000_000) * 1_000
    seconds = F.col("event_id") % 90
    text = F.concat(seconds.cast("string"), F.lit("m"), (seconds + 30).cast("string"), F.lit(".5s"))
    return rows.select(
        "event_id",
        parse_duration(format_duration(nanos)).alias("nanos"),
        parse_duration(text).alias("minutes_and_seconds"),
        format_duration(seconds * 1_000_000_000).alias("text"),
        parse_duration(F.col("event_type")).isNull().alias("word_refused"),
    )


@query
def rounding(spark, sf_dir):
    """Prices rounded by scaling; halves go away from zero."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return rows.select("l_orderkey", "l_linenumber", round_half_away(net).alias("net"))


# History -------------------------------------------------------------------


@query
def history_dedup(spark, sf_dir):
    return dedup.first_by_position(views.deliveries(spark, sf_dir))


@query
def history_dedup_any_position(spark, sf_dir):
    return dedup.first_by_position(views.deliveries(spark, sf_dir), packed=False)


@query
def insert_ignore(spark, sf_dir):
    """Purchases stored before; all deliveries offered; what is added."""
    offered = views.deliveries(spark, sf_dir)
    stored = dedup.first_by_position(views.clean_readings(spark, sf_dir).where("event_type = 'purchase'"))
    return dedup.insert_ignore(stored, offered)


@query
def readings_per_sensor(spark, sf_dir):
    stored = dedup.first_by_position(views.deliveries(spark, sf_dir))
    return history.counts_by_sensor(stored)


def _stored_history(spark: SparkSession, sf_dir: str) -> str:
    """The history table after two appends that overlap: its path."""
    path = scratch_path(spark, "history")
    offered = views.deliveries(spark, sf_dir)
    history.ensure_history(spark, path)
    history.append_ignore(spark, path, offered.where("event_id % 3 <> 0"), "first")
    history.append_ignore(spark, path, offered, "second")
    return path


@query
def history_key_count(spark, sf_dir):
    return history.count_for(history.scan(spark, _stored_history(spark, sf_dir)), "sensor-0008")


@query
def history_range(spark, sf_dir):
    """Ten days of the history table: the folders of other days are not listed in the plan."""
    path = _stored_history(spark, sf_dir)
    return history.scan_range(spark, path, datetime(2024, 1, 5, 6), datetime(2024, 1, 15, 18))


@query
def history_compacted(spark, sf_dir):
    """The history table with the batches of each day merged."""
    path = _stored_history(spark, sf_dir)
    history.compact(spark, path, f"{path}-compacted")
    return history.scan(spark, f"{path}-compacted").select(*S.READING.names, "batch")


@query
def retention(spark, sf_dir):
    """Rows each topic would keep, with the newest arrival as the clock."""
    rows = views.readings(spark, sf_dir)
    now = rows.agg(F.max("arrival_ts")).scalar()
    limits = {
        "readings": S.READINGS_TOPIC,
        "clean": S.CLEAN_TOPIC,
        "dead_letters": S.DEAD_LETTER_TOPIC,
        "aggregates": S.AGGREGATES_TOPIC,
    }
    kept = {
        name: topics.is_retained(topic.retention, now, "arrival_ts") for name, topic in limits.items()
    }
    return rows.agg(*[F.count_if(keep).alias(f"{name}_kept") for name, keep in kept.items()])


@query
def retained_topic_rows(spark, sf_dir):
    """Rows of a stored topic that its retention of an hour leaves, at the newest arrival."""
    path = scratch_path(spark, "topic")
    topics.append_topic(views.raw_topic(spark, sf_dir), path, "all")
    now = topics.read_topic(spark, path).agg(F.max("timestamp").alias("now")).first().now
    rows = topics.read_topic(spark, path, S.AGGREGATES_TOPIC.retention, now.replace(tzinfo=timezone.utc))
    return rows.select("partition", "offset", "timestamp")


# Topics --------------------------------------------------------------------


@query
def latest_offsets(spark, sf_dir):
    return topics.end_offsets(views.raw_topic(spark, sf_dir))


@query
def after_backlog(spark, sf_dir):
    """Rows after the backlog, which ends with the last signup of a partition."""
    rows = views.readings(spark, sf_dir).withColumn("topic", F.lit(S.READINGS_TOPIC.name))
    ends = topics.end_offsets(rows.where("event_type = 'signup'"))
    return topics.after_offsets(rows, ends).select("partition", "offset", "event_id")


@query
def topic_lag(spark, sf_dir):
    rows = views.readings(spark, sf_dir).withColumn("topic", F.lit(S.READINGS_TOPIC.name))
    committed = (
        rows.where("event_type = 'signup'")
        .groupBy("topic", "partition")
        .agg(F.max("offset").alias("committed"))
    )
    return metrics.topic_lag(rows, committed)


@query
def live_feed_messages(spark, sf_dir):
    """Hourly aggregates sent to a subscriber that joined on 15 January."""
    hourly = windows.summarise(views.clean_readings(spark, sf_dir), HOUR)
    rows = aggregates_topic(hourly, F.col("window_end"))
    joined = F.lit("2024-01-15 00:00:00").cast("timestamp")
    backlog = topics.end_offsets(rows.where(F.col("timestamp") < joined))
    sent = live_feed(rows, backlog)
    parsed = F.from_json(
        "message",
        "scope string, window_start string, window_end string, avg_temp_c double,"
        " min_temp_c double, max_temp_c double, count bigint",
    )
    return sent.select(parsed.alias("m")).select("m.*")


# Registry ------------------------------------------------------------------


@query
def register_sensors(spark, sf_dir):
    requests = views.requests(spark, sf_dir)
    rows = registry.register(requests, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return rows.select(
        "request_key", "id", "lat", "lon", "start_temp_c", "pattern", "interval_ns", "reason", "reason_code"
    )


@query
def register_response(spark, sf_dir):
    requests = views.requests(spark, sf_dir)
    rows = registry.register(requests, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return registry.response(rows.where(F.col("reason").isNull()))


@query
def register_collisions(spark, sf_dir):
    """Two hex digits cannot tell this many requests apart."""
    rows = registry.register(views.requests(spark, sf_dir), id_digits=2)
    return registry.id_collisions(rows)


@query
def registry_round_trip(spark, sf_dir):
    """Sensors to text and back are the same sensors."""
    return registry.from_stored_strict(registry.to_stored(views.sensors(spark, sf_dir)))


@query
def registry_quarantine(spark, sf_dir):
    rows = registry.from_stored(views.stored_sensors(spark, sf_dir))
    return rows.select("id", "bad_field", "lat", "lon", "start_temp_c", "interval_ns", "created_at")


@query
def registry_list(spark, sf_dir):
    """All ids against the records of running sensors: the rest is skipped."""
    ids = views.sensors(spark, sf_dir)
    return registry.list_registered(ids, views.running_sensors(spark, sf_dir)).select(
        *registry.SENSOR_COLUMNS
    )


@query
def registry_get(spark, sf_dir):
    return registry.lookup(views.sensors(spark, sf_dir), "sensor-0008").select(*registry.SENSOR_COLUMNS)


@query
def registry_upsert(spark, sf_dir):
    """Every valid event registers its sensor again; the last one counts."""
    return registry.upsert(views.running_sensors(spark, sf_dir), views.sensor_changes(spark, sf_dir))


@query
def registry_remove(spark, sf_dir):
    gone = views.running_sensors(spark, sf_dir)
    return registry.remove(views.sensors(spark, sf_dir), gone).select(*registry.SENSOR_COLUMNS)


@query
def registry_removal_report(spark, sf_dir):
    return registry.removal_report(views.running_sensors(spark, sf_dir), views.sensors(spark, sf_dir))


@query
def registry_diff(spark, sf_dir):
    return registry.reconcile(views.desired_sensors(spark, sf_dir), views.running_sensors(spark, sf_dir))


@query
def registry_diff_with_changes(spark, sf_dir):
    desired, running = views.desired_sensors(spark, sf_dir), views.running_sensors(spark, sf_dir)
    return registry.reconcile(desired, running, report_changes=True)


@query
def register_unique_ids(spark, sf_dir):
    """Ids that begin with two digits of the hash and have more only where two requests share them."""
    return registry.unique_ids(views.requests(spark, sf_dir), digits=2)


@query
def registry_current(spark, sf_dir):
    """A stored registry after upserts, a removal and another upsert, with a fold in between."""
    path = scratch_path(spark, "registry")
    changes = views.sensor_changes(spark, sf_dir).join(
        views.events(spark, sf_dir).select(F.col("event_id").alias("seq"), "event_type"), "seq"
    )
    registry_store.write_snapshot(views.running_sensors(spark, sf_dir), path, 1)
    registry_store.append_upserts(spark, path, changes.where("event_type = 'view'"))
    registry_store.append_upserts(spark, path, changes.where("event_type = 'click'"))
    registry_store.fold(spark, path, 0.5)
    gone = views.sensors(spark, sf_dir).where(F.col("user_id") % 7 == 0)
    registry_store.append_removals(spark, path, gone)
    registry_store.append_upserts(spark, path, changes.where("event_type = 'purchase'"))
    return registry_store.read_current(spark, path)


# Service figures -------------------------------------------------------------


@query
def regional_1h(spark, sf_dir):
    placed = with_region(views.clean_readings(spark, sf_dir), views.regions(spark, sf_dir))
    return windows.summarise(placed, HOUR, F.col("scope"))


@query
def service_metrics(spark, sf_dir):
    checked = validate(views.readings(spark, sf_dir), READING)
    handled = checked.select(
        F.lit("ingestion").alias("service"), "ts", "arrival_ts", F.col("reason").isNotNull().alias("is_error")
    )
    return metrics.service_metrics(handled)


@query
def slo_burn(spark, sf_dir):
    return metrics.slo_burn(views.readings(spark, sf_dir))


# Streams -------------------------------------------------------------------


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Run the ingest stream over the whole events table; the output folder."""
    root = scratch_path(spark, "ingest")
    rows = views.as_topic(views.events_stream(spark, sf_dir))
    start_ingest(rows, file_outputs(spark, root), f"{root}/checkpoint", once=True).awaitTermination()
    return root


@query
def stream_ingest_history(spark, sf_dir):
    return history.scan(spark, f"{_ingested(spark, sf_dir)}/history").select(*S.READING.names)


@query
def stream_ingest_outputs(spark, sf_dir):
    """Rows in each output of the ingest stream."""
    root = _ingested(spark, sf_dir)
    outputs = {
        "history": history.scan(spark, f"{root}/history"),
        "clean": topics.read_topic(spark, f"{root}/clean"),
        "dead_letters": topics.read_topic(spark, f"{root}/dead_letters"),
    }
    counts = None
    for name, rows in outputs.items():
        one = rows.agg(_count()).select(F.lit(name).alias("output"), "n")
        counts = one if counts is None else counts.unionByName(one)
    audit = spark.read.parquet(f"{root}/audit")
    return counts.unionByName(
        audit.groupBy(F.lit("audit_processed").alias("output")).agg(F.sum("processed").alias("n"))
    )


@query
def stream_audit(spark, sf_dir):
    """Rows offered, accepted and rejected by the ingest stream, from the totals its listener wrote."""
    root = scratch_path(spark, "audit")
    listener = AuditListener(spark, f"{root}/progress")
    spark.streams.addListener(listener)
    try:
        rows = views.as_topic(views.events_stream(spark, sf_dir))
        run = start_ingest(rows, file_outputs(spark, root), f"{root}/checkpoint", once=True)
        run.awaitTermination()
        listener.await_run(run.runId)
    finally:
        spark.streams.removeListener(listener)
    return metric_totals(read_audit(spark, f"{root}/progress")).where("metric <> 'rows'").select("metric", "n")


@query
def stream_resumed_history(spark, sf_dir):
    """The topic arrives in two parts; the ingest stream stops after the first and goes on from there."""
    root = scratch_path(spark, "resumed")
    rows = views.raw_topic(spark, sf_dir)
    for part in (0, 1):
        topics.append_topic(rows.where(F.floor(F.col("offset") / 2) % 2 == part), f"{root}/raw", f"part-{part}")
        # Outputs are set up anew: tables that exist stay as they are.
        stream = topics.stream_topic(spark, f"{root}/raw", MAX_FILES)
        start_ingest(stream, file_outputs(spark, root), f"{root}/checkpoint", once=True).awaitTermination()
    return history.scan(spark, f"{root}/history").select(*S.READING.names)


@query
def stream_lag(spark, sf_dir):
    """Rows of the raw topic that the ingest stream is behind, half of them added after it stopped."""
    root = scratch_path(spark, "lag")
    rows = views.raw_topic(spark, sf_dir)
    listener = AuditListener(spark, f"{root}/progress")
    spark.streams.addListener(listener)
    try:
        topics.append_topic(rows.where(F.floor(F.col("offset") / 2) % 2 == 0), f"{root}/raw", "before")
        stream = topics.stream_topic(spark, f"{root}/raw", MAX_FILES)
        run = start_ingest(stream, file_outputs(spark, root), f"{root}/checkpoint", once=True)
        run.awaitTermination()
        listener.await_run(run.runId)
    finally:
        spark.streams.removeListener(listener)
    topics.append_topic(rows.where(F.floor(F.col("offset") / 2) % 2 == 1), f"{root}/raw", "after")
    behind = rows_behind(topics.read_topic(spark, f"{root}/raw"), read_audit(spark, f"{root}/progress"), str(run.id))
    return behind.select("newest", "read", "lag")


@query
def replayed_batch(spark, sf_dir):
    """A batch that runs twice leaves the rows of one run in every output."""
    root = scratch_path(spark, "replayed")
    outputs, rows = file_outputs(spark, root), views.raw_topic(spark, sf_dir)
    for _ in range(2):
        ingest_batch(rows, "batch-0", outputs)
    tables = {
        "history": history.scan(spark, f"{root}/history"),
        "clean": topics.read_topic(spark, f"{root}/clean"),
        "dead_letters": topics.read_topic(spark, f"{root}/dead_letters"),
    }
    counts = [rows.agg(_count()).select(F.lit(name).alias("output"), "n") for name, rows in tables.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def handled_readings(spark, sf_dir):
    """History of an ingest stream whose handler keeps readings above zero and passes the rest over."""
    root = scratch_path(spark, "handled")
    rows = views.as_topic(views.events_stream(spark, sf_dir))
    outputs = file_outputs(spark, root)
    run = start_ingest(rows, outputs, f"{root}/checkpoint", handler=lambda good: good.where("event.temp_c > 0"), once=True)
    run.awaitTermination()
    return history.scan(spark, f"{root}/history").select(*S.READING.names)


@query
def stream_full_copies(spark, sf_dir):
    """Hourly windows that each of two subscribers got: both all of them."""
    root = scratch_path(spark, "copies")
    hourly = windows.summarise(views.clean_readings(spark, sf_dir), HOUR)
    topics.append_topic(aggregates_topic(hourly, F.col("window_end")), f"{root}/topic", "all")
    sent = None
    for name in ("one", "two"):

        def subscriber(messages: DataFrame, number: int, name: str = name) -> None:
            messages.write.mode("overwrite").parquet(f"{root}/{name}/number={number}")

        rows = topics.stream_topic(spark, f"{root}/topic", MAX_FILES)
        start_feed(rows, subscriber, f"{root}/checkpoint-{name}", once=True).awaitTermination()
        got = spark.read.parquet(f"{root}/{name}").select(F.lit(name).alias("subscriber"), "scope", "window_start")
        sent = got if sent is None else sent.unionByName(got)
    return sent


_AGGREGATE_JSON = (
    "scope string, window_start timestamp, window_end timestamp, avg_temp_c double,"
    " min_temp_c double, max_temp_c double, count bigint"
)


#: Topic files of one batch of the window stream.
MAX_FILES = 200


def _sent(spark: SparkSession, root: str) -> DataFrame:
    """The windows in the aggregates topic, as its subscribers decode them."""
    sent = feed_messages(rollup.aggregates(spark, root))
    return sent.select(F.from_json("message", _AGGREGATE_JSON).alias("m")).select("m.*")


def _valid_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.as_readings(views.events_stream(spark, sf_dir))
    return validate(rows, READING).where(F.col("reason").isNull())


@query
def stream_tumbling_1h(spark, sf_dir):
    """Hourly windows of a stream, closed by the clock: all of them."""
    root = scratch_path(spark, "aggregate")
    rollup.drain(_valid_stream(spark, sf_dir), root, HOUR)
    return _sent(spark, root)


@query
def stream_balance(spark, sf_dir):
    """Readings sent, waiting for their window to end, and late, at midnight before 15 January."""
    root = scratch_path(spark, "balance")
    now = datetime(2024, 1, 15, tzinfo=timezone.utc)
    rollup.drain(_valid_stream(spark, sf_dir), root, HOUR, now=now, settle=timedelta(0))
    return rollup.balance(spark, root, _sent(spark, root)).where("fate <> 'missed'")


def _missed(spark: SparkSession, sf_dir: str) -> str:
    """Half of the readings can be read only after the closing on 15 January; the output folder."""
    root = scratch_path(spark, "missed")
    valid = views.clean_readings(spark, sf_dir)
    folder = f"{root}/topic"
    valid.where("event_id % 2 = 0").write.parquet(folder)
    stream = spark.readStream.schema(valid.schema).parquet(folder)
    rollup.drain(stream, root, HOUR, now=datetime(2024, 1, 15, tzinfo=timezone.utc), settle=timedelta(0))
    valid.where("event_id % 2 = 1").write.mode("append").parquet(folder)
    rollup.drain(stream, root, HOUR)
    return root


@query
def stream_missed(spark, sf_dir):
    """Hourly aggregates of readings that came on time but were visible after their window was sent."""
    return rollup.corrections(spark, _missed(spark, sf_dir), HOUR)


@query
def stream_missed_balance(spark, sf_dir):
    """Readings sent, waiting, late and missed, when half of them became visible late."""
    root = _missed(spark, sf_dir)
    return rollup.balance(spark, root, _sent(spark, root))


@query
def stream_first_deliveries(spark, sf_dir):
    """Hourly windows of a stream with repeated deliveries, each reading counted once, in six batches."""
    root = scratch_path(spark, "first")
    rows = views.deliveries(spark, sf_dir)
    # First deliveries come last: what counts is the position, not the order of reading.
    for copy in (1, 0):
        rows.where(F.col("copy") == copy).repartition(3, "event_id").write.mode("append").parquet(f"{root}/topic")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/topic")
    rollup.drain(stream, root, HOUR, drop_duplicates=True, fan=4)
    return _sent(spark, root)


@query
def stream_closed_twice(spark, sf_dir):
    """Windows sent by a closing on 15 January and by a later one: each window once."""
    root = scratch_path(spark, "closings")
    rollup.drain(_valid_stream(spark, sf_dir), root, HOUR, now=datetime(2024, 1, 15, tzinfo=timezone.utc))
    rollup.drain(_valid_stream(spark, sf_dir), root, HOUR)
    return _sent(spark, root)


@query
def stream_raw_to_feed(spark, sf_dir):
    """Raw topic to clean topic to hourly windows to a subscriber, in bounded batches."""
    clean = topics.stream_topic(spark, f"{_ingested(spark, sf_dir)}/clean", MAX_FILES)
    root = scratch_path(spark, "aggregate")
    rollup.drain(readings_from_topic(clean), root, HOUR)
    return _sent(spark, root)


@query
def stream_feed_from_latest(spark, sf_dir):
    """What a subscriber of the regional windows gets that joins on 15 January.

    Regions share topic partitions, so their offsets repeat.
    """
    root = scratch_path(spark, "latest")
    placed = with_region(views.clean_readings(spark, sf_dir), views.regions(spark, sf_dir))
    rows = aggregates_topic(windows.summarise(placed, HOUR, F.col("scope")), F.col("window_end"))
    joined = F.lit("2024-01-15 00:00:00").cast("timestamp")
    topics.append_topic(rows.where(F.col("timestamp") < joined), f"{root}/topic", "before")
    topics.end_files(spark, f"{root}/topic").write.parquet(f"{root}/backlog")
    topics.append_topic(rows.where(F.col("timestamp") >= joined), f"{root}/topic", "after")

    def subscriber(messages: DataFrame, number: int) -> None:
        messages.write.mode("overwrite").parquet(f"{root}/sent/number={number}")

    live = topics.stream_topic(spark, f"{root}/topic", MAX_FILES, spark.read.parquet(f"{root}/backlog"))
    start_feed(live, subscriber, f"{root}/checkpoint", once=True).awaitTermination()
    sent = spark.read.parquet(f"{root}/sent")
    return sent.select(F.from_json("message", _AGGREGATE_JSON).alias("m")).select("m.*")
