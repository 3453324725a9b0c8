import json
import time
from datetime import datetime, timedelta, timezone

import pytest
from builders import BASE, READING, at, topic, wire
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stationflow import schemas as S
from stationflow.operators import codec, windows
from stationflow.operators import validation as V
from stationflow.sources import files, history, topics
from stationflow.streaming import aggregate, audit, feed, ingest, manifest, rollup, wallclock


def message(sensor, second, temp):
    return wire({**READING, "sensor_id": sensor, "ts": at(second), "temp_c": temp})


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def run_ingest(spark, root, outputs=None, **options):
    rows = topics.stream_topic(spark, f"{root}/raw", options.pop("max_files", None))
    query = ingest.start_ingest(
        rows, outputs or ingest.file_outputs(spark, f"{root}/out"), f"{root}/checkpoint", once=True, **options
    )
    query.awaitTermination()
    return query


def stored(spark, root):
    rows = history.scan(spark, f"{root}/out/history")
    return sorted((r.sensor_id, r.temp_c) for r in rows.select("sensor_id", "temp_c").collect())


def test_ingest_and_resume(spark, root):
    first = [message("a", 0, 20.0), b"not json", message("a", 0, 25.0), message("b", 1, 99.0)]
    topics.append_topic(topic(spark, first), f"{root}/raw", "0")
    run_ingest(spark, root)
    assert stored(spark, root) == [("a", 20.0)]
    clean = topics.read_topic(spark, f"{root}/out/clean").orderBy("offset").collect()
    # A duplicate is not stored but still published.
    assert [json.loads(r.value)["temp_c"] for r in clean] == [20.0, 25.0]
    letters = topics.read_topic(spark, f"{root}/out/dead_letters").orderBy("offset").collect()
    assert [r.offset for r in letters] == [1, 3]

    topics.append_topic(topic(spark, [message("a", 0, 30.0), message("c", 2, 21.0)], start=4), f"{root}/raw", "1")
    run_ingest(spark, root)
    assert stored(spark, root) == [("a", 20.0), ("c", 21.0)]
    assert topics.read_topic(spark, f"{root}/out/clean").count() == 4
    audit = spark.read.parquet(f"{root}/out/audit").agg(F.sum("offered"), F.sum("rejected"), F.sum("processed"))
    assert tuple(audit.first()) == (6, 2, 4)


def test_error_stops_without_moving_on(spark, root):
    topics.append_topic(topic(spark, [message("a", 0, 20.0), b"bad"]), f"{root}/raw", "0")
    files = ingest.file_outputs(spark, f"{root}/out")

    def broken(rows, name):
        raise RuntimeError("clean topic is down")

    failing = ingest.Outputs(files.dead_letters, files.history, broken, files.audit)
    with pytest.raises(Exception, match="clean topic is down"):
        run_ingest(spark, root, failing)
    # Stored but not published, so not counted as processed.
    assert stored(spark, root) == [("a", 20.0)]
    with pytest.raises(Exception, match="(?i)path does not exist|PATH_NOT_FOUND"):
        spark.read.parquet(f"{root}/out/audit")

    run_ingest(spark, root)
    assert stored(spark, root) == [("a", 20.0)]
    assert topics.read_topic(spark, f"{root}/out/clean").count() == 1
    assert topics.read_topic(spark, f"{root}/out/dead_letters").count() == 1
    assert spark.read.parquet(f"{root}/out/audit").first().processed == 1


def test_store_failure_publishes_nothing(spark, root):
    topics.append_topic(topic(spark, [message("a", 0, 20.0)]), f"{root}/raw", "0")
    files = ingest.file_outputs(spark, f"{root}/out")

    def broken(rows, name):
        raise RuntimeError("history is down")

    with pytest.raises(Exception, match="history is down"):
        run_ingest(spark, root, ingest.Outputs(files.dead_letters, broken, files.clean))
    with pytest.raises(Exception):
        topics.read_topic(spark, f"{root}/out/clean").count()


def test_handler_sees_valid_rows_only(spark, root):
    topics.append_topic(topic(spark, [message("a", 0, 20.0), b"bad"]), f"{root}/raw", "0")
    seen = []

    def handler(rows):
        seen.append(rows.count())
        return rows.withColumn("event", F.col("event").withField("temp_c", F.col("event.temp_c") + 1))

    run_ingest(spark, root, handler=handler)
    assert seen == [1] and stored(spark, root) == [("a", 21.0)]


def test_independent_checkpoints_are_full_copies(spark, root):
    topics.append_topic(topic(spark, [message("a", n, 20.0) for n in range(3)]), f"{root}/raw", "0")
    for copy in ("one", "two"):
        query = (
            topics.stream_topic(spark, f"{root}/raw")
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{root}/{copy}-checkpoint")
            .trigger(availableNow=True)
            .start(f"{root}/{copy}")
        )
        query.awaitTermination()
    assert [spark.read.parquet(f"{root}/{c}").count() for c in ("one", "two")] == [3, 3]


READINGS = "sensor_id string, lat double, lon double, temp_c double, ts timestamp, arrival_ts timestamp"


def write_readings(spark, path, *rows):
    """One file of (second, temperature, arrival second)."""
    data = [("a", 47.5, 19.0, float(t), at(s), at(a)) for s, t, a in rows]
    spark.createDataFrame(data, READINGS).coalesce(1).write.mode("append").parquet(path)


def summary_rows(df):
    rows = df.select(F.unix_seconds("window_start").alias("s"), "avg_temp_c", "min_temp_c", "max_temp_c", "count")
    base = int(BASE.timestamp())
    return sorted((r.s - base, r.avg_temp_c, r.min_temp_c, r.max_temp_c, r["count"]) for r in rows.collect())


def test_stream_equals_batch(spark, root):
    batches = [
        [(1, 20, 1), (5, 22, 5), (12, 30, 13)],
        [(9, 21, 11), (3, 50, 13), (25, 10, 26)],  # (3, ..) is late
        [(500, 0, 500), (2, 60, 501), (10_000, 5, 500)],  # late; then far in the future
        [(1000, 1, 1000)],
    ]
    for n, rows in enumerate(batches):
        write_readings(spark, f"{root}/in", *rows)
        time.sleep(1.1)  # file order follows modification time
    stream = spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    query = aggregate.start_aggregates(
        aggregate.aggregate_stream(stream), f"{root}/aggregates", f"{root}/checkpoint", once=True
    )
    query.awaitTermination()
    sent = codec.decode(topics.read_topic(spark, f"{root}/aggregates"), V.AGGREGATE)
    got = summary_rows(sent.select("event.*"))
    batch = spark.read.schema(READINGS).parquet(f"{root}/in").where(~aggregate.is_future())
    closed = windows.summarise(windows.on_time(batch))
    watermark = at(1000) - timedelta(seconds=122)
    want = summary_rows(closed.where(F.col("window_end") <= F.lit(watermark)))
    assert got == want and len(got) == 4
    seen = [p.observedMetrics["lateness"] for p in query.recentProgress if "lateness" in p.observedMetrics]
    assert [sum(s[k] or 0 for s in seen) for k in ("offered", "late", "future")] == [10, 2, 1]


def test_stream_counts_duplicates_unless_told_not_to(spark, root):
    write_readings(spark, f"{root}/in", (1, 20, 1), (1, 20, 2), (1000, 1, 1000))
    for drop, want in ((False, 2), (True, 1)):
        stream = spark.readStream.schema(READINGS).parquet(f"{root}/in")
        aggregate.start_aggregates(
            aggregate.aggregate_stream(stream, drop_duplicates=drop),
            f"{root}/out-{drop}",
            f"{root}/checkpoint-{drop}",
            once=True,
        ).awaitTermination()
        sent = codec.decode(topics.read_topic(spark, f"{root}/out-{drop}"), V.AGGREGATE)
        assert [r[4] for r in summary_rows(sent.select("event.*"))] == [want]


def test_feed_sends_each_subscriber_everything(spark, root):
    write_readings(spark, f"{root}/in", (1, 20, 1), (12, 30, 12))
    rows = aggregate.aggregates_topic(windows.summarise(spark.read.parquet(f"{root}/in")), F.lit(BASE))
    broken = rows.limit(1).withColumn("value", F.lit("{}").cast("binary"))
    topics.append_topic(rows.union(broken), f"{root}/aggregates", "0")
    for name in ("one", "two"):
        got = []
        feed.start_feed(
            topics.stream_topic(spark, f"{root}/aggregates"),
            lambda batch, number: got.extend(r.message for r in batch.collect()),
            f"{root}/{name}",
            once=True,
        ).awaitTermination()
        assert [json.loads(m)["avg_temp_c"] for m in got] == [20.0, 30.0]
        assert list(json.loads(got[0])) == S.AGGREGATE.names


def test_wall_clock_closes_a_silent_stream(spark, root):
    size, grace = timedelta(seconds=4), timedelta(seconds=2)
    now = datetime.now(timezone.utc).replace(microsecond=0)
    # Dated ahead, so a slow start does not make them late.
    ahead = now + timedelta(seconds=20)
    fresh = [("a", 47.5, 19.0, t, ahead, now) for t in (20.0, 22.5, 21.0)]
    old = [("a", 47.5, 19.0, 50.0, now - timedelta(hours=1), now)]
    spark.createDataFrame(fresh + old, READINGS).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(READINGS).parquet(f"{root}/in")
    closed = wallclock.wall_clock_stream(stream, size, grace)
    query = aggregate.start_aggregates(closed, f"{root}/aggregates", f"{root}/checkpoint")

    def sent():
        try:
            return codec.decode(topics.read_topic(spark, f"{root}/aggregates"), V.AGGREGATE).collect()
        except AnalysisException:  # nothing written yet
            return []

    try:
        deadline = time.time() + 90
        while time.time() < deadline and not sent() and query.isActive:
            time.sleep(1)
        time.sleep(3)  # a window must not come out twice
        rows = [row.event for row in sent()]
        seen = [p.observedMetrics for p in query.recentProgress]
        late = sum(s["lateness"]["late"] or 0 for s in seen if "lateness" in s)
    finally:
        query.stop()
    assert query.exception() is None
    assert [(r.avg_temp_c, r.min_temp_c, r.max_temp_c, r["count"]) for r in rows] == [(21.17, 20.0, 22.5, 3)]
    assert late == 1


def test_streams_read_files_and_folders_alike(spark, sf_dir, tmp_path):
    from pyspark.sql import functions as F

    from stationflow.plans import views

    whole = views.events(spark, sf_dir)
    whole.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    for folder in (sf_dir, str(tmp_path)):
        query = views.events_stream(spark, folder).writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.table("seen").agg(F.sum("event_id")).first() == whole.agg(F.sum("event_id")).first()


def test_audit_counts_what_the_handler_keeps(spark, tmp_path):
    from builders import READING, at, topic, wire

    from stationflow.streaming import ingest

    kept = []
    rows = topic(spark, [wire(READING), wire({**READING, "ts": at(5)}), b"not json at all"])
    outputs = ingest.Outputs(
        dead_letters=None,
        history=lambda df, name: kept.append(df.count()),
        clean=lambda df, name: kept.append(df.count()),
        audit=lambda df, name: kept.append(df.first().processed),
    )
    ingest.ingest_batch(rows, "b1", outputs, handler=lambda good: good.limit(1))
    assert kept == [1, 1, 1]


def rolled(spark, root):
    return codec.decode(rollup.aggregates(spark, root), V.AGGREGATE).select("event.*")


def test_rollup_equals_batch_in_any_order(spark, root):
    # Newest first, one file a batch: a watermark would drop nearly all of it.
    files = [
        [(1000, 1, 1000), (10_000, 5, 500)],
        [(2, 60, 501), (25, 10, 26), (3, 50, 13)],  # late, on time, late
        [(1, 20, 1), (5, 22, 5), (12, 30, 13), (9, 21, 11)],
    ]
    for rows in files:
        write_readings(spark, f"{root}/in", *rows)
        time.sleep(1.1)

    def flush(second):
        stream = spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        rollup.drain(stream, root, now=at(second), settle=timedelta(0))
        return summary_rows(rolled(spark, root))

    batch = windows.summarise(windows.on_time(spark.read.schema(READINGS).parquet(f"{root}/in")))
    want = summary_rows(batch)
    # The reading dated ahead waits; the windows that are over come out without newer data.
    first = flush(2000)
    assert first == [w for w in want if w[0] < 2000] and len(first) == 4
    balance = {r.fate: r.n for r in rollup.balance(spark, root, rolled(spark, root)).collect()}
    assert balance == {"sent": 6, "waiting": 1, "late": 2, "missed": 0}
    assert flush(2000) == first
    assert flush(20_000) == want


def test_rollup_repeats_a_broken_closing_and_counts_missed_rows(spark, root, monkeypatch):
    write_readings(spark, f"{root}/in", (1, 20, 1), (12, 30, 12))

    def flush(second):
        stream = spark.readStream.schema(READINGS).parquet(f"{root}/in")
        rollup.drain(stream, root, now=at(second), settle=timedelta(0))

    with monkeypatch.context() as patch:
        real = rollup.append_topic

        def broken(*args):
            real(*args)
            raise RuntimeError("lost the driver")

        patch.setattr(rollup, "append_topic", broken)
        with pytest.raises(RuntimeError):
            flush(15)
    flush(30)
    assert [row[0] for row in summary_rows(rolled(spark, root))] == [0, 10]
    # On time by its arrival, but read after its window was sent: counted, kept apart, no error.
    write_readings(spark, f"{root}/in", (2, 20, 3), (7, 40, 8), (3, 50, 13), (31, 8, 32))
    flush(40)
    assert [row[0] for row in summary_rows(rolled(spark, root))] == [0, 10]
    assert summary_rows(rollup.corrections(spark, root)) == [(0, 30.0, 20.0, 40.0, 2)]
    flush(60)
    assert [row[0] for row in summary_rows(rolled(spark, root))] == [0, 10, 30]
    balance = {r.fate: r.n for r in rollup.balance(spark, root, rolled(spark, root)).collect()}
    assert balance == {"sent": 3, "waiting": 0, "late": 1, "missed": 2}


def test_rollup_of_an_empty_topic(spark, root):
    spark.createDataFrame([], READINGS).write.parquet(f"{root}/in")
    rollup.drain(spark.readStream.schema(READINGS).parquet(f"{root}/in"), root, now=at(5))
    assert rollup.aggregates(spark, root).count() == 0
    assert [r.n for r in rollup.balance(spark, root, rolled(spark, root)).collect()] == [0, 0, 0, 0]


def file_stream(spark, root, schema=READINGS):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")


def test_closings_open_few_segments():
    """A thousand flushes, merged by tiers of sixteen: never more than 45 segments."""
    segments, most = [], 0
    for n in range(1, 1001):
        segments.append(manifest.Segment(str(n), 0, n, n + 5))
        while members := manifest.to_merge(segments):
            ends = [s.first_us for s in members], [s.last_us for s in members]
            segments = [s for s in segments if s not in members]
            segments.append(manifest.Segment(f"{members[0].name}+", members[0].tier + 1, min(ends[0]), max(ends[1])))
        most = max(most, len(segments))
    assert most <= 45
    opened = [s for s in segments if s.holds(900, 1000)]
    assert {s.last_us for s in opened} == {s.last_us for s in segments if s.last_us > 900}


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", range(4))
def test_compaction_killed_anywhere_loses_and_doubles_nothing(spark, root, monkeypatch, step, after):
    """The process dies before or after the n-th step that touches storage; the next flush goes on."""
    rows = [(i, 20 + i % 7, i + 1) for i in range(0, 64, 3)]
    for part in range(3):
        write_readings(spark, f"{root}/in", *rows[part::3], (500 + part, 10 + part, 501 + part))

    def flush(second, fan=3):
        rollup.drain(file_stream(spark, root), root, now=at(second), settle=timedelta(0), fan=fan)

    steps = iter(range(100))

    def dying(real):
        def run(*args, **kwargs):
            mine = next(steps) == step
            out = None if mine and not after else real(*args, **kwargs)
            if mine:
                raise RuntimeError("killed")
            return out

        return run

    flush(0, fan=99)
    before = len(manifest.read(spark, root).segments)
    assert before >= 3
    with monkeypatch.context() as patch:
        for owner, name in ((rollup, "_segments"), (rollup, "_write_segment"), (files, "write_new")):
            patch.setattr(owner, name, dying(getattr(owner, name)))
        with pytest.raises(RuntimeError, match="killed"):
            rollup.compact(spark, root, fan=3)
    flush(40)
    assert len(manifest.read(spark, root).segments) < before
    flush(2000)
    whole = windows.summarise(windows.on_time(spark.read.schema(READINGS).parquet(f"{root}/in")))
    assert summary_rows(rolled(spark, root)) == summary_rows(whole)


def test_a_batch_that_runs_again_is_added_once(spark, root):
    import shutil

    write_readings(spark, f"{root}/in", (1, 20, 1), (12, 30, 12))
    rollup.drain(file_stream(spark, root), root, now=at(0), settle=timedelta(0))
    # The process died before the query could write its commit.
    shutil.rmtree(f"{root}/checkpoint/commits")
    rollup.drain(file_stream(spark, root), root, now=at(100), settle=timedelta(0))
    assert [(row[0], row[-1]) for row in summary_rows(rolled(spark, root))] == [(0, 1), (10, 1)]


def test_a_table_keeps_its_window_size(spark, root):
    write_readings(spark, f"{root}/in", (1, 20, 1))
    rollup.drain(file_stream(spark, root), root, now=at(0), settle=timedelta(0))
    write_readings(spark, f"{root}/in", (2, 20, 2))
    with pytest.raises(Exception, match="another window size"):
        rollup.drain(file_stream(spark, root), root, timedelta(hours=1), now=at(9), settle=timedelta(0))


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 2, 0]])
def test_first_deliveries_count_in_any_order(spark, root, order):
    kind = f"{READINGS}, `partition` int, `offset` bigint"
    parts = [[("a", 1, 20.0, 5), ("b", 1, 10.0, 6)], [("a", 1, 99.0, 7), ("a", 3, 30.0, 8)], [("b", 1, 50.0, 2), ("b", 1, 50.0, 2)]]
    for n in order:
        rows = [(s, 47.5, 19.0, t, at(sec), at(sec + 1), 0, o) for s, sec, t, o in parts[n]]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{root}/in")
    rollup.drain(file_stream(spark, root, kind), root, now=at(50), settle=timedelta(0), drop_duplicates=True, fan=2)
    assert summary_rows(rolled(spark, root)) == [(0, 33.33, 20.0, 50.0, 3)]


def test_flushes_on_a_timer_close_a_silent_stream(spark, root):
    now = datetime.now(timezone.utc).replace(microsecond=0)
    rows = [("a", 47.5, 19.0, t, now, now) for t in (20.0, 22.0)]
    spark.createDataFrame(rows, READINGS).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(READINGS).parquet(f"{root}/in")
    flushes = rollup.start_flushes(stream, root, timedelta(milliseconds=200), size=timedelta(seconds=2), settle=timedelta(0))
    try:
        deadline = time.time() + 90
        while time.time() < deadline and flushes.is_active and not rolled(spark, root).count():
            time.sleep(0.5)
    finally:
        flushes.stop()
    assert flushes.done > 0 and not flushes.is_active
    assert [(r.avg_temp_c, r["count"]) for r in rolled(spark, root).collect()] == [(21.0, 2)]


def test_an_error_of_a_flush_ends_the_timer():
    def flush():
        raise RuntimeError("disk full")

    flushes = rollup.Flushes(flush, timedelta(0))
    with pytest.raises(RuntimeError, match="disk full"):
        flushes.await_termination(10)
    assert not flushes.is_active and flushes.done == 0


def test_a_version_is_written_once(spark, root):
    state = manifest.commit(spark, root, manifest.Manifest(), counts={"late": 1}, closing=(1, 5))
    assert manifest.read(spark, root) == state
    with pytest.raises(FileExistsError):
        manifest.commit(spark, root, manifest.Manifest())
    for _ in range(manifest.KEPT_VERSIONS + 3):
        state = manifest.commit(spark, root, state, segments=(manifest.Segment("a", 1, 2, 3),), garbage=("b",), closing=None)
    assert manifest.read(spark, root) == state
    assert len(manifest.files.names(spark, f"{root}/manifest")) <= manifest.KEPT_VERSIONS


def test_audit_totals_over_runs(spark, root):
    listener = audit.AuditListener(spark, f"{root}/progress")
    spark.streams.addListener(listener)
    done = []
    outputs = ingest.Outputs(dead_letters=None, history=lambda df, n: done.append(df.count()), clean=lambda df, n: None)
    try:
        for payloads in ([wire(READING), b"no"], [wire(READING)], []):
            if payloads:
                topic(spark, payloads).write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(S.TOPIC_ROW).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
            run = ingest.start_ingest(stream, outputs, f"{root}/checkpoint", once=True)
            run.awaitTermination()
            assert listener.await_run(run.runId)
    finally:
        spark.streams.removeListener(listener)
    rows = audit.read_audit(spark, f"{root}/progress")
    # The third run found nothing to do.
    assert rows.count() == 2 and rows.select("query").distinct().count() == 1
    totals = {r.metric: r.n for r in audit.metric_totals(rows).collect()}
    assert totals == {"rows": 3, "ingest.offered": 3, "ingest.rejected": 1, "ingest.accepted": 2}
    assert audit.read_audit(spark, f"{root}/none").count() == 0
