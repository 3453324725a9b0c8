from datetime import timedelta

import pytest
from builders import BASE, READING, at, topic, wire
from pyspark.sql import functions as F

from stationflow import schemas as S
from stationflow.operators import metrics
from stationflow.operators.regions import cover, with_region
from stationflow.sources import topics


def reading(temp):
    return wire({**READING, "temp_c": temp})


def test_write_and_read_keeps_order_per_key(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = topic(spark, [reading(20.0 + n) for n in range(5)])
    topics.append_topic(rows, path, "q-0")
    back = topics.read_topic(spark, path).orderBy("partition", "offset").collect()
    assert [bytes(r.value) for r in back] == [reading(20.0 + n) for n in range(5)]
    topics.append_topic(rows, path, "q-0")
    assert topics.read_topic(spark, path).count() == 5
    topics.append_topic(rows, path, "q-1")
    assert topics.read_topic(spark, path).count() == 10


def test_same_key_same_partition(spark):
    keys = spark.range(600).select(F.concat(F.lit("s"), F.col("id") % 50).alias("k"), F.col("id").alias("o"))
    rows = topics.topic_rows(keys, S.CLEAN_TOPIC, F.col("k"), F.lit("v"), F.col("o"))
    per_key = rows.groupBy("key").agg(F.count_distinct("partition").alias("n"))
    assert per_key.where("n <> 1").count() == 0
    used = {r.partition for r in rows.select("partition").distinct().collect()}
    assert used == set(range(S.CLEAN_TOPIC.partitions))


def test_latest_skips_the_backlog(spark):
    rows = topic(spark, [b"a", b"b"], partition=0).union(topic(spark, [b"c"], partition=1))
    ends = topics.end_offsets(rows)
    later = rows.union(topic(spark, [b"d"], partition=0, start=2)).union(topic(spark, [b"e"], partition=2))
    assert sorted(bytes(r.value) for r in topics.after_offsets(later, ends).collect()) == [b"d", b"e"]


def test_retention_limit_is_inclusive(spark):
    rows = topic(spark, [b"a"], when=at(-60)).union(topic(spark, [b"b"], when=at(-61)))
    kept = rows.where(topics.is_retained(timedelta(minutes=1), F.lit(BASE)))
    assert [bytes(r.value) for r in kept.collect()] == [b"a"]


def test_topic_settings():
    assert [(t.name, t.partitions, t.retention) for t in S.TOPICS] == [
        ("sensor.readings", 6, timedelta(hours=24)),
        ("sensor.readings.clean", 6, timedelta(hours=24)),
        ("sensor.readings.dlq", 1, timedelta(days=7)),
        ("weather.aggregates", 3, timedelta(hours=1)),
    ]


def test_kafka_options():
    source = topics.kafka_source_options("host:9092", "sensor.readings")
    assert source["startingOffsets"] == "earliest" and source["subscribe"] == "sensor.readings"
    late = topics.kafka_source_options("host:9092", "weather.aggregates", from_latest=True, max_offsets=5)
    assert late["startingOffsets"] == "latest" and late["maxOffsetsPerTrigger"] == "5"
    assert topics.kafka_sink_options("host:9092", "t")["kafka.acks"] == "all"


def test_lag(spark):
    rows = topic(spark, [b"a", b"b", b"c"]).union(topic(spark, [b"x"], partition=1))
    committed = spark.createDataFrame([("sensor.readings", 0, 0)], "topic string, partition int, committed bigint")
    lag = {r.partition: r.lag for r in metrics.topic_lag(rows, committed).collect()}
    assert lag == {0: 2, 1: 1}


def test_regions_against_brute_force(spark):
    import random

    rng = random.Random(5)
    places = [(n, rng.choice([47.0, 47.25, rng.uniform(45, 49)]), rng.uniform(16, 23)) for n in range(300)]
    boxes = [("a", 45.7, 47.0, 16.1, 19.0), ("b", 47.0, 48.6, 16.1, 22.9), ("c", 46.9, 47.3, 18.0, 18.01)]
    df = spark.createDataFrame(places, "n int, lat double, lon double")
    regions = spark.createDataFrame(
        boxes, "scope string, min_lat double, max_lat double, min_lon double, max_lon double"
    )
    placed = with_region(df, regions)
    got = sorted((r.n, r.scope) for r in placed.collect())
    inside = {n: [s for s, a, b, c, d in boxes if a <= lat < b and c <= lon < d] for n, lat, lon in places}
    assert got == sorted((n, s) for n, scopes in inside.items() for s in scopes or ["unassigned"])
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


BOXES = "scope string, min_lat double, max_lat double, min_lon double, max_lon double"


def test_many_boxes_of_all_sizes(spark):
    """Broadcast cells, and the form for more cells than may be broadcast, against all pairs."""
    import random

    rng = random.Random(9)
    boxes = []
    for n in range(60):
        lat, lon = rng.uniform(-60, 60), rng.uniform(-150, 150)
        high, wide = (10 ** rng.uniform(-4, 1.3) for _ in "ab")
        boxes.append((f"r{n}", lat, lat + high, lon, lon + wide))
    boxes.append(("point", 1.0, 1.0, 2.0, 2.0))
    boxes.append(("reversed", 5.0, 4.0, 2.0, 3.0))
    edges = [(lat, lon) for _, a, b, c, d in boxes for lat, lon in ((a, c), (b, d), (a, d), ((a + b) / 2, (c + d) / 2))]
    places = [(n, *p) for n, p in enumerate([*edges, *edges[:9], (None, 3.0), (float("nan"), 2.0), (1e30, 0.0), (95.0, -200.0)])]
    df = spark.createDataFrame(places, "n int, lat double, lon double")
    regions = spark.createDataFrame(boxes, BOXES)

    def scopes(lat, lon):
        return [s for s, a, b, c, d in boxes if lat is not None and a <= lat < b and c <= lon < d] or ["unassigned"]

    want = sorted((n, s) for n, lat, lon in places for s in scopes(lat, lon))
    for limit in (250_000, 0):
        placed = with_region(df, regions, limit)
        assert placed.columns == ["n", "lat", "lon", "scope"]
        assert sorted((r.n, r.scope) for r in placed.collect()) == want
    none = with_region(df, regions.where("false"))
    assert {r.scope for r in none.collect()} == {"unassigned"} and none.count() == len(places)


def test_cells_of_a_box_are_few(spark):
    import random

    rng = random.Random(1)
    boxes = [("ten", 40.0, 50.0, 10.0, 20.0), ("stripe", 45.7, 48.65, 16.0, 16.25), ("line", 0.0, 20.0, 5.0, 5.0001)]
    boxes += [(f"r{n}", a, a + 10 ** rng.uniform(-4, 1.5), b, b + 10 ** rng.uniform(-4, 1.5)) for n in range(200) for a, b in [(rng.uniform(-50, 50), rng.uniform(-100, 100))]]
    cells = cover(spark.createDataFrame(boxes, BOXES))
    sizes = {r.scope: r["count"] for r in cells.groupBy("scope").count().collect()}
    assert set(sizes) == {b[0] for b in boxes} and max(sizes.values()) < 200
    assert cells.where("scope = 'ten'").select("level").distinct().count() > 1


def test_readings_are_not_shuffled_to_find_their_region(spark):
    """Half of the readings lie in one cell: they stay where they are."""
    df = spark.range(2000).selectExpr("id AS n", "if(id % 2 = 0, 47.1, 46.0 + id / 1000) AS lat", "19.0D AS lon")
    regions = spark.createDataFrame([("a", 45.0, 47.0, 18.0, 20.0), ("b", 47.0, 48.0, 18.0, 20.0)], BOXES)
    placed = with_region(df.repartition(4), regions)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert placed.groupBy("scope").count().orderBy("scope").collect()[0]["count"] > 400


def test_percentile_is_exact_on_large_groups(spark):
    import math
    import random

    rng = random.Random(2)
    rows = []
    for service, n in (("a", 20_000), ("b", 1), ("c", 20), ("d", 100)):
        spread = rng.choice([10**3, 10**6])
        rows += [(service, at(0), at(0) + timedelta(microseconds=int(rng.expovariate(1 / spread)) - 50), i % 7 == 0) for i in range(n)]
    rows += [("c", at(0), None, False), ("e", None, at(0), True)]
    df = spark.createDataFrame(rows, "service string, ts timestamp, arrival_ts timestamp, is_error boolean")
    for share in ((95, 100), (1, 2), (1, 1)):
        got = {r.service: r for r in metrics.service_metrics(df, timedelta(hours=1), share).collect()}
        for service in "abcd":
            known = sorted((b - a) / timedelta(microseconds=1) for s, a, b, _ in rows if s == service and a and b)
            row = got[service]
            assert row.p95_latency_ms == known[math.ceil(len(known) * share[0] / share[1]) - 1] / 1000
            assert row.max_latency_ms == known[-1] / 1000 and math.isclose(row.avg_latency_ms, sum(known) / len(known) / 1000)
            assert row.handled == sum(s == service for s, *_ in rows)
        assert (got["e"].handled, got["e"].p95_latency_ms, got["e"].error_share) == (1, None, 1.0)


def test_service_figures(spark):
    rows = [("a", at(0), at(1), False), ("a", at(1), at(4), True), ("a", at(2), at(4), False)]
    df = spark.createDataFrame(rows, "service string, ts timestamp, arrival_ts timestamp, is_error boolean")
    row = metrics.service_metrics(df).first()
    assert (row.handled, row.error_share, row.avg_latency_ms) == (3, 1 / 3, 2000.0)
    assert (row.max_latency_ms, row.p95_latency_ms) == (3000.0, 3000.0)
    burn = metrics.slo_burn(df).first()
    assert burn.good_share == 2 / 3 and abs(burn.budget_burn - 100 / 3) < 1e-9


def test_latest_by_files_loses_no_row_of_a_derived_topic(spark, tmp_path):
    path = str(tmp_path / "letters")
    # The backlog ends at offset 10,000; a live letter of another source partition has offset 6.
    topics.append_topic(topic(spark, [b"old"], start=10_000), path, "0")
    backlog = topics.end_files(spark, path)
    backlog.write.parquet(str(tmp_path / "backlog"))
    topics.append_topic(topic(spark, [b"live"], start=6), path, "1")
    live = topics.stream_topic(spark, path, backlog=spark.read.parquet(str(tmp_path / "backlog")))
    query = live.writeStream.format("memory").queryName("latest_by_files").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [bytes(r.value) for r in spark.table("latest_by_files").collect()] == [b"live"]


@pytest.mark.parametrize("listed", [50_000, 3])
def test_latest_opens_no_file_of_the_backlog(spark, tmp_path, monkeypatch, listed):
    """Named in the plan, the backlog's files are not opened; too many of them are passed over row by row."""
    monkeypatch.setattr(topics, "LISTED_FILES", listed)
    path = str(tmp_path / "topic")
    for n in range(5):
        topics.append_topic(topic(spark, [b"old"] * 20, start=20 * n).coalesce(1), path, f"old-{n}")
    backlog = topics.end_files(spark, path)
    assert backlog.count() == 5
    for n in range(2):
        topics.append_topic(topic(spark, [b"live"], start=n), path, f"new-{n}")
    query = topics.stream_topic(spark, path, backlog=backlog).writeStream.format("memory").queryName(f"latest_{listed}")
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    assert [bytes(r.value) for r in spark.table(f"latest_{listed}").collect()] == [b"live"] * 2
    read = sum(p.numInputRows for p in query.recentProgress)
    assert read == 2 if listed > 5 else read > 2


def test_retention_on_read(spark, tmp_path):
    path = str(tmp_path / "topic")
    hours = [0, 20, 23, 24, 47]
    for n, hour in enumerate(hours):
        topics.append_topic(topic(spark, [b"v"], start=n, when=at(3600 * hour)), path, str(n))
    kept = lambda limit: sorted(r.offset for r in topics.read_topic(spark, path, limit, at(3600 * 47)).collect())
    assert kept(timedelta(hours=24)) == [2, 3, 4] and kept(timedelta(hours=1)) == [4] and kept(None) == [0, 1, 2, 3, 4]


def test_positions_of_kafka_sources(spark):
    from stationflow.streaming import audit

    rows = [
        ("q", "r1", None, 3, 3, "2025-03-09T10:00:00Z", 5, 1, {}, ['{"t":{"0":10,"1":4}}']),
        ("q", "r2", None, 5, 2, "2025-03-09T11:00:00Z", 5, 1, {}, ['{"t":{"0":12,"1":7},"u":{"0":1}}']),
        ("f", "r3", None, 5, 2, "2025-03-09T11:00:00Z", 5, 1, {}, ['{"logOffset":3}']),
    ]
    got = audit.kafka_positions(spark.createDataFrame(rows, audit.AUDIT)).collect()
    assert sorted(map(tuple, got)) == [("q", "t", 0, 11), ("q", "t", 1, 6), ("q", "u", 0, 0)]
