import random
from datetime import datetime, timedelta

import pytest
from builders import at
from pyspark.sql import functions as F

from stationflow.operators import dedup
from stationflow.sources import history, topics

SCHEMA = (
    "sensor_id string, lat double, lon double, temp_c double, ts timestamp, partition int, offset bigint"
)


def offered(spark, *rows):
    """(sensor, second, temperature, offset)"""
    return spark.createDataFrame(
        [(s, 47.5, 19.0, float(t), at(second), 0, o) for s, second, t, o in rows], SCHEMA
    )


def stored(spark, path):
    rows = history.scan(spark, path).select("sensor_id", F.unix_seconds("ts").alias("s"), "temp_c")
    base = int(at(0).timestamp())
    return sorted((r.sensor_id, r.s - base, r.temp_c) for r in rows.collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "history")
    history.ensure_history(spark, path)
    return path


def test_first_delivery_wins_against_brute_force(spark):
    rng = random.Random(11)
    rows = [(f"s{rng.randrange(5)}", rng.randrange(6), n, rng.randrange(10**9)) for n in range(400)]
    # A third of all rows are copies of one reading.
    rows += [("hot", 0, n, 2 * 10**9 - n) for n in range(200)]
    rng.shuffle(rows)
    want = {}
    for sensor, second, temp, offset in rows:
        key = (sensor, second)
        if key not in want or offset < want[key][0]:
            want[key] = (offset, float(temp))
    df = offered(spark, *rows).repartition(4)
    for packed in (True, False):
        got = dedup.first_by_position(df, packed=packed).withColumn("s", F.unix_seconds("ts"))
        base = int(at(0).timestamp())
        assert {(r.sensor_id, r.s - base): r.temp_c for r in got.collect()} == {
            key: temp for key, (_, temp) in want.items()
        }


def test_position_orders_partitions_first_and_refuses_what_does_not_fit(spark):
    df = offered(spark, ("a", 0, 1, 5)).union(
        offered(spark, ("a", 0, 2, 3)).withColumn("partition", F.lit(1))
    )
    assert dedup.first_by_position(df).first().temp_c == 1.0
    big = df.withColumn("offset", F.lit(2**60))
    with pytest.raises(Exception, match="packed=False"):
        dedup.first_by_position(big).collect()
    assert dedup.first_by_position(big, packed=False).first().temp_c == 1.0


def test_hot_key_is_merged_before_the_shuffle(spark):
    plan = dedup.first_by_position(offered(spark, ("a", 0, 1, 5)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "HashAggregate" in plan and "SortAggregate" not in plan


def test_same_reading_twice_is_stored_once(spark, table):
    history.append_ignore(spark, table, offered(spark, ("a", 0, 1, 0), ("a", 0, 1, 1), ("a", 5, 2, 2)), "q-0")
    assert stored(spark, table) == [("a", 0, 1.0), ("a", 5, 2.0)]


def test_stored_rows_win_over_later_batches(spark, table):
    history.append_ignore(spark, table, offered(spark, ("a", 0, 1, 0)), "q-0")
    history.append_ignore(spark, table, offered(spark, ("a", 0, 9, 1), ("b", 0, 3, 2)), "q-1")
    assert stored(spark, table) == [("a", 0, 1.0), ("b", 0, 3.0)]


def test_replaying_a_batch_changes_nothing(spark, table):
    history.append_ignore(spark, table, offered(spark, ("a", 0, 1, 0), ("b", 90_000, 2, 1)), "q-0")
    rows = offered(spark, ("a", 0, 9, 2), ("c", 1, 4, 3), ("d", 90_001, 5, 4))
    history.append_ignore(spark, table, rows, "q-1")
    once = stored(spark, table)
    history.append_ignore(spark, table, rows, "q-1")
    assert stored(spark, table) == once
    assert len(once) == 4


def test_a_new_query_never_replaces_rows_of_an_old_one(spark, table):
    history.append_ignore(spark, table, offered(spark, ("a", 0, 1, 0)), "old-0")
    history.append_ignore(spark, table, offered(spark, ("a", 0, 1, 0), ("b", 1, 2, 1)), "new-0")
    assert stored(spark, table) == [("a", 0, 1.0), ("b", 1, 2.0)]


def test_ensure_keeps_an_existing_table(spark, table):
    history.append_ignore(spark, table, offered(spark, ("a", 0, 1, 0)), "q-0")
    history.ensure_history(spark, table)
    assert len(stored(spark, table)) == 1


def test_empty_batch_writes_nothing(spark, table):
    history.append_ignore(spark, table, offered(spark, ("a", 0, 1, 0)).where("false"), "q-0")
    assert stored(spark, table) == []


def test_many_days_fall_back_to_a_day_range(spark, table, monkeypatch):
    monkeypatch.setattr(history, "MAX_LISTED_DAYS", 2)
    rows = [("a", day * 86_400, day, day) for day in range(5)]
    assert history.touched_days(offered(spark, *rows), 2).listed == ()
    monkeypatch.setattr(history, "touched_days", lambda df, most=2, real=history.touched_days: real(df, 2))
    history.append_ignore(spark, table, offered(spark, *rows), "q-0")
    history.append_ignore(spark, table, offered(spark, *rows, ("b", 0, 1, 9)), "q-1")
    assert len(stored(spark, table)) == 6


def test_big_batches_take_the_shuffle_path(spark, table, monkeypatch):
    monkeypatch.setattr(history, "BROADCAST_ROWS", 1)
    history.append_ignore(spark, table, offered(spark, ("a", 0, 1, 0), ("b", 1, 1, 1)), "q-0")
    history.append_ignore(spark, table, offered(spark, ("a", 0, 2, 2), ("b", 1, 2, 3), ("c", 2, 2, 4)), "q-1")
    assert stored(spark, table) == [("a", 0, 1.0), ("b", 1, 1.0), ("c", 2, 2.0)]


def test_stored_keys_of_other_times_are_skipped_by_statistics(spark, table):
    history.append_ignore(spark, table, offered(spark, ("a", 0, 1, 0), ("b", 50, 1, 1)), "q-0")
    days = history.touched_days(offered(spark, ("a", 50, 2, 2), ("c", 60, 2, 3)))
    keys = history._stored_keys(spark, table, days, "q-1")
    assert [r.sensor_id for r in keys.collect()] == ["b"]
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan


def test_range_scan_prunes_days(spark, table):
    rows = [("a", day * 86_400, day, day) for day in range(5)]
    history.append_ignore(spark, table, offered(spark, *rows), "q-0")
    start = datetime(2025, 3, 10, 12)
    df = history.scan_range(spark, table, start, start + timedelta(days=2))
    assert sorted(r.temp_c for r in df.collect()) == [1.0, 2.0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_key_scan_is_pushed_down(spark, table):
    history.append_ignore(spark, table, offered(spark, ("a", 0, 1, 0), ("b", 1, 2, 1)), "q-0")
    df = history.count_for(history.scan(spark, table), "a")
    assert df.first()["count"] == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(sensor_id,a)" in plan and "ReadSchema: struct<sensor_id:string>" in plan


def test_compaction_keeps_rows_and_replays(spark, table, tmp_path):
    first = offered(spark, ("a", 0, 1, 0), ("b", 1, 2, 1))
    second = offered(spark, ("a", 0, 9, 2), ("c", 2, 3, 3))
    history.append_ignore(spark, table, first, "q-0")
    history.append_ignore(spark, table, second, "q-1")
    target = str(tmp_path / "compacted")
    history.compact(spark, table, target)
    assert stored(spark, target) == stored(spark, table)
    # A batch that is run again after the switch adds nothing.
    history.append_ignore(spark, target, second, "q-1")
    assert stored(spark, target) == stored(spark, table)


def scanned(df):
    """Rows that the scans of a finished query handed on."""
    df.collect()
    nodes, rows = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif node.getClass().getSimpleName().endswith("QueryStageExec"):
            nodes.append(node.plan())
        elif node.getClass().getSimpleName() == "FileSourceScanExec":
            rows += node.metrics().apply("numOutputRows").value()
        else:
            nodes += [node.children().apply(i) for i in range(node.children().length())]
    return rows


def test_row_groups_of_other_sensors_are_skipped(spark, table):
    """A day's rows of two overlapping appends; one sensor is asked for, one has no row."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows = [(f"s{n % 40:03}", n // 40, n % 7, n) for n in range(40_000) if n % 40 != 25]
    conf.set("parquet.block.size", "8192")
    conf.set("parquet.page.row.count.limit", "1000")
    try:
        history.append_ignore(spark, table, offered(spark, *[r for r in rows if r[3] % 3]), "q-0")
        history.append_ignore(spark, table, offered(spark, *rows), "q-1")
    finally:
        conf.unset("parquet.block.size")
        conf.unset("parquet.page.row.count.limit")
    whole = history.scan(spark, table)
    assert whole.count() == len(rows)
    one = history.count_for(whole, "s007")
    assert one.first()["count"] == 1000 and scanned(one) < len(rows) / 4
    # Within the range of its neighbours, but in no Bloom filter.
    none = history.count_for(whole, "s025")
    assert none.first()["count"] == 0 and scanned(none) == 0


def test_days_outside_a_range_are_not_read(spark, table):
    rows = [("a", day * 86_400, day, day) for day in range(6)]
    history.append_ignore(spark, table, offered(spark, *rows), "q-0")
    found = history.scan_range(spark, table, datetime(2025, 3, 10), datetime(2025, 3, 12))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert scanned(found) == 2 == found.count() or scanned(found) == 3


def test_days_are_compacted_apart(spark, table, tmp_path):
    rows = [("a", day * 86_400, day, day) for day in range(4)]
    history.append_ignore(spark, table, offered(spark, *rows[:3]), "q-0")
    history.append_ignore(spark, table, offered(spark, *rows), "q-1")
    target = str(tmp_path / "days")
    history.compact(spark, table, target, datetime(2025, 3, 10).date(), datetime(2025, 3, 11).date())
    assert [r[2] for r in stored(spark, target)] == [1.0, 2.0]


def test_purge_drops_whole_old_days(spark, table):
    rows = [("a", day * 86_400, day, day) for day in range(5)]
    history.append_ignore(spark, table, offered(spark, *rows), "q-0")
    now = datetime(2025, 3, 13, 13)
    gone = topics.purge_days(spark, table, "event_date", now, timedelta(hours=24))
    assert gone == ["2025-03-09", "2025-03-10", "2025-03-11"]
    assert [r[2] for r in stored(spark, table)] == [3.0, 4.0]
    assert topics.purge_days(spark, table + "-missing", "event_date", now, timedelta(hours=1)) == []
