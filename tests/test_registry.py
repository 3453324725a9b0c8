import pytest
from builders import BASE, SENSOR, frame

from stationflow import schemas as S
from stationflow.operators import registry as R
from stationflow.operators.dedup import last_by
from stationflow.sources import registry_store as store
from stationflow.sources.registry_store import current_version, read_snapshot, write_snapshot

REQUEST = "request_key string, lat double, lon double, start_temp_c double, pattern string, interval string"


def sensors(spark, *changes):
    return frame(spark, S.SENSOR, *[{**SENSOR, **c} for c in changes])


def ids(df):
    return sorted(r.id for r in df.collect())


def test_text_round_trip(spark):
    df = sensors(spark, {}, {"id": "b", "lat": 46.123456789012345, "interval_ns": 90_000_000_000})
    text = R.to_stored(df).orderBy("id").collect()
    assert text[1].asDict() == {
        "id": "sensor-0417",
        "lat": "46.9036",
        "lon": "19.6877",
        "start_temp_c": "11.75",
        "pattern": "falling",
        "interval": "12s",
        "created_at": "2025-03-09T12:00:00Z",
    }
    assert text[0].interval == "1m30s"
    back = R.from_stored_strict(R.to_stored(df))
    assert sorted(back.collect()) == sorted(df.collect())


@pytest.mark.parametrize("name", ["lat", "lon", "start_temp_c", "interval", "created_at"])
@pytest.mark.parametrize("value", ["garbage", None])
def test_corrupt_fields(spark, name, value):
    from pyspark.sql import functions as F

    text = R.to_stored(sensors(spark, {})).withColumn(name, F.lit(value).cast("string"))
    assert R.from_stored(text).first().bad_field == name
    with pytest.raises(Exception, match=f"sensor sensor-0417: field {name}"):
        R.from_stored_strict(text).collect()
    with pytest.raises(Exception, match=f"field {name}"):
        R.from_stored_strict(text).select("id").collect()


def test_registration(spark):
    rows = [
        ("bare", 47.5, 19.0, None, None, None),
        ("zero", 47.5, 19.0, 0.0, "", ""),
        ("full", 47.5, 19.0, 20.0, "rising", "1.5s"),
        ("berlin", 52.52, 13.4, None, None, None),
        ("empty", None, None, None, None, None),
        ("odd", 47.5, 19.0, None, "sideways", None),
        ("fast", 47.5, 19.0, None, None, "fast"),
        ("slow", 47.5, 19.0, None, None, "45s"),
    ]
    from pyspark.sql import functions as F

    out = R.register(spark.createDataFrame(rows, REQUEST), F.lit(BASE))
    got = {r.request_key: r for r in out.collect()}
    bare, zero, full = got["bare"], got["zero"], got["full"]
    assert (bare.start_temp_c, bare.pattern, bare.interval_ns) == (15.0, "noisy", 5_000_000_000)
    assert (zero.start_temp_c, zero.pattern, zero.interval_ns) == (0.0, "noisy", 5_000_000_000)
    assert (full.start_temp_c, full.pattern, full.interval_ns) == (20.0, "rising", 1_500_000_000)
    assert [r.reason for r in (bare, zero, full)] == [None] * 3
    codes = {k: r.reason_code for k, r in got.items() if r.reason}
    assert codes == {
        "berlin": "coordinates",
        "empty": "coordinates",
        "odd": "pattern",
        "fast": "duration",
        "slow": "interval",
    }
    assert got["fast"].reason == 'interval: "fast" is not a duration (try "5s")'
    assert bare.id.startswith("sensor-") and len(bare.id) == len("sensor-") + 8
    again = {r.request_key: r.id for r in R.register(spark.createDataFrame(rows, REQUEST)).collect()}
    assert again == {k: r.id for k, r in got.items()}
    shown = R.response(out.where("request_key = 'full'")).first()
    assert shown.interval == "1.5s" and shown.asDict().keys() == {
        "id",
        "lat",
        "lon",
        "start_temp_c",
        "pattern",
        "interval",
        "created_at",
    }


def test_collisions_are_found(spark):
    rows = [(f"r{n}", 47.5, 19.0, None, None, None) for n in range(40)]
    df = spark.createDataFrame(rows, REQUEST)
    assert R.id_collisions(R.register(df, id_digits=1)).count() > 0
    assert R.id_collisions(R.register(df)).count() == 0


def test_upsert_last_change_wins(spark):
    from pyspark.sql import functions as F

    old = sensors(spark, {"id": "a", "lat": 46.0}, {"id": "b"})
    changes = sensors(spark, {"id": "a", "lat": 47.0}, {"id": "a", "lat": 48.0}, {"id": "c"})
    changes = changes.withColumn("seq", F.when(F.col("lat") == 48.0, 2).otherwise(1))
    new = {r.id: r.lat for r in R.upsert(old, changes).collect()}
    assert new == {"a": 48.0, "b": 46.9036, "c": 46.9036}
    bad = sensors(spark, {"id": "b", "lat": 90.0}, {"id": "d", "pattern": "odd"}).withColumn("seq", F.lit(3))
    assert {r.id: r.lat for r in R.upsert(old, bad).collect()} == {"a": 46.0, "b": 46.9036}


def test_remove_and_report(spark):
    old = sensors(spark, {"id": "a"}, {"id": "b"})
    gone = spark.createDataFrame([("a",), ("x",), ("x",)], "id string")
    assert ids(R.remove(old, gone)) == ["b"]
    assert {r.id: r.existed for r in R.removal_report(old, gone).collect()} == {"a": True, "x": False}


def test_lookup_and_list(spark):
    records = sensors(spark, {"id": "a"}, {"id": "b"})
    assert ids(R.lookup(records, "a")) == ["a"]
    assert R.lookup(records, "none").count() == 0
    index = spark.createDataFrame([("a",), ("gone",)], "id string")
    assert ids(R.list_registered(index, records)) == ["a"]


def test_reconcile(spark):
    running = sensors(spark, {"id": "a"}, {"id": "b", "lat": 46.0})
    desired = sensors(spark, {"id": "b"}, {"id": "c"})
    assert {r.id: r.action for r in R.reconcile(desired, running).collect()} == {
        "a": "stop",
        "b": "keep",
        "c": "start",
    }
    actions = {r.id: r.action for r in R.reconcile(desired, running, report_changes=True).collect()}
    assert actions["b"] == "changed"


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "registry")
    write_snapshot(sensors(spark, {"id": "a"}, {"id": "b"}), path, 1)
    first = read_snapshot(spark, path, 1)
    write_snapshot(R.remove(first, spark.createDataFrame([("a",)], "id string")), path, 2)
    assert ids(read_snapshot(spark, path, 1)) == ["a", "b"]
    assert ids(read_snapshot(spark, path, 2)) == ["b"]
    with pytest.raises(Exception, match="(?i)already exists"):
        write_snapshot(first, path, 2)
    assert read_snapshot(spark, path, 2, strict=False).first().bad_field is None


def test_current_version_is_complete(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert current_version(spark, path) is None
    for version in (1, 2, 10):
        write_snapshot(sensors(spark, {"id": f"v{version}"}), path, version)
    (tmp_path / "registry" / "version=11").mkdir()
    assert current_version(spark, path) == 10
    assert ids(read_snapshot(spark, path, current_version(spark, path))) == ["v10"]


def change(spark, *rows):
    """(id, seq, lat) as registrations."""
    from pyspark.sql import functions as F

    df = sensors(spark, *[{"id": i, "lat": lat} for i, _, lat in rows])
    return df.join(spark.createDataFrame(rows, "id string, seq int, lat double"), ["id", "lat"]).select(*S.SENSOR.names, F.col("seq"))


def now(spark, path):
    return {r.id: r.lat for r in store.read_current(spark, path).collect()}


def test_changes_on_top_of_a_snapshot(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert now(spark, path) == {}
    with pytest.raises(ValueError, match="first snapshot"):
        store.append_upserts(spark, path, change(spark, ("a", 1, 47.0)))
    write_snapshot(sensors(spark, *[{"id": i, "lat": 46.5} for i in "abcdef"]), path, 1)
    state = {i: 46.5 for i in "abcdef"}
    steps = [
        (store.append_upserts, [("a", 1, 47.0), ("a", 3, 47.5), ("a", 2, 48.0), ("g", 1, 46.0), ("b", 1, 90.0)], {"a": 47.5, "g": 46.0}),
        (store.append_upserts, [("a", 1, 46.25), ("c", 9, 46.75)], {"a": 46.25, "c": 46.75}),
        (store.append_removals, ["a", "d", "unknown"], None),
        (store.append_upserts, [("d", 1, 47.25)], {"d": 47.25}),
    ]
    for number, (append, rows, wanted) in enumerate(steps, 1):
        frame_ = change(spark, *rows) if wanted else spark.createDataFrame([(i,) for i in rows], "id string")
        assert append(spark, path, frame_) == number
        state = state | wanted if wanted else {i: lat for i, lat in state.items() if i not in rows}
        assert now(spark, path) == state
    # A change that a writer left unfinished is in no registry, and its number is used again.
    (tmp_path / "registry" / "changes" / "version=1" / "number=5").mkdir()
    assert now(spark, path) == state
    assert store.fold(spark, path, outgrown=5) is None
    # A fold that broke off left a folder without a mark.
    (tmp_path / "registry" / "version=2").mkdir()
    assert store.fold(spark, path, outgrown=0.5) == 3
    assert current_version(spark, path) == 3 and now(spark, path) == state
    assert store.append_removals(spark, path, spark.createDataFrame([("g",)], "id string")) == 1
    assert set(now(spark, path)) == set(state) - {"g"}


def test_last_by_sorts_nothing(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z"), ("b", 2, "w"), ("c", None, "n"), ("d", 5, "d"), ("d", 5, "d")]
    last = last_by(spark.createDataFrame(rows, "k string, n bigint, v string"), "k", "n")
    got = {r.k: r.v for r in last.collect()}
    assert last.count() == 4 and got["a"] == "y" and got["b"] in "zw" and (got["c"], got["d"]) == ("n", "d")
    again = last_by(spark.createDataFrame(rows[::-1], "k string, n bigint, v string").repartition(3), "k", "n")
    assert {r.k: r.v for r in again.collect()} == got
    plan = R.upsert(sensors(spark, {}), change(spark, ("a", 1, 47.0)))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


@pytest.mark.parametrize("digits", [1, 3, 8])
def test_unique_ids_grow_only_where_they_collide(spark, digits):
    from hashlib import sha256

    keys = [f"request-{n}" for n in range(3000)]
    df = spark.createDataFrame([(k,) for k in [*keys, *keys[:50], None]], "request_key string")
    got = {r.request_key: r.id for r in R.unique_ids(df, digits=digits).collect()}
    assert set(got) == set(keys) and len(set(got.values())) == len(keys)
    said = {k: sha256(k.encode()).hexdigest() for k in keys}
    starts = {}
    for k in keys:
        for n in range(digits, 12):
            starts.setdefault(said[k][:n], set()).add(k)
    for k in keys:
        # The shortest start that no other key has.
        length = next(n for n in range(digits, 12) if len(starts[said[k][:n]]) == 1)
        assert got[k] == f"sensor-{said[k][:length]}"


def test_unique_ids_keep_those_given_before(spark):
    keys = [f"request-{n}" for n in range(400)]
    make = lambda some: spark.createDataFrame([(k,) for k in some], "request_key string")
    old = R.unique_ids(make(keys[:200]), digits=2)
    before = {r.request_key: r.id for r in old.collect()}
    new = {r.request_key: r.id for r in R.unique_ids(make(keys), old, digits=2).collect()}
    assert {k: new[k] for k in before} == before and len(set(new.values())) == 400
    # A replay in another order gives the same.
    assert {r.request_key: r.id for r in R.unique_ids(make(keys[::-1]), old, digits=2).collect()} == new


def test_reconcile_has_one_row_for_an_id(spark):
    twice = sensors(spark, {"id": "a"}, {"id": "a", "lat": 46.0}, {"id": "a"})
    for report in (False, True):
        rows = R.reconcile(twice, twice, report_changes=report).collect()
        assert [(r.id, r.action) for r in rows] == [("a", "keep")]
