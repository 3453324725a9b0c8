import base64
import json
import random

from builders import AGGREGATE, BASE, DEAD_LETTER, READING, frame, topic, wire
from pyspark.sql import functions as F

from stationflow import schemas as S
from stationflow.operators import codec, routing
from stationflow.operators import validation as V
from stationflow.streaming.ingest import dead_letter_topic

GOOD = wire(READING).decode()


def decoded(spark, *payloads, entity=V.READING):
    values = [p.encode() if isinstance(p, str) else p for p in payloads]
    # The zero time has no Python value, so the time stays out of the rows.
    kept = [f"event.{f.name}" for f in entity.schema.fields if f.name != "ts"]
    rows = codec.decode(topic(spark, values), entity).orderBy("offset")
    return rows.select("reason", F.struct(*kept).alias("event")).collect()


def reasons(spark, *payloads, entity=V.READING):
    return [row.reason for row in decoded(spark, *payloads, entity=entity)]


def test_strict_json(spark):
    bad = [
        "not json at all",
        "",
        "   ",
        None,
        '{"lat":NaN}',
        "{'sensor_id':'a'}",
        GOOD + " trailing",
        GOOD + "," + GOOD,
        GOOD + "}",
        GOOD + "], [1",
        '{"lat":047.5}',
        '{"lat":+1}',
        '{"lat":.5}',
        '{"sensor_id":"a",}',
        "// note\n" + GOOD,
        '{"sensor_id":"a\tb"}',
        "﻿" + GOOD,
    ]
    assert reasons(spark, *bad) == [codec.BAD_JSON] * len(bad)


def test_wrong_top_level(spark):
    cases = ["[]", "5", '"text"', "true", "[" + GOOD + "]"]
    assert reasons(spark, *cases) == [codec.NOT_OBJECT] * len(cases)


def test_wrong_field_types(spark):
    def change(**fields):
        return json.dumps({**json.loads(GOOD), **fields})

    number = "unmarshal: field lat is not a number"
    time = "unmarshal: field ts is not an RFC 3339 time"
    cases = [
        (change(sensor_id=5), "unmarshal: field sensor_id is not a string"),
        (change(sensor_id={"a": 1}), "unmarshal: field sensor_id is not a string"),
        (change(lat="47.5"), number),
        (change(lat=True), number),
        (change(lat=[47.5]), number),
        (GOOD.replace("46.9036", "1e999"), number),
        (change(ts=1234), time),
        (change(ts="2025-03-09"), time),
        (change(ts="2025-03-09 12:00:00Z"), time),
        (change(ts="2025-03-09T12:00:00"), time),
        (change(ts="2025-03-09t12:00:00z"), time),
        (change(ts="2026-02-30T12:00:00Z"), time),
        (change(ts="2025-03-09T24:00:00Z"), time),
        (change(ts="2025-03-09T12:00:60Z"), time),
        (change(ts="2025-03-09T12:00:00+24:00"), time),
        (change(ts=""), time),
    ]
    assert reasons(spark, *[c[0] for c in cases]) == [c[1] for c in cases]


def test_absent_and_null_fields_are_zero(spark):
    rows = decoded(
        spark,
        "null",
        "{}",
        '{"sensor_id":null,"lat":null}',
        '{"sensor_id":"a"}',
        '{"sensor_id":"a","lat":47.5,"lon":19,"ts":"2025-03-09T12:00:00Z"}',
        '{"sensor_id":"a","temp_c":3,"ts":"2025-03-09T12:00:00Z"}',
        '{"sensor_id":"a","lat":47.5,"lon":19,"ts":"0001-01-01T00:00:00Z"}',
    )
    assert [r.reason for r in rows] == [
        "validate: sensor id is required",
        "validate: sensor id is required",
        "validate: sensor id is required",
        "validate: timestamp is required",
        None,
        "validate: coordinates outside Hungary: (0.0000, 0.0000)",
        "validate: timestamp is required",
    ]
    assert rows[4].event.temp_c == 0.0


def test_unknown_and_repeated_keys(spark):
    extra = GOOD[:-1] + ',"extra":{"deep":[1,2]}}'
    twice = '{"sensor_id":"first",' + GOOD[1:]
    spaced = " \n" + GOOD + "\t"
    rows = decoded(spark, extra, twice, spaced)
    assert [(r.reason, r.event.sensor_id) for r in rows] == [(None, "sensor-0417")] * 3


def test_offsets_fractions_and_bytes(spark):
    def ts(text):
        return GOOD.replace("2025-03-09T12:00:00Z", text)

    rows = decoded(
        spark,
        ts("2025-03-09T14:00:00+02:00"),
        ts("2025-03-10T11:30:00+23:30"),
        ts("2025-03-08T13:00:00-23:00"),
        ts("2025-03-09T12:00:00.123456789Z"),
        GOOD.replace("sensor-0417", "sensor-\udcff").encode("utf-8", "surrogateescape"),
    )
    assert [r.reason for r in rows] == [None] * 5
    times = ["2025-03-09T14:00:00+02:00", "2025-03-10T11:30:00+23:30", "2025-03-08T13:00:00-23:00"]
    values = [ts(t).encode() for t in [*times, "2025-03-09T12:00:00.123456789Z"]]
    got = codec.decode(topic(spark, values), V.READING).orderBy("offset").select(F.unix_micros("event.ts"))
    noon = int(BASE.timestamp()) * 1_000_000
    assert [r[0] for r in got.collect()] == [noon, noon, noon, noon + 123_456]
    assert rows[4].event.sensor_id == "sensor-�"


def test_reading_round_trip_and_size(spark):
    encoded = frame(spark, S.READING, READING).select(codec.encode(V.READING).alias("value"))
    text = encoded.first().value
    assert set(json.loads(text)) == {"sensor_id", "lat", "lon", "temp_c", "ts"}
    assert json.loads(text)["ts"] == "2025-03-09T12:00:00Z"
    row = codec.with_wire_size(encoded, S.MAX_READING_BYTES).first()
    assert row.wire_bytes == len(text.encode()) and row.within_budget
    back = decoded(spark, text)[0]
    assert back.reason is None
    assert (back.event.lat, back.event.lon, back.event.temp_c) == (46.9036, 19.6877, 17.25)


def test_aggregate_round_trip(spark):
    text = frame(spark, S.AGGREGATE, AGGREGATE).select(codec.encode(V.AGGREGATE)).first()[0]
    assert list(json.loads(text)) == S.AGGREGATE.names
    row = decoded(spark, text, entity=V.AGGREGATE)[0]
    assert row.reason is None and row.event["count"] == 3
    assert reasons(spark, text.replace('"count":3', '"count":3.0'), entity=V.AGGREGATE) == [
        "unmarshal: field count is not a whole number"
    ]


def test_poison_to_dead_letters_and_back(spark):
    berlin = wire({**READING, "lat": 52.52, "lon": 13.40})
    values = [b"this is not json at all", berlin, wire(READING), None]
    rows = codec.decode(topic(spark, values), V.READING)
    assert routing.accepted(rows).select("offset").collect() == [(2,)]
    letters = routing.dead_letters(rows).orderBy("offset").collect()
    assert [(x.source_topic, x.partition, x.offset) for x in letters] == [
        ("sensor.readings", 0, 0),
        ("sensor.readings", 0, 1),
        ("sensor.readings", 0, 3),
    ]
    assert letters[0].reason.startswith("unmarshal")
    assert "outside Hungary" in letters[1].reason
    assert [bytes(x.payload) if x.payload is not None else None for x in letters] == [values[0], berlin, None]

    wire_rows = dead_letter_topic(routing.dead_letters(rows))
    texts = [json.loads(r.value) for r in wire_rows.orderBy("offset").collect()]
    assert base64.b64decode(texts[0]["payload"]) == values[0]
    assert texts[2]["payload"] is None
    back = codec.decode(wire_rows, V.DEAD_LETTER).orderBy("event.offset").collect()
    assert [r.reason for r in back] == [None] * 3
    assert bytes(back[1].event.payload) == berlin


def test_long_payload_survives_base64(spark):
    letter = {**DEAD_LETTER, "payload": bytes(range(256)) * 20}
    text = frame(spark, S.DEAD_LETTER, letter).select(codec.encode(V.DEAD_LETTER)).first()[0]
    assert base64.b64decode(json.loads(text)["payload"]) == letter["payload"]
    assert bytes(decoded(spark, text, entity=V.DEAD_LETTER)[0].event.payload) == letter["payload"]


def test_normalise_drops_unknown_keys(spark):
    extra = (GOOD[:-1] + ',"extra":1}').encode()
    out = codec.normalise(topic(spark, [extra, b"nope"]), V.READING).collect()
    assert len(out) == 1
    assert json.loads(out[0].value) == json.loads(GOOD)


def test_skip_reports_counts(spark):
    from pyspark.sql import Observation

    seen = Observation("seen")
    rows = codec.decode(topic(spark, [b"nope", wire(READING), b"5"]), V.READING)
    assert routing.skip_rejected(rows, seen).count() == 1
    assert seen.get == {"offered": 3, "skipped": 2}


def test_both_ways_of_decoding_agree(spark):
    """A blank in front keeps a payload from the short way."""
    rng = random.Random(2)
    edges = ["0", "-0.5", "46.9036", "99999999999999999", "1e1", "-1", "0.1234567890123456789", "1e400", "01"]
    texts = ["plain", "", r"tab\tescaped", r'quo\"te', "žluť", r"back\\slash", "line\u2028end"]
    times_ = ["2025-03-09T12:00:00Z", "2025-13-09T12:00:00Z", "T", "0001-01-01T00:00:00Z", "2025-03-09T12:00:00.5Z"]
    payloads = [
        f'{{"sensor_id":"{rng.choice(texts)}","lat":{rng.choice(edges)},"lon":{rng.choice(edges)},'
        f'"temp_c":{rng.choice(edges)},"ts":"{rng.choice(times_)}"}}{rng.choice(["", "", chr(10), chr(133)])}'
        for _ in range(300)
    ]
    short = decoded(spark, *payloads)
    assert short == decoded(spark, *[" " + p for p in payloads])
    assert len({r.reason.split(":")[1] if r.reason else None for r in short}) > 3


def test_plain_form_is_what_the_encoder_writes(spark):
    import re

    for entity, row in ((V.READING, READING), (V.AGGREGATE, AGGREGATE), (V.DEAD_LETTER, DEAD_LETTER)):
        text = frame(spark, entity.schema, row).select(codec.encode(entity)).first()[0]
        pattern = codec._plain_form(entity).replace(r"\p{Cntrl}", r"\x00-\x1f").replace(r"\z", r"\Z")
        assert re.match(pattern, text), entity.name


def test_parse_runs_once_under_filters(spark):
    rows = codec.decode(topic(spark, [wire(READING)]), V.READING)
    plan = routing.accepted(rows).select("event.*")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_base_time_is_utc(spark):
    assert frame(spark, S.READING, READING).select(F.unix_seconds("ts")).first()[0] == int(BASE.timestamp())
