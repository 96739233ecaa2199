"""Decoding and cleaning of single messages."""

import datetime
import hashlib
import json
import math
import random

import pytest

from crowdgrid.functions.visits import mask_device_id
from crowdgrid.operators.clean import clean, visits_from_messages
from crowdgrid.schema import MESSAGE_FIELDS
from crowdgrid.sources.messages import decode, encode, kafka_options, read_messages

SAMPLES = [
    '{"device_id": "+447652281079", "timezone_visit": "UTC+0", "day_of_week_visit": "Friday", '
    '"time_stamp": 1731655224.390121, "lat_visit": 53.549933, "data_visit": "2024-11-29", '
    '"time_visit": "04:08:15", "lon_visit": -2.433338}',
    '{"device_id": "+447774158921", "timezone_visit": "UTC+0", "day_of_week_visit": "Thursday", '
    '"time_stamp": 1731482424.390124, "lat_visit": 53.549947, "data_visit": "2024-11-03", '
    '"time_visit": "07:59:04", "lon_visit": -2.433206}',
]


def messages(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def one(spark, value):
    rows = visits_from_messages(messages(spark, [value])).collect()
    assert len(rows) <= 1
    return rows[0] if rows else None


def test_sample_messages(spark):
    first, second = visits_from_messages(messages(spark, SAMPLES)).orderBy("lat_visit").collect()
    assert first.device_id == "03985c4b4b432f37b02f32acf8c8a80e8d54505fa759cf0c9f67a3107abf9a58"
    assert first.date_visit == "2024-11-15 07:20:24"
    assert (first.lat_visit, first.lon_visit) == (53.549933, -2.433338)
    assert second.device_id == hashlib.sha256(b"+447774158921").hexdigest()
    assert second.date_visit == "2024-11-13 07:20:24"


def test_binary_values_decode_alike(spark):
    text = messages(spark, SAMPLES)
    binary = text.select(text.value.cast("binary").alias("value"))
    assert visits_from_messages(binary).collect() == visits_from_messages(text).collect()


def test_decode_reads_all_fields_as_text(spark):
    row = decode(messages(spark, SAMPLES[:1])).first()
    assert list(row.asDict()) == MESSAGE_FIELDS
    assert row.date_visit is None  # the wire name differs, so the field is never filled
    assert row.timezone_visit == "UTC+0" and float(row.time_stamp) == 1731655224.390121


@pytest.mark.parametrize(
    "value",
    [
        "not json",
        None,
        "",
        "[]",
        "{}",
        '{"device_id": "a", "time_stamp": 1, "lat_visit": 1.5}',
        '{"device_id": "a", "time_stamp": 1, "lon_visit": 1.5}',
        '{"device_id": "a", "time_stamp": 1, "lat_visit": "north", "lon_visit": 1.5}',
        '{"device_id": "a", "time_stamp": 1, "lat_visit": "NaN", "lon_visit": 1.5}',
        '{"device_id": "a", "time_stamp": 1, "lat_visit": 1.5, "lon_visit": "Infinity"}',
        '{"device_id": "a", "time_stamp": 1, "lat_visit": 90.1, "lon_visit": 1.5}',
        '{"device_id": "a", "time_stamp": 1, "lat_visit": 1.5, "lon_visit": -180.5}',
        '{"device_id": "a", "time_stamp": 1, "lat_visit": 1.5, "lon_visit": 1.5',
    ],
)
def test_dropped(spark, value):
    assert one(spark, value) is None


@pytest.mark.parametrize(
    "stamp", ["", ', "time_stamp": "soon"', ', "time_stamp": "NaN"', ', "time_stamp": 1e300',
              ', "time_stamp": null']
)
def test_unusable_time_is_null(spark, stamp):
    row = one(spark, '{"device_id": "a", "lat_visit": 1.5, "lon_visit": 2.5%s}' % stamp)
    assert row.date_visit is None and row.lat_visit == 1.5


def test_time_limits(spark):
    at = '{"lat_visit": 0, "lon_visit": 0, "time_stamp": %s}'
    assert one(spark, at % -0.5).date_visit == "1969-12-31 23:59:59"
    assert one(spark, at % 253402300799.5).date_visit == "9999-12-31 23:59:59"
    assert one(spark, at % 253402300800).date_visit is None


def test_device_ids(spark):
    at = '{"time_stamp": 0, "lat_visit": 1, "lon_visit": 1, "device_id": %s}'
    assert one(spark, at % "null").device_id is None
    assert one(spark, at % '""').device_id == hashlib.sha256(b"").hexdigest()
    assert one(spark, at % 7).device_id == hashlib.sha256(b"7").hexdigest()


def test_coordinates_as_text_and_at_the_limits(spark):
    row = one(spark, '{"lat_visit": "1.5", "lon_visit": " 2.5 "}')
    assert (row.lat_visit, row.lon_visit) == (1.5, 2.5)
    row = one(spark, '{"lat_visit": -90, "lon_visit": 180}')
    assert (row.lat_visit, row.lon_visit) == (-90.0, 180.0)


def test_substitution_comes_before_the_hash(spark):
    df = spark.createDataFrame([("+4471",), (None,)], "device_id string")
    masked = [r[0] for r in df.select(mask_device_id(df.device_id, ("147", "xyz"))).collect()]
    assert masked == [hashlib.sha256(b"+yyzx").hexdigest(), None]


def test_round_trip(spark):
    decoded = decode(messages(spark, SAMPLES))
    assert clean(decode(encode(decoded))).collect() == clean(decoded).collect()


def test_one_parse_in_the_plan(spark):
    visits = visits_from_messages(messages(spark, SAMPLES))
    plan = visits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert "timezone_visit" not in plan


def test_kafka_options():
    options = kafka_options("host:9092", "pings", maxOffsetsPerTrigger="1000")
    assert options["subscribe"] == "pings"
    assert options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false"
    assert options["kafka.security.protocol"] == "PLAINTEXT"
    assert options["maxOffsetsPerTrigger"] == "1000"


def test_line_files_in_batch(spark, tmp_path):
    (tmp_path / "m.txt").write_text("\n".join(SAMPLES))
    read = read_messages(spark, "text", path=str(tmp_path), streaming=False)
    assert visits_from_messages(read).count() == 2


def random_message(rng):
    """A message with every field drawn from good, odd and bad values, and what becomes of it."""
    device = rng.choice([None, "", "+447000000001", "\u00e9\u6f22", "a b"])
    lat = rng.choice([0, -90, 90, 53.549933, "53.5", " 1 ", "1e1", 90.0001, "x", "", None, "NaN", "-Infinity"])
    lon = rng.choice([0, -180, 180, -2.433338, "-2.4", 180.5, -1e9, "east", None, "Infinity"])
    stamp = rng.choice([0, -1.5, 1731655224.390121, "1731655224", "1e9", "soon", "", None, 1e18, "NaN"])
    fields = {"device_id": device, "lat_visit": lat, "lon_visit": lon, "time_stamp": stamp}
    kept = {k: v for k, v in fields.items() if v is not None or rng.random() < 0.5}
    text = json.dumps(kept, ensure_ascii=rng.random() < 0.5)
    if rng.random() < 0.1:
        return text[: rng.randrange(len(text))], None
    return text, expected_visit(device, lat, lon, stamp)


def as_number(value):
    try:
        return None if value is None else float(value)
    except ValueError:
        return None


def expected_visit(device, lat, lon, stamp):
    lat, lon, stamp = as_number(lat), as_number(lon), as_number(stamp)
    if lat is None or lon is None or not (abs(lat) <= 90 and abs(lon) <= 180):
        return None
    at = None
    if stamp is not None and -62135596800 <= stamp < 253402300800:
        epoch = datetime.datetime(1970, 1, 1)
        at = str(epoch + datetime.timedelta(seconds=math.floor(stamp)))
    masked = None if device is None else hashlib.sha256(device.encode()).hexdigest()
    return masked, at, lat, lon


def test_random_messages_against_a_model(spark):
    rng = random.Random(20)
    pairs = [random_message(rng) for _ in range(5000)]
    got = visits_from_messages(messages(spark, [text for text, _ in pairs])).collect()
    want = [visit for _, visit in pairs if visit is not None]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_times_do_not_depend_on_the_session_zone(spark):
    from crowdgrid.functions.visits import epoch_to_text

    epochs = ["1731655224.390121", "-62135596800", "253402300799.9", "0", "-0.5", "1e300", "NaN", "x", None]
    df = spark.createDataFrame([(e,) for e in epochs], "e string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        got = [r.t for r in df.select(epoch_to_text(df.e).alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [
        "2024-11-15 07:20:24", "0001-01-01 00:00:00", "9999-12-31 23:59:59", "1970-01-01 00:00:00",
        "1969-12-31 23:59:59", None, None, None, None,
    ]
