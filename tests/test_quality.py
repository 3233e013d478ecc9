import json

import pytest
from fixtures import START_MS
from pyspark.sql import functions as F

from fleetlens.functions.geo import grid_cell
from fleetlens.operators.quality import (
    dead_letters,
    ping_dead_letters,
    ping_events,
    request_events,
    validate_pings,
    validate_requests,
)
from fleetlens.schemas import DEAD_LETTER, PING_EVENT, REQUEST_EVENT
from fleetlens.sources.events import flatten_pings

PING = {"driver_id": "d", "lat": 37.7, "lon": -122.4}
POINT = {"lat": 37.7, "lon": -122.4}
RIDE = {"ride_id": "r", "rider_id": "u", "pickup": POINT, "dropoff": POINT}
def now():
    return F.timestamp_millis(F.lit(START_MS))


def raw(spark, *bodies, **extra):
    texts = [b if b is None or isinstance(b, str) else json.dumps(b) for b in bodies]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def reason(spark, body, check=validate_pings):
    good, bad = check(raw(spark, body))
    found = [r.failure_reason for r in bad.collect()]
    assert len(found) + good.count() == 1
    return found[0] if found else ""


def test_ping_bounds_are_inclusive(spark):
    assert reason(spark, PING | {"lat": 90, "lon": -180}) == ""
    assert reason(spark, PING | {"lat": -90.0, "lon": "180"}) == ""
    assert reason(spark, PING | {"lat": 90.0001}) == "lat: out of range"
    assert reason(spark, PING | {"lon": -180.5, "lat": None}) == "lat: missing; lon: out of range"


def test_ping_fields(spark):
    assert reason(spark, {"lat": 1, "lon": 1}) == "driver_id: missing"
    assert reason(spark, PING | {"driver_id": ""}) == "driver_id: empty"
    assert reason(spark, PING | {"lat": "north"}) == "lat: not a number"
    assert reason(spark, PING | {"speed_mps": "fast"}) == "speed_mps: not a number"
    assert reason(spark, PING | {"occurred_at_ms": 1.5}) == "occurred_at_ms: not an integer"


def test_unreadable_values(spark):
    for text in ("", "{", "[1]", "7", None):
        _, bad = validate_pings(raw(spark, text))
        assert [r.failure_stage for r in bad.collect()] == ["deserialize"]


def test_types_are_kept(spark):
    assert reason(spark, PING | {"driver_id": 5}) == "driver_id: not text"
    assert reason(spark, PING | {"driver_id": {"x": 1}}) == "driver_id: not text"
    assert reason(spark, PING | {"h3_cell": 7}) == "h3_cell: not text"
    assert reason(spark, PING | {"h3_cell": None, "speed_mps": None}) == ""
    assert reason(spark, PING | {"lat": True}) == "lat: not a number"
    assert reason(spark, PING | {"occurred_at_ms": [1]}) == "occurred_at_ms: not an integer"
    assert reason(spark, PING | {"occurred_at_ms": "12"}) == ""
    assert reason(spark, PING | {"occurred_at_ms": 12.0}) == ""
    check = validate_requests
    assert reason(spark, RIDE | {"ride_id": 1}, check) == "ride_id: not text"
    assert reason(spark, RIDE | {"product_tier": None}, check) == "product_tier: unknown"
    assert reason(spark, RIDE | {"product_tier": 3}, check) == "product_tier: unknown"
    assert reason(spark, RIDE | {"pickup": POINT | {"h3_cell": 1}}, check) == "pickup.h3_cell: not text"


def test_the_whole_value_is_one_object(spark):
    body = json.dumps(PING)
    tails = (" trailing", "{}", ",{}", ", " + body, "]", "] []", "}", "} {", "]}", "}]", ":1", " 1", '"')
    for tail in tails:
        good, bad = validate_pings(raw(spark, body + tail))
        assert (good.count(), [r.failure_stage for r in bad.collect()]) == (0, ["deserialize"]), tail
    assert reason(spark, f" \n{body}\t ") == ""


def test_request_fields(spark):
    check = validate_requests
    assert reason(spark, RIDE, check) == ""
    assert reason(spark, RIDE | {"product_tier": "luxury"}, check) == "product_tier: unknown"
    assert reason(spark, RIDE | {"rider_id": ""}, check) == "rider_id: empty"
    no_dropoff = {k: v for k, v in RIDE.items() if k != "dropoff"}
    assert reason(spark, no_dropoff, check) == "dropoff.lat: missing; dropoff.lon: missing"
    assert reason(spark, RIDE | {"pickup": {"lat": 91, "lon": 0}}, check) == (
        "pickup.lat: out of range")


def test_dead_letter_keeps_the_bytes(spark):
    letters = ping_dead_letters(raw(spark, "{", key="k", headers=None))
    expected = spark.createDataFrame([], DEAD_LETTER).schema
    assert [(f.name, f.dataType) for f in letters.drop("original_headers").schema] == [
        (f.name, f.dataType) for f in expected if f.name != "original_headers"]
    row = letters.first()
    assert (bytes(row.original_key_bytes), bytes(row.original_value_bytes)) == (b"k", b"{")
    assert (row.original_topic, row.failure_stage) == ("driver.location.v1", "deserialize")


def test_later_stages_are_named(spark):
    _, bad = validate_pings(raw(spark, "{"))
    assert dead_letters(bad, "t", stage="sink").first().failure_stage == "sink"
    with pytest.raises(ValueError, match="stage"):
        dead_letters(bad, "t", stage="elsewhere")


def same_shape(df, ddl, spark):
    expected = spark.createDataFrame([], ddl).schema
    assert df.schema.simpleString() == expected.simpleString()


def test_ping_events(spark):
    good, _ = validate_pings(raw(
        spark, PING | {"h3_cell": "", "occurred_at_ms": 0}, PING | {"h3_cell": "x"},
        PING | {"occurred_at_ms": START_MS - 5, "heading_degrees": 1}))
    events = ping_events(good, now=now())
    same_shape(events, PING_EVENT, spark)
    got = sorted(events.select(F.unix_millis("envelope.occurred_at"), "payload.h3_cell",
                               "payload.heading_degrees").collect())
    cell = spark.range(1).select(grid_cell(F.lit(37.7), F.lit(-122.4))).first()[0]
    assert got == [(START_MS - 5, cell, 1.0), (START_MS, cell, None), (START_MS, "x", None)]
    ids = [r.event_id for r in events.select("envelope.event_id").collect()]
    assert len(set(ids)) == 3
    assert flatten_pings(events).columns[:2] == ["event_id", "driver_id"]


def test_request_events(spark):
    good, _ = validate_requests(raw(spark, RIDE, trace_id="t1"))
    events = request_events(good, now=now())
    same_shape(events, REQUEST_EVENT, spark)
    row = events.first()
    assert (row.payload.product_tier, row.envelope.trace_id) == ("economy", "t1")
    assert row.payload.requested_at == row.envelope.occurred_at


def test_odd_numbers(spark):
    assert reason(spark, PING | {"occurred_at_ms": 9223372036854775807}) == "occurred_at_ms: out of range"
    assert reason(spark, PING | {"lat": "1d"}) == "lat: not a number"
    events = ping_events(validate_pings(raw(spark, PING | {"occurred_at_ms": 12.0}))[0], now=now())
    assert events.select(F.unix_millis("envelope.occurred_at")).first()[0] == 12
