import json
from decimal import Decimal

import pytest
from fixtures import START_MS
from pyspark.sql import functions as F

from fleetlens.operators.changelog import current_state
from fleetlens.operators.lifecycle import ride_states
from fleetlens.schemas import DRIVER, DRIVER_CHANGE, RIDE_CHANGE
from fleetlens.session import work_dir
from fleetlens.sources.events import (
    read_driver_changes,
    read_pings,
    read_ride_changes,
    read_transitions,
)
from fleetlens.sources.relations import read_table


@pytest.fixture
def path(spark):
    return work_dir(spark, "sources")


def write_lines(spark, path, *records):
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    lines.coalesce(1).write.text(path)


def envelope(event_id, at="2024-01-01T00:00:00.123456Z"):
    return {"event_id": event_id, "event_type": "x", "occurred_at": at}


def test_nested_json_events_are_flattened_and_cut_to_milliseconds(spark, path):
    payload = {"driver_id": "d", "lat": 1, "lon": 2.5, "h3_cell": "c", "speed_mps": 3}
    write_lines(spark, path, {"envelope": envelope("e1"), "payload": payload, "more": 1})
    row = read_pings(spark, path, format="json").withColumn("us", F.unix_micros("event_time"))
    row = row.first()
    assert (row.event_id, row.driver_id, row.lat, row.speed_mps, row.heading_degrees) == (
        "e1", "d", 1.0, 3.0, None)
    assert row.us == START_MS * 1000 + 123_000


def test_transitions(spark, path):
    records = [
        {"envelope": envelope(f"e{i}"), "payload": {
            "ride_id": "r", "to_state": state, "changed_at": f"2024-01-01T00:00:0{i}Z"}}
        for i, state in enumerate(["requested", "matched", "started"])
    ]
    write_lines(spark, path, *records)
    state = ride_states(read_transitions(spark, path, format="json")).first()
    assert (state.ride_id, state.state, state.transitions) == ("r", "started", 3)


def test_captured_tables(spark, path):
    row = ("a", "Ann", None, "economy", Decimal("4.50"), True, None, None)
    changes = [(*row, "c", 1, 1, "false"), ("a", *row[1:], "d", 2, 2, "true"),
               ("b", *row[1:], "c", 1, 3, "false")]
    spark.createDataFrame(changes, DRIVER_CHANGE).write.parquet(f"{path}/changes")
    state = current_state(read_driver_changes(spark, f"{path}/changes"), ["driver_id"])
    assert [r.driver_id for r in state.collect()] == ["b"]

    ride = ("r", "u", "a", "picked_up", 1.0, 2.0, None, None, None, None, None)
    spark.createDataFrame([(*ride, "r", 1, 1, None)], RIDE_CHANGE).write.parquet(f"{path}/rides")
    rides = current_state(read_ride_changes(spark, f"{path}/rides"), ["ride_id"])
    assert [(r.ride_id, r.state) for r in rides.collect()] == [("r", "picked_up")]

    spark.createDataFrame([row], DRIVER).write.parquet(f"{path}/drivers")
    assert read_table(spark, f"{path}/drivers", DRIVER).first().rating == Decimal("4.50")
