"""Record schemas, as DDL text, and the fixed values they allow."""

from __future__ import annotations

from datetime import timedelta

# Names and symbols that producers and consumers share.
LOCATION_TOPIC = "driver.location.v1"
REQUEST_TOPIC = "ride.request.v1"
ANOMALY_TOPIC = "anomaly.detected.v1"
PRODUCT_TIERS = ("economy", "comfort", "premium")
RIDE_STATES = ("requested", "matched", "started", "completed", "cancelled")
FAILURE_STAGES = ("deserialize", "validate", "business", "sink")
EVIDENCE_KEYS = ("observed_speed_mps", "prev_lat", "prev_lon", "curr_lat", "curr_lon", "gap_ms")
# How long rows of each view live.
VIEW_TTL = {
    "hot_zones": timedelta(seconds=300),
    "surge_zones": timedelta(seconds=600),
    "idle_drivers": timedelta(seconds=3600),
    "ride_matches": timedelta(seconds=600),
    "anomalies": timedelta(seconds=3600),
    "enriched_rides": timedelta(seconds=600),
}
# The table of rides names one state otherwise than the events do.
STATE_ALIASES = {"picked_up": "started"}


ENVELOPE = (
    "event_id string, event_type string, event_version int, occurred_at timestamp, "
    "ingested_at timestamp, producer string, trace_id string"
)
GEO_POINT = "lat double, lon double, h3_cell string"


def _event(payload: str) -> str:
    return f"envelope struct<{ENVELOPE}>, payload struct<{payload}>"


PING_EVENT = _event(
    "driver_id string, lat double, lon double, h3_cell string, "
    "heading_degrees double, speed_mps double, accuracy_meters double"
)
REQUEST_EVENT = _event(
    f"ride_id string, rider_id string, pickup struct<{GEO_POINT}>, "
    f"dropoff struct<{GEO_POINT}>, product_tier string, requested_at timestamp"
)
LIFECYCLE_EVENT = _event(
    "ride_id string, from_state string, to_state string, driver_id string, "
    "reason string, changed_at timestamp"
)
ANOMALY_EVENT = _event(
    "anomaly_id string, anomaly_type string, entity_type string, entity_id string, "
    "severity string, evidence map<string,string>, detected_at timestamp"
)
DEAD_LETTER = (
    "original_topic string, original_key_bytes binary, original_value_bytes binary, "
    "failure_reason string, failure_stage string, failed_at timestamp, "
    "original_headers map<string,string>"
)
DRIVER = (
    "driver_id string, name string, phone string, vehicle_type string, "
    "rating decimal(3,2), active boolean, created_at timestamp, updated_at timestamp"
)
RIDE = (
    "ride_id string, rider_id string, driver_id string, state string, "
    "pickup_lat double, pickup_lon double, dropoff_lat double, dropoff_lon double, "
    "fare decimal(10,2), created_at timestamp, updated_at timestamp"
)
# A change row is the flattened table row plus the capture marks; seq is the log offset.
CHANGE_MARKS = "op string, ts_ms bigint, seq bigint, __deleted string"
DRIVER_CHANGE = f"{DRIVER}, {CHANGE_MARKS}"
RIDE_CHANGE = f"{RIDE}, {CHANGE_MARKS}"

# Submitted JSON keeps its types, so that text and numbers can be told apart and each fault be
# reported with the field it stands in.
PING_INPUT = (
    "driver_id variant, lat variant, lon variant, h3_cell variant, heading_degrees variant, "
    "speed_mps variant, accuracy_meters variant, occurred_at_ms variant"
)
_POINT_INPUT = "struct<lat variant, lon variant, h3_cell variant>"
REQUEST_INPUT = (
    f"ride_id variant, rider_id variant, pickup {_POINT_INPUT}, dropoff {_POINT_INPUT}, "
    "product_tier variant, requested_at_ms variant, occurred_at_ms variant"
)
