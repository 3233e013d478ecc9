"""Extensions declared by the event schemas only: retries, ride states, event quality."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.records import stable_id
from fleetlens.functions.timing import LATENESS, interval, millis, watermarked
from fleetlens.schemas import RIDE_STATES, STATE_ALIASES

# Kinds of anomalies.
DUPLICATE, SKEWED = "dup_event", "clock_skew"


def first_requests(
    requests: DataFrame, *, horizon: timedelta = timedelta(hours=1)
) -> DataFrame:
    """One request per ride_id: the earliest in batch, the first to arrive in a stream.

    A stream forgets a ride_id ``horizon`` after its event time.
    """
    if requests.isStreaming:
        return watermarked(requests, horizon).dropDuplicatesWithinWatermark(["ride_id"])
    row = F.struct("event_time", *(c for c in requests.columns if c != "event_time"))
    first = requests.groupBy("ride_id").agg(F.min(row).alias("row"))
    return first.select(*(F.col(f"row.{c}") for c in requests.columns))


def _state(name: str) -> Column:
    """A state by its usual name."""
    named = F.col(name)
    for other, usual in STATE_ALIASES.items():
        named = F.when(F.col(name) == other, usual).otherwise(named)
    return named


def unknown_transitions(transitions: DataFrame) -> DataFrame:
    """Transitions to a state that is not known, with the reason: for the dead letters."""
    known = F.coalesce(_state("to_state").isin(*RIDE_STATES), F.lit(False))
    reason = F.concat(F.lit("to_state: unknown state "), F.coalesce("to_state", F.lit("null")))
    return transitions.where(~known).withColumn("failure_reason", reason)


def ride_states(transitions: DataFrame) -> DataFrame:
    """State of each ride after its last transition to a known state; ``unknown_transitions``
    has the others."""
    transitions = transitions.withColumns(
        {"from_state": _state("from_state"), "to_state": _state("to_state")}
    ).where(F.col("to_state").isin(*RIDE_STATES))
    last = F.max(F.struct("changed_at", "event_id", "from_state", "to_state"))
    return transitions.groupBy("ride_id").agg(
        last.alias("last"), F.count("*").alias("transitions")
    ).select(
        "ride_id",
        F.col("last.to_state").alias("state"),
        F.col("last.from_state").alias("previous_state"),
        F.unix_millis("last.changed_at").alias("changed_at_ms"),
        "transitions",
    )


def duplicate_events(events: DataFrame) -> DataFrame:
    """Event ids seen more than once."""
    return events.groupBy("event_id").agg(F.count("*").alias("copies")).where("copies > 1")


def clock_skew(events: DataFrame, *, most: timedelta = timedelta(minutes=1)) -> DataFrame:
    """Events whose ingestion and occurrence lie further apart than ``most``, either way."""
    skew = F.unix_millis("ingested_at") - F.unix_millis("occurred_at")
    return events.withColumn("skew_ms", skew).where(F.abs("skew_ms") > millis(most))


def event_faults(
    events: DataFrame,
    *,
    most: timedelta = timedelta(minutes=1),
    horizon: timedelta = timedelta(hours=1),
    lateness: timedelta = LATENESS,
) -> DataFrame:
    """Anomaly rows, once per event id, of events sent more than once (``dup_event``) and of those whose
    ingestion and occurrence lie further apart than ``most`` (``clock_skew``).

    Wants event_id, driver_id, lat, lon, event_time and ingested_at. Copies belong together while no more than
    ``horizon`` of event time lies between one and the next. Window state holds one row per event id and forgets
    it ``horizon`` after its last copy, which is when the stream reports it; nothing runs outside the JVM. ``gap_ms`` is
    the time from the first ingestion to the last, or the greatest skew. Events without an id or a time are
    left out.
    """
    at, skew = F.unix_millis("event_time"), F.unix_millis("ingested_at") - F.unix_millis("event_time")
    arrived = F.unix_millis("ingested_at")
    copy = F.struct(at.alias("at"), arrived.alias("arrived"), "driver_id", "lat", "lon")
    sent = watermarked(events, lateness).where("event_id is not null and event_time is not null")
    sent = sent.select("event_id", "event_time", copy.alias("copy"), arrived.alias("arrived"), skew.alias("skew"))
    seen = sent.groupBy("event_id", F.session_window("event_time", interval(horizon)).alias("session")).agg(
        F.count("*").alias("copies"),
        F.min("copy").alias("first"),
        F.max("copy").alias("last"),
        (F.max("arrived") - F.min("arrived")).alias("apart"),
        F.max(F.struct(F.abs("skew").alias("size"), "skew")).alias("worst"),
    )
    faults = F.array_compact(F.array(
        F.when(F.col("copies") > 1, _fault(DUPLICATE, F.col("apart"))),
        F.when(F.col("worst.size") > millis(most), _fault(SKEWED, F.col("worst.skew"))),
    ))
    return seen.select(F.inline(faults))


def _fault(kind: str, gap: Column) -> Column:
    """A row with the columns of an anomaly: the first and last copy as positions."""
    first, last, at = F.col("first"), F.col("last"), F.col("last.at")
    return F.struct(
        stable_id(F.lit(kind), F.col("event_id"), at.cast("string")).alias("anomaly_id"),
        F.lit(kind).alias("anomaly_type"), last["driver_id"].alias("driver_id"), F.lit("low").alias("severity"),
        at.alias("detected_at_ms"), F.lit(0.0).alias("observed_speed_mps"),
        first["lat"].alias("prev_lat"), first["lon"].alias("prev_lon"),
        last["lat"].alias("curr_lat"), last["lon"].alias("curr_lon"), gap.alias("gap_ms"),
    )
