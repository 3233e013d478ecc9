"""Keyed state for anomalies on a stream: the last position and a silence timeout per driver."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fleetlens.functions.geo import EARTH_RADIUS_M
from fleetlens.functions.timing import LATENESS, millis, watermarked
from fleetlens.operators.motion import GHOST, GHOST_GAP, SPEED, SPEED_MPS

# The state function travels with the query, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ANOMALY_COLUMNS = (
    "anomaly_id string, anomaly_type string, driver_id string, severity string, "
    "detected_at_ms bigint, observed_speed_mps double, prev_lat double, prev_lon double, "
    "curr_lat double, curr_lon double, gap_ms bigint"
)
_NAMES = [column.split()[0] for column in ANOMALY_COLUMNS.split(", ")]
_INPUT = ("event_id", "lat", "lon", "at")
# armed: a silence after this position has not been reported yet.
STATE_COLUMNS = "lat double, lon double, at bigint, armed boolean"


def _metres(lat1, lon1, lat2, lon2):
    half_dlat = np.sin(np.radians(lat2 - lat1) / 2)
    half_dlon = np.sin(np.radians(lon2 - lon1) / 2)
    chord = half_dlat**2 + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * half_dlon**2
    return np.arcsin(np.minimum(1.0, np.sqrt(chord))) * (2 * EARTH_RADIUS_M)


def _anomaly_id(kind: str, driver: str, at: int) -> str:
    digest = hashlib.md5(f"{kind}|{driver}|{at}".encode()).hexdigest()
    return "-".join((digest[:8], digest[8:12], digest[12:16], digest[16:20], digest[20:]))


def _ghost(driver, lat, lon, at, gap_ms) -> tuple:
    due = at + gap_ms
    return (_anomaly_id(GHOST, driver, due), GHOST, driver, "medium", due, 0.0,
            lat, lon, lat, lon, gap_ms)


def _track(frames: Iterator[pd.DataFrame], last: tuple | None) -> list[np.ndarray]:
    """Columns lat, lon and at in event-time order, led by the last known position.

    Pings older than that one (late, but within the watermark) are left out.
    """
    batches = [[frame[name].to_numpy() for name in _INPUT] for frame in frames]
    event_id, lat, lon, at = (np.concatenate(parts) for parts in zip(*batches))
    order = np.lexsort((event_id.astype(str), at)) if len(at) > 1 else [0]
    track = [column[order] for column in (lat, lon, at)]
    if last is None:
        return track
    fresh = track[2] >= last[2]
    return [np.append(value, column[fresh]) for value, column in zip(last, track)]


def _detector(mps: float, gap_ms: int) -> Callable:
    def found_in(driver: str, track: list[np.ndarray], first_armed: bool) -> Iterator[tuple]:
        lat, lon, at = track
        elapsed = np.diff(at)
        with np.errstate(divide="ignore", invalid="ignore"):
            speed = _metres(lat[:-1], lon[:-1], lat[1:], lon[1:]) / (elapsed / 1000.0)
        for i in np.flatnonzero((elapsed > 0) & (speed > mps)):
            severity = "critical" if speed[i] > 2 * mps else "high"
            seen = int(at[i + 1])
            yield (_anomaly_id(SPEED, driver, seen), SPEED, driver, severity, seen,
                   float(speed[i]), lat[i], lon[i], lat[i + 1], lon[i + 1], int(elapsed[i]))
        # A silence that both starts and ends before this batch's timeouts are looked at.
        for i in np.flatnonzero(elapsed > gap_ms):
            if i > 0 or first_armed:
                yield _ghost(driver, lat[i], lon[i], int(at[i]), gap_ms)

    def detect(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (driver,) = key
        last = state.get if state.exists else None
        if state.hasTimedOut:
            lat, lon, at, armed = last
            found = [_ghost(driver, lat, lon, at, gap_ms)] if armed else []
            state.update((lat, lon, at, False))
        else:
            track = _track(frames, last)
            found = list(found_in(driver, track, last is None or last[3]))
            lat, lon, at = (column[-1].item() for column in track)
            armed = last is None or len(track[2]) > 1 or last[3]
            due = at + gap_ms
            if armed and due <= state.getCurrentWatermarkMs():
                found.append(_ghost(driver, lat, lon, at, gap_ms))
                armed = False
            state.update((lat, lon, at, armed))
            if armed:
                state.setTimeoutTimestamp(due)
        if found:
            yield pd.DataFrame(found, columns=_NAMES)

    return detect


def anomaly_stream(
    pings: DataFrame,
    *,
    mps: float = SPEED_MPS,
    gap: timedelta = GHOST_GAP,
    lateness: timedelta = LATENESS,
) -> DataFrame:
    """Anomalies of a ping stream.

    Each batch resets its drivers' timeouts; a driver without pings times out once the
    watermark passes its last ping by ``gap``. The pings of one driver in one micro-batch
    are sorted in one task, so the source's per-batch bound also bounds that sort.
    """
    flat = watermarked(pings, lateness).where(F.col("driver_id").isNotNull()).select(
        "driver_id", "event_id", "lat", "lon", F.unix_millis("event_time").alias("at"),
        "event_time",
    )
    return flat.groupBy("driver_id").applyInPandasWithState(
        _detector(mps, millis(gap)),
        ANOMALY_COLUMNS,
        STATE_COLUMNS,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
