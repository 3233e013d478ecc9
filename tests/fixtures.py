"""Small hand-made inputs. Times are seconds after a fixed start."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

START_MS = 1_704_067_200_000
PING = "event_id string, driver_id string, lat double, lon double, h3_cell string, at double"
REQUEST = "ride_id string, rider_id string, h3_cell string, at double"


def _timed(df):
    ms = F.round(F.col("at") * 1000).cast("bigint") + START_MS
    return df.withColumn("event_time", F.timestamp_millis(ms)).drop("at")


def pings(spark, rows):
    """Rows (driver, seconds[, cell[, lat, lon]])."""
    full = []
    for i, row in enumerate(rows):
        driver, at, cell, lat, lon = (tuple(row) + ("c1", 37.7, -122.4)[len(row) - 2:])[:5]
        full.append((f"e{i:05d}", driver, lat, lon, cell, float(at)))
    return _timed(spark.createDataFrame(full, PING))


def requests(spark, rows):
    """Rows (ride, seconds[, cell[, rider]])."""
    full = []
    for row in rows:
        ride, at, cell, rider = (tuple(row) + ("c1", "rdr-00001")[len(row) - 2:])[:4]
        full.append((ride, rider, cell, float(at)))
    return _timed(spark.createDataFrame(full, REQUEST)).withColumn("event_id", F.col("ride_id"))


def ms(seconds: float) -> int:
    return START_MS + round(seconds * 1000)


def moment(seconds: float) -> datetime:
    start = datetime.fromtimestamp(START_MS / 1000, timezone.utc)
    return start + timedelta(seconds=seconds)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
