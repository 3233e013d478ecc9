"""Rides joined with the changes of their driver on a stream, sent again when the driver changes.

Rides and changes come as one stream and meet in tables, a micro-batch at a time and without Python per driver: the
drivers' newest changes, and the rides that still wait for changes. A ride is emitted when it comes, with its
driver's values so far, and again whenever they change or the driver is deleted; ``keep`` after its arrival it
leaves the state. A driver's rides are spread over several join keys and its values copied to each of them, so a driver
with many rides isn't one task's work.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.timing import millis
from fleetlens.operators.changelog import CHANGE_ORDER, is_delete, latest_per_key
from fleetlens.operators.joins import rider_driver_id
from fleetlens.sources.views import batch_writer, drop_expired, read_version, read_view, retain, write_version

KEEP = timedelta(minutes=10)
SPREAD = 8
_RIDE = "ride_id string, rider_id string, pickup_h3 string, request_ms bigint"
_VALUES = "name string, vehicle_type string, rating string, active boolean"
_RIDE_NAMES = [c.split()[0] for c in _RIDE.split(", ")]
_VALUE_NAMES = [c.split()[0] for c in _VALUES.split(", ")]
_CHANGE_NAMES = [*CHANGE_ORDER, "known", *_VALUE_NAMES]
_DRIVERS = f"driver_id string, ts_ms bigint, seq bigint, known boolean, {_VALUES}, moved boolean"


def _blank(columns: str) -> list[Column]:
    return [F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in columns.split(", "))]


def rides_and_changes(requests: DataFrame, changes: DataFrame) -> DataFrame:
    """Requests and changes as rows of one stream; ``asked`` tells them apart.

    ``changes`` are those of the driver table: driver_id, name, vehicle_type, rating, active, op, ts_ms and seq (or
    ``__deleted``), in any order. Rides whose driver id can't be derived have none and wait with the others; every
    request row is a ride of its own.
    """
    asked = requests.select(
        F.lit(True).alias("asked"), rider_driver_id(F.col("rider_id")).alias("driver_id"),
        "ride_id", "rider_id", F.col("h3_cell").alias("pickup_h3"),
        F.unix_millis("event_time").alias("request_ms"),
        *_blank(f"ts_ms bigint, seq bigint, known boolean, {_VALUES}"),
    )
    turned = changes.where("driver_id is not null").select(
        F.lit(False).alias("asked"), "driver_id", *_blank(_RIDE),
        F.col("ts_ms").cast("bigint").alias("ts_ms"), F.col("seq").cast("bigint").alias("seq"),
        (~is_delete(changes)).alias("known"),
        *(F.col(c.split()[0]).cast(c.split()[1]) for c in _VALUES.split(", ")),
    )
    return asked.unionByName(turned)


def _turn(before: DataFrame, changes: DataFrame) -> DataFrame:
    """The newest change of each driver, and whether it moved its values. A deleted driver stays as such, so that an
    older change that comes later can't bring it back."""
    newest = latest_per_key(changes, ["driver_id"], CHANGE_ORDER)
    both = before.select("driver_id", F.struct(*_CHANGE_NAMES).alias("old")).join(
        newest.select("driver_id", F.struct(*_CHANGE_NAMES).alias("new")), "driver_id", "full")

    def part(side: str, names) -> Column:
        return F.struct(*(F.col(f"{side}.{name}").alias(name) for name in names))

    fresh, newer = F.col("old").isNull(), part("new", CHANGE_ORDER) > part("old", CHANGE_ORDER)
    newer = F.col("new").isNotNull() & (fresh | newer)
    values = ["known", *_VALUE_NAMES]
    moved = newer & (fresh | ~part("new", values).eqNullSafe(part("old", values)))
    state = F.when(newer, F.col("new")).otherwise(F.col("old")).alias("state")
    return both.select("driver_id", state, moved.alias("moved")).select("driver_id", "state.*", "moved")


def _joined(rides: DataFrame, drivers: DataFrame, spread: int, how: str) -> DataFrame:
    """Rides with their driver's values, none where it is deleted or not known."""
    known = F.coalesce("known", F.lit(False))
    values = [F.when(known, F.col(name)).alias(name) for name in _VALUE_NAMES]
    parts = F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part")
    dealt = rides.withColumn("part", F.pmod(F.xxhash64("ride_id"), F.lit(spread)).cast("int"))
    found = dealt.join(drivers.select("driver_id", "known", *_VALUE_NAMES, parts), ["driver_id", "part"], how)
    return found.select(*_RIDE_NAMES, "driver_id", *values, known.alias("enriched"))


def reenricher(
    sink: Callable[[DataFrame, int], None], state: str, rating: str, *, keep: timedelta = KEEP, spread: int = SPREAD
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function over :func:`rides_and_changes`: a row per ride and state of its driver to ``sink``; the
    last one of a ride is current.

    Version n of the drivers is what batches up to n left, and a batch owns its folder of the waiting rides, so a batch
    that is run again starts from what the one before it left.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, now_ms = batch.sparkSession, int(time.time() * 1000)
        drivers, waiting = f"{state}/drivers", f"{state}/rides"
        batch.persist()
        try:
            before = read_version(spark, drivers, batch_id - 1)
            if before is None:
                before = spark.createDataFrame([], _DRIVERS)
            write_version(_turn(before, batch.where("not asked")), drivers, batch_id)
            fresh = batch.where("asked").select("driver_id", *_RIDE_NAMES)
            batch_writer(waiting, F.lit(now_ms))(fresh, batch_id)
            newest = read_version(spark, drivers, batch_id)
            held = retain(read_view(spark, waiting), now_ms, keep).where(F.col("batch_id") < batch_id)
            again = _joined(held.select("driver_id", *_RIDE_NAMES), newest.where("moved"), spread, "inner")
            found = _joined(fresh, newest, spread, "left").unionByName(again)
            sink(found.select(
                "ride_id", "rider_id", "pickup_h3", F.timestamp_millis("request_ms").alias("request_time"),
                "driver_id", "name", "vehicle_type", F.col("rating").cast(rating).alias("rating"), "active", "enriched",
            ), batch_id)
            drop_expired(spark, waiting, now_ms, keep)
        finally:
            batch.unpersist()

    return write
