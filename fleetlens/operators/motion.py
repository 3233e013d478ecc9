"""Speed violations and ghost drivers."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.geo import haversine_m
from fleetlens.functions.records import stable_id
from fleetlens.functions.timing import millis, pane_start

SPEED_MPS = 50.0
GHOST_GAP = timedelta(minutes=5)
# Time slice of a driver's track that one task sorts.
CHUNK = timedelta(hours=1)
# A driver with fewer positions is never split by rows.
TRACK_ROWS = 1_000_000
SPEED = "speed_violation"
GHOST = "ghost_driver"


def _positions(pings: DataFrame) -> DataFrame:
    return pings.where(
        F.col("driver_id").isNotNull() & F.col("event_time").isNotNull()
    ).select("driver_id", "event_id", "lat", "lon", F.unix_millis("event_time").alias("at"))


def _speed() -> Column:
    elapsed = F.col("at") - F.col("prev_at")
    metres = haversine_m(F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon"))
    return F.when(elapsed > 0, metres / (elapsed / F.lit(1000.0)))


def _anomaly(kind: str, severity: Column, detected: Column, speed: Column,
             prev: tuple[Column, Column], gap: Column) -> Column:
    return F.struct(
        stable_id(F.lit(kind), F.col("driver_id"), detected.cast("string")).alias("anomaly_id"),
        F.lit(kind).alias("anomaly_type"),
        F.col("driver_id"),
        severity.alias("severity"),
        detected.alias("detected_at_ms"),
        speed.alias("observed_speed_mps"),
        prev[0].alias("prev_lat"),
        prev[1].alias("prev_lon"),
        F.col("lat").alias("curr_lat"),
        F.col("lon").alias("curr_lon"),
        gap.alias("gap_ms"),
    )


def _speed_anomaly(mps: float) -> Column:
    speed = F.col("speed")
    severity = F.when(speed > 2 * mps, "critical").otherwise("high")
    prev = (F.col("prev_lat"), F.col("prev_lon"))
    return _anomaly(SPEED, severity, F.col("at"), speed, prev, F.col("at") - F.col("prev_at"))


def _ghost_anomaly(gap: timedelta) -> Column:
    here = (F.col("lat"), F.col("lon"))
    fires_at = F.col("at") + millis(gap)
    return _anomaly(
        GHOST, F.lit("medium"), fires_at, F.lit(0.0), here, F.lit(millis(gap)).cast("long")
    )


def _as_ms(as_of: datetime | None) -> Column | None:
    return None if as_of is None else F.unix_millis(F.lit(as_of))


def _goes_silent(next_at: Column, gap: timedelta, as_of_ms: Column | None) -> Column:
    """No ping up to and including one gap later, as far as time has come."""
    due = F.col("at") + millis(gap)
    reached = F.lit(True) if as_of_ms is None else due <= as_of_ms
    return F.when(next_at.isNull(), reached).otherwise(next_at > due)


def _cut(
    positions: DataFrame, chunk: timedelta | None, rows: int, order: tuple[str, ...]
) -> DataFrame:
    """Positions with the ``chunk`` of their driver's track that one task sorts.

    Tracks are cut by time, or not at all without a ``chunk``. A driver who would fill a shuffle
    partition alone is cut by rows instead: range partitioning samples (driver, order) and
    makes pieces of about equal size, so that a burst is split too, whatever its span. There are
    fewer such drivers than shuffle partitions, which bounds the list that is collected.
    """
    spark = positions.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_time = F.lit(0).cast("long") if chunk is None else pane_start(F.col("at"), chunk)
    total = positions.count()
    if total <= rows:
        return positions.withColumn("chunk", by_time)
    size = max(rows, total / parts)
    held = positions.groupBy("driver_id").count()
    busy = held.where(F.col("count") > size).collect()
    if not busy:
        return positions.withColumn("chunk", by_time)
    is_busy = F.col("driver_id").isin([row["driver_id"] for row in busy])
    pieces = 1 + int(sum(row["count"] for row in busy) / size)
    by_rows = positions.where(is_busy).repartitionByRange(pieces, "driver_id", *order)
    by_rows = by_rows.withColumn("chunk", F.spark_partition_id().cast("long"))
    return positions.where(~is_busy).withColumn("chunk", by_time).unionByName(by_rows)


def _neighbours(
    positions: DataFrame,
    chunk: timedelta | None,
    interesting: Column,
    order: tuple[str, ...] = ("at", "event_id"),
    carry: tuple[str, ...] = (),
    rows: int = TRACK_ROWS,
) -> DataFrame:
    """Each interesting position with the driver's previous and next one in event-time order.

    A driver's track is cut into chunks that are sorted in separate tasks. Inside a chunk the
    neighbours are known; only its first and last positions ("ends") miss one. The ends of a
    driver meet in a second pass, at most two per chunk. ``interesting`` may use prev_at,
    prev_lat, prev_lon and next_at, and drops every other inner position before that pass.
    """
    in_chunk = Window.partitionBy("driver_id", "chunk").orderBy(*order)
    inner = _cut(positions, chunk, rows, order).select(
        "*",
        F.lag("at").over(in_chunk).alias("prev_at"),
        F.lag("lat").over(in_chunk).alias("prev_lat"),
        F.lag("lon").over(in_chunk).alias("prev_lon"),
        F.lead("at").over(in_chunk).alias("next_at"),
    )
    is_end = F.col("prev_at").isNull() | F.col("next_at").isNull()
    kept = inner.where(is_end | interesting).withColumn(
        "lane", F.when(~is_end, F.col("chunk"))
    )
    # Ends share the NULL lane of their driver; inner positions stay spread by chunk.
    in_lane = Window.partitionBy("driver_id", "lane").orderBy(*order)
    is_first, is_last = F.col("prev_at").isNull(), F.col("next_at").isNull()

    def earlier(name: str, source: str) -> Column:
        return F.when(is_first, F.lag(source).over(in_lane)).otherwise(F.col(name)).alias(name)

    return kept.select(
        "driver_id", "event_id", "lat", "lon", "at", *carry,
        earlier("prev_at", "at"),
        earlier("prev_lat", "lat"),
        earlier("prev_lon", "lon"),
        F.when(is_last, F.lead("at").over(in_lane)).otherwise(F.col("next_at")).alias("next_at"),
    )


def speed_violations(
    pings: DataFrame,
    *,
    mps: float = SPEED_MPS,
    chunk: timedelta | None = CHUNK,
    rows: int = TRACK_ROWS,
) -> DataFrame:
    """Positions reached from the previous one faster than ``mps``.

    Counts the pings of each driver first: tracks above ``rows`` are cut by rows if one of them would
    fill a shuffle partition, all others by ``chunk`` (None: not at all).
    """
    moved = _neighbours(_positions(pings), chunk, _speed() > mps, rows=rows)
    moved = moved.withColumn("speed", _speed())
    fast = moved.where(F.col("speed") > mps)
    return fast.select(_speed_anomaly(mps).alias("a")).select("a.*")


def ghost_drivers(
    pings: DataFrame, *, gap: timedelta = GHOST_GAP, as_of: datetime | None = None
) -> DataFrame:
    """Silences longer than ``gap``, found one gap after the last position.

    Only the last ping of a pane one gap wide can start such a silence, so panes are
    aggregated ahead of the shuffle and a driver has at most (time span / gap) of them.
    """
    panes = (
        _positions(pings)
        .groupBy("driver_id", pane_start(F.col("at"), gap).alias("pane"))
        .agg(
            F.min("at").alias("first_at"),
            F.max(F.struct("at", "event_id", "lat", "lon")).alias("last"),
        )
        .select("driver_id", "pane", "first_at", "last.*")
    )
    next_at = F.lead("first_at").over(Window.partitionBy("driver_id").orderBy("pane"))
    silent = panes.withColumn("next_at", next_at).where(
        _goes_silent(F.col("next_at"), gap, _as_ms(as_of))
    )
    return silent.select(_ghost_anomaly(gap).alias("a")).select("a.*")


def anomalies(
    pings: DataFrame,
    *,
    mps: float = SPEED_MPS,
    gap: timedelta = GHOST_GAP,
    as_of: datetime | None = None,
    chunk: timedelta | None = CHUNK,
    rows: int = TRACK_ROWS,
) -> DataFrame:
    """Speed violations and ghosts from one full shuffle of the pings, two for drivers cut by rows.

    ``chunk`` and ``rows`` as in :func:`speed_violations`.
    """
    silent = _goes_silent(F.col("next_at"), gap, _as_ms(as_of))
    track = _neighbours(_positions(pings), chunk, (_speed() > mps) | silent, rows=rows)
    return _found(track.withColumn("speed", _speed()), mps, gap, silent)


def _found(track: DataFrame, mps: float, gap: timedelta, silent: Column) -> DataFrame:
    found = F.array_compact(
        F.array(
            F.when(F.col("speed") > mps, _speed_anomaly(mps)),
            F.when(silent, _ghost_anomaly(gap)),
        )
    )
    return track.select(F.explode(found).alias("a")).select("a.*")


def found_in_track(steps: DataFrame, mps: float, gap: timedelta) -> DataFrame:
    """Anomalies of positions whose ``speed`` and following silence (``silent``) are known."""
    return _found(steps, mps, gap, F.col("silent"))


# Last position per driver; armed until the silence after it has been reported.
STATE_COLUMNS = (
    "driver_id string, event_id string, lat double, lon double, at bigint, armed boolean"
)


def continue_tracks(
    state: DataFrame,
    pings: DataFrame,
    *,
    as_of_ms: int,
    mps: float = SPEED_MPS,
    gap: timedelta = GHOST_GAP,
    chunk: timedelta | None = CHUNK,
    rows: int = TRACK_ROWS,
) -> DataFrame:
    """Known last positions continued by newer pings: the positions that matter with their
    neighbours. Read it with :func:`track_anomalies` and :func:`track_state`.

    Pings older than their driver's last position are left out.
    """
    columns = ("driver_id", "event_id", "lat", "lon", "at")
    seen = state.select("driver_id", F.col("at").alias("seen_at"))
    fresh = (
        _positions(pings)
        .join(seen, "driver_id", "left")
        .where(F.col("seen_at").isNull() | (F.col("at") >= F.col("seen_at")))
        .select(*columns, F.lit(True).alias("fresh"), F.lit(True).alias("armed"))
    )
    known = state.select(*columns, F.lit(False).alias("fresh"), "armed")
    silent = _goes_silent(F.col("next_at"), gap, F.lit(as_of_ms))
    track = _neighbours(
        known.unionByName(fresh),
        chunk,
        (_speed() > mps) | silent,
        order=("at", "fresh", "event_id"),
        carry=("fresh", "armed"),
        rows=rows,
    )
    return track.withColumn("silent", F.col("armed") & silent)


def track_anomalies(
    track: DataFrame, *, mps: float = SPEED_MPS, gap: timedelta = GHOST_GAP
) -> DataFrame:
    return found_in_track(track.withColumn("speed", _speed()), mps, gap)


def track_state(track: DataFrame) -> DataFrame:
    """Each driver's newest position."""
    newest = track.where(F.col("next_at").isNull())
    armed = (F.col("armed") & ~F.col("silent")).alias("armed")
    return newest.select("driver_id", "event_id", "lat", "lon", "at", armed)
