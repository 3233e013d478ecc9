"""Anomalies of a ping stream in two stages, so that one driver's pings spread over many tasks.

The first stage groups pings by (driver, time slice) in built-in window state. A slice closes once the
watermark passes its end: its pings are then sorted, its speed violations found, and its first and last positions
handed on. The second stage keeps the drivers' last positions in a table, reads one row per slice whatever the slice
held, and joins the slices of a micro-batch: speed across their borders, and silences. Neither runs Python. A late ping
within the watermark is in its place in the order of event times.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.geo import haversine_m
from fleetlens.functions.timing import LATENESS, interval, millis, watermarked
from fleetlens.operators.motion import GHOST_GAP, SPEED_MPS, found_in_track
from fleetlens.sources.views import read_version, write_version

SLICE = timedelta(minutes=1)
_POSITIONS = [f"{end}_{name}" for end in ("first", "last") for name in ("lat", "lon", "at")]
_STATE = "driver_id string, lat double, lon double, at bigint, armed boolean"


def _moved(before: Column, after: Column) -> Column:
    """Two positions and the speed between them; none without time between them."""
    elapsed = after["at"] - before["at"]
    metres = haversine_m(before["lat"], before["lon"], after["lat"], after["lon"])
    speed = F.when(elapsed > 0, metres / (elapsed / F.lit(1000.0)))
    return _row(F.lit(False), before, after, speed)


def _row(edge: Column, first: Column, last: Column, speed: Column) -> Column:
    values = [p[c].alias(f"{name}_{c}") for name, p in (("first", first), ("last", last)) for c in ("lat", "lon", "at")]
    return F.struct(edge.alias("edge"), *values, speed.cast("double").alias("speed"))


def closed_slices(
    pings: DataFrame, *, mps: float = SPEED_MPS, width: timedelta = SLICE, lateness: timedelta = LATENESS
) -> DataFrame:
    """Per closed slice of a driver a row with its first and last positions (``edge``), and one per
    violation inside it. Pings without a driver or a time are left out; equal times are ordered by event id."""
    flat = watermarked(pings, lateness).where("driver_id is not null").select(
        "driver_id", "event_time",
        F.struct(F.unix_millis("event_time").alias("at"), "event_id", "lat", "lon").alias("ping"),
    )
    slices = flat.groupBy("driver_id", F.window("event_time", interval(width)).alias("slice"))
    tracks = slices.agg(F.array_sort(F.collect_list("ping")).alias("track"))
    track, n = F.col("track"), F.size("track")
    steps = F.zip_with(F.slice(track, F.lit(1), n - 1), F.slice(track, F.lit(2), n - 1), _moved)
    edge = _row(F.lit(True), track[0], F.element_at(track, -1), F.lit(None))
    rows = F.concat(F.array(edge), F.filter(steps, lambda s: s["speed"] > mps))
    timed = tracks.select("driver_id", F.window_time("slice").alias("event_time"), rows.alias("rows"))
    return timed.select("driver_id", "event_time", F.inline("rows"))


def slices_and_times(
    pings: DataFrame, *, mps: float = SPEED_MPS, width: timedelta = SLICE, lateness: timedelta = LATENESS
) -> DataFrame:
    """The rows of :func:`closed_slices`, and for the watermark a row with the time of each ping."""
    closed = closed_slices(pings, mps=mps, width=width, lateness=lateness)
    closed = closed.select("driver_id", "edge", *_POSITIONS, "speed", F.lit(None).cast("bigint").alias("arrived"))
    times = pings.where("driver_id is not null").select(F.unix_millis("event_time").alias("arrived"))
    return closed.unionByName(times, allowMissingColumns=True)


def stitch(
    state: DataFrame, edges: DataFrame, mark: int, *, mps: float, gap: timedelta, width: timedelta
) -> DataFrame:
    """Known last positions and closed slices of each driver in the order of time, with the position before each and
    whether a silence follows it: known once the slice that holds the end of the allowed silence is closed, as until
    then a ping may still show up. ``mark`` is the watermark in ms."""
    here = [F.col(name).alias(f"{end}_{name}") for end in ("first", "last") for name in ("lat", "lon", "at")]
    known = state.select("driver_id", *here, "armed", F.lit(True).alias("known"))
    fresh = edges.select("driver_id", *_POSITIONS, F.lit(True).alias("armed"), F.lit(False).alias("known"))
    track = Window.partitionBy("driver_id").orderBy(F.desc("known"), "first_at")
    joined = known.unionByName(fresh).withColumns({
        **{f"prev_{name}": F.lag(f"last_{name}").over(track) for name in ("lat", "lon", "at")},
        "next_at": F.lead("first_at").over(track),
    })
    due = F.col("last_at") + millis(gap)
    closes = due - F.pmod(due, F.lit(millis(width))) + millis(width)
    silent = F.when(F.col("next_at").isNull(), closes <= mark).otherwise(F.col("next_at") > due)
    elapsed = F.col("first_at") - F.col("prev_at")
    metres = haversine_m(F.col("prev_lat"), F.col("prev_lon"), F.col("first_lat"), F.col("first_lon"))
    return joined.withColumns({
        "silent": F.col("armed") & silent, "speed": F.when(elapsed > 0, metres / (elapsed / F.lit(1000.0))),
    })


def stitcher(
    sink: Callable[[DataFrame, int], None], state: str, *, mps: float = SPEED_MPS, gap: timedelta = GHOST_GAP,
    width: timedelta = SLICE, lateness: timedelta = LATENESS,
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function over :func:`slices_and_times`: anomalies to ``sink``, each once its slice is closed; a
    silence is known once the slice that holds its end is closed. ``width`` must not be above ``gap``: a slice then
    holds no silence inside. Version n of the state is what batches up to n left."""
    if width > gap:
        raise ValueError("a slice must not be wider than the gap")

    def moved(rows: DataFrame, before: str, after: str) -> DataFrame:
        names = ("lat", "lon", "at")
        return rows.select("driver_id", "speed", *(F.col(f"{before}_{n}").alias(f"prev_{n}") for n in names),
                           *(F.col(f"{after}_{n}").alias(n) for n in names), F.lit(False).alias("silent"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        last, times = f"{state}/last", f"{state}/newest"
        try:
            before, upto = read_version(spark, last, batch_id - 1), read_version(spark, times, batch_id - 1)
            newest = None if upto is None else upto.first()[0]
            # As Spark's own: it follows the batches before this one.
            mark = 0 if newest is None else max(newest - millis(lateness), 0)
            if before is None:
                before = spark.createDataFrame([], _STATE)
            edges = batch.where("edge")
            track = stitch(before, edges, mark, mps=mps, gap=gap, width=width).persist()
            quiet = track.where("silent").select(
                "driver_id", F.lit(None).cast("double").alias("speed"), "prev_lat", "prev_lon", "prev_at",
                F.col("last_lat").alias("lat"), F.col("last_lon").alias("lon"), F.col("last_at").alias("at"), "silent")
            steps = moved(batch.where("not edge"), "first", "last").unionByName(moved(track, "prev", "first"))
            sink(found_in_track(steps.unionByName(quiet), mps, gap), batch_id)
            ends = track.where("next_at is null").select(
                "driver_id", F.col("last_lat").alias("lat"), F.col("last_lon").alias("lon"),
                F.col("last_at").alias("at"), (F.col("armed") & ~F.col("silent")).alias("armed"))
            write_version(ends, last, batch_id)
            arrived = F.greatest(F.max("arrived"), F.lit(newest).cast("bigint"))
            write_version(batch.agg(arrived.alias("newest")), times, batch_id)
            track.unpersist()
        finally:
            batch.unpersist()

    return write
