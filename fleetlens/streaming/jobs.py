"""The streaming jobs: a source, one operator and an idempotent view."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.functions.records import anomaly_events
from fleetlens.functions.timing import LATENESS, millis
from fleetlens.operators.changelog import CHANGE_ORDER, LOG_ORDER, check_changes, is_delete, split_checked
from fleetlens.operators.joins import enrich_rides
from fleetlens.operators.lifecycle import event_faults
from fleetlens.operators.motion import (
    CHUNK,
    GHOST_GAP,
    SPEED_MPS,
    STATE_COLUMNS,
    continue_tracks,
    track_anomalies,
    track_state,
)
from fleetlens.operators.quality import (
    check_pings,
    check_requests,
    dead_letters,
    ping_events,
    request_events,
    validate_pings,
    validate_requests,
)
from fleetlens.operators.windows import hot_zones, idle_sessions, surge_zones, zone_sketches
from fleetlens.schemas import LOCATION_TOPIC, REQUEST_TOPIC
from fleetlens.sources.views import (
    batch_writer,
    bucket_writer,
    read_keyed_view,
    read_version,
    timed_writer,
    upsert_writer,
    write_version,
)
from fleetlens.streaming.enrichment import reenricher, rides_and_changes
from fleetlens.streaming.matching import matcher, merged_matches, requests_and_pings
from fleetlens.streaming.slices import slices_and_times, stitcher

Sink = Callable[[DataFrame, int], None]

# Keys and order of the keyed views: of a key's rows the last one by this order counts, within a
# batch and between batches, whichever comes first. Enriched rides of one request are told apart by batch.
IDLE_VIEW = (["driver_id"], ["session_end_ms"])
MATCH_VIEW = (["ride_id", "driver_id"], ["match_time_ms", "h3_cell"])
REQUEST_VIEW = (["ride_id"], ["event_time", "event_id"])
ENRICHED_VIEW = (["ride_id"], ["request_time", "rider_id", "pickup_h3"])


def start(
    df: DataFrame,
    sink: Sink,
    checkpoint: str,
    *,
    name: str | None = None,
    drain: bool = False,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Run ``df`` into ``sink``; ``drain`` stops once the available input is processed."""
    writer = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if drain else {"processingTime": every}
    return writer.trigger(**trigger).start()


def append_log(df: DataFrame, path: str, checkpoint: str, *, drain: bool = False,
               every: str = "10 seconds") -> StreamingQuery:
    """Append ``df`` to a folder that other streams read; each row appears there once."""
    trigger = {"availableNow": True} if drain else {"processingTime": every}
    writer = df.writeStream.format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def ingest_pings(raw: DataFrame, events: str, letters: str, checkpoint: str, *, drain=False):
    """Submitted pings to the event log and to dead letters; returns both queries."""
    good, bad = validate_pings(raw)
    return (
        append_log(ping_events(good), events, f"{checkpoint}/events", drain=drain),
        append_log(dead_letters(bad, LOCATION_TOPIC), letters, f"{checkpoint}/letters",
                   drain=drain),
    )


def ingest_requests(raw: DataFrame, events: str, letters: str, checkpoint: str, *, drain=False):
    """Submitted ride requests to the event log and to dead letters; returns both queries."""
    good, bad = validate_requests(raw)
    return (
        append_log(request_events(good), events, f"{checkpoint}/events", drain=drain),
        append_log(dead_letters(bad, REQUEST_TOPIC), letters, f"{checkpoint}/letters",
                   drain=drain),
    )


def publish_pings(raw: DataFrame, to_topic: Sink, letters: str, checkpoint: str, *, drain=False,
                  **options):
    """Submitted pings to a topic and to dead letters, from one check of each; ``to_topic`` is a
    ``kafka.topic_writer`` or a ``views.frame_writer`` keyed by driver, ``options`` go to ``ping_events``."""
    return _publish(check_pings, ping_events, raw, to_topic, letters, LOCATION_TOPIC, checkpoint, drain, options)


def publish_requests(raw: DataFrame, to_topic: Sink, letters: str, checkpoint: str, *, drain=False,
                     **options):
    """As :func:`publish_pings`, for ride requests, keyed by rider."""
    return _publish(check_requests, request_events, raw, to_topic, letters, REQUEST_TOPIC, checkpoint, drain, options)


def _publish(check, events, raw, to_topic, letters, topic, checkpoint, drain, options):
    to_letters = batch_writer(letters)

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = check(batch).persist()
        try:
            to_topic(events(checked.where("failure_reason = ''"), **options), batch_id)
            to_letters(dead_letters(checked.where("failure_reason != ''"), topic), batch_id)
        finally:
            checked.unpersist()

    return start(raw, write, checkpoint, drain=drain)


def _zone_writer(view: str, ttl: timedelta | None) -> Sink:
    return batch_writer(view) if ttl is None else timed_writer(view, "window_end_ms", width=ttl, ttl=ttl)


def hot_zones_job(pings: DataFrame, view: str, checkpoint: str, *, drain=False,
                  ttl: timedelta | None = None, **options):
    """A window's row is final when it appears, so the view only grows; with ``ttl`` (``schemas.VIEW_TTL``)
    it is kept by time and read with ``views.read_timed``, and old windows are deleted."""
    return start(hot_zones(pings, **options), _zone_writer(view, ttl), checkpoint, drain=drain)


def zone_sketch_job(pings: DataFrame, view: str, checkpoint: str, *, drain=False, **options):
    """Keeps sketches per pane, which ``windows.zones_from_sketches`` merges into any wider window."""
    return start(zone_sketches(pings, **options), batch_writer(view), checkpoint, drain=drain)


def surge_job(requests: DataFrame, view: str, checkpoint: str, *, drain=False,
              ttl: timedelta | None = None, **options):
    """As hot_zones_job, for surge windows."""
    return start(surge_zones(requests, **options), _zone_writer(view, ttl), checkpoint, drain=drain)


def idle_job(pings: DataFrame, view: str, checkpoint: str, *, drain=False,
             ttl: timedelta | None = None, fold_every: int = 50, **options):
    """Keeps each driver's latest session; with ``ttl`` folds leave out drivers whose session is older, and
    readers apply ``views.alive``."""
    expire = None if ttl is None else (IDLE_VIEW[1][0], ttl)
    sink = upsert_writer(view, *IDLE_VIEW, between=IDLE_VIEW[1], fold_every=fold_every, expire=expire)
    return start(idle_sessions(pings, **options), sink, checkpoint, drain=drain)


def match_job(requests: DataFrame, pings: DataFrame, view: str, checkpoint: str, *, drain=False,
              **options):
    """Keeps the latest match per (ride, driver), read with :func:`read_matches`; requests and pings that may still
    match are kept in tables beside the view."""
    write = matcher(view, f"{view}-state", **options)
    return start(requests_and_pings(requests, pings), write, checkpoint, drain=drain)


def read_matches(spark: SparkSession, view: str) -> DataFrame:
    """The current rows of a view kept by :func:`match_job`."""
    return merged_matches(spark, view, f"{view}-state", *MATCH_VIEW)


def anomaly_job(pings: DataFrame, view: str, events: str, checkpoint: str, *, drain=False,
                to_topic: Sink | None = None, mps: float = SPEED_MPS, gap: timedelta = GHOST_GAP,
                lateness: timedelta = LATENESS, chunk: timedelta | None = CHUNK):
    """Flat rows to the view for ranked reads, nested events to the outgoing log and, keyed by driver, to
    ``to_topic`` if given (``kafka.topic_writer`` or ``views.frame_writer``).

    As anomaly_table_job with its table beside the view, but pings behind the watermark, which follows the batches
    before, are left out."""
    write = _table_writer(_anomaly_sink(view, events, to_topic), f"{view}-state", mps=mps, gap=gap,
                          lateness=lateness, chunk=chunk, late=False)
    return start(pings.where(F.col("event_time").isNotNull()), write, checkpoint, drain=drain)


def sliced_anomaly_job(pings: DataFrame, view: str, events: str, checkpoint: str, *, drain=False,
                       to_topic: Sink | None = None, **options):
    """As anomaly_job; a busy driver's pings are sorted by slice, in many tasks. Drivers' last positions are kept in
    a table beside the view."""
    write = stitcher(_anomaly_sink(view, events, to_topic), f"{view}-state", **options)
    read = {name: options[name] for name in ("mps", "width", "lateness") if name in options}
    return start(slices_and_times(pings, **read), write, checkpoint, drain=drain)


def event_fault_job(sent: DataFrame, view: str, events: str, checkpoint: str, *, drain=False,
                    to_topic: Sink | None = None, **options):
    """Events sent more than once or with a skewed clock, as anomalies, to the same outputs as anomaly_job."""
    return _start_anomalies(event_faults(sent, **options), view, events, checkpoint, drain, to_topic)


def _start_anomalies(found: DataFrame, view: str, events: str, checkpoint: str, drain: bool,
                     to_topic: Sink | None = None):
    return start(found, _anomaly_sink(view, events, to_topic), checkpoint, drain=drain)


def _anomaly_sink(view: str, events: str, to_topic: Sink | None = None) -> Sink:
    to_view, to_events = batch_writer(view), batch_writer(events)

    def write(batch: DataFrame, batch_id: int) -> None:
        # All outputs come from one evaluation of the stateful stage.
        batch.persist()
        try:
            to_view(batch, batch_id)
            to_events(anomaly_events(batch), batch_id)
            if to_topic is not None:
                to_topic(anomaly_events(batch), batch_id)
        finally:
            batch.unpersist()

    return write


def anomaly_table_job(
    pings: DataFrame,
    view: str,
    events: str,
    state: str,
    checkpoint: str,
    *,
    mps: float = SPEED_MPS,
    gap: timedelta = GHOST_GAP,
    lateness: timedelta = LATENESS,
    chunk: timedelta = CHUNK,
    drain: bool = False,
):
    """As anomaly_job, with a table of its own and pings behind the watermark.

    Each micro-batch runs the batch operators: no Python per driver, and a busy driver's
    share is cut into chunks. It rewrites one row per driver, so it suits larger batches. A
    ping behind the watermark still counts if it is its driver's newest; anomaly_job drops it.
    State version n holds what batches up to n left, which makes a replay repeatable.
    """

    write = _table_writer(_anomaly_sink(view, events), state, mps=mps, gap=gap, lateness=lateness, chunk=chunk)
    return start(pings.where(F.col("event_time").isNotNull()), write, checkpoint, drain=drain)


def _table_writer(sink: Sink, state: str, *, mps: float, gap: timedelta, lateness: timedelta,
                  chunk: timedelta | None, late: bool = True) -> Sink:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = read_version(spark, state, batch_id - 1)
        if before is None:
            before = spark.createDataFrame([], STATE_COLUMNS)
        latest = before.agg(F.max("at")).first()[0]
        arrived = batch.agg(F.max(F.unix_millis("event_time"))).first()[0]
        newest = max((t for t in (latest, arrived) if t is not None), default=0)
        if not late and latest is not None:
            batch = batch.where(F.unix_millis("event_time") > latest - millis(lateness))
        track = continue_tracks(before, batch, as_of_ms=newest - millis(lateness), mps=mps,
                                gap=gap, chunk=chunk).persist()
        try:
            sink(track_anomalies(track, mps=mps, gap=gap), batch_id)
            write_version(track_state(track), state, batch_id)
        finally:
            track.unpersist()

    return write


def dimension_job(changes: DataFrame, view: str, checkpoint: str, *, keys=("driver_id",),
                  fold_every: int = 50, buckets: int | None = None, drain=False):
    """Keeps a captured table's latest change per key, deletes included as such. With ``buckets`` a batch
    rewrites only the buckets of its keys, and the view is read with ``views.read_buckets``."""
    if buckets is None:
        sink = upsert_writer(view, list(keys), CHANGE_ORDER, between=CHANGE_ORDER, fold_every=fold_every)
    else:
        sink = bucket_writer(view, list(keys), CHANGE_ORDER, buckets=buckets)
    return start(changes, sink, checkpoint, drain=drain)


def change_log_job(rows: DataFrame, table: str, view: str, letters: str, checkpoint: str, *, topic: str,
                   keys=("driver_id",), fold_every: int = 50, drain=False):
    """As dimension_job, from a capture topic's own rows (``changelog.check_changes``): changes are ordered by
    offset, and values that can't be read go to the letters and stop nothing. A key must stay in one
    partition; ``changelog.log_state`` checks that, a stream does not."""
    sink = upsert_writer(view, list(keys), LOG_ORDER, between=LOG_ORDER, fold_every=fold_every)
    to_letters = batch_writer(letters)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Values are parsed once for both outputs.
        checked = check_changes(batch, table, keys).persist()
        try:
            good, bad = split_checked(checked, topic=topic)
            sink(good, batch_id)
            to_letters(bad, batch_id)
        finally:
            checked.unpersist()

    return start(rows, write, checkpoint, drain=drain)


def read_dimension(spark, view: str, keys=("driver_id",), order=CHANGE_ORDER) -> DataFrame:
    """Current rows of a captured table kept by :func:`dimension_job`, or with ``order=LOG_ORDER``
    by :func:`change_log_job`."""
    latest = read_keyed_view(spark, view, list(keys), order)
    return latest.where(~is_delete(latest)).drop("op", "__deleted", "batch_id", "written_at_ms")


def enrich_job(requests: DataFrame, drivers: Callable[[], DataFrame], view: str, checkpoint: str,
               *, drain=False):
    """Enriches each micro-batch with the dimension as it is then.

    A ride keeps the driver values of its arrival. Where later driver changes must show,
    keep the requests with request_job and join them when read (read_enriched).
    """
    sink = upsert_writer(view, *ENRICHED_VIEW, between=[*ENRICHED_VIEW[1], "batch_id"])

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(enrich_rides(batch, drivers()), batch_id)

    return start(requests, write, checkpoint, drain=drain)


def request_job(requests: DataFrame, view: str, checkpoint: str, *, drain=False):
    """Keeps the latest request of each ride."""
    sink = upsert_writer(view, *REQUEST_VIEW, between=REQUEST_VIEW[1])
    return start(requests, sink, checkpoint, drain=drain)


def read_enriched(spark: SparkSession, requests_view: str, drivers: DataFrame) -> DataFrame:
    """Kept requests with their drivers' values as of now, changes after arrival included."""
    return enrich_rides(read_keyed_view(spark, requests_view, *REQUEST_VIEW), drivers)


def reenrich_job(requests: DataFrame, changes: DataFrame, view: str, checkpoint: str, *, drain=False,
                 **options):
    """Keeps each ride with its driver's current values; a change of the driver replaces the ride's row. Drivers and
    waiting rides are kept in tables beside the view."""
    sink = upsert_writer(view, *ENRICHED_VIEW, between=[*ENRICHED_VIEW[1], "batch_id"])
    rating = dict(changes.dtypes)["rating"]
    write = reenricher(sink, f"{view}-state", rating, **options)
    return start(rides_and_changes(requests, changes), write, checkpoint, drain=drain)


def read_rides(spark: SparkSession, view: str) -> DataFrame:
    """The current rows of a view kept by :func:`enrich_job` or :func:`reenrich_job`."""
    keys, order = ENRICHED_VIEW
    return read_keyed_view(spark, view, keys, [*order, "batch_id"])
