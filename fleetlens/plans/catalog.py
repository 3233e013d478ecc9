"""Registered queries: every operator over the given tables, in full.

Events are sparse (a month in all), so windows, gaps and speeds are wider than the defaults.
Times leave as epoch milliseconds and nested records as flat columns.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.geo import haversine_m, with_cell
from fleetlens.functions.records import anomaly_events, enriched_map
from fleetlens.operators import changelog, joins, lifecycle, motion, quality, serving, windows
from fleetlens.plans import tables
from fleetlens.schemas import EVIDENCE_KEYS, LOCATION_TOPIC
from fleetlens.session import work_dir
from fleetlens.sources import kafka, views
from fleetlens.sources.events import flatten_pings, flatten_requests, read_pings
from fleetlens.streaming import jobs

HOT_WINDOW = timedelta(hours=6)
SURGE_SIZE, SURGE_SLIDE = timedelta(hours=5), timedelta(hours=1)
IDLE_GAP = timedelta(hours=6)
MATCH_BEFORE, MATCH_AFTER = timedelta(hours=1), timedelta(hours=2)
SPEED_MPS = 5.0
GHOST_GAP = timedelta(hours=12)
CHUNK = timedelta(days=7)
# Drivers of more pings are cut by rows.
TRACK_ROWS = 200
SLICE = timedelta(minutes=1)
# Sketched panes, and the wide windows they are merged into.
PANE, WIDE_WINDOW, SMALL_BITS = timedelta(hours=1), timedelta(days=7), 8
# Of streams in several micro-batches, whose rows come late by up to three quarters of it.
BATCH_LATENESS = timedelta(hours=1)
ZONE_TTL = timedelta(days=2)
RIDE_KEEP = timedelta(hours=6)
SKEW = timedelta(seconds=60)
HORIZON = timedelta(hours=1)
CENTRE = (37.7749, -122.4194)
# A fixed "now" for ingestion, so that results do not depend on the clock.
NOW_MS = 1_760_000_000_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _ms(column: str):
    return F.unix_millis(column)


# Sources


@query
def pings(spark, sf_dir):
    """Nested ping events, flattened."""
    events = tables.ping_events(tables.table(spark, sf_dir, "events"))
    return flatten_pings(events).select(
        "event_id", "driver_id", "lat", "lon", "h3_cell", _ms("event_time").alias("event_ms")
    )


@query
def ride_requests(spark, sf_dir):
    """Nested request events, flattened."""
    events = tables.request_events(tables.table(spark, sf_dir, "events"))
    return flatten_requests(events).select(
        "ride_id", "rider_id", "h3_cell", _ms("event_time").alias("event_ms")
    )


@query
def driver_changes(spark, sf_dir):
    return tables.driver_changes(spark, sf_dir).withColumn("rating", F.col("rating").cast("string"))


@query
def driver_table(spark, sf_dir):
    return tables.drivers(spark, sf_dir).withColumn("rating", F.col("rating").cast("string"))


@query
def framed_values(spark, sf_dir):
    """Values with a schema-id frame, taken apart again."""
    value = kafka.framed(F.col("driver_id").cast("binary"), 258)
    return tables.pings(spark, sf_dir).select("event_id", value.alias("value")).select(
        "event_id",
        F.length("value").cast("bigint").alias("framed_length"),
        kafka.frame_schema_id(F.col("value")).alias("schema_id"),
        kafka.frame_body(F.col("value")).cast("string").alias("body"),
    )


def _decode_json(body):
    return F.from_json(body.cast("string"), "event_id string, driver_id string")


def _split_frames(spark, sf_dir):
    return kafka.split_frames(
        tables.ping_frames(spark, sf_dir), _decode_json, topic=LOCATION_TOPIC,
        schema_ids=[tables.FRAME_ID], required=["driver_id"], failed_at=_now(),
    )


@query
def framed_events(spark, sf_dir):
    """Events of the frames that can be read."""
    return _split_frames(spark, sf_dir)[0]


@query
def frame_letters(spark, sf_dir):
    """Frames that are missing, cut, of another schema or not of theirs, with their bytes."""
    letters = _split_frames(spark, sf_dir)[1]
    return _letters(letters.withColumn("bytes", F.hex("original_value_bytes")), "bytes")


# Scalar functions


@query
def centre_distance(spark, sf_dir):
    lat, lon = (F.lit(x) for x in CENTRE)
    metres = haversine_m(F.col("lat"), F.col("lon"), lat, lon)
    return tables.pings(spark, sf_dir).select("event_id", F.round(metres, 3).alias("metres"))


@query
def grid_cells(spark, sf_dir):
    """Every third cell name is taken away and derived from the position."""
    known = F.when(F.col("event_id").cast("bigint") % 3 != 0, F.col("h3_cell"))
    unnamed = tables.pings(spark, sf_dir).withColumn("h3_cell", known)
    return with_cell(unnamed).select("event_id", "h3_cell")


# Ingest checks


def _now():
    return F.timestamp_millis(F.lit(NOW_MS).cast("bigint"))


def _letters(letters: DataFrame, *more: str) -> DataFrame:
    return letters.select(
        *more,
        "original_topic",
        F.col("original_key_bytes").cast("string").alias("original_key"),
        "failure_reason",
        "failure_stage",
        _ms("failed_at").alias("failed_at_ms"),
    )


@query
def valid_pings(spark, sf_dir):
    good, _ = quality.validate_pings(tables.raw_pings(spark, sf_dir))
    events = quality.ping_events(good, now=_now(), event_id=F.col("key"))
    return events.select(
        "envelope.event_id",
        "envelope.event_type",
        _ms("envelope.occurred_at").alias("occurred_ms"),
        _ms("envelope.ingested_at").alias("ingested_ms"),
        "payload.driver_id",
        "payload.lat",
        "payload.lon",
        "payload.h3_cell",
    )


@query
def ping_dead_letters(spark, sf_dir):
    raw = tables.raw_pings(spark, sf_dir)
    return _letters(quality.ping_dead_letters(raw, failed_at=_now()))


@query
def valid_requests(spark, sf_dir):
    good, _ = quality.validate_requests(tables.raw_requests(spark, sf_dir))
    events = quality.request_events(good, now=_now(), event_id=F.col("key"))
    return events.select(
        "envelope.event_id",
        _ms("envelope.occurred_at").alias("occurred_ms"),
        "payload.ride_id",
        "payload.rider_id",
        F.col("payload.pickup.lat").alias("pickup_lat"),
        F.col("payload.pickup.h3_cell").alias("pickup_cell"),
        F.col("payload.dropoff.lon").alias("dropoff_lon"),
        "payload.product_tier",
        _ms("payload.requested_at").alias("requested_ms"),
    )


@query
def request_dead_letters(spark, sf_dir):
    raw = tables.raw_requests(spark, sf_dir)
    return _letters(quality.request_dead_letters(raw, failed_at=_now()))


@query
def mistyped_ping_letters(spark, sf_dir):
    """Numbers and objects for text, text for an integer, text after the object."""
    raw = tables.mistyped_pings(spark, sf_dir)
    return _letters(quality.ping_dead_letters(raw, failed_at=_now()))


@query
def mistyped_request_letters(spark, sf_dir):
    raw = tables.mistyped_requests(spark, sf_dir)
    return _letters(quality.request_dead_letters(raw, failed_at=_now()))


# Windows


@query
def hot_zones(spark, sf_dir):
    return windows.hot_zones(tables.pings(spark, sf_dir), window=HOT_WINDOW)


@query
def hot_zones_from_sketches(spark, sf_dir):
    """The same windows from sketches of their panes; exact, as cells have fewer drivers than a sketch lists."""
    panes = windows.zone_sketches(tables.pings(spark, sf_dir), pane=PANE)
    return windows.zones_from_sketches(panes, HOT_WINDOW)


@query
def wide_zone_bounds(spark, sf_dir):
    """Wide windows from small sketches: the exact count, and whether the estimate is within four standard errors."""
    seen = tables.pings(spark, sf_dir)
    panes = windows.zone_sketches(seen, pane=PANE, bits=SMALL_BITS)
    estimate = windows.zones_from_sketches(panes, WIDE_WINDOW).withColumnRenamed("driver_count", "estimate")
    exact = windows.hot_zones(seen, window=WIDE_WINDOW)
    most = 4 * 1.04 / 2 ** (SMALL_BITS / 2)
    within = F.abs(F.col("estimate") - F.col("driver_count")) <= most * F.col("driver_count")
    return exact.join(estimate, ["h3_cell", "window_end_ms"], "left").select(
        "h3_cell", "window_end_ms", "driver_count", within.alias("within"))


@query
def surge_zones(spark, sf_dir):
    requests = tables.requests(spark, sf_dir)
    return windows.surge_zones(requests, size=SURGE_SIZE, slide=SURGE_SLIDE)


@query
def idle_sessions(spark, sf_dir):
    return windows.idle_sessions(tables.pings(spark, sf_dir), gap=IDLE_GAP)


@query
def idle_sessions_exact_last(spark, sf_dir):
    return windows.idle_sessions(tables.pings(spark, sf_dir), gap=IDLE_GAP, exact_last=True)


# Joins and changelogs


def _match(operator, spark, sf_dir):
    return operator(
        tables.requests(spark, sf_dir),
        tables.pings(spark, sf_dir),
        before=MATCH_BEFORE,
        after=MATCH_AFTER,
    )


def _match_repeated(operator, spark, sf_dir):
    asked = tables.requests(spark, sf_dir).withColumn("ride_id", F.col("rider_id"))
    pings = tables.pings(spark, sf_dir)
    return operator(asked, pings, before=MATCH_BEFORE, after=MATCH_AFTER)


@query
def ride_matches(spark, sf_dir):
    return _match(joins.match_rides, spark, sf_dir).select(
        "ride_id", "driver_id", _ms("match_time").alias("match_time_ms"), "h3_cell"
    )


@query
def match_candidates(spark, sf_dir):
    return _match(joins.match_candidates, spark, sf_dir)


@query
def match_candidates_from_matches(spark, sf_dir):
    side = _match(joins.block_side, spark, sf_dir)
    return joins.reduce_matches(_match(partial(joins.match_rides, side=side), spark, sf_dir))


@query
def repeated_ride_candidates(spark, sf_dir):
    """A rider's requests as retries of one ride, in whatever cell each of them was made."""
    return _match_repeated(joins.match_candidates, spark, sf_dir)


@query
def repeated_ride_last_match(spark, sf_dir):
    return _match_repeated(joins.last_matches, spark, sf_dir)


@query
def last_match(spark, sf_dir):
    return _match(joins.last_matches, spark, sf_dir)


@query
def driver_state(spark, sf_dir):
    state = changelog.current_state(tables.driver_changes(spark, sf_dir), ["driver_id"])
    return state.withColumn("rating", F.col("rating").cast("string"))


@query
def ride_state(spark, sf_dir):
    state = changelog.current_state(tables.ride_changes(spark, sf_dir), ["ride_id"])
    return state.withColumn("fare", F.col("fare").cast("string"))


def _driver_log(spark, sf_dir):
    rows = tables.driver_topic(spark, sf_dir)
    return changelog.split_changes(
        rows, tables.DRIVER_ROW, ["driver_id"], topic=tables.DRIVER_TOPIC, failed_at=_now())


@query
def topic_driver_state(spark, sf_dir):
    """Current drivers from their capture topic in several partitions, unreadable values left out."""
    state = changelog.log_state(_driver_log(spark, sf_dir)[0], ["driver_id"])
    return state.withColumn("rating", F.col("rating").cast("string"))


@query
def topic_change_letters(spark, sf_dir):
    """The topic's values that can't be read."""
    return _letters(_driver_log(spark, sf_dir)[1])


@query
def topic_ride_state(spark, sf_dir):
    rows = tables.ride_topic(spark, sf_dir)
    changes, _ = changelog.split_changes(rows, tables.RIDE_ROW, ["ride_id"], topic=tables.RIDE_TOPIC)
    return changelog.log_state(changes, ["ride_id"]).withColumn("fare", F.col("fare").cast("string"))


def _enriched(spark, sf_dir):
    return joins.enrich_rides(tables.requests(spark, sf_dir), tables.drivers(spark, sf_dir))


def _flat_enriched(enriched: DataFrame) -> DataFrame:
    return enriched.withColumn("request_ms", _ms("request_time")).withColumn(
        "rating", F.col("rating").cast("string")
    ).drop("request_time")


@query
def enriched_rides(spark, sf_dir):
    return _flat_enriched(_enriched(spark, sf_dir))


@query
def enriched_rides_from_changes(spark, sf_dir):
    """Enrichment with the dimension rebuilt from its changes."""
    dimension = changelog.current_state(tables.driver_changes(spark, sf_dir), ["driver_id"])
    dimension = dimension.withColumn("vehicle_type", F.lit("economy"))
    return _flat_enriched(joins.enrich_rides(tables.requests(spark, sf_dir), dimension))


@query
def enriched_fields(spark, sf_dir):
    return enriched_map(_enriched(spark, sf_dir)).select(
        "ride_id", F.explode("fields").alias("field", "text")
    )


# Detection


def _rounded(found: DataFrame) -> DataFrame:
    return found.withColumn("observed_speed_mps", F.round("observed_speed_mps", 3))


def _anomalies(spark, sf_dir):
    return motion.anomalies(
        tables.pings(spark, sf_dir), mps=SPEED_MPS, gap=GHOST_GAP, chunk=None
    )


@query
def speed_violations(spark, sf_dir):
    return _rounded(
        motion.speed_violations(tables.pings(spark, sf_dir), mps=SPEED_MPS, chunk=None)
    )


def _busy_anomalies(spark, sf_dir):
    return motion.anomalies(
        tables.busy_pings(spark, sf_dir), mps=SPEED_MPS, gap=GHOST_GAP, chunk=None, rows=TRACK_ROWS
    )


@query
def busy_anomalies(spark, sf_dir):
    """A driver with a third of all pings in one hour, cut by rows."""
    return _rounded(_busy_anomalies(spark, sf_dir))


@query
def ghost_drivers(spark, sf_dir):
    return motion.ghost_drivers(tables.pings(spark, sf_dir), gap=GHOST_GAP)


@query
def anomalies(spark, sf_dir):
    return _rounded(_anomalies(spark, sf_dir))


def _evidence(found: DataFrame) -> DataFrame:
    keys = [F.col("evidence")[key].alias(key) for key in EVIDENCE_KEYS]
    return found.select("*", *keys).drop("evidence")


@query
def anomaly_records(spark, sf_dir):
    events = anomaly_events(_anomalies(spark, sf_dir))
    return _evidence(
        events.select(
            "envelope.event_id",
            "envelope.event_type",
            _ms("envelope.occurred_at").alias("occurred_ms"),
            "payload.anomaly_type",
            "payload.entity_type",
            "payload.entity_id",
            "payload.severity",
            kafka.anomaly_key().alias("topic_key"),
            "payload.evidence",
        )
    )


# Ranked reads


def _newest_hot_zones(spark, sf_dir):
    """The view's newest window, from its own pings alone."""
    newest = windows.newest_events(tables.pings(spark, sf_dir), HOT_WINDOW)
    return windows.hot_zones(newest, window=HOT_WINDOW)


@query
def latest_hot_window(spark, sf_dir):
    return _newest_hot_zones(spark, sf_dir)


@query
def top_hot_zones(spark, sf_dir):
    return serving.top_hot_zones(_newest_hot_zones(spark, sf_dir), 10)


@query
def top_surge_zones(spark, sf_dir):
    newest = windows.newest_events(tables.requests(spark, sf_dir), SURGE_SLIDE)
    view = windows.surge_zones(newest, size=SURGE_SIZE, slide=SURGE_SLIDE)
    return serving.top_surge_zones(view, 10)


@query
def recently_idle_drivers(spark, sf_dir):
    return serving.idle_drivers(idle_sessions(spark, sf_dir), 10)


@query
def recent_matches(spark, sf_dir):
    newest = _match(partial(joins.newest_candidates, k=10), spark, sf_dir)
    return serving.recent_matches(newest, 10)


def _last_ride(spark, sf_dir):
    """The greatest ride id, looked up as part of the query."""
    return tables.requests(spark, sf_dir).select(F.max("ride_id")).scalar()


@query
def matches_for_last_ride(spark, sf_dir):
    """Only the ride's own request and the pings in its reach are matched."""
    ride = _last_ride(spark, sf_dir)
    asked = tables.requests(spark, sf_dir).where(F.col("ride_id") == ride)
    reach = {"before": MATCH_BEFORE, "after": MATCH_AFTER}
    seen = joins.pings_in_reach(asked, tables.pings(spark, sf_dir), **reach)
    return serving.matches_for_ride(joins.match_candidates(asked, seen, **reach), ride, 10)


@query
def recent_anomalies(spark, sf_dir):
    return _evidence(serving.recent_anomalies(_anomalies(spark, sf_dir), 20))


@query
def last_enriched_ride(spark, sf_dir):
    ride = _last_ride(spark, sf_dir)
    return serving.enriched_ride(enriched_rides(spark, sf_dir), ride)


@query
def retained_hot_zones(spark, sf_dir):
    """Rows alive at the last window's end, as if each were written when its window closed."""
    view = hot_zones(spark, sf_dir).withColumn("written_at_ms", F.col("window_end_ms"))
    return views.retain(view, view.select(F.max("written_at_ms")).scalar(), ZONE_TTL)


# Extensions


@query
def first_requests(spark, sf_dir):
    """A third as many ride ids as requests, so most are retried."""
    numbered = (F.col("ride_id").cast("bigint") / 3).cast("bigint").cast("string")
    retried = tables.requests(spark, sf_dir).withColumn("ride_id", numbered)
    return lifecycle.first_requests(retried).select(
        "ride_id", "event_id", _ms("event_time").alias("event_ms")
    )


@query
def ride_lifecycle(spark, sf_dir):
    return lifecycle.ride_states(tables.transitions(spark, sf_dir)).drop("previous_state")


@query
def duplicate_events(spark, sf_dir):
    """An id per driver and hour, so busy hours repeat it."""
    hour = F.date_format("event_time", "yyyyMMddHH")
    ids = F.concat_ws("-", "driver_id", hour)
    return lifecycle.duplicate_events(tables.pings(spark, sf_dir).withColumn("event_id", ids))


@query
def clock_skew(spark, sf_dir):
    events = tables.ping_events(tables.table(spark, sf_dir, "events")).select("envelope.*")
    return lifecycle.clock_skew(events, most=SKEW).select("event_id", "skew_ms")


@query
def event_faults(spark, sf_dir):
    """Events sent twice and skewed clocks, as anomalies."""
    return lifecycle.event_faults(tables.sent_events(spark, sf_dir), most=SKEW, horizon=HORIZON)


# Streams: the same operators over a file stream, run until the input is processed.


def _drain(spark, name, run) -> str:
    """Runs ``run(view, checkpoint)`` to the end of its input and returns the view's path."""
    base = work_dir(spark, name)
    run(f"{base}/view", f"{base}/checkpoint").awaitTermination()
    return f"{base}/view"


def _read(spark, path):
    return views.read_view(spark, path).drop("batch_id", "written_at_ms")


@query
def hot_zones_stream(spark, sf_dir):
    events = tables.stream_pings(spark, sf_dir)
    path = _drain(spark, "hot-zones", lambda view, checkpoint: jobs.hot_zones_job(
        events, view, checkpoint, drain=True, window=HOT_WINDOW))
    return _read(spark, path)


@query
def surge_zones_stream(spark, sf_dir):
    events = tables.stream_requests(spark, sf_dir)
    path = _drain(spark, "surge", lambda view, checkpoint: jobs.surge_job(
        events, view, checkpoint, drain=True, size=SURGE_SIZE, slide=SURGE_SLIDE))
    return _read(spark, path)


@query
def idle_drivers_stream(spark, sf_dir):
    """The keyed view of each driver's latest closed session."""
    events = tables.stream_pings(spark, sf_dir)
    path = _drain(spark, "idle", lambda view, checkpoint: jobs.idle_job(
        events, view, checkpoint, drain=True, gap=IDLE_GAP))
    return views.read_keyed_view(spark, path, *jobs.IDLE_VIEW).drop("batch_id", "written_at_ms")


@query
def match_candidates_stream(spark, sf_dir):
    asked, seen = tables.stream_requests(spark, sf_dir), tables.stream_pings(spark, sf_dir)
    path = _drain(spark, "matches", lambda view, checkpoint: jobs.match_job(
        asked, seen, view, checkpoint, drain=True, before=MATCH_BEFORE, after=MATCH_AFTER,
        slices=2))
    return jobs.read_matches(spark, path).drop("batch_id", "written_at_ms")


@query
def match_candidates_batches_stream(spark, sf_dir):
    """The same from five micro-batches each of requests and pings, late and out of order."""
    late = BATCH_LATENESS * 3 // 4
    asked = tables.in_batches(tables.requests(spark, sf_dir), 5, late)
    seen = tables.in_batches(tables.pings(spark, sf_dir), 5, late)
    path = _drain(spark, "match-batches", lambda view, checkpoint: jobs.match_job(
        asked, seen, view, checkpoint, drain=True, before=MATCH_BEFORE, after=MATCH_AFTER,
        lateness=BATCH_LATENESS))
    return jobs.read_matches(spark, path).drop("batch_id", "written_at_ms")


@query
def anomalies_stream(spark, sf_dir):
    events = tables.stream_pings(spark, sf_dir)
    path = _drain(spark, "anomalies", lambda view, checkpoint: jobs.anomaly_job(
        events, view, f"{view}-events", checkpoint, drain=True, mps=SPEED_MPS, gap=GHOST_GAP))
    return _rounded(_read(spark, path))


@query
def anomalies_sliced_stream(spark, sf_dir):
    """Six micro-batches with late pings and a driver with a third of all pings in one hour, in slices and timers."""
    events = tables.in_batches(tables.busy_pings(spark, sf_dir), 6, BATCH_LATENESS * 3 // 4)
    path = _drain(spark, "sliced-anomalies", lambda view, checkpoint: jobs.sliced_anomaly_job(
        events, view, f"{view}-events", checkpoint, drain=True, mps=SPEED_MPS, gap=GHOST_GAP,
        width=SLICE, lateness=BATCH_LATENESS))
    return _rounded(_read(spark, path))


@query
def anomalies_table_stream(spark, sf_dir):
    """The same with the drivers' last positions kept in a table."""
    events = tables.stream_pings(spark, sf_dir)
    path = _drain(spark, "anomaly-table", lambda view, checkpoint: jobs.anomaly_table_job(
        events, view, f"{view}-events", f"{view}-state", checkpoint, drain=True, mps=SPEED_MPS,
        gap=GHOST_GAP, chunk=CHUNK))
    return _rounded(_read(spark, path))


@query
def enriched_rides_stream(spark, sf_dir):
    events = tables.stream_requests(spark, sf_dir)
    path = _drain(spark, "enriched", lambda view, checkpoint: jobs.enrich_job(
        events, lambda: tables.drivers(spark, sf_dir), view, checkpoint, drain=True))
    return _flat_enriched(jobs.read_rides(spark, path).drop("batch_id", "written_at_ms"))


@query
def enriched_rides_changed_stream(spark, sf_dir):
    """Rides in three micro-batches, their drivers' changes in six and not in order; rides are sent again
    when their driver changes."""
    asked = tables.in_batches(tables.requests(spark, sf_dir), 3, BATCH_LATENESS)
    changes = tables.stream_shuffled_driver_changes(spark, sf_dir, 6)
    changes = changes.withColumn("vehicle_type", F.lit("economy"))
    path = _drain(spark, "changed-rides", lambda view, checkpoint: jobs.reenrich_job(
        asked, changes, view, checkpoint, drain=True, keep=RIDE_KEEP, spread=2))
    return _flat_enriched(jobs.read_rides(spark, path).drop("batch_id", "written_at_ms"))


@query
def driver_state_stream(spark, sf_dir):
    """The driver dimension kept from a stream of its changes."""
    changes = tables.stream_driver_changes(spark, sf_dir)
    path = _drain(spark, "drivers", lambda view, checkpoint: jobs.dimension_job(
        changes, view, checkpoint, drain=True))
    state = jobs.read_dimension(spark, path)
    return state.withColumn("rating", F.col("rating").cast("string"))


@query
def driver_state_batches_stream(spark, sf_dir):
    """The same from several micro-batches out of order, with a fold after every second one."""
    changes = tables.stream_shuffled_driver_changes(spark, sf_dir, 6)
    path = _drain(spark, "driver-batches", lambda view, checkpoint: jobs.dimension_job(
        changes, view, checkpoint, drain=True, fold_every=2))
    state = jobs.read_dimension(spark, path)
    return state.withColumn("rating", F.col("rating").cast("string"))


@query
def driver_state_buckets_stream(spark, sf_dir):
    """The same kept in buckets, of which a batch rewrites those of its keys."""
    changes = tables.stream_shuffled_driver_changes(spark, sf_dir, 6)
    path = _drain(spark, "driver-buckets", lambda view, checkpoint: jobs.dimension_job(
        changes, view, checkpoint, drain=True, buckets=8))
    latest = views.read_buckets(spark, path)
    state = latest.where(~changelog.is_delete(latest)).drop("op")
    return state.withColumn("rating", F.col("rating").cast("string"))


@query
def enriched_rides_latest_stream(spark, sf_dir):
    """Streamed requests and streamed driver changes, joined when read."""
    asked = tables.stream_requests(spark, sf_dir)
    rides = _drain(spark, "requests", lambda view, checkpoint: jobs.request_job(
        asked, view, checkpoint, drain=True))
    changes = tables.stream_driver_changes(spark, sf_dir)
    drivers = _drain(spark, "drivers", lambda view, checkpoint: jobs.dimension_job(
        changes, view, checkpoint, drain=True))
    dimension = jobs.read_dimension(spark, drivers).withColumn("vehicle_type", F.lit("economy"))
    return _flat_enriched(jobs.read_enriched(spark, rides, dimension))


@query
def ingested_zones_stream(spark, sf_dir):
    """Submitted JSON through checks and the event log to hot zones."""
    base = work_dir(spark, "ingest")
    raw = tables.stream_raw_pings(spark, sf_dir)
    for run in jobs.ingest_pings(
            raw, f"{base}/events", f"{base}/letters", f"{base}/ingest", drain=True):
        run.awaitTermination()
    events = read_pings(spark, f"{base}/events", streaming=True)
    jobs.hot_zones_job(events, f"{base}/view", f"{base}/zones", drain=True,
                       window=HOT_WINDOW).awaitTermination()
    return _read(spark, f"{base}/view")


@query
def zone_sketches_stream(spark, sf_dir):
    """Panes kept by a stream of five micro-batches and merged when read."""
    seen = tables.in_batches(tables.pings(spark, sf_dir), 5, BATCH_LATENESS * 3 // 4)
    path = _drain(spark, "sketches", lambda view, checkpoint: jobs.zone_sketch_job(
        seen, view, checkpoint, drain=True, pane=PANE, lateness=BATCH_LATENESS))
    return windows.zones_from_sketches(_read(spark, path), WIDE_WINDOW)


@query
def event_faults_stream(spark, sf_dir):
    """Five micro-batches; an event and its copy may lie in two of them."""
    sent = tables.in_batches(tables.sent_events(spark, sf_dir), 5, BATCH_LATENESS * 3 // 4, by="row_id")
    path = _drain(spark, "event-faults", lambda view, checkpoint: jobs.event_fault_job(
        sent, view, f"{view}-events", checkpoint, drain=True, most=SKEW, horizon=HORIZON,
        lateness=BATCH_LATENESS))
    return _read(spark, path)


@query
def topic_driver_state_stream(spark, sf_dir):
    """The capture topic in six micro-batches out of order, with folds."""
    rows = tables.stream_shuffled_driver_topic(spark, sf_dir, 6)
    path = _drain(spark, "driver-log", lambda view, checkpoint: jobs.change_log_job(
        rows, tables.DRIVER_ROW, view, f"{view}-letters", checkpoint, topic=tables.DRIVER_TOPIC,
        drain=True, fold_every=2))
    state = jobs.read_dimension(spark, path, order=changelog.LOG_ORDER)
    return state.withColumn("rating", F.col("rating").cast("string"))


@query
def expiring_hot_zones_stream(spark, sf_dir):
    """Six micro-batches over much more than the view's lifetime: only living windows are left to read."""
    seen = tables.in_batches(tables.pings(spark, sf_dir), 6, BATCH_LATENESS * 3 // 4)
    path = _drain(spark, "expiring-zones", lambda view, checkpoint: jobs.hot_zones_job(
        seen, view, checkpoint, drain=True, ttl=ZONE_TTL, window=HOT_WINDOW, lateness=BATCH_LATENESS))
    rows = views.read_timed(spark, path, "window_end_ms", width=ZONE_TTL, ttl=ZONE_TTL)
    return rows.drop("batch_id")


@query
def expiring_idle_drivers_stream(spark, sf_dir):
    """The keyed view of latest sessions, folded without expired drivers after every second batch."""
    seen = tables.in_batches(tables.pings(spark, sf_dir), 6, BATCH_LATENESS * 3 // 4)
    path = _drain(spark, "expiring-idle", lambda view, checkpoint: jobs.idle_job(
        seen, view, checkpoint, drain=True, ttl=ZONE_TTL, fold_every=2, gap=IDLE_GAP, lateness=BATCH_LATENESS))
    rows = views.read_keyed_view(spark, path, *jobs.IDLE_VIEW)
    return views.alive(rows, "session_end_ms", ZONE_TTL).drop("batch_id", "written_at_ms")


def _frames(spark, path, payload: str):
    """Key and value of kept frames, the value taken apart again."""
    value = F.col("value").cast("string")
    event = F.from_json(value, f"envelope struct<event_id string, event_type string>, payload struct<{payload}>")
    frames = views.read_view(spark, path).select(
        F.col("key").cast("string").alias("topic_key"),
        F.array_join(F.array_sort(F.json_object_keys(value)), ",").alias("fields"), event.alias("event"))
    return frames.select("topic_key", "fields", "event.envelope.*", "event.payload.*")


@query
def anomaly_frames_stream(spark, sf_dir):
    """What the anomaly job sends to its topic."""
    events, base = tables.stream_pings(spark, sf_dir), work_dir(spark, "anomaly-frames")
    to_topic = views.frame_writer(f"{base}/frames", kafka.anomaly_key())
    jobs.anomaly_job(events, f"{base}/view", f"{base}/events", f"{base}/checkpoint", drain=True,
                     to_topic=to_topic, mps=SPEED_MPS, gap=GHOST_GAP).awaitTermination()
    return _frames(spark, f"{base}/frames", "anomaly_type string, severity string")


@query
def ping_frames_stream(spark, sf_dir):
    """What checked pings are sent as."""
    raw, base = tables.stream_raw_pings(spark, sf_dir), work_dir(spark, "ping-frames")
    to_topic = views.frame_writer(f"{base}/frames", kafka.ping_key())
    jobs.publish_pings(raw, to_topic, f"{base}/letters", f"{base}/checkpoint", drain=True,
                       event_id=F.col("key")).awaitTermination()
    return _frames(spark, f"{base}/frames", "driver_id string, lon double")


@query
def request_frames_stream(spark, sf_dir):
    """What checked ride requests are sent as."""
    raw, base = tables.stream_raw_requests(spark, sf_dir), work_dir(spark, "request-frames")
    to_topic = views.frame_writer(f"{base}/frames", kafka.request_key())
    jobs.publish_requests(raw, to_topic, f"{base}/letters", f"{base}/checkpoint", drain=True,
                          event_id=F.col("key")).awaitTermination()
    return _frames(spark, f"{base}/frames", "ride_id string, product_tier string")
