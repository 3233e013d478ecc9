"""Streams replayed from files against the batch operators."""

import json
from datetime import timedelta

import pytest
from fixtures import ms, pings, requests, rows
from pyspark.sql import functions as F

from fleetlens.operators.joins import match_rides, reduce_matches
from fleetlens.operators.lifecycle import first_requests
from fleetlens.operators.motion import anomalies
from fleetlens.operators.serving import top_hot_zones
from fleetlens.operators.windows import hot_zones, idle_sessions, surge_zones
from fleetlens.plans import tables
from fleetlens.session import work_dir
from fleetlens.sources.events import read_files, read_pings, read_raw
from fleetlens.sources.views import batch_writer, read_keyed_view, read_view
from fleetlens.streaming import jobs

FLUSH = 100_000
KEY = ("anomaly_type", "driver_id", "detected_at_ms", "gap_ms", "severity")


class Feed:
    """A folder whose files arrive one per micro-batch, in the given order."""

    def __init__(self, spark, make):
        self.spark, self.make = spark, make
        self.base = work_dir(spark, "replay")
        self.files = 0

    def add(self, rows):
        df = self.make(self.spark, rows)
        df.coalesce(1).write.mode("append").parquet(f"{self.base}/in{self.files:03d}")
        self.files += 1

    def read(self):
        return read_files(
            self.spark, f"{self.base}/in*", self.make(self.spark, [("x", 0)]).schema,
            streaming=True, files_per_batch=1)

    def path(self, name):
        return f"{self.base}/{name}"


def feed(spark, make, *batches):
    source = Feed(spark, make)
    for batch in batches:
        source.add(batch)
    return source


TRACK = [
    [("a", 0), ("b", 20, "c2"), ("a", 55)],
    [("a", 70), ("c", 61), ("b", 66, "c2")],
    [("a", 300), ("c", 290, "c2")],
    [("zz", FLUSH, "far")],
]


def flat(track):
    return [row for batch in track for row in batch if row[0] != "zz"]


@pytest.mark.parametrize(
    "job, operator, make, columns",
    [
        (jobs.hot_zones_job, hot_zones, pings, ("h3_cell", "window_end_ms", "driver_count")),
        (jobs.surge_job, surge_zones, requests, ("h3_cell", "window_end_ms", "request_count")),
    ],
)
def test_window_streams_equal_batch(spark, job, operator, make, columns):
    source = feed(spark, make, *TRACK)
    view = source.path("view")
    job(source.read(), view, source.path("checkpoint"), drain=True).awaitTermination()
    want = rows(operator(make(spark, flat(TRACK))), *columns)
    assert rows(read_view(spark, view), *columns) == want


def test_late_rows_are_dropped(spark):
    # A window is closed by the batch after the one that moves the watermark past it.
    source = feed(spark, pings, [("a", 0)], [("a", 500)], [("a", 501)], [("b", 1), ("b", 495)],
                  [("z", FLUSH)])
    view = source.path("view")
    jobs.hot_zones_job(
        source.read(), view, source.path("checkpoint"), drain=True).awaitTermination()
    assert rows(read_view(spark, view), "window_end_ms", "driver_count") == [
        (ms(60), 1), (ms(540), 2)]


def test_session_stream_equals_batch(spark):
    source = feed(spark, pings, *TRACK)
    view, gap = source.path("view"), timedelta(seconds=100)
    jobs.start(idle_sessions(source.read(), gap=gap), batch_writer(view),
               source.path("checkpoint"), drain=True).awaitTermination()
    columns = ("driver_id", "session_end_ms", "ping_count", "last_h3_cell")
    want = rows(idle_sessions(pings(spark, flat(TRACK)), gap=gap), *columns)
    assert rows(read_view(spark, view), *columns) == want


@pytest.mark.parametrize("slices", [1, 3])
def test_match_stream_equals_batch(spark, slices):
    asked = feed(spark, requests, [("r1", 50)], [("r2", 200, "c2"), ("r3", 90, None)])
    seen = feed(spark, pings, *TRACK[:3])
    view = seen.path("view")
    jobs.match_job(asked.read(), seen.read(), view, seen.path("checkpoint"), drain=True,
                   slices=slices).awaitTermination()
    columns = ("ride_id", "driver_id", "match_time_ms")
    want = reduce_matches(match_rides(
        requests(spark, [("r1", 50), ("r2", 200, "c2")]), pings(spark, flat(TRACK))))
    got = read_keyed_view(spark, view, ["ride_id", "driver_id"])
    assert rows(got, *columns) == rows(want, *columns) != []


def keyed_job(events, source):
    return jobs.anomaly_job(events, source.path("view"), source.path("log"),
                            source.path("checkpoint"), drain=True)


def table_job(events, source):
    return jobs.anomaly_table_job(
        events, source.path("view"), source.path("log"), source.path("state"),
        source.path("checkpoint"), drain=True, chunk=timedelta(seconds=500))


both_jobs = pytest.mark.parametrize("job", [keyed_job, table_job])


@both_jobs
def test_anomaly_stream_equals_batch(spark, job):
    track = [
        # Two silences of one driver inside one batch, and one that ends in the next. No
        # ping comes later than the lateness allows.
        [("a", 0), ("a", 400), ("a", 900), ("b", 905, "c1", 37.0, -122.0)],
        [("a", 1300), ("b", 915, "c1", 38.0, -122.0), ("b", 915, "c1", 38.5, -122.0)],
        [("a", 1310, "c1", 37.71, -122.4), ("c", 1320)],
        [("c", 1330), ("a", 9000)],
        [("zz", FLUSH)],
        [("a", FLUSH + 5), ("zz", 2 * FLUSH)],
    ]
    source = feed(spark, pings, *track)
    view, log = source.path("view"), source.path("log")
    job(source.read(), source).awaitTermination()
    want = [r for r in rows(anomalies(pings(spark, [r for b in track for r in b])), *KEY)
            if r[2] <= ms(2 * FLUSH - 10)]
    assert rows(read_view(spark, view), *KEY) == want
    assert read_view(spark, log).count() == len(want)


@both_jobs
def test_ping_older_than_the_last_changes_nothing(spark, job):
    source = feed(spark, pings, [("a", 100)], [("a", 95, "c1", 39.0, -122.4)], [("a", 120)],
                  [("zz", FLUSH)])
    view = source.path("view")
    job(source.read(), source).awaitTermination()
    assert rows(read_view(spark, view), *KEY) == [("ghost_driver", "a", ms(420), 300000, "medium")]


def sliced(source, gap=300, lateness=10, width=60):
    return jobs.sliced_anomaly_job(
        source.read(), source.path("view"), source.path("log"), source.path("checkpoint"), drain=True,
        gap=timedelta(seconds=gap), lateness=timedelta(seconds=lateness), width=timedelta(seconds=width))


def closed(track, flush, gap=300, width=60_000):
    """The batch result, as far as the slice of an anomaly's time ends by ``flush`` seconds."""
    found = rows(anomalies(track, gap=timedelta(seconds=gap)), *KEY)
    return [r for r in found if (r[2] // width + 1) * width <= ms(flush)]


def test_sliced_anomalies_equal_batch(spark):
    """Late pings within the lateness, equal times, silences inside and across batches, and one that a ping
    exactly one gap later, in a slice still open at that time, prevents."""
    track = [
        [("a", 0), ("a", 400), ("a", 900), ("b", 905, "c1", 37.0, -122.0), (None, 5)],
        [("a", 1300), ("b", 915, "c1", 38.0, -122.0), ("b", 915, "c1", 38.5, -122.0), ("a", 890)],
        [("a", 1310, "c1", 37.71, -122.4), ("c", 1320), ("b", 1214), ("b", 1215), ("d", 1330)],
        [("c", 1330), ("d", 1630), ("a", 9000), ("a", 8995, "c1", 37.9, -122.4)],
        [("zz", FLUSH)],
        [("a", FLUSH + 5), ("zz", 2 * FLUSH)],
    ]
    source = feed(spark, pings, *track)
    # A restart between batches changes nothing.
    sliced(source, lateness=400).awaitTermination()
    source.add([("zz", 3 * FLUSH)])
    sliced(source, lateness=400).awaitTermination()
    everything = pings(spark, [r for b in [*track, [("zz", 3 * FLUSH)]] for r in b])
    got = rows(read_view(spark, source.path("view")), *KEY)
    assert got == closed(everything, 3 * FLUSH - 400) and len({r[0] for r in got}) == 2
    assert read_view(spark, source.path("log")).count() == len(got)


def test_sliced_anomalies_drop_what_comes_too_late(spark):
    source = feed(spark, pings, [("a", 0)], [("a", 1000)], [("b", 1001)], [("a", 30, "c1", 39.0, -122.4)], [("zz", FLUSH)])
    sliced(source).awaitTermination()
    got = rows(read_view(spark, source.path("view")), *KEY)
    assert got == closed(pings(spark, [("a", 0), ("a", 1000), ("b", 1001), ("zz", FLUSH)]), FLUSH - 10) != []
    with pytest.raises(ValueError):
        sliced(source, gap=30)


def test_a_busy_driver_is_sorted_in_many_groups(spark):
    """One driver with all pings of a few minutes: no state row of the first stage holds more than a slice of them."""
    busy = [("a", i / 10, "c1", 37.0 + i % 7 * 0.001, -122.0) for i in range(6000)]
    source = feed(spark, pings, busy[:3000], busy[3000:], [("zz", FLUSH)])
    query = sliced(source, width=60)
    query.awaitTermination()
    state = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert max(state) >= 5
    got = rows(read_view(spark, source.path("view")), *KEY)
    assert got == closed(pings(spark, [*busy, ("zz", FLUSH)]), FLUSH - 10) and len(got) > 3000


CHANGE = "driver_id string, name string, rating decimal(3,2), active boolean, op string, ts_ms bigint, seq bigint"


def changes(spark, rows):
    """Rows (driver, name, op, seq); rows of a feed's schema probe have no more than a driver."""
    full = [(r[0], r[1], None, True, r[2], r[3], r[3]) for r in rows if len(r) == 4]
    return spark.createDataFrame(full, CHANGE).withColumn("vehicle_type", F.lit("economy"))


def test_rides_are_sent_again_when_their_driver_changes(spark):
    """A change, a delete, a later insert, and an older change that comes last; one ride has no driver."""
    asked = feed(spark, requests, [("r1", 0, "c1", "rdr-00010"), ("r2", 5, "c1", "rdr-00020")],
                 [("r3", 9, "c1", "rdr-00011"), ("r4", 9, "c1", None)])
    turned = feed(spark, changes, [("drv-0001", "old", "c", 2)], [("drv-0002", "two", "c", 3)],
                  [("drv-0001", "new", "u", 7), ("drv-0002", "two", "d", 8)], [("drv-0001", "older", "u", 5)])
    view = asked.path("view")
    jobs.reenrich_job(asked.read(), turned.read(), view, asked.path("checkpoint"), drain=True, spread=2,
                      keep=timedelta(hours=1)).awaitTermination()
    got = {r.ride_id: (r.driver_id, r.name, r.enriched) for r in jobs.read_rides(spark, view).collect()}
    assert got == {"r1": ("drv-0001", "new", True), "r3": ("drv-0001", "new", True),
                   "r2": ("drv-0002", None, False), "r4": (None, None, False)}


def test_restart_continues_from_the_checkpoint(spark):
    source = feed(spark, pings, *TRACK[:2])
    view, checkpoint = source.path("view"), source.path("checkpoint")

    def run():
        jobs.hot_zones_job(source.read(), view, checkpoint, drain=True).awaitTermination()

    run()
    before = rows(read_view(spark, view), "h3_cell", "window_end_ms", "driver_count")
    run()
    assert rows(read_view(spark, view), "h3_cell", "window_end_ms", "driver_count") == before
    for batch in TRACK[2:]:
        source.add(batch)
    run()
    want = rows(hot_zones(pings(spark, flat(TRACK))), "h3_cell", "window_end_ms", "driver_count")
    got = rows(read_view(spark, view), "h3_cell", "window_end_ms", "driver_count")
    assert got == want


def test_dimension_follows_changes(spark):
    columns = "driver_id string, name string, op string, ts_ms bigint, seq bigint"

    def make(spark, changes):
        known = [c if len(c) == 5 else ("x", "x", "c", 0, 0) for c in changes]
        return spark.createDataFrame(known, columns)

    source = feed(spark, make, [("a", "one", "c", 1, 1), ("b", "x", "c", 1, 2)],
                  [("a", "two", "u", 2, 3)], [("b", "x", "d", 3, 4), ("a", "old", "u", 1, 0)])
    view = source.path("view")
    jobs.dimension_job(source.read(), view, source.path("checkpoint"),
                       drain=True).awaitTermination()
    assert rows(jobs.read_dimension(spark, view), "driver_id", "name") == [("a", "two")]


def test_later_driver_changes_show_when_rides_are_read(spark):
    asked = feed(spark, requests, [("r1", 0, "c1", "rdr-00012")],
                 [("r1", 9, "c2", "rdr-00012"), ("r2", 9, "c1", "rdr-09990")])
    view = asked.path("view")
    jobs.request_job(asked.read(), view, asked.path("checkpoint"), drain=True).awaitTermination()
    columns = "driver_id string, name string, vehicle_type string, rating string, active boolean"
    for name in ("old", "new"):
        drivers = spark.createDataFrame([("drv-0001", name, "economy", "4.5", True)], columns)
        got = rows(jobs.read_enriched(spark, view, drivers), "ride_id", "pickup_h3", "enriched")
        assert got == [("r1", "c2", True), ("r2", "c1", False)]
        known = jobs.read_enriched(spark, view, drivers).where("enriched")
        assert rows(known, "name") == [(name,)]


def test_submitted_pings_reach_the_ranked_read(spark):
    """Three cells with one, two and three drivers, some seen twice, then a ping that closes their
    window."""
    base = work_dir(spark, "submitted")
    crowds = {"north": ["ann"], "south": ["bob", "cyd"], "west": ["dee", "eve", "fay"]}
    seen_twice = [(cell, who) for cell, names in crowds.items() for who in names + names[:1]]
    lines = [
        json.dumps({"driver_id": who, "lat": 48.1, "lon": 11.5, "h3_cell": cell,
                    "occurred_at_ms": ms(5 * i)})
        for i, (cell, who) in enumerate(seen_twice)
    ]
    lines += ['{"driver_id": "bad", "lon": 1}',
              json.dumps({"driver_id": "z", "lat": 0, "lon": 0, "occurred_at_ms": ms(FLUSH)})]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(f"{base}/raw")

    raw = read_raw(spark, f"{base}/raw", streaming=True)
    for query in jobs.ingest_pings(raw, f"{base}/events", f"{base}/letters", f"{base}/ingest",
                                   drain=True):
        query.awaitTermination()
    events = read_pings(spark, f"{base}/events", streaming=True)
    jobs.hot_zones_job(events, f"{base}/view", f"{base}/zones", drain=True).awaitTermination()

    letters = spark.read.parquet(f"{base}/letters")
    assert rows(letters, "failure_reason") == [("lat: missing",)]
    top = top_hot_zones(read_view(spark, f"{base}/view"), 10).collect()
    assert [(r.h3_cell, r.driver_count, r.window_end_ms) for r in top] == [
        ("west", 3, ms(60)), ("south", 2, ms(60)), ("north", 1, ms(60))]


def test_retried_requests_pass_once(spark):
    source = feed(spark, requests, [("r1", 0), ("r1", 3), ("r2", 5)], [("r1", 9), ("r3", 9)])
    view = source.path("view")
    jobs.start(first_requests(source.read()), batch_writer(view), source.path("checkpoint"),
               drain=True).awaitTermination()
    assert rows(read_view(spark, view), "ride_id") == [("r1",), ("r2",), ("r3",)]
    again = first_requests(requests(spark, [("r1", 4), ("r1", 3), ("r2", 5)]))
    assert [(r.ride_id, r.event_time.second) for r in again.orderBy("ride_id").collect()] == [
        ("r1", 3), ("r2", 5)]


def test_file_input_has_no_latest(spark):
    with pytest.raises(ValueError, match="earliest"):
        read_files(spark, "/nowhere", "a int", starting="latest")


def test_shuffled_changes_have_the_same_batches_however_the_table_lies(spark):
    """A table of many files is a larger micro-batch, not more of them."""
    base = work_dir(spark, "orders")
    orders = spark.range(1000).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("x").alias("o_orderpriority"))
    orders.repartition(9).write.option("maxRecordsPerFile", 20).parquet(f"{base}/orders.parquet")
    sizes = []
    changes = tables.stream_shuffled_driver_changes(spark, base, 6)
    jobs.start(changes, lambda batch, _: sizes.append(batch.count()), f"{base}/checkpoint", drain=True).awaitTermination()
    assert len(sizes) == 6 and sum(sizes) == 1000
