"""Streaming jobs that keep their state in tables."""

from datetime import timedelta

import pytest
from fixtures import ms, pings, requests, rows
from test_streaming import changes, feed

from fleetlens.operators.joins import match_candidates
from fleetlens.session import work_dir
from fleetlens.sources.views import batch_writer, read_view
from fleetlens.streaming import jobs
from fleetlens.streaming.enrichment import reenricher, rides_and_changes


def sent(spark, view, batch_id):
    got = read_view(spark, view).where(f"batch_id = {batch_id}")
    return sorted((r.ride_id, r.name, r.enriched) for r in got.collect())


def test_a_ride_batch_run_again_starts_from_the_one_before(spark):
    """Rides are sent again only where their driver's values changed, and not once ``keep`` is over."""
    base = work_dir(spark, "reenrich")
    batches = [
        rides_and_changes(requests(spark, [("r1", 0, "c1", "rdr-00010"), ("r2", 1, "c1", "rdr-00020")]),
                          changes(spark, [("drv-0001", "one", "c", 1), ("drv-0002", "two", "c", 2)])),
        rides_and_changes(requests(spark, [("r3", 9, "c1", "rdr-00010")]),
                          changes(spark, [("drv-0001", "new", "u", 5), ("drv-0002", "two", "u", 6)])),
    ]
    view = f"{base}/view"
    write = reenricher(batch_writer(view), f"{base}/state", "decimal(3,2)", keep=timedelta(hours=1), spread=3)
    for batch_id in (0, 1, 1):
        write(batches[batch_id], batch_id)
    assert sent(spark, view, 0) == [("r1", "one", True), ("r2", "two", True)]
    assert sent(spark, view, 1) == [("r1", "new", True), ("r3", "new", True)]
    late = reenricher(batch_writer(view), f"{base}/state", "decimal(3,2)", keep=timedelta(0))
    late(rides_and_changes(requests(spark, []), changes(spark, [("drv-0001", "last", "u", 7)])), 2)
    assert sent(spark, view, 2) == []


def test_changed_rides_run_no_python_per_driver(spark):
    asked = feed(spark, requests, [("r1", 0, "c1", "rdr-00010")])
    turned = feed(spark, changes, [("drv-0001", "one", "c", 2)])
    query = jobs.reenrich_job(asked.read(), turned.read(), asked.path("view"), asked.path("checkpoint"), drain=True)
    query.awaitTermination()
    assert [p["stateOperators"] for p in query.recentProgress] == [[]] * len(query.recentProgress) != []


COLUMNS = ("ride_id", "driver_id", "match_time_ms", "h3_cell")


@pytest.mark.parametrize("slices", [1, 3])
def test_streamed_matches_keep_and_shuffle_no_pairs(spark, slices):
    """Late pings, a ride requested again in a later batch, and rows without a cell or time, without state per pair."""
    asked = [[("r1", 50), ("r2", 60, "c2")], [("r1", 400, "c2"), ("r3", 130), ("r4", 90, None)], [("r5", 395, "c2")]]
    seen = [[("a", 0), ("b", 20, "c2"), ("a", 55), ("a", 55)], [("a", 70), ("b", 66, "c2"), ("c", 61)],
            [("a", 300), ("b", 390, "c2"), ("b", 402, "c2"), ("c", 135)]]
    one, two = feed(spark, requests, *asked), feed(spark, pings, *seen)
    view = two.path("view")
    query = jobs.match_job(one.read(), two.read(), view, two.path("checkpoint"), drain=True, slices=slices,
                           lateness=timedelta(seconds=100))
    query.awaitTermination()
    assert all(p["stateOperators"] == [] for p in query.recentProgress)
    want = match_candidates(requests(spark, sum(asked, [])), pings(spark, sum(seen, [])))
    got = jobs.read_matches(spark, view)
    assert rows(got, *COLUMNS) == rows(want, *COLUMNS) and ("r1", "b", ms(402), "c2") in rows(got, *COLUMNS)


def test_matches_forget_what_can_match_no_more(spark):
    one = feed(spark, requests, [("r1", 0)], [("r2", 5000)], [("r3", 10000)])
    two = feed(spark, pings, [("a", 1)], [("a", 5001)], [("b", 10001)])
    jobs.match_job(one.read(), two.read(), two.path("view"), two.path("checkpoint"), drain=True).awaitTermination()
    kept = spark.read.parquet(f"{two.path('view')}-state/rows/version=2")
    assert rows(kept.where("asked"), "ride_id") == [("r3",)] and rows(kept.where("not asked"), "driver_id") == [("b",)]


def test_slices_of_many_drivers_are_joined_without_python(spark):
    """Only the slices themselves are keyed state; positions and silences of drivers are joined from a table."""
    source = feed(spark, pings, [(f"d{i}", i) for i in range(40)], [("d1", 900, "c1", 39.0, -122.0)], [("zz", 100_000)])
    view = source.path("view")
    query = jobs.sliced_anomaly_job(source.read(), view, source.path("log"), source.path("checkpoint"), drain=True)
    query.awaitTermination()
    names = {op["operatorName"] for p in query.recentProgress for op in p["stateOperators"]}
    assert names == {"stateStoreSave"}
    got = rows(read_view(spark, view), "anomaly_type", "driver_id", "detected_at_ms")
    ghosts = [("ghost_driver", f"d{i}", ms(i + 300)) for i in range(40)] + [("ghost_driver", "d1", ms(1200))]
    assert got == sorted([*ghosts, ("speed_violation", "d1", ms(900))])


def test_streamed_anomalies_keep_a_table_and_drop_late_pings(spark):
    """No keyed state and no Python per driver; a driver first seen behind the watermark is left out."""
    source = feed(spark, pings, [("a", 0)], [("zz", 5000)], [("b", 10)], [("zz", 100_000)])
    view = source.path("view")
    query = jobs.anomaly_job(source.read(), view, source.path("log"), source.path("checkpoint"), drain=True)
    query.awaitTermination()
    assert all(p["stateOperators"] == [] for p in query.recentProgress)
    got = rows(read_view(spark, view), "anomaly_type", "driver_id", "detected_at_ms")
    assert got == [("ghost_driver", "a", ms(300)), ("ghost_driver", "zz", ms(5300))]
