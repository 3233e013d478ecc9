from datetime import timedelta
from decimal import Decimal

import pytest
from fixtures import ms, pings, requests, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.functions.records import enriched_map
from fleetlens.operators import joins
from fleetlens.operators.joins import (
    enrich_rides,
    last_match,
    last_matches,
    match_candidates,
    match_rides,
    newest_candidates,
    pings_in_reach,
    reduce_matches,
)
from fleetlens.operators.serving import recent_matches

CALLS = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
CELLS = st.sampled_from(["c1", "c2", None])
PINGS = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 900), CELLS), min_size=1,
                 max_size=60)
RIDES = st.lists(st.tuples(st.integers(0, 900), CELLS), min_size=1, max_size=12)


def test_interval_bounds_are_inclusive(spark):
    df = match_rides(
        requests(spark, [("r", 100)]),
        pings(spark, [("a", 39.999), ("b", 40), ("c", 220), ("d", 220.001)]))
    assert rows(df, "driver_id") == [("b",), ("c",)]


def test_null_cells_never_match(spark):
    df = match_rides(requests(spark, [("r", 100, None)]), pings(spark, [("a", 100, None)]))
    assert df.count() == 0


@CALLS
@given(RIDES, PINGS, st.sampled_from([(60, 120), (0, 0), (500, 3)]), st.sampled_from([1, 3]))
def test_matches_and_candidates_brute_force(spark, rides, track, spans, slices):
    before, after = spans
    asked = requests(spark, [(f"r{i}", at, cell) for i, (at, cell) in enumerate(rides)])
    seen = pings(spark, track)
    pairs = [
        (f"r{i}", driver, ms(t))
        for i, (at, cell) in enumerate(rides)
        for driver, t, where in track
        if cell is not None and cell == where and at - before <= t <= at + after
    ]
    bounds = {"before": timedelta(seconds=before), "after": timedelta(seconds=after)}
    matches = match_rides(asked, seen, slices=slices, **bounds)
    got = rows(matches, "ride_id", "driver_id", F.unix_millis("match_time"))
    assert got == sorted(pairs)

    latest = {}
    for ride, driver, t in pairs:
        latest[ride, driver] = max(t, latest.get((ride, driver), 0))
    want = sorted((*key, t) for key, t in latest.items())
    columns = ("ride_id", "driver_id", "match_time_ms")
    assert rows(reduce_matches(matches), *columns) == want
    cut = match_candidates(asked, seen, chunk=timedelta(seconds=100), **bounds)
    assert rows(cut, *columns) == want


def test_candidates_of_a_driver_that_pings_every_millisecond(spark):
    track = [("a", 100 + i / 1000) for i in range(2000)] + [("b", 100.5), ("b", 100.5)]
    asked = requests(spark, [("r1", 0), ("r2", -20), ("r3", -18.5), ("r4", 162)])
    got = rows(match_candidates(asked, pings(spark, track)),
               "ride_id", "driver_id", "match_time_ms")
    assert got == [
        ("r1", "a", ms(101.999)), ("r1", "b", ms(100.5)), ("r2", "a", ms(100)),
        ("r3", "a", ms(101.5)), ("r3", "b", ms(100.5))]


def test_last_match_per_ride(spark):
    df = match_candidates(requests(spark, [("r", 100)]), pings(spark, [("a", 90), ("b", 130)]))
    assert rows(last_match(df), "ride_id", "h3_cell", "last_match_ms") == [("r", "c1", ms(130))]


def _drivers(spark):
    return spark.createDataFrame(
        [("drv-0001", "Ann", "economy", Decimal("4.50"), False)],
        "driver_id string, name string, vehicle_type string, rating decimal(3,2), active boolean")


def test_enrichment_keeps_unknown_rides(spark):
    asked = requests(spark, [("r1", 0, "c1", "rdr-00012"), ("r2", 0, "c1", "rdr-00999"),
                             ("r3", 0, "c1", None)])
    df = enrich_rides(asked, _drivers(spark))
    assert sorted(df.select("ride_id", "driver_id", "name", "enriched").collect()) == [
        ("r1", "drv-0001", "Ann", True), ("r2", "drv-0099", None, False),
        ("r3", None, None, False)]


def test_enriched_map_drops_empty_texts(spark):
    asked = requests(spark, [("r1", 1, "c1", "rdr-00012"), ("r2", 0, None, "rdr-00999")])
    maps = enriched_map(enrich_rides(asked, _drivers(spark)))
    got = {r.ride_id: r.fields for r in maps.collect()}
    assert got["r1"] == {
        "rider_id": "rdr-00012", "pickup_h3": "c1", "request_ms": str(ms(1)),
        "driver_id": "drv-0001", "driver_name": "Ann", "vehicle_type": "economy",
        "rating": "4.50", "active": "false", "enriched": "true"}
    assert got["r2"] == {"rider_id": "rdr-00999", "request_ms": str(ms(0)),
                         "driver_id": "drv-0099", "enriched": "false"}


def test_a_ride_requested_again_is_one_ride(spark):
    requests = spark.createDataFrame(
        [("r", "c1", 100), ("r", "c2", 150)], "ride_id string, h3_cell string, s long"
    ).withColumn("event_time", F.timestamp_seconds("s"))
    pings = spark.createDataFrame(
        [("d", "c1", 100), ("d", "c2", 160)], "driver_id string, h3_cell string, s long"
    ).withColumn("event_time", F.timestamp_seconds("s"))
    want = [("r", "d", "c2", 160_000)]
    columns = ("ride_id", "driver_id", "h3_cell", "match_time_ms")
    found = match_candidates(requests, pings)
    assert rows(found, *columns) == want
    assert rows(reduce_matches(match_rides(requests, pings)), *columns) == want
    assert rows(last_match(found), "ride_id", "h3_cell", "last_match_ms") == [("r", "c2", 160_000)]


def test_pings_in_reach_are_those_that_match(spark):
    asked = requests(spark, [("r1", 100), ("r1", 130), ("r2", 100, None)])
    seen = pings(spark, [("a", 39.999), ("a", 40), ("b", 250), ("b", 250.001), ("c", 100, "c2"), ("d", 100, None)])
    near = pings_in_reach(asked, seen)
    assert rows(near, "driver_id", "event_id") == [("a", "e00001"), ("b", "e00002")]
    columns = ("ride_id", "driver_id", "h3_cell", "match_time_ms")
    assert rows(match_candidates(asked, near), *columns) == rows(match_candidates(asked, seen), *columns)


@CALLS
@given(RIDES, PINGS, st.sampled_from([(60, 120), (0, 0), (500, 3)]), st.integers(1, 6), st.integers(1, 4))
def test_last_matches_and_newest_candidates_are_those_of_all(spark, rides, track, spans, k, retries):
    bounds = {name: timedelta(seconds=s) for name, s in zip(("before", "after"), spans)}
    asked = requests(spark, [(f"r{i // retries}", at, cell) for i, (at, cell) in enumerate(rides)])
    seen = pings(spark, track)
    every = match_candidates(asked, seen, **bounds)
    columns = "ride_id", "h3_cell", "last_match_ms"
    assert rows(last_matches(asked, seen, **bounds), *columns) == rows(last_match(every), *columns)
    newest = newest_candidates(asked, seen, k, **bounds)
    assert recent_matches(newest, k).collect() == recent_matches(every, k).collect()


def test_last_matches_list_no_pairs(spark):
    """A thousand requests and pings of one interval are a million candidates."""
    asked = requests(spark, [(f"r{i}", 500 + i / 1000) for i in range(1000)])
    seen = pings(spark, [(f"d{i}", 450 + i / 1000) for i in range(1000)])
    found = last_matches(asked, seen)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert {r[0] for r in rows(found, "last_match_ms")} == {ms(450.999)}
    assert newest_candidates(asked, seen, 10).count() == 1000


def test_null_rides_and_drivers_have_last_matches(spark):
    asked = requests(spark, [(None, 100), (None, 300), ("r", 100)])
    seen = pings(spark, [(None, 90), ("a", 310)])
    every = match_candidates(asked, seen)
    columns = "ride_id", "h3_cell", "last_match_ms"
    found = {tuple(r) for r in last_matches(asked, seen).select(*columns).collect()}
    assert found == {tuple(r) for r in last_match(every).select(*columns).collect()}


@CALLS
@given(RIDES, PINGS, st.integers(1, 3), st.sampled_from([50, 100, 3600]))
def test_blocks_give_the_same_candidates(spark, rides, track, retries, chunk):
    bounds = {"before": timedelta(seconds=60), "after": timedelta(seconds=120)}
    asked = requests(spark, [(f"r{i // retries}", at, cell) for i, (at, cell) in enumerate(rides)])
    seen = pings(spark, track)
    columns = "ride_id", "driver_id", "h3_cell", "match_time_ms"
    want = rows(reduce_matches(match_rides(asked, seen, **bounds)), *columns)
    assert rows(reduce_matches(match_rides(asked, seen, side=3, **bounds)), *columns) == want
    cut = {"chunk": timedelta(seconds=chunk), **bounds}
    assert rows(match_candidates(asked, seen, **cut), *columns) == want
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(joins, "BLOCK_PAIRS", 2)
        assert rows(match_candidates(asked, seen, **cut), *columns) == want


def test_pairs_of_rides_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(joins, "BLOCK_PAIRS", 10)
    seen = pings(spark, [(f"d{i}", 100 + i) for i in range(20)])
    once = requests(spark, [(f"r{i}", 100) for i in range(20)])
    again = requests(spark, [(f"r{i % 10}", 100 + i) for i in range(20)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # As with sides that are too large to be broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [found._jdf.queryExecution().executedPlan().toString() for found in (
            match_candidates(once, seen), match_candidates(again, seen),
            reduce_matches(match_rides(again, seen, side=3)))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Of rides with one request only the first branch has rows.
    plans[0] = "\n".join(line for line in plans[0].splitlines() if line.startswith("   :"))
    assert all("Inner" in plan for plan in plans)
    assert [_exchanged_joins(plan) for plan in plans] == [0, 0, 0]


def _exchanged_joins(plan: str) -> int:
    """Joins of pings and requests that lie below an exchange."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    lines, found = plan.splitlines(), 0
    for i, line in enumerate(lines):
        if " Exchange " in f" {line.lstrip(' :+-*')} "[:10]:
            for under in lines[i + 1 :]:
                if depth(under) <= depth(line):
                    break
                found += "Join" in under and "Inner" in under
    return found


@pytest.fixture
def many_partitions(spark):
    """More shuffle partitions than blocks, and no broadcasts."""
    settings = {"spark.sql.shuffle.partitions": "500", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_matches_stay_in_their_blocks_with_many_partitions(spark, many_partitions):
    """Few blocks were dealt again by all keys of the join, and every match was shuffled."""
    asked = requests(spark, [(f"r{i % 10}", 100 + i) for i in range(20)])
    seen = pings(spark, [(f"d{i}", 100 + i) for i in range(20)])
    plan = _plan(reduce_matches(match_rides(asked, seen, side=2)))
    assert "Inner" in plan and _exchanged_joins(plan) == 0
    assert plan.count("Exchange") == 2


def test_candidates_of_repeated_rides_stay_in_their_blocks_with_many_partitions(spark, many_partitions, monkeypatch):
    """Spans and requests are copied to blocks as they are; panes and sizes are looked up inside a block."""
    monkeypatch.setattr(joins, "BLOCK_PAIRS", 50)
    again = requests(spark, [(f"r{i % 10}", 100 + i) for i in range(20)])
    seen = pings(spark, [(f"d{i % 15}", 100 + i) for i in range(20)])
    several = match_candidates(again, seen)
    text = _plan(several)
    assert _exchanged_joins(text[text.index("WindowGroupLimit"):]) == 0
    lines = text[text.index("WindowGroupLimit"):].splitlines()
    dealt = [i for i, line in enumerate(lines) if "shufflepartitionidpassthrough" in line]
    assert len(dealt) == 2 and not any("Generate explode(array" in line for line in lines[dealt[1]:])
    want = rows(reduce_matches(match_rides(again, seen)), "ride_id", "driver_id", "h3_cell", "match_time_ms")
    assert rows(several, "ride_id", "driver_id", "h3_cell", "match_time_ms") == want
