import math
from collections import defaultdict
from datetime import timedelta

from fixtures import moment, ms, pings, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.functions.geo import haversine_m
from fleetlens.functions.records import anomaly_events, evidence_map
from fleetlens.operators.motion import (
    _cut,
    _neighbours,
    _positions,
    anomalies,
    ghost_drivers,
    speed_violations,
)
from fleetlens.schemas import ANOMALY_EVENT

CALLS = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
KEY = ("anomaly_type", "driver_id", "detected_at_ms", "prev_lat", "curr_lat", "gap_ms")


def metres(a, b):
    (lat1, lon1), (lat2, lon2) = a, b
    p, q = math.radians(lat1), math.radians(lat2)
    h = (math.sin((q - p) / 2) ** 2
         + math.cos(p) * math.cos(q) * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * 6_371_000 * math.asin(math.sqrt(h))


def test_distance(spark):
    df = spark.createDataFrame([(37.7, -122.4, 37.8, -122.5), (0.0, 0.0, 0.0, 180.0),
                                (1.0, 1.0, 1.0, 1.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_m(*(F.col(x) for x in "abcd"))).collect()]
    assert abs(got[0] - metres((37.7, -122.4), (37.8, -122.5))) < 1e-6
    assert abs(got[1] - math.pi * 6_371_000) < 1e-6 and got[2] == 0.0


def test_speed_threshold_is_strict_and_severity_doubles(spark):
    step = math.degrees(1000 / 6_371_000)
    track = [("a", 0, "c1", 0.0, 0.0), ("a", 10, "c1", step, 0.0), ("a", 15, "c1", 0.0, 0.0)]
    speeds = speed_violations(pings(spark, track), mps=99.0)
    assert rows(speeds, "severity", "gap_ms") == [("critical", 5000), ("high", 10000)]
    assert speed_violations(pings(spark, track), mps=201.0).count() == 0


def test_equal_times_emit_nothing(spark):
    track = [("a", 0, "c1", 0.0, 0.0), ("a", 0, "c1", 10.0, 0.0)]
    assert speed_violations(pings(spark, track)).count() == 0


def test_ghost_needs_more_than_the_gap(spark):
    df = pings(spark, [("a", 0), ("a", 300), ("a", 600.001)])
    got = rows(ghost_drivers(df), "detected_at_ms", "gap_ms", "observed_speed_mps")
    assert got == [(ms(600), 300000, 0.0), (ms(900.001), 300000, 0.0)]
    assert rows(ghost_drivers(df, as_of=moment(900)), "detected_at_ms") == [(ms(600),)]
    late = ghost_drivers(df, as_of=moment(900.001))
    assert late.count() == 2


def test_null_drivers_are_left_out(spark):
    assert anomalies(pings(spark, [(None, 0), (None, 9999)])).count() == 0


@CALLS
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 4000), st.floats(37.0, 38.0)),
             min_size=1, max_size=50, unique_by=lambda r: r[:2]),
    st.sampled_from([1, 70, 3600, 100000]),
)
def test_any_chunk_gives_the_same_anomalies(spark, track, chunk):
    df = pings(spark, [(d, t, "c1", lat, -122.4) for d, t, lat in track])
    by_driver = defaultdict(list)
    for driver, t, lat in track:
        by_driver[driver].append((t, lat))
    want = []
    for driver, seen in by_driver.items():
        seen.sort()
        for (t, lat), (t2, lat2) in zip(seen, seen[1:] + [(None, None)]):
            if t2 is not None and metres((lat, -122.4), (lat2, -122.4)) / (t2 - t) > 50:
                want.append(("speed_violation", driver, ms(t2), lat, lat2, (t2 - t) * 1000))
            if t2 is None or t2 - t > 300:
                want.append(("ghost_driver", driver, ms(t + 300), lat, lat, 300000))
    cut = timedelta(seconds=chunk)
    assert rows(anomalies(df, chunk=cut), *KEY) == sorted(want)
    speeds, ghosts = speed_violations(df, chunk=cut), ghost_drivers(df)
    assert rows(speeds.unionByName(ghosts), *KEY) == sorted(want)
    by_rows = anomalies(df, chunk=cut if chunk < 3600 else None, rows=3)
    assert rows(by_rows, *KEY) == sorted(want)


def _burst(spark):
    """A driver with a third of 30,000 pings inside one minute, several at the same millisecond, and one jump."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(30_000).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("d"), n % 500)).alias("driver_id"),
        F.format_string("%06d", n).alias("event_id"),
        F.when(n == 15_000, 38.7).otherwise(37.7).alias("lat"),
        F.lit(-122.4).alias("lon"),
        F.timestamp_millis(F.when(hot, n * 7919 % 60_000 - n * 7919 % 60_000 % 12).otherwise(n * 1000)).alias("event_time"),
    )


def test_a_burst_of_one_driver_is_cut_by_rows(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        cut = _cut(_positions(_burst(spark)), timedelta(hours=1), 1000, ("at", "event_id"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sizes = cut.where("driver_id = 'hot'").groupBy("chunk").count()
    largest, pieces = sizes.agg(F.max("count"), F.count("*")).first()
    assert pieces >= 4 and largest <= 2 * 30_000 / 16
    assert cut.count() == 30_000
    calm = cut.where("driver_id <> 'hot'").groupBy("driver_id", "chunk").count()
    assert calm.agg(F.max("count")).first()[0] <= 40


def test_a_burst_gives_the_same_anomalies_by_rows_and_whole(spark):
    df = _burst(spark)
    whole, cut = (anomalies(df, chunk=None, rows=r) for r in (10**9, 1000))
    assert rows(cut, *KEY) == rows(whole, *KEY)
    # The jump shares its millisecond with another ping: only one side of it takes time.
    assert whole.where("anomaly_type = 'speed_violation' and driver_id = 'hot'").count() == 1


def test_null_and_empty_tracks_by_rows(spark):
    assert anomalies(pings(spark, [("a", 0)]).where("false"), chunk=None, rows=1).count() == 0
    assert anomalies(pings(spark, [("a", 0), ("a", 0)]), chunk=None, rows=1).count() == 1


def test_only_chunk_ends_of_a_busy_driver_meet_again(spark):
    seconds = spark.range(20_000).select(
        F.lit("hot").alias("driver_id"), F.col("id").cast("string").alias("event_id"),
        F.lit(37.7).alias("lat"), F.lit(-122.4).alias("lon"),
        F.timestamp_seconds("id").alias("event_time"))
    kept = _neighbours(_positions(seconds), timedelta(hours=1), F.lit(False))
    assert kept.count() == 2 * 6
    assert kept.where("next_at - at > 1000 or at - prev_at > 1000").count() == 0
    assert anomalies(seconds).count() == 1


def test_ids_are_stable_and_evidence_is_text(spark):
    df = pings(spark, [("a", 0, "c1", 37.5, -122.25)])
    first, again = (ghost_drivers(df).select("anomaly_id").first()[0] for _ in range(2))
    assert first == again and [len(part) for part in first.split("-")] == [8, 4, 4, 4, 12]
    assert ghost_drivers(df).select(evidence_map().alias("e")).first().e == {
        "observed_speed_mps": "0.000", "prev_lat": "37.500000", "prev_lon": "-122.250000",
        "curr_lat": "37.500000", "curr_lon": "-122.250000", "gap_ms": "300000"}


def test_event_record(spark):
    events = anomaly_events(ghost_drivers(pings(spark, [("a", 0)])))
    assert events.schema.simpleString() == spark.createDataFrame(
        [], ANOMALY_EVENT).schema.simpleString()
    event = events.first()
    envelope, payload = event.envelope, event.payload
    assert envelope.event_id == envelope.trace_id == payload.anomaly_id
    assert envelope.occurred_at == envelope.ingested_at == payload.detected_at
    assert (envelope.event_type, payload.entity_type, payload.entity_id, payload.severity) == (
        "AnomalyDetected", "driver", "a", "medium")
