from datetime import timedelta

from pyspark.sql import functions as F

from fleetlens.operators.lifecycle import clock_skew, duplicate_events, event_faults, ride_states, unknown_transitions


def test_last_known_state(spark):
    df = spark.createDataFrame(
        [("r1", "e1", None, "requested", 1), ("r1", "e2", "requested", "matched", 2),
         ("r2", "e3", None, "requested", 5), ("r2", "e4", "requested", "vanished", 6)],
        "ride_id string, event_id string, from_state string, to_state string, at int")
    df = df.withColumn("changed_at", F.timestamp_seconds("at"))
    got = sorted(tuple(r) for r in ride_states(df).collect())
    assert got == [("r1", "matched", "requested", 2000, 2), ("r2", "requested", None, 5000, 1)]


def test_duplicates(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "event_id string")
    assert [tuple(r) for r in duplicate_events(df).collect()] == [("a", 2)]


def test_skew_beyond_the_bound_either_way(spark):
    df = spark.createDataFrame([("a", 0, 60), ("b", 0, 61), ("c", 100, 0)],
                               "event_id string, o int, i int")
    df = df.select("event_id", F.timestamp_seconds("o").alias("occurred_at"),
                   F.timestamp_seconds("i").alias("ingested_at"))
    found = clock_skew(df, most=timedelta(seconds=60))
    assert sorted((r.event_id, r.skew_ms) for r in found.collect()) == [
        ("b", 61000), ("c", -100000)]


def test_other_names_of_a_state_and_unknown_ones(spark):
    moves = spark.createDataFrame(
        [("1", "r", "requested", "matched", 1), ("2", "r", "matched", "picked_up", 2),
         ("3", "r", "started", "flying", 3)],
        "event_id string, ride_id string, from_state string, to_state string, s long",
    ).withColumn("changed_at", F.timestamp_seconds("s"))
    row = ride_states(moves).first()
    assert (row.state, row.previous_state, row.transitions) == ("started", "matched", 2)
    lost = unknown_transitions(moves).collect()
    assert [(r.event_id, r.failure_reason) for r in lost] == [("3", "to_state: unknown state flying")]


def test_faults_once_per_event(spark):
    rows = [("a", 0, 1), ("a", 0, 40), ("a", 0, 90), ("b", 5, 5), ("c", 100, 20), ("d", 0, 0), ("d", 7200, 7200), (None, 0, 99)]
    df = spark.createDataFrame(
        [(i, "drv", 1.0, 2.0, o, n) for i, o, n in rows], "event_id string, driver_id string, lat double, lon double, o long, n long")
    df = df.select("*", F.timestamp_seconds("o").alias("event_time"), F.timestamp_seconds("n").alias("ingested_at"))
    found = event_faults(df, most=timedelta(seconds=60)).collect()
    assert sorted((r.anomaly_type, r.detected_at_ms, r.gap_ms) for r in found) == [
        ("clock_skew", 0, 90000), ("clock_skew", 100000, -80000), ("dup_event", 0, 89000)]
    assert len({r.anomaly_id for r in found}) == 3
    assert event_faults(df.limit(0)).count() == 0
