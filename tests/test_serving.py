import pytest

from fleetlens.operators import serving

ZONES = "window_end_ms bigint, h3_cell string, driver_count bigint"


def test_only_the_latest_window_and_ties_by_name(spark):
    view = spark.createDataFrame(
        [(1, "c9", 99), (2, "c1", 3), (2, "c2", 3), (2, "c3", 4), (2, "c0", 1)], ZONES)
    assert serving.latest_window(view).count() == 4
    top = [(r.h3_cell, r.driver_count) for r in serving.top_hot_zones(view, 3).collect()]
    assert top == [("c3", 4), ("c2", 3), ("c1", 3)]
    assert serving.top_hot_zones(view, 100).count() == 4
    assert serving.top_hot_zones(view.limit(0)).count() == 0


@pytest.mark.parametrize("k", [0, 101])
def test_zone_limit_range(spark, k):
    with pytest.raises(ValueError, match="limit"):
        serving.top_hot_zones(spark.createDataFrame([], ZONES), k)


@pytest.mark.parametrize("read, top", [
    (serving.idle_drivers, 500), (serving.recent_matches, 500), (serving.recent_anomalies, 500),
    (lambda view, k: serving.matches_for_ride(view, "r", k), 100)])
def test_other_limit_ranges(spark, read, top):
    view = spark.createDataFrame(
        [], "driver_id string, session_end_ms bigint, ping_count bigint, last_h3_cell string, "
        "ride_id string, h3_cell string, match_time_ms bigint, anomaly_id string, "
        "anomaly_type string, severity string, detected_at_ms bigint, "
        "observed_speed_mps double, prev_lat double, prev_lon double, curr_lat double, "
        "curr_lon double, gap_ms bigint")
    assert read(view, top).count() == 0
    with pytest.raises(ValueError, match="limit"):
        read(view, top + 1)


def test_idle_drivers_show_their_latest_session(spark):
    view = spark.createDataFrame(
        [("a", 5, 1, "x"), ("a", 9, 2, "y"), ("b", 9, 3, "z"), ("c", 1, 1, None)],
        "driver_id string, session_end_ms bigint, ping_count bigint, last_h3_cell string")
    assert [tuple(r) for r in serving.idle_drivers(view, 2).collect()] == [
        ("b", 9, 3, "z"), ("a", 9, 2, "y")]


def test_match_ties_compare_the_joined_name(spark):
    view = spark.createDataFrame(
        [("1", "d", "c", 7), ("10", "d", "c", 7), ("2", "d", "c", 6)],
        "ride_id string, driver_id string, h3_cell string, match_time_ms bigint")
    assert [r.ride_id for r in serving.recent_matches(view, 3).collect()] == ["1", "10", "2"]
    assert [tuple(r) for r in serving.matches_for_ride(view, "2").collect()] == [
        ("2", "c", "d", 6)]
    assert serving.enriched_ride(view, "none").count() == 0


def test_anomaly_without_details_takes_its_place(spark):
    columns = ("anomaly_id string, anomaly_type string, driver_id string, severity string, "
               "detected_at_ms bigint, observed_speed_mps double, prev_lat double, "
               "prev_lon double, curr_lat double, curr_lon double, gap_ms bigint")
    full = ("x", "ghost_driver", "d", "medium", 5, 0.0, 1.0, 2.0, 1.0, 2.0, 9)
    bare = ("y", None, None, None, 6, None, None, None, None, None, None)
    view = spark.createDataFrame([full, bare], columns)
    assert [r.anomaly_id for r in serving.recent_anomalies(view, 2).collect()] == ["x"]
    assert serving.recent_anomalies(view, 1).count() == 0
