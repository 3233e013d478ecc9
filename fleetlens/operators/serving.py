"""Ranked reads over result views.

Ties are broken by member name in descending byte order. The top-k reads sort by a limit,
so each task keeps k rows and only those meet in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.records import evidence_map, keep_evidence

ZONE_LIMIT = 100
MEMBER_LIMIT = 500
RIDE_LIMIT = 100


def _limit(k: int, most: int) -> int:
    if not 1 <= k <= most:
        raise ValueError(f"limit must be in 1..{most}, got {k}")
    return k


def latest_window(view: DataFrame) -> DataFrame:
    """All rows of the view's highest window; the bound is one aggregated value."""
    newest = view.select(F.max("window_end_ms")).scalar()
    return view.where(F.col("window_end_ms") == newest)


def _top_of_latest(view: DataFrame, score: str, k: int) -> DataFrame:
    """Top k of the latest window in one pass: the window leads the sort key, so rows of
    earlier windows follow and are dropped from the k kept."""
    kept = view.orderBy(F.desc("window_end_ms"), F.desc(score), F.desc("h3_cell")).limit(
        _limit(k, ZONE_LIMIT)
    )
    newest = F.max("window_end_ms").over(Window.partitionBy(F.lit(0)))
    return (
        kept.withColumn("newest", newest)
        .where("window_end_ms = newest")
        .select("window_end_ms", "h3_cell", score)
    )


def top_hot_zones(view: DataFrame, k: int = 10) -> DataFrame:
    return _top_of_latest(view, "driver_count", k)


def top_surge_zones(view: DataFrame, k: int = 10) -> DataFrame:
    return _top_of_latest(view, "request_count", k)


def latest_session(view: DataFrame) -> DataFrame:
    """Each driver's session that ended last."""
    newest = F.max(F.struct("session_end_ms", "ping_count", "last_h3_cell"))
    return view.groupBy("driver_id").agg(newest.alias("s")).select("driver_id", "s.*")


def idle_drivers(view: DataFrame, k: int = 10) -> DataFrame:
    """Most recently idle drivers."""
    return (
        latest_session(view)
        .orderBy(F.desc("session_end_ms"), F.desc("driver_id"))
        .limit(_limit(k, MEMBER_LIMIT))
    )


def recent_matches(candidates: DataFrame, k: int = 10) -> DataFrame:
    """Latest (ride, driver) candidates; ties compare the joined 'ride:driver' name."""
    member = F.concat_ws(":", "ride_id", "driver_id")
    return (
        candidates.select("ride_id", "driver_id", "match_time_ms")
        .orderBy(F.desc("match_time_ms"), member.desc())
        .limit(_limit(k, MEMBER_LIMIT))
    )


def matches_for_ride(candidates: DataFrame, ride_id: str | Column, k: int = 10) -> DataFrame:
    """Latest candidates of one ride with its pickup cell."""
    return (
        candidates.where(F.col("ride_id") == ride_id)
        .select("ride_id", "h3_cell", "driver_id", "match_time_ms")
        .orderBy(F.desc("match_time_ms"), F.desc("driver_id"))
        .limit(_limit(k, RIDE_LIMIT))
    )


def recent_anomalies(found: DataFrame, k: int = 20) -> DataFrame:
    """Latest anomalies with their evidence; ids without details are left out.

    As in a ranked view with separate details, an id without them still takes its place
    among the k.
    """
    ranked = found.orderBy(F.desc("detected_at_ms"), F.desc("anomaly_id")).limit(
        _limit(k, MEMBER_LIMIT)
    )
    return ranked.where(F.col("anomaly_type").isNotNull()).select(
        "anomaly_id", "detected_at_ms", "anomaly_type", "driver_id", "severity",
        keep_evidence(evidence_map()).alias("evidence"),
    )


def enriched_ride(enriched: DataFrame, ride_id: str | Column) -> DataFrame:
    """The enriched row of one ride, or none."""
    return enriched.where(F.col("ride_id") == ride_id)
