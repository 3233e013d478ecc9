"""Output records: anomaly events, evidence and the enriched-ride map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.schemas import EVIDENCE_KEYS


def stable_id(*parts: Column) -> Column:
    """A UUID-shaped digest: the same finding keeps its id when a task or batch is retried."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.concat_ws("-", *(F.substring(digest, at, n) for at, n in
                              ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def evidence_map() -> Column:
    """Evidence of a flat anomaly row as text: three decimals for speed, six for positions."""
    texts = {
        "observed_speed_mps": F.format_string("%.3f", "observed_speed_mps"),
        "gap_ms": F.col("gap_ms").cast("string"),
    }
    pairs = []
    for key in EVIDENCE_KEYS:
        pairs += [F.lit(key), texts.get(key, F.format_string("%.6f", key))]
    return F.create_map(*pairs)


def keep_evidence(evidence: Column) -> Column:
    """The known evidence keys that are present."""
    return F.map_filter(evidence, lambda key, _: key.isin(*EVIDENCE_KEYS))


def anomaly_events(anomalies: DataFrame, producer: str = "fleetlens-anomaly") -> DataFrame:
    """Flat anomaly rows as nested events; all three times are the detection time."""
    detected = F.timestamp_millis("detected_at_ms")
    return anomalies.select(
        F.struct(
            F.col("anomaly_id").alias("event_id"),
            F.lit("AnomalyDetected").alias("event_type"),
            F.lit(1).alias("event_version"),
            detected.alias("occurred_at"),
            detected.alias("ingested_at"),
            F.lit(producer).alias("producer"),
            F.col("anomaly_id").alias("trace_id"),
        ).alias("envelope"),
        F.struct(
            "anomaly_id",
            "anomaly_type",
            F.lit("driver").alias("entity_type"),
            F.col("driver_id").alias("entity_id"),
            "severity",
            evidence_map().alias("evidence"),
            detected.alias("detected_at"),
        ).alias("payload"),
    )


def enriched_map(enriched: DataFrame) -> DataFrame:
    """Enriched rides as (ride_id, fields): text values, empty ones left out."""
    texts = {
        "rider_id": F.col("rider_id"),
        "pickup_h3": F.col("pickup_h3"),
        "request_ms": F.unix_millis("request_time").cast("string"),
        "driver_id": F.col("driver_id"),
        "driver_name": F.col("name"),
        "vehicle_type": F.col("vehicle_type"),
        "rating": F.col("rating").cast("string"),
        "active": F.col("active").cast("string"),
        "enriched": F.col("enriched").cast("string"),
    }
    pairs = []
    for key, text in texts.items():
        pairs += [F.lit(key), F.coalesce(text, F.lit(""))]
    fields = F.map_filter(F.create_map(*pairs), lambda _, value: value != "")
    return enriched.select("ride_id", fields.alias("fields"))
