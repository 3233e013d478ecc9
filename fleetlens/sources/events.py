"""Event sources: nested events from files, flattened for the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.timing import to_event_time
from fleetlens.schemas import (
    DRIVER_CHANGE,
    LIFECYCLE_EVENT,
    PING_EVENT,
    REQUEST_EVENT,
    RIDE_CHANGE,
)


def read_files(
    spark: SparkSession,
    path: str,
    schema: str,
    *,
    streaming: bool = False,
    format: str = "parquet",
    starting: str = "earliest",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Rows of a folder with a declared schema, whole or as a stream of arriving files.

    A folder keeps no read position, so a new file stream always starts at its first file.
    """
    if starting != "earliest":
        raise ValueError("file input starts at the earliest file; use Kafka for 'latest'")
    if streaming:
        reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = spark.read
    return reader.schema(schema).format(format).load(path)


def read_raw(
    spark: SparkSession, path: str, *, streaming: bool = False, files_per_batch: int = 1000
) -> DataFrame:
    """Submitted JSON, one value per line."""
    if streaming:
        return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return spark.read.text(path)


def flatten_pings(events: DataFrame) -> DataFrame:
    return events.select(
        "envelope.event_id",
        "payload.*",
        to_event_time(F.col("envelope.occurred_at")).alias("event_time"),
    )


def flatten_requests(events: DataFrame) -> DataFrame:
    """The fields that queries use; the scan skips the rest of the record."""
    return events.select(
        "envelope.event_id",
        "payload.ride_id",
        "payload.rider_id",
        "payload.pickup.lat",
        "payload.pickup.lon",
        "payload.pickup.h3_cell",
        to_event_time(F.col("envelope.occurred_at")).alias("event_time"),
    )


def flatten_transitions(events: DataFrame) -> DataFrame:
    return events.select("envelope.event_id", "payload.*")


def read_pings(spark: SparkSession, path: str, **options) -> DataFrame:
    return flatten_pings(read_files(spark, path, PING_EVENT, **options))


def read_requests(spark: SparkSession, path: str, **options) -> DataFrame:
    return flatten_requests(read_files(spark, path, REQUEST_EVENT, **options))


def read_transitions(spark: SparkSession, path: str, **options) -> DataFrame:
    return flatten_transitions(read_files(spark, path, LIFECYCLE_EVENT, **options))


def read_driver_changes(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_files(spark, path, DRIVER_CHANGE, **options)


def read_ride_changes(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_files(spark, path, RIDE_CHANGE, **options)
