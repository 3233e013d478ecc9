"""Kafka and framed Avro. Needs the Kafka and Avro packages on the session's class path.

A framed value is one zero byte, a four-byte schema id and the Avro body.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.quality import dead_letters
from fleetlens.schemas import ANOMALY_TOPIC

STARTING = ("earliest", "latest")
_SAFE = {"kafka.acks": "all", "kafka.enable.idempotence": "true"}


def kafka_options(
    servers: str, topic: str, *, starting: str = "latest", rows_per_batch: int = 5_000_000
) -> dict[str, str]:
    """Source options; a batch read may only start at the earliest offset."""
    if starting not in STARTING:
        raise ValueError(f"starting must be one of {STARTING}")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(rows_per_batch),
    }


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    *,
    group: str | None = None,
    streaming: bool = True,
    starting: str | None = None,
    rows_per_batch: int = 5_000_000,
) -> DataFrame:
    """Rows of a topic: a stream from the latest offsets on, or a batch of all of them, unless
    ``starting`` says otherwise; a batch can't start at the latest ones."""
    if starting is None:
        starting = "latest" if streaming else "earliest"
    if not streaming and starting == "latest":
        raise ValueError("a batch read of a topic can't start at the latest offsets")
    options = kafka_options(servers, topic, starting=starting, rows_per_batch=rows_per_batch)
    if group:
        options["kafka.group.id"] = group
    if not streaming:
        options.pop("maxOffsetsPerTrigger")
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def frame_schema_id(value: Column) -> Column:
    """Schema id of a framed value, NULL where the frame is not one."""
    head = F.hex(F.substring(value, 1, 5))
    framed = (F.length(value) >= 5) & F.startswith(head, F.lit("00"))
    return F.when(framed, F.conv(F.substring(head, 3, 8), 16, 10).cast("bigint"))


def frame_body(value: Column) -> Column:
    return F.when(frame_schema_id(value).isNotNull(), F.substr(value, F.lit(6)))


def framed(body: Column, schema_id: int) -> Column:
    head = F.unhex(F.lit(f"00{schema_id:08X}"))
    return F.concat(head, body)


def split_frames(
    rows: DataFrame,
    decode: Callable[[Column], Column],
    *,
    topic: str,
    schema_ids: Sequence[int],
    required: Sequence[str] = (),
    failed_at: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters) from a topic's key, value and headers.

    ``decode`` turns a frame's body into a struct. A value goes to the letters with its original bytes where it is
    missing, no frame, of a schema id not in ``schema_ids``, or not decoded: a lenient decoder gives a struct
    without any value then, and one whose ``required`` fields are null is none either.
    """
    value, event = F.col("value"), F.col("_event")
    found = frame_schema_id(value)
    known = found.isin(*schema_ids)
    read = rows.withColumn("_event", F.when(known, decode(frame_body(value))))
    fields = read.schema["_event"].dataType.names
    blank = F.lit(True)
    for name in fields:
        blank = blank & event[name].isNull()
    for path in required:
        blank = blank | F.col(f"_event.{path}").isNull()
    wrong_id = F.concat(F.lit("value: unknown schema id "), found.cast("string"))
    reason = (
        F.when(value.isNull(), "value: missing")
        .when(found.isNull(), "value: not a frame")
        .when(~known, wrong_id)
        .when(event.isNull() | blank, "value: not of its schema")
    )
    # Behind a generator, the optimizer decodes once and not again in every filter and field.
    checked = read.select("*", F.inline(F.array(F.struct(reason.alias("failure_reason")))))
    good = checked.where("failure_reason is null").select("_event.*")
    bad = checked.where("failure_reason is not null").drop("_event")
    return good, dead_letters(bad, topic, stage="deserialize", failed_at=failed_at)


def decode_events(
    rows: DataFrame, avro_schema: str, *, topic: str, schema_ids: Sequence[int], required: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters) of framed Avro values; ``avro_schema`` is the registered JSON text."""
    from pyspark.sql.avro.functions import from_avro

    return split_frames(
        rows, lambda body: from_avro(body, avro_schema, {"mode": "PERMISSIVE"}), topic=topic,
        schema_ids=schema_ids, required=required,
    )


def keyed_json(events: DataFrame, key: Column) -> DataFrame:
    """Events as Kafka rows with JSON values."""
    return events.select(
        key.cast("binary").alias("key"), F.to_json(F.struct("*")).cast("binary").alias("value")
    )


def keyed_avro(events: DataFrame, key: Column, avro_schema: str, schema_id: int) -> DataFrame:
    """Events as Kafka rows with framed Avro values."""
    from pyspark.sql.avro.functions import to_avro

    body = to_avro(F.struct("*"), avro_schema)
    return events.select(
        key.cast("binary").alias("key"), framed(body, schema_id).alias("value")
    )


def anomaly_key() -> Column:
    """Anomaly events are keyed by the driver they are about."""
    return F.col("payload.entity_id")


def ping_key() -> Column:
    """Pings are keyed by driver."""
    return F.col("payload.driver_id")


def request_key() -> Column:
    """Ride requests are keyed by rider."""
    return F.col("payload.rider_id")


def topic_writer(servers: str, topic: str, key: Column) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes a batch's events to a topic as JSON. A batch that is run again is
    sent again: the log keeps events at least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        options = {**_SAFE, "kafka.bootstrap.servers": servers, "topic": topic}
        keyed_json(batch, key).write.format("kafka").options(**options).save()

    return write


def write_topic(rows: DataFrame, servers: str, topic: str, checkpoint: str):
    """Start writing Kafka rows with full acknowledgement and producer idempotence."""
    return (
        rows.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**_SAFE)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_anomalies(
    events: DataFrame, servers: str, checkpoint: str, *, topic: str = ANOMALY_TOPIC
):
    """Start writing anomaly events, keyed by driver, as JSON."""
    return write_topic(keyed_json(events, anomaly_key()), servers, topic, checkpoint)
