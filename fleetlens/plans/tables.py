"""The given tables seen as ride events.

Every event is a driver ping; a purchase is also a ride request. Customers are the drivers,
orders the captured changes of drivers and line items those of rides.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.timing import millis, to_event_time
from fleetlens.session import configure, work_dir
from fleetlens.sources.events import read_files
from fleetlens.sources.kafka import framed

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)
ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
# How the given categories stand for this domain's.
TIER_OF_SEGMENT = {
    "AUTOMOBILE": "economy",
    "BUILDING": "economy",
    "FURNITURE": "comfort",
    "HOUSEHOLD": "premium",
    "MACHINERY": "comfort",
}
STATE_OF_EVENT = {
    "view": "requested",
    "click": "matched",
    "signup": "started",
    "purchase": "completed",
    "error": "cancelled",
}
OP_OF_STATUS = {"O": "c", "P": "u", "F": "d"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    """A table as a file stream; the pattern also matches a folder of parts."""
    configure(spark)
    return read_files(spark, f"{sf_dir.rstrip('/')}/{name}.parque[t]", schema, streaming=True)


def _mapped(column: Column, values: dict[str, str]) -> Column:
    pairs = [F.lit(item) for pair in values.items() for item in pair]
    return F.element_at(F.create_map(*pairs), column)


def _numbered(prefix: str, digits: int, number: Column) -> Column:
    """The prefix and the number with at least ``digits`` digits."""
    text = number.cast("string")
    width = F.greatest(F.lit(digits), F.length(text))
    return F.concat(F.lit(prefix), F.call_function("lpad", text, width, F.lit("0")))


def driver_id(number: Column) -> Column:
    return _numbered("drv-", 4, number)


def rider_id(number: Column) -> Column:
    return _numbered("rdr-", 5, number)


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _cell_of(k: Column) -> Column:
    return _numbered("c", 2, k % 16)


def _cell() -> Column:
    return _cell_of(_k())


def _lat() -> Column:
    return F.lit(37.7) + (F.col("event_id") * 7919 % 1200) / F.lit(10000.0)


def _lon() -> Column:
    return F.lit(-122.52) + (F.col("event_id") * 104729 % 1500) / F.lit(10000.0)


def _envelope(kind: str) -> Column:
    at = to_event_time(F.col("ts"))
    # Ingestion lags or leads by up to two minutes.
    lag_ms = (F.col("event_id") * 37 % 240 - 120) * 1000
    event_id = F.col("event_id").cast("string")
    return F.struct(
        event_id.alias("event_id"),
        F.lit(kind).alias("event_type"),
        F.lit(1).alias("event_version"),
        at.alias("occurred_at"),
        F.timestamp_millis(F.unix_millis(at) + lag_ms).alias("ingested_at"),
        F.lit("testdata").alias("producer"),
        event_id.alias("trace_id"),
    ).alias("envelope")


def ping_events(events: DataFrame) -> DataFrame:
    unknown = F.lit(None).cast("double")
    payload = F.struct(
        driver_id(F.col("user_id")).alias("driver_id"),
        _lat().alias("lat"),
        _lon().alias("lon"),
        _cell().alias("h3_cell"),
        unknown.alias("heading_degrees"),
        F.col("value").alias("speed_mps"),
        unknown.alias("accuracy_meters"),
    ).alias("payload")
    return events.select(_envelope("DriverLocationPinged"), payload)


def request_events(events: DataFrame) -> DataFrame:
    point = F.struct(_lat().alias("lat"), _lon().alias("lon"), _cell().alias("h3_cell"))
    payload = F.struct(
        F.col("event_id").cast("string").alias("ride_id"),
        rider_id(F.col("user_id")).alias("rider_id"),
        point.alias("pickup"),
        point.alias("dropoff"),
        F.lit("economy").alias("product_tier"),
        to_event_time(F.col("ts")).alias("requested_at"),
    ).alias("payload")
    return events.where("event_type = 'purchase'").select(_envelope("RideRequested"), payload)


def flat_pings(events: DataFrame) -> DataFrame:
    """The columns of flattened ping events, taken straight from the table so that the scan
    reads only what a query uses."""
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        driver_id(F.col("user_id")).alias("driver_id"),
        _lat().alias("lat"),
        _lon().alias("lon"),
        _cell().alias("h3_cell"),
        to_event_time(F.col("ts")).alias("event_time"),
    )


def flat_requests(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'purchase'").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_id").cast("string").alias("ride_id"),
        rider_id(F.col("user_id")).alias("rider_id"),
        _lat().alias("lat"),
        _lon().alias("lon"),
        _cell().alias("h3_cell"),
        to_event_time(F.col("ts")).alias("event_time"),
    )


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_pings(table(spark, sf_dir, "events"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_requests(table(spark, sf_dir, "events"))


def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event moves the ride numbered by its user to the state its type stands for."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        _numbered("ride-", 4, F.col("user_id")).alias("ride_id"),
        F.lit(None).cast("string").alias("from_state"),
        _mapped(F.col("event_type"), STATE_OF_EVENT).alias("to_state"),
        to_event_time(F.col("ts")).alias("changed_at"),
    )


def stream_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_pings(table_stream(spark, sf_dir, "events", EVENTS))


# A driver with a third of all pings, all of them in one hour.
BUSY_DRIVER = "drv-busy"
BUSY_FROM_MS, BUSY_SPAN_MS = 1_705_320_000_000, 3_600_000


def busy_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pings, every third of them given to one driver in one hour."""
    number = F.col("event_id").cast("bigint")
    busy = number % 3 == 0
    at = F.timestamp_millis(F.lit(BUSY_FROM_MS) + number * 7919 % BUSY_SPAN_MS)
    return pings(spark, sf_dir).withColumns({
        "driver_id": F.when(busy, BUSY_DRIVER).otherwise(F.col("driver_id")),
        "event_time": F.when(busy, at).otherwise(F.col("event_time")),
    })


# Sent again that much later.
RESENT_MS = 2_700_000


def sent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pings as they were ingested, every fifth of them sent twice; ``row_id`` tells copies apart."""
    number = F.col("event_id").cast("bigint")
    copies = F.when(number % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    lag_ms = (number * 37 % 240 - 120) * 1000 + F.col("copy") * RESENT_MS
    sent = pings(spark, sf_dir).select("*", F.explode(copies).alias("copy"))
    return sent.select(
        "event_id", "driver_id", "lat", "lon", "event_time",
        F.timestamp_millis(F.unix_millis("event_time") + lag_ms).alias("ingested_at"),
        F.concat_ws("-", "event_id", "copy").alias("row_id"),
    )


def in_batches(rows: DataFrame, parts: int, most_late: timedelta, by: str = "event_id") -> DataFrame:
    """Rows as a stream of ``parts`` micro-batches. A row may come after rows up to ``most_late`` later than it,
    by a hash of ``by``, and batches overlap in time that far, so rows arrive late and out of order."""
    spark, base = rows.sparkSession, work_dir(rows.sparkSession, "batches")
    at = F.unix_millis("event_time")
    low, high = rows.agg(F.min(at), F.max(at)).first()
    spread = F.pmod(F.xxhash64(by), F.lit(millis(most_late)))
    step = max((high - low) // parts + 1, 1) if low is not None else 1
    part = F.least(F.lit(parts - 1), F.floor((at + spread - F.lit(low or 0)) / step))
    # One part after the other: a file source takes the oldest file first.
    for i in range(parts):
        rows.where(part == i).coalesce(1).write.parquet(f"{base}/part{i:03d}")
    return read_files(spark, f"{base}/part*", rows.schema, streaming=True, files_per_batch=1)


def stream_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_requests(table_stream(spark, sf_dir, "events", EVENTS))


def _rating(number: Column) -> Column:
    return ((number % 401 + 100) / F.lit(100.0)).cast("decimal(3,2)")


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even driver numbers only, so that odd ones are missing from the join."""
    return table(spark, sf_dir, "customer").select(
        driver_id(F.col("c_custkey") * 2).alias("driver_id"),
        F.col("c_name").alias("name"),
        _mapped(F.col("c_mktsegment"), TIER_OF_SEGMENT).alias("vehicle_type"),
        _rating(F.col("c_custkey")).alias("rating"),
        (F.col("c_acctbal") > 0).alias("active"),
    )


def _driver_changes(orders: DataFrame) -> DataFrame:
    return orders.select(
        driver_id(F.col("o_custkey")).alias("driver_id"),
        F.col("o_orderpriority").alias("name"),
        _rating(F.col("o_orderkey")).alias("rating"),
        (F.col("o_totalprice") > 200000).alias("active"),
        _mapped(F.col("o_orderstatus"), OP_OF_STATUS).alias("op"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"),
        F.col("o_orderkey").alias("seq"),
    )


def driver_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _driver_changes(table(spark, sf_dir, "orders"))


def stream_driver_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _driver_changes(table_stream(spark, sf_dir, "orders", ORDERS))


def stream_shuffled_driver_changes(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    return _driver_changes(_stream_shuffled_orders(spark, sf_dir, parts))


def _stream_shuffled_orders(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    """The changes as a stream of ``parts`` micro-batches that are not in the order of time: every file holds changes
    of the whole span, and a driver's changes lie in several of them. A micro-batch has as many files as tasks can
    read at once, however large the table is."""
    path = work_dir(spark, "shuffled-orders")
    orders = table(spark, sf_dir, "orders")
    files = spark.sparkContext.defaultParallelism
    orders.repartition(parts * files, "o_orderkey").write.parquet(path)
    return read_files(spark, path, ORDERS, streaming=True, files_per_batch=files)


def ride_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as changes of the ride numbered by their order; returns count as deletes."""
    op = F.when(F.col("l_returnflag") == "R", "d").otherwise("u")
    return table(spark, sf_dir, "lineitem").select(
        _numbered("ride-", 4, F.col("l_orderkey")).alias("ride_id"),
        rider_id(F.col("l_suppkey")).alias("rider_id"),
        driver_id(F.col("l_partkey")).alias("driver_id"),
        F.when(F.col("l_linestatus") == "O", "matched").otherwise("completed").alias("state"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("fare"),
        op.alias("op"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ts_ms"),
        (F.col("l_linenumber") * F.lit(100_000_000).cast("bigint") + F.col("l_partkey")).alias(
            "seq"
        ),
    )


LOG_PARTITIONS = 4
DAY_MS = 86_400_000
DRIVER_TOPIC, RIDE_TOPIC = "cdc.drivers", "cdc.rides"
DRIVER_ROW = "driver_id string, name string, rating decimal(3,2), active boolean"
RIDE_ROW = "ride_id string, rider_id string, driver_id string, state string, fare decimal(10,2)"


def _as_topic(changes: DataFrame, key: str, value: Column) -> DataFrame:
    """Changes as rows of a capture topic in several partitions; a tombstone follows each delete."""
    number = F.regexp_extract(key, r"(\d+)$", 1).cast("bigint")
    log = changes.withColumns({"key": F.col(key), "value": value, "partition": (number % LOG_PARTITIONS).cast("int")})
    held = F.struct(F.col("value"), (F.col("seq") * 2).alias("offset"))
    tombstone = F.struct(F.lit(None).cast("string").alias("value"), (F.col("seq") * 2 + 1).alias("offset"))
    rows = F.when(F.col("op") == "d", F.array(held, tombstone)).otherwise(F.array(held))
    log = log.select("key", "partition", F.inline(rows))
    return log.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "partition", "offset"
    )


def _captured(changes: DataFrame, names: list[str], **given: Column) -> Column:
    """The flattened JSON row of a change; ``given`` replaces some of its fields."""
    marks = {
        "__op": F.col("op"), "__ts_ms": F.col("ts_ms"),
        "__deleted": F.when(F.col("op") == "d", "true").otherwise("false"),
    }
    fields = {**{name: F.col(name) for name in names}, **marks, **given}
    return F.to_json(F.struct(*(value.alias(name) for name, value in fields.items())))


def _driver_topic(orders: DataFrame) -> DataFrame:
    """Driver changes as their topic holds them; by its number some value can't be read."""
    changes = _driver_changes(orders).withColumn("rating", F.col("rating").cast("string"))
    fault = F.col("seq") % 23
    value = _captured(
        changes, ["driver_id", "name", "rating", "active"],
        driver_id=F.when(fault != 4, F.col("driver_id")),
        active=F.when(fault == 2, "maybe").otherwise(F.col("active").cast("string")),
        __op=F.when(fault == 3, "x").when(fault != 1, F.col("op")),
    )
    # Booleans are JSON booleans, apart from the faulty one.
    value = F.regexp_replace(value, '"active":"(true|false)"', '"active":$1')
    value = F.when(fault == 0, F.substring(value, 1, 20)).otherwise(value)
    return _as_topic(changes, "driver_id", value)


def driver_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _driver_topic(table(spark, sf_dir, "orders"))


def stream_shuffled_driver_topic(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    return _driver_topic(_stream_shuffled_orders(spark, sf_dir, parts))


def ride_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Offsets follow the ship date, then the order within it.
    offset = F.floor(F.col("ts_ms") / DAY_MS) * F.lit(10_000_000_000) + F.col("seq")
    changes = ride_changes(spark, sf_dir).withColumns({"fare": F.col("fare").cast("string"), "seq": offset})
    return _as_topic(changes, "ride_id", _captured(changes, [c.split()[0] for c in RIDE_ROW.split(", ")]))


FRAME_ID = 258


def ping_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings as framed values of a topic; the last digit of k picks a fault for some of them."""
    fault = F.col("fault")
    body = F.to_json(F.struct("event_id", "driver_id")).cast("binary")
    good = framed(body, FRAME_ID)
    value = (
        F.when(fault == 0, body)
        .when(fault == 1, F.substring(good, 1, 4))
        .when(fault == 2, framed(body, FRAME_ID + 1))
        .when(fault == 3, F.substring(good, 1, 12))
        .when(fault != 4, good)
    )
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), driver_id(F.col("user_id")).alias("driver_id"),
        (_k() % 10).alias("fault"),
    )
    return events.select(F.col("driver_id").cast("binary").alias("key"), value.alias("value"))


def raw_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_pings(table(spark, sf_dir, "events"))


def stream_raw_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_pings(table_stream(spark, sf_dir, "events", EVENTS))


def _raw_pings(events: DataFrame) -> DataFrame:
    """Pings as submitted JSON; the last digit of k picks a fault for some of them."""
    fault = F.col("fault")
    body = F.struct(
        F.when(fault == 5, "").otherwise(driver_id(F.col("user_id"))).alias("driver_id"),
        F.when(fault == 4, 91.5).when(fault != 3, _lat()).alias("lat"),
        F.when(fault == 6, -180.0).when(fault == 7, 180.5).otherwise(_lon()).alias("lon"),
        F.when(fault == 8, "").otherwise(_cell()).alias("h3_cell"),
        F.when(fault == 9, 0)
        .otherwise(F.unix_millis(F.col("ts").cast("timestamp")))
        .alias("occurred_at_ms"),
    )
    return events.withColumn("fault", _k() % 10).select(
        F.col("event_id").cast("string").alias("key"), F.to_json(body).alias("value")
    )


def mistyped_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings as submitted JSON that a lenient reader would take: by the last digit of k another type in a
    field, or text after the object."""
    good = F.col("good")
    value = (
        F.when(F.col("fault") == 0, F.regexp_replace(good, '"driver_id":"[^"]*"', '"driver_id":5'))
        .when(F.col("fault") == 1, F.regexp_replace(good, '"driver_id":"[^"]*"', '"driver_id":{"x":1}'))
        .when(F.col("fault") == 2, F.regexp_replace(good, '"h3_cell":"[^"]*"', '"h3_cell":7'))
        .when(F.col("fault") == 3, F.concat(good, F.lit(" trailing")))
        .when(F.col("fault") == 4, F.concat(good, F.lit(","), good))
        .when(F.col("fault") == 5, F.concat(good, F.lit("] [")))
        .when(F.col("fault") == 6, F.regexp_replace(good, '"lat":', '"speed_mps":"12.5","lat":'))
        .when(F.col("fault") == 7, F.regexp_replace(good, '"lat":', '"speed_mps":true,"lat":'))
        .otherwise(good)
    )
    body = F.struct(
        driver_id(F.col("user_id")).alias("driver_id"), _lat().alias("lat"), _lon().alias("lon"),
        _cell().alias("h3_cell"),
    )
    events = table(spark, sf_dir, "events")
    events = events.withColumns({"fault": _k() % 10, "good": F.to_json(body)})
    return events.select(F.col("event_id").cast("string").alias("key"), value.alias("value"))


def mistyped_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`mistyped_pings`, for ride requests."""
    good = F.col("good")
    value = (
        F.when(F.col("fault") == 0, F.regexp_replace(good, '"ride_id":"[^"]*"', '"ride_id":5'))
        .when(F.col("fault") == 1, F.regexp_replace(good, '"rider_id":"[^"]*"', '"rider_id":[1]'))
        .when(F.col("fault") == 2, F.regexp_replace(good, '"h3_cell":"[^"]*"', '"h3_cell":7'))
        .when(F.col("fault") == 3, F.concat(good, F.lit("} {")))
        .when(F.col("fault") == 4, F.regexp_replace(good, '"pickup":', '"product_tier":null,"pickup":'))
        .when(F.col("fault") == 5, F.regexp_replace(good, '"pickup":', '"product_tier":2,"pickup":'))
        .otherwise(good)
    )
    point = F.struct(_lat().alias("lat"), _lon().alias("lon"), _cell().alias("h3_cell"))
    body = F.struct(
        F.col("event_id").cast("string").alias("ride_id"), rider_id(F.col("user_id")).alias("rider_id"),
        point.alias("pickup"), point.alias("dropoff"),
    )
    events = table(spark, sf_dir, "events")
    events = events.withColumns({"fault": _k() % 10, "good": F.to_json(body)})
    return events.select(F.col("event_id").cast("string").alias("key"), value.alias("value"))


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_requests(table(spark, sf_dir, "events"))


def stream_raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_requests(table_stream(spark, sf_dir, "events", EVENTS))


def _raw_requests(events: DataFrame) -> DataFrame:
    """Ride requests as submitted JSON; the last digit of k picks a fault for some of them."""
    fault = F.col("fault")
    point = F.struct("lat", "lon", "h3_cell")
    away = F.struct(F.lit(-90.0).alias("lat"), F.lit(180.0).alias("lon"), "h3_cell")
    off = F.struct(F.lit(-90.5).alias("lat"), "lon", "h3_cell")
    tier = F.when(fault == 1, "luxury").when(fault == 2, "premium")
    body = F.struct(
        F.when(fault == 3, "").otherwise(F.col("event_id").cast("string")).alias("ride_id"),
        F.when(fault != 4, rider_id(F.col("user_id"))).alias("rider_id"),
        F.when(fault == 5, off).when(fault == 6, away).otherwise(point).alias("pickup"),
        F.when(fault != 7, point).alias("dropoff"),
        tier.alias("product_tier"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("occurred_at_ms"),
    )
    # The number is read from its text once, and not for each use.
    events = events.withColumn("k", _k()).withColumns({
        "fault": F.col("k") % 10, "lat": _lat(), "lon": _lon(), "h3_cell": _cell_of(F.col("k")),
    })
    text = F.when(fault == 8, "{not json").otherwise(F.to_json(body))
    return events.select(F.col("event_id").cast("string").alias("key"), text.alias("value"))
