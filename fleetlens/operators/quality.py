"""Checks on submitted JSON, dead letters for what fails, event envelopes for the rest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.geo import GRID_DEGREES, cell_or_grid
from fleetlens.schemas import (
    FAILURE_STAGES,
    LOCATION_TOPIC,
    PING_INPUT,
    PRODUCT_TIERS,
    REQUEST_INPUT,
    REQUEST_TOPIC,
)

# Raw rows: value holds the submitted JSON; key, topic, headers and trace_id are optional.
_CORRUPT = "_corrupt"


# How a number is written, without a type suffix; and the instants of the years 1 to 9999.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INSTANTS = (-62_135_596_800_000, 253_402_300_799_999)


def _computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns behind a generator, which keeps the optimizer from copying their
    expressions into every later filter and field access."""
    row = F.struct(*(value.alias(name) for name, value in columns.items()))
    return df.select("*", F.inline(F.array(row)))


def _parsed(raw: DataFrame, schema: str) -> DataFrame:
    """``body``: the submitted object with its fields as variants; null unless the value is one object.

    A parser stops at the end of a value, so what follows goes unseen. In an array, text after
    the value is an error unless it begins with "]"; in an object, unless it begins with "}": together
    they leave only a value that ends where the text ends.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    text = F.col("value").cast("string")
    inner = F.concat(F.lit('{"body":'), text, F.lit("}"))
    read = F.from_json(inner, f"body struct<{schema}>, {_CORRUPT} string", options)
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    parsed = _computed_once(raw, _read=read, _alone=alone)
    whole = F.col("_alone") & F.col(f"_read.{_CORRUPT}").isNull()
    return _computed_once(parsed, body=F.when(whole, F.col("_read.body"))).drop("_read", "_alone")


def _kind(field: str) -> Column:
    """The JSON type of a field: STRING, a number's, BOOLEAN, VOID for null, and so on; null if missing."""
    return F.col(f"kinds.{field}")


def _as(field: str, kind: str) -> Column:
    return F.try_variant_get(F.col(f"body.{field}"), "$", kind)


def _is_number(field: str) -> Column:
    kind = _kind(field)
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _string(field: str) -> Column:
    return F.when(_kind(field) == "STRING", _as(field, "string"))


def _text(field: str) -> Column:
    return F.col(f"texts.{field}")


def _double(field: str) -> Column:
    """A JSON number, or text that is written like one."""
    text = _text(field)
    return F.when(_is_number(field), _as(field, "double")).when(
        text.rlike(_NUMBER), text.try_cast("double")
    )


def _decimal(field: str) -> Column:
    """Of a whole number that isn't written as one."""
    return F.when(_is_number(field) & (_kind(field) != "BIGINT"), _as(field, "decimal(38,6)")).when(
        _text(field).rlike(_NUMBER), _text(field).try_cast("decimal(38,6)")
    )


def _whole(field: str) -> Column:
    """A whole number, also one written as 12.0 or as text."""
    decimal = F.col(f"decimals.{field}")
    other = F.when(decimal == F.floor(decimal), decimal.try_cast("bigint"))
    return F.when(_kind(field) == "BIGINT", _as(field, "bigint")).otherwise(other)


def _is_given(field: str) -> Column:
    return _kind(field).isNotNull() & (_kind(field) != "VOID")


def _non_empty(field: str) -> Column:
    return (
        F.when(~_is_given(field), f"{field}: missing")
        .when(_kind(field) != "STRING", f"{field}: not text")
        .when(F.length(F.col(f"typed.{field}")) < 1, f"{field}: empty")
    )


def _text_or_none(field: str) -> Column:
    return F.when(_is_given(field) & (_kind(field) != "STRING"), f"{field}: not text")


def _in_range(field: str, bound: float) -> Column:
    number = F.col(f"typed.{field}")
    return (
        F.when(~_is_given(field), f"{field}: missing")
        .when(number.isNull(), f"{field}: not a number")
        .when(~number.between(-bound, bound), f"{field}: out of range")
    )


def _optional(field: str, kind: str) -> Column:
    value = F.col(f"typed.{field}")
    if kind == "double":
        return F.when(_is_given(field) & value.isNull(), f"{field}: not a number")
    return F.when(_is_given(field) & value.isNull(), f"{field}: not an integer").when(
        ~value.between(*_INSTANTS), f"{field}: out of range"
    )


def _values(fields: dict, read: Callable[[str], Column] | None = None, prefix: str = "") -> Column:
    """A struct of the fields, nested ones too, each by ``read`` or by its own function."""
    return F.struct(*(
        (
            _values(own, read, f"{prefix}{name}.")
            if isinstance(own, dict)
            else (read or own)(prefix + name)
        ).alias(name)
        for name, own in fields.items()
    ))


def _checked(raw: DataFrame, schema: str, fields: dict, checks: list[Column]) -> DataFrame:
    """``body`` with typed fields, and what is wrong with the value.

    In steps, each of which becomes a method of its own that is small enough to be compiled.
    """
    kinds = _values(fields, lambda field: F.schema_of_variant(F.col(f"body.{field}")))
    parsed = _computed_once(_parsed(raw, schema), kinds=kinds)
    parsed = _computed_once(parsed, texts=_values(fields, _string))
    whole = {name: _decimal for name, own in fields.items() if own is _whole}
    parsed = _computed_once(parsed, decimals=_values(whole))
    parsed = _computed_once(parsed, typed=_values(fields))
    half = len(checks) // 2
    parsed = _computed_once(parsed, _first=F.array(*checks[:half]))
    parsed = _computed_once(parsed, _last=F.array(*checks[half:]))
    unreadable = F.col("body").isNull()
    reason = F.when(unreadable, "value: not a JSON object").otherwise(
        F.concat_ws("; ", "_first", "_last")
    )
    stage = F.when(unreadable, "deserialize").otherwise("validate")
    found = _computed_once(parsed, failure_reason=reason, failure_stage=stage)
    steps = ("body", "kinds", "texts", "decimals", "_first", "_last")
    return found.drop(*steps).withColumnRenamed("typed", "body")


_POINT = {"lat": _double, "lon": _double, "h3_cell": _text}
_PING = {
    "driver_id": _text, **_POINT, "heading_degrees": _double, "speed_mps": _double,
    "accuracy_meters": _double, "occurred_at_ms": _whole,
}
_REQUEST = {
    "ride_id": _text, "rider_id": _text, "pickup": _POINT, "dropoff": _POINT, "product_tier": _text,
    "requested_at_ms": _whole, "occurred_at_ms": _whole,
}


def check_pings(raw: DataFrame) -> DataFrame:
    """Pings with typed fields and all their failures as text; an empty text means valid."""
    return _checked(
        raw,
        PING_INPUT,
        _PING,
        [
            _non_empty("driver_id"),
            _in_range("lat", 90.0),
            _in_range("lon", 180.0),
            _text_or_none("h3_cell"),
            _optional("heading_degrees", "double"),
            _optional("speed_mps", "double"),
            _optional("accuracy_meters", "double"),
            _optional("occurred_at_ms", "bigint"),
        ],
    )


def check_requests(raw: DataFrame) -> DataFrame:
    """Ride requests with typed fields and all their failures as text; the tier defaults to the first."""
    tier = F.col("typed.product_tier")
    given = _kind("product_tier").isNotNull()
    points = [
        check
        for point in ("pickup", "dropoff")
        for check in (
            _in_range(f"{point}.lat", 90.0),
            _in_range(f"{point}.lon", 180.0),
            _text_or_none(f"{point}.h3_cell"),
        )
    ]
    known = F.coalesce(tier.isin(*PRODUCT_TIERS), F.lit(False))
    return _checked(
        raw,
        REQUEST_INPUT,
        _REQUEST,
        [
            _non_empty("ride_id"),
            _non_empty("rider_id"),
            *points,
            F.when(given & ~known, "product_tier: unknown"),
            _optional("requested_at_ms", "bigint"),
            _optional("occurred_at_ms", "bigint"),
        ],
    )


def _split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid = F.col("failure_reason") == ""
    return checked.where(valid), checked.where(~valid)


def validate_pings(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) pings."""
    return _split(check_pings(raw))


def validate_requests(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) ride requests."""
    return _split(check_requests(raw))


def _given(df: DataFrame, name: str, default: Column) -> Column:
    return F.coalesce(F.col(name), default) if name in df.columns else default


def dead_letters(
    bad: DataFrame, topic: str, *, stage: str | None = None, failed_at: Column | None = None
) -> DataFrame:
    """Rejected rows with their original bytes and the reasons.

    ``stage`` names where rows failed if that was not in the checks above.
    """
    if stage is not None and stage not in FAILURE_STAGES:
        raise ValueError(f"stage must be one of {FAILURE_STAGES}, got {stage!r}")
    return bad.select(
        _given(bad, "topic", F.lit(topic)).alias("original_topic"),
        _given(bad, "key", F.lit("")).cast("binary").alias("original_key_bytes"),
        F.coalesce(F.col("value"), F.lit("")).cast("binary").alias("original_value_bytes"),
        "failure_reason",
        F.col("failure_stage") if stage is None else F.lit(stage).alias("failure_stage"),
        (F.current_timestamp() if failed_at is None else failed_at).alias("failed_at"),
        _given(bad, "headers", F.create_map().cast("map<string,string>")).alias(
            "original_headers"
        ),
    )


def _or_now(ms: str, now: Column) -> Column:
    """The given instant; a missing one or zero means now."""
    given = F.col(f"body.{ms}")
    return F.coalesce(F.when(given != 0, F.timestamp_millis(given)), now)


def _envelope(good: DataFrame, kind: str, producer: str, now: Column,
              event_id: Column | None) -> Column:
    trace = F.when(_given(good, "trace_id", F.lit("")) != "", _given(good, "trace_id", F.lit("")))
    return F.struct(
        (F.uuid() if event_id is None else event_id).alias("event_id"),
        F.lit(kind).alias("event_type"),
        F.lit(1).alias("event_version"),
        _or_now("occurred_at_ms", now).alias("occurred_at"),
        now.alias("ingested_at"),
        F.lit(producer).alias("producer"),
        F.coalesce(trace, F.uuid()).alias("trace_id"),
    ).alias("envelope")


def _now(now: Column | None) -> Column:
    return F.date_trunc("millisecond", F.current_timestamp()) if now is None else now


def ping_events(
    good: DataFrame,
    *,
    producer: str = "fleetlens-ingest",
    now: Column | None = None,
    event_id: Column | None = None,
    degrees: float = GRID_DEGREES,
) -> DataFrame:
    """Valid pings as events.

    Pass ``event_id`` built from a log position where rows may be written twice (a retried
    job); by default each row gets a random one.
    """
    lat, lon = F.col("body.lat"), F.col("body.lon")
    payload = F.struct(
        F.col("body.driver_id"),
        lat.alias("lat"),
        lon.alias("lon"),
        cell_or_grid(F.col("body.h3_cell"), lat, lon, degrees).alias("h3_cell"),
        *(
            F.col(f"body.{name}")
            for name in ("heading_degrees", "speed_mps", "accuracy_meters")
        ),
    ).alias("payload")
    kind = "DriverLocationPinged"
    return good.select(_envelope(good, kind, producer, _now(now), event_id), payload)


def request_events(
    good: DataFrame,
    *,
    producer: str = "fleetlens-ingest",
    now: Column | None = None,
    event_id: Column | None = None,
    degrees: float = GRID_DEGREES,
) -> DataFrame:
    """Valid ride requests as events; ``event_id`` as in :func:`ping_events`."""

    def point(name: str) -> Column:
        lat, lon = (F.col(f"body.{name}.{axis}") for axis in ("lat", "lon"))
        cell = cell_or_grid(F.col(f"body.{name}.h3_cell"), lat, lon, degrees)
        return F.struct(lat.alias("lat"), lon.alias("lon"), cell.alias("h3_cell")).alias(name)

    at = _now(now)
    payload = F.struct(
        F.col("body.ride_id"),
        F.col("body.rider_id"),
        point("pickup"),
        point("dropoff"),
        F.coalesce("body.product_tier", F.lit(PRODUCT_TIERS[0])).alias("product_tier"),
        _or_now("requested_at_ms", at).alias("requested_at"),
    ).alias("payload")
    return good.select(_envelope(good, "RideRequested", producer, at, event_id), payload)


def ping_dead_letters(raw: DataFrame, **kwargs) -> DataFrame:
    return dead_letters(validate_pings(raw)[1], LOCATION_TOPIC, **kwargs)


def request_dead_letters(raw: DataFrame, **kwargs) -> DataFrame:
    return dead_letters(validate_requests(raw)[1], REQUEST_TOPIC, **kwargs)
