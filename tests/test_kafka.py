import pytest
from pyspark.sql import functions as F

from fleetlens.sources import kafka


def test_options():
    options = kafka.kafka_options("h:1", "t", starting="earliest", rows_per_batch=5)
    assert options["subscribe"] == "t" and options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "5"
    with pytest.raises(ValueError, match="starting"):
        kafka.kafka_options("h:1", "t", starting="middle")


def test_frames(spark):
    values = [bytes([0, 0, 0, 1, 2]) + b"body", bytes([1, 0, 0, 0, 1]) + b"x", b"\0\0", b""]
    df = spark.createDataFrame([(v,) for v in values], "value binary")
    value = F.col("value")
    got = df.select(kafka.frame_schema_id(value), kafka.frame_body(value)).collect()
    assert [(r[0], r[1] and bytes(r[1])) for r in got] == [
        (258, b"body"), (None, None), (None, None), (None, None)]
    again = df.select(kafka.framed(kafka.frame_body(value), 258)).first()[0]
    assert bytes(again) == values[0]


def test_json_rows(spark):
    df = spark.createDataFrame([("k", 1)], "k string, v int")
    row = kafka.keyed_json(df, F.col("k")).first()
    assert (bytes(row.key), bytes(row.value)) == (b"k", b'{"k":"k","v":1}')


def test_a_batch_cannot_start_at_the_latest_offsets(spark):
    with pytest.raises(ValueError, match="latest"):
        kafka.read_topic(spark, "h:1", "t", streaming=False, starting="latest")


def test_frames_that_cannot_be_read_are_letters(spark):
    body, head = b'{"a":"x"}', bytes([0, 0, 0, 0, 7])
    values = [head + body, None, b"", body, head[:4], bytes([0, 0, 0, 0, 8]) + body, head + body[:4], head + b'{"b":1}', head]
    df = spark.createDataFrame([(b"k", v, {"h": "1"}) for v in values], "key binary, value binary, headers map<string,string>")
    good, bad = kafka.split_frames(
        df, lambda b: F.from_json(b.cast("string"), "a string, b int"), topic="t", schema_ids=[7], required=["a"])
    assert [tuple(r) for r in good.collect()] == [("x", None)]
    assert [r.failure_reason for r in bad.collect()] == [
        "value: missing", "value: not a frame", "value: not a frame", "value: not a frame",
        "value: unknown schema id 8", "value: not of its schema", "value: not of its schema", "value: not of its schema"]
    row = bad.where("failure_reason = 'value: unknown schema id 8'").first()
    assert (row.failure_stage, row.original_headers) == ("deserialize", {"h": "1"})
    assert bytes(row.original_value_bytes) == values[5] and bytes(row.original_key_bytes) == b"k"
