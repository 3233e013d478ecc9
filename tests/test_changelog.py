import json

import pytest

from fleetlens.operators.changelog import check_changes, current_state, log_state, moved_keys, split_changes, topic_changes

COLUMNS = "driver_id string, name string, op string, ts_ms bigint, seq bigint, __deleted string"


def state(spark, changes):
    df = current_state(spark.createDataFrame(changes, COLUMNS), ["driver_id"])
    assert df.columns == ["driver_id", "name", "ts_ms", "seq"]
    return {r.driver_id: r.name for r in df.collect()}


def test_delete_then_reinsert(spark):
    changes = [("a", "one", "c", 1, 1, "false"), ("a", "one", "d", 2, 2, "true"),
               ("a", "two", "c", 3, 4, "false"), ("b", "x", "c", 1, 5, None),
               ("b", "x", "d", 2, 6, None)]
    assert state(spark, changes) == {"a": "two"}


def test_rewritten_delete_and_tombstone(spark):
    changes = [("a", "one", "c", 1, 1, "false"), ("a", "one", "u", 2, 2, "true"),
               ("a", None, None, None, 3, None), ("b", None, None, None, 4, None)]
    assert state(spark, changes) == {}


def test_log_offset_breaks_ties(spark):
    changes = [("a", "old", "u", 5, 1, None), ("a", "new", "u", 5, 2, None)]
    assert state(spark, changes) == {"a": "new"}


def topic(spark, *values):
    rows = [(b"k", None if v is None else json.dumps(v).encode(), i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key binary, value binary, offset bigint")


def test_changes_as_the_topic_holds_them(spark):
    def row(who, rating, op, ts, deleted="false"):
        at = "2024-01-01T00:00:00Z"
        return {"driver_id": who, "rating": rating, "updated_at": at, "__op": op, "__ts_ms": ts, "__deleted": deleted}

    rows = topic(
        spark, row("a", "4.50", "c", 9), row("b", "3.25", "c", 5), row("a", "4.75", "u", 1),
        row("b", "3.25", "d", 6, "true"), None, row("c", "1.00", "c", 7), row("c", "1.00", "d", 7, "true"),
        None, row("c", "2.00", "c", 7),
    )
    changes = topic_changes(rows, "driver_id string, rating decimal(3,2), updated_at timestamp")
    got = {r.driver_id: (str(r.rating), r.updated_at is not None) for r in current_state(changes, ["driver_id"], ["seq"]).collect()}
    assert got == {"a": ("4.75", True), "c": ("2.00", True)}


def test_values_without_marks_stop_the_job(spark):
    changes = topic_changes(topic(spark, {"driver_id": "a"}), "driver_id string")
    with pytest.raises(Exception, match="no change marks at offset 0"):
        changes.collect()


LOG = "key binary, value binary, partition int, offset bigint"
MARKS = '"__op":"u","__ts_ms":1,"__deleted":"false"'


def split(spark, *values, partitions=None):
    rows = [(b"k", None if v is None else v.encode(), (partitions or [0] * len(values))[i], i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, LOG)
    return split_changes(df, "driver_id string, rating decimal(3,2)", ["driver_id"], topic="t")


def test_unreadable_changes_go_to_the_letters(spark):
    good, bad = split(
        spark, '{"driver_id":"a","rating":"4.50",%s}' % MARKS, '{"driver_id":', '[1]', "", None, '{"driver_id":"a"}',
        '{"rating":"1.00",%s}' % MARKS, '{"driver_id":"a","rating":"much",%s}' % MARKS,
        '{"driver_id":"a","__op":"t","__ts_ms":1}', '{"driver_id":"a",%s} more' % MARKS,
    )
    assert [(r.driver_id, str(r.rating), r.op, r.log_partition, r.seq) for r in good.collect()] == [("a", "4.50", "u", 0, 0)]
    letters = [(bytes(r.original_value_bytes).decode(), r.failure_reason) for r in bad.collect()]
    assert letters == [
        ('{"driver_id":', "value: not a JSON object"), ("[1]", "value: not a JSON object"),
        ("", "value: not a JSON object"), ('{"driver_id":"a"}', "__op: missing"),
        ('{"rating":"1.00",%s}' % MARKS, "driver_id: missing"),
        ('{"driver_id":"a","rating":"much",%s}' % MARKS, "value: a field of another type"),
        ('{"driver_id":"a","__op":"t","__ts_ms":1}', "__op: unknown"),
        ('{"driver_id":"a",%s} more' % MARKS, "value: not a JSON object"),
    ]
    assert {(r.failure_stage, r.original_topic, bytes(r.original_key_bytes)) for r in bad.collect()} == {("deserialize", "t", b"k")}


def test_a_key_in_two_partitions_is_found(spark):
    values = ['{"driver_id":"%s",%s}' % (who, MARKS) for who in "aabb"]
    good, _ = split(spark, *values, partitions=[0, 0, 1, 2])
    assert [tuple(r) for r in moved_keys(good, ["driver_id"]).collect()] == [("b", 1, 2)]
    stays = log_state(good.where("driver_id = 'a'"), ["driver_id"])
    assert [(r.driver_id, r.seq) for r in stays.collect()] == [("a", 1)]
    with pytest.raises(Exception, match="several log partitions"):
        log_state(good, ["driver_id"]).collect()


def test_state_of_no_changes(spark):
    good, bad = split_changes(
        spark.createDataFrame([], LOG), "driver_id string", ["driver_id"], topic="t")
    assert log_state(good, ["driver_id"]).count() == bad.count() == moved_keys(good, ["driver_id"]).count() == 0


def test_values_that_only_lenient_readers_take(spark):
    good = '{"k":"a","__op":"u"}'
    values = {
        good: None, f" {good}\n": None, good + "x": "not a JSON object", good + "}": "not a JSON object",
        good + "]": "not a JSON object", good + "," + good: "not a JSON object", good + ',"x":1': "not a JSON object",
        good + "} {": "not a JSON object", f"[{good}]": "not a JSON object", "null": "not a JSON object",
        "": "not a JSON object", good.replace('"u"', '"u","k":"b"'): "not a JSON object",
        good.replace('"u"', '"u","n":"x"'): "a field of another type", good.replace("'", '"'): None,
        good.replace('"', "'"): "not a JSON object", good.replace('"u"', '"u","y":NaN'): "not a JSON object",
    }
    given = [(b"k", value.encode(), 0, i) for i, value in enumerate(values)]
    rows = spark.createDataFrame(given, "key binary, value binary, partition int, offset bigint")
    got = check_changes(rows, "k string, n int", ["k"]).select("value", "failure_reason").collect()
    found = {bytes(r.value).decode(): r.failure_reason for r in got}
    assert found == {value: reason and f"value: {reason}" for value, reason in values.items()}
