import time
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql.types import StructType
from pyspark.sql import functions as F

from fleetlens.schemas import VIEW_TTL
from fleetlens.session import work_dir
from fleetlens.sources.views import (
    batch_writer,
    bucket_writer,
    drop_expired,
    drop_folded,
    alive,
    fold_view,
    read_buckets,
    read_keyed_view,
    read_timed,
    read_view,
    retain,
    timed_writer,
    upsert_writer,
)

COLUMNS = "k string, v int, at bigint"


@pytest.fixture
def path(spark):
    return work_dir(spark, "views")


def keyed(spark, path):
    return {r.k: r.v for r in read_keyed_view(spark, path, ["k"]).collect()}


def test_replayed_batch_changes_nothing(spark, path):
    write = batch_writer(path)
    write(spark.createDataFrame([("a", 1, 1)], COLUMNS), 0)
    write(spark.createDataFrame([("b", 2, 1)], COLUMNS), 1)
    write(spark.createDataFrame([("b", 2, 1)], COLUMNS), 1)
    assert sorted((r.k, r.v) for r in read_view(spark, path).collect()) == [("a", 1), ("b", 2)]


def test_empty_view_is_reported(spark, path):
    with pytest.raises(ValueError, match="no finished batch"):
        read_view(spark, path)
    assert read_view(spark, path, StructType.fromDDL(COLUMNS)).count() == 0


def test_later_batch_replaces_earlier(spark, path):
    upsert = upsert_writer(path, ["k"], ["at"])
    upsert(spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("b", 3, 1)], COLUMNS), 0)
    assert keyed(spark, path) == {"a": 2, "b": 3}
    upsert(spark.createDataFrame([("a", 7, 3)], COLUMNS), 1)
    assert keyed(spark, path) == {"a": 7, "b": 3}


def test_folding_keeps_the_view(spark, path):
    upsert = upsert_writer(path, ["k"], ["at"], fold_every=2)
    for batch in range(5):
        rows = [("a", batch, 1), (f"k{batch}", batch, 1)]
        upsert(spark.createDataFrame(rows, COLUMNS), batch)
    want = {"a": 4, "k0": 0, "k1": 1, "k2": 2, "k3": 3, "k4": 4}
    assert keyed(spark, path) == want
    fold_view(spark, path, ["k"])
    fold_view(spark, path, ["k"])
    assert keyed(spark, path) == want
    drop_folded(spark, path)
    assert keyed(spark, path) == want
    assert read_view(spark, path).count() == 2


def test_rows_expire_one_by_one(spark, path):
    write = batch_writer(path, F.col("at"))
    write(spark.createDataFrame([("a", 1, 0), ("b", 2, 1), ("c", 3, 300_000)], COLUMNS), 0)
    alive = retain(read_view(spark, path), 300_000, VIEW_TTL["hot_zones"])
    assert sorted(r.k for r in alive.collect()) == ["b", "c"]


def test_old_batches_can_be_deleted(spark, path):
    write = batch_writer(path)
    for batch in range(2):
        write(spark.createDataFrame([("a", batch, 0)], COLUMNS), batch)
        time.sleep(0.5)
    now = int(time.time() * 1000)
    drop_expired(spark, path, now, timedelta(hours=1))
    assert read_view(spark, path).count() == 2
    drop_expired(spark, path, now, timedelta(seconds=0.75))
    assert [r.v for r in read_view(spark, path).collect()] == [1]


def test_folding_keeps_the_declared_order(spark, path):
    """Changes that arrive out of order: the fold must not let a later batch win."""
    upsert = upsert_writer(path, ["k"], ["at"], between=["at"], fold_every=2)
    arrivals = [("new", 10), ("old", 1), ("older", 0), ("newest", 12), ("late", 11)]
    for batch, (value, at) in enumerate(arrivals):
        upsert(spark.createDataFrame([("a", value, at)], "k string, v string, at long"), batch)
        got = read_keyed_view(spark, path, ["k"], ["at"]).first()
        assert got.v == max(arrivals[: batch + 1], key=lambda x: x[1])[0]


def test_timed_views_read_and_keep_living_partitions_only(spark, path):
    width, ttl = timedelta(milliseconds=10), timedelta(milliseconds=25)
    write = timed_writer(path, "at", width=width, ttl=ttl)
    for batch, times in enumerate(([0, 9, 12], [11, 31], [31, 55, 56])):
        for _ in range(2):  # Run again, a batch changes nothing.
            write(spark.createDataFrame([("k", 1, at) for at in times], COLUMNS), batch)
    got = read_timed(spark, path, "at", width=width, ttl=ttl)
    assert sorted((r.at, r.batch_id) for r in got.collect()) == [(55, 2), (56, 2)]
    plan = got._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(part_ms" in plan
    write(spark.createDataFrame([("k", 1, 54)], COLUMNS), 3)
    write(spark.createDataFrame([], COLUMNS), 4)
    assert sorted(r.at for r in read_timed(spark, path, "at", width=width, ttl=ttl).collect()) == [54, 55, 56]
    assert {r.part_ms for r in spark.read.parquet(path).select("part_ms").collect()} == {30, 50}


def test_a_timed_view_without_rows(spark, path):
    span = timedelta(seconds=1)
    with pytest.raises(ValueError, match="no finished batch"):
        read_timed(spark, path, "at", width=span, ttl=span)
    assert read_timed(spark, path, "at", width=span, ttl=span, schema=StructType.fromDDL(COLUMNS)).count() == 0


def test_folds_leave_out_expired_keys(spark, path):
    expire = ("at", timedelta(milliseconds=10))
    upsert = upsert_writer(path, ["k"], ["at"], between=["at"], fold_every=2, expire=expire)
    upsert(spark.createDataFrame([("a", 1, 1), ("b", 1, 8)], COLUMNS), 0)
    upsert(spark.createDataFrame([("c", 1, 15)], COLUMNS), 1)
    assert {r.k for r in spark.read.parquet(f"{path}/snapshots/upto=1").collect()} == {"b", "c"}
    upsert(spark.createDataFrame([("c", 2, 19), ("a", 2, 16)], COLUMNS), 2)
    left = alive(read_keyed_view(spark, path, ["k"], ["at"]), *expire)
    assert {(r.k, r.v) for r in left.collect()} == {("a", 2), ("c", 2)}


def test_a_batch_rewrites_the_buckets_of_its_keys(spark, path):
    write = bucket_writer(path, ["k"], ["at"], buckets=4)

    def folders():
        return {(p.parent.name, p.name) for p in Path(path).glob("bucket=*/version=*")}

    write(spark.createDataFrame([(f"k{i}", i, 5) for i in range(40)], COLUMNS), 0)
    assert len(folders()) == 4
    for _ in range(2):  # Run again, a batch changes nothing.
        write(spark.createDataFrame([("k1", 100, 6), ("k1", 99, 4)], COLUMNS), 1)
        assert len(folders()) == 5
        assert {r.k: r.v for r in read_buckets(spark, path).collect()} == {f"k{i}": i for i in range(40)} | {"k1": 100}
    write(spark.createDataFrame([("k1", 7, 5), (None, 3, 1)], COLUMNS), 2)
    write(spark.createDataFrame([], COLUMNS), 3)
    want = {f"k{i}": i for i in range(40)} | {"k1": 100, None: 3}
    assert {r.k: r.v for r in read_buckets(spark, path).collect()} == want
    assert max(len(list(b.glob("version=*"))) for b in Path(path).glob("bucket=*")) == 2


def test_a_bucketed_view_without_rows(spark, path):
    with pytest.raises(ValueError, match="no finished batch"):
        read_buckets(spark, path)
    assert read_buckets(spark, path, StructType.fromDDL(COLUMNS)).count() == 0
    with pytest.raises(ValueError, match="keep"):
        bucket_writer(path, ["k"], ["at"], keep=1)
