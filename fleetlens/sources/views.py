"""Result views: tables that streaming jobs write and ranked reads query.

Each micro-batch owns the folder ``batch_id=<n>`` and overwrites it, so a replayed batch
leaves the view as it was. A keyed view is merged when it is read: the row of the latest
batch wins. Folding old batches into a snapshot keeps that merge short.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlens.functions.timing import millis, pane_start
from fleetlens.operators.changelog import latest_per_key
from fleetlens.sources.kafka import keyed_json


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _finished(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers n of the sub-folders <prefix>=<n> whose write was committed."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(f"{prefix}=") and fs.exists(done):
            found.append(int(name.split("=")[1]))
    return sorted(found)


def _batches(spark: SparkSession, path: str, numbers: Sequence[int]) -> DataFrame:
    folders = [f"{path}/batch_id={n}" for n in numbers]
    rows = spark.read.option("basePath", path).parquet(*folders)
    return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def batch_writer(path: str, written_at: Column | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends each micro-batch to the view at ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        at = F.unix_millis(F.current_timestamp()) if written_at is None else written_at
        (
            batch.withColumn("written_at_ms", at)
            .write.mode("overwrite")
            .parquet(f"{path}/batch_id={batch_id}")
        )

    return write


def frame_writer(path: str, key: Column) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps events as a topic would: rows of key and JSON value, and nothing else."""

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed_json(batch, key).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def timed_writer(
    path: str, time_ms: str, *, width: timedelta, ttl: timedelta | None = None
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends each micro-batch to a view partitioned by time.

    A batch overwrites its own folder of each ``width`` of ``time_ms``, so a batch that is run again leaves the view
    as it was. With ``ttl``, partitions that hold expired rows only are deleted whole. Rows without a time are kept but
    never read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        placed = {"part_ms": pane_start(F.col(time_ms), width), "batch_id": F.lit(batch_id)}
        rows = batch.withColumns(placed).write.mode("overwrite").partitionBy(*placed)
        rows.option("partitionOverwriteMode", "dynamic").parquet(path)
        if ttl is not None:
            drop_partitions(batch.sparkSession, path, width, ttl)

    return write


def _partitions(spark: SparkSession, path: str) -> list[int]:
    """Starts of a timed view's partitions: as many as its lifetime has widths."""
    fs, folder = _folder(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    starts = [name.removeprefix("part_ms=") for name in names if name.startswith("part_ms=")]
    return sorted(int(start) for start in starts if start.lstrip("-").isdigit())


def drop_partitions(spark: SparkSession, path: str, width: timedelta, ttl: timedelta) -> None:
    """Delete the partitions of a timed view whose rows are all older than ``ttl`` before the newest row."""
    starts = _partitions(spark, path)
    old = [start for start in starts if start + millis(width) <= starts[-1] - millis(ttl)]
    _delete(spark, [f"{path}/part_ms={start}" for start in old])


def read_timed(
    spark: SparkSession, path: str, time_ms: str, *, width: timedelta, ttl: timedelta,
    schema: StructType | None = None,
) -> DataFrame:
    """Rows of a timed view less than ``ttl`` older than its newest one; only their partitions are read."""
    starts = _partitions(spark, path)
    if not starts:
        return _empty(spark, path, schema).drop("written_at_ms")
    oldest = starts[-1] - millis(ttl)
    rows = spark.read.parquet(path).where(F.col("part_ms") >= oldest - oldest % millis(width))
    newest = rows.where(F.col("part_ms") == starts[-1]).select(F.max(time_ms)).scalar()
    rows = rows.where(F.col(time_ms) > newest - millis(ttl)).drop("part_ms")
    return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def alive(rows: DataFrame, time_ms: str, ttl: timedelta) -> DataFrame:
    """Rows less than ``ttl`` older than the newest one."""
    return rows.where(F.col(time_ms) > rows.select(F.max(time_ms)).scalar() - millis(ttl))


def _empty(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    """A view without a finished batch has no rows; its columns must then be given."""
    if schema is None:
        raise ValueError(f"no finished batch in {path}, and no schema given")
    extra = StructType.fromDDL("written_at_ms bigint, batch_id bigint")
    return spark.createDataFrame([], StructType([*schema.fields, *extra.fields]))


def read_view(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Every row of an append-only view; ``schema`` has the columns of a view not yet written."""
    done = _finished(spark, path, "batch_id")
    if not done:
        return _empty(spark, path, schema)
    return _batches(spark, path, done)


def read_keyed_view(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    order: Sequence[str] = ("batch_id",),
    schema: StructType | None = None,
) -> DataFrame:
    """The latest row of each key: last snapshot plus the batches written since."""
    snapshots = _finished(spark, f"{path}/snapshots", "upto")
    upto = snapshots[-1] if snapshots else -1
    since = [n for n in _finished(spark, path, "batch_id") if n > upto]
    parts = []
    if since:
        parts.append(_batches(spark, path, since))
    if snapshots:
        parts.append(spark.read.parquet(f"{path}/snapshots/upto={upto}"))
    if not parts:
        return _empty(spark, path, schema)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return latest_per_key(rows, keys, order)


def fold_view(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = ("batch_id",),
    expire: tuple[str, timedelta] | None = None,
) -> None:
    """Write the merged view as a new snapshot; readers switch once it is complete. ``expire``, a time column in
    ms and a lifetime, leaves out keys whose row has expired; readers apply ``alive`` to the others."""
    done = _finished(spark, path, "batch_id")
    snapshots = _finished(spark, f"{path}/snapshots", "upto")
    if done and (not snapshots or done[-1] > snapshots[-1]):
        merged = read_keyed_view(spark, path, keys, order)
        if expire is not None:
            merged = alive(merged, *expire)
        merged.write.mode("overwrite").parquet(f"{path}/snapshots/upto={done[-1]}")


def upsert_writer(
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    between: Sequence[str] = ("batch_id",),
    fold_every: int = 50,
    written_at: Column | None = None,
    expire: tuple[str, timedelta] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that replaces rows by key.

    A batch is first reduced to its latest row per key by ``order``. Between batches
    ``between`` decides, by default the later batch; readers must pass the same. Every
    ``fold_every`` batches the view is folded into a snapshot in that order, without what ``expire`` says.
    """
    write = batch_writer(path, written_at)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        write(latest_per_key(batch, keys, order), batch_id)
        if fold_every and batch_id % fold_every == fold_every - 1:
            fold_view(batch.sparkSession, path, keys, between, expire)

    return upsert


def _bucket_versions(spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> dict[int, list[int]]:
    """Versions of each bucket of a bucketed view, oldest first."""
    fs, folder = _folder(spark, path)
    if buckets is None:
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        buckets = [int(name.split("=")[1]) for name in names if name.startswith("bucket=")]
    found = {}
    for bucket in buckets:
        fs, folder = _folder(spark, f"{path}/bucket={bucket}")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        found[bucket] = sorted(int(name.split("=")[1]) for name in names if name.startswith("version="))
    return found


def _read_versions(spark: SparkSession, path: str, newest: dict[int, int]) -> DataFrame:
    folders = [f"{path}/bucket={bucket}/version={version}" for bucket, version in newest.items()]
    return spark.read.option("basePath", path).parquet(*folders).drop("version")


def bucket_writer(
    path: str, keys: Sequence[str], order: Sequence[str], *, buckets: int = 64, keep: int = 2
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that replaces rows by key in a view hashed into ``buckets`` by key.

    A batch rewrites only the buckets that its keys fall into, each as a new version of that bucket: a folder that
    appears whole, by a rename, so a lost job leaves the version before it. The last row by ``order`` counts, in
    whichever batch it comes; a batch that is run again starts from the versions before its own. ``keep``
    versions of a bucket stay for readers. The number of buckets must stay the same for one view.
    """
    if keep < 2:
        raise ValueError("a batch that is run again needs the version before its own: keep at least 2")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        latest = latest_per_key(batch, keys, order).withColumn("bucket", bucket).persist()
        try:
            # As many numbers as the view has buckets.
            touched = [row.bucket for row in latest.select("bucket").distinct().collect()]
            before = {b: [n for n in all_of if n < batch_id]
                      for b, all_of in _bucket_versions(spark, path, touched).items()}
            newest = {b: versions[-1] for b, versions in before.items() if versions}
            rows = latest.unionByName(_read_versions(spark, path, newest)) if newest else latest
            merged = latest_per_key(rows, keys, order).withColumn("version", F.lit(batch_id))
            parts = merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket", "version")
            parts.option("partitionOverwriteMode", "dynamic").parquet(path)
        finally:
            latest.unpersist()
        old = [(b, n) for b, versions in before.items() for n in versions[: 1 - keep]]
        _delete(spark, [f"{path}/bucket={b}/version={n}" for b, n in old])

    return write


def read_buckets(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The row of each key of a bucketed view: the newest version of every bucket."""
    newest = {b: versions[-1] for b, versions in _bucket_versions(spark, path).items() if versions}
    if not newest:
        return _empty(spark, path, schema).drop("written_at_ms", "batch_id")
    return _read_versions(spark, path, newest).drop("bucket")


def read_version(spark: SparkSession, path: str, upto: int) -> DataFrame | None:
    """The newest version of a rewritten table that is not after ``upto``, if any."""
    done = [n for n in _finished(spark, path, "version") if n <= upto]
    return spark.read.parquet(f"{path}/version={done[-1]}") if done else None


def write_version(table: DataFrame, path: str, version: int, *, keep: int = 5) -> None:
    """Write a table's version and delete those more than ``keep`` versions older."""
    table.write.mode("overwrite").parquet(f"{path}/version={version}")
    spark = table.sparkSession
    old = [n for n in _finished(spark, path, "version") if n < version - keep]
    _delete(spark, [f"{path}/version={n}" for n in old])


def retain(view: DataFrame, as_of_ms: int | Column, ttl: timedelta) -> DataFrame:
    """Rows written less than ``ttl`` before ``as_of_ms``; each row expires on its own."""
    return view.where(F.col("written_at_ms") > as_of_ms - millis(ttl))


def _delete(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:
        fs, target = _folder(spark, folder)
        fs.delete(target, True)


def drop_expired(spark: SparkSession, path: str, as_of_ms: int, ttl: timedelta) -> None:
    """Delete the batches of an append-only view that were finished ``ttl`` ago or earlier."""
    old = []
    for n in _finished(spark, path, "batch_id"):
        fs, marker = _folder(spark, f"{path}/batch_id={n}/_SUCCESS")
        if fs.getFileStatus(marker).getModificationTime() <= as_of_ms - millis(ttl):
            old.append(f"{path}/batch_id={n}")
    _delete(spark, old)


def drop_folded(spark: SparkSession, path: str) -> None:
    """Delete batches and snapshots that the newest snapshot replaces.

    Run it when no reader still uses the snapshot before that.
    """
    snapshots = _finished(spark, f"{path}/snapshots", "upto")
    if not snapshots:
        return
    old = [f"{path}/snapshots/upto={n}" for n in snapshots[:-1]]
    old += [f"{path}/batch_id={n}" for n in _finished(spark, path, "batch_id")
            if n < snapshots[-1]]
    _delete(spark, old)
