"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # Event times are UTC; zone-less Parquet timestamps are read as such.
    "spark.sql.session.timeZone": "UTC",
    # AQE picks broadcast joins from measured sizes and splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows dealt by block are joined and reduced where they lie (operators.joins).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Keyed state lives on disk, and only its changes are uploaded per micro-batch.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Pre-merge sessions on the map side so a busy driver shuffles sessions, not pings.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to a running session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "fleetlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder, or, where none is set,
    below the warehouse, which executors share as well."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return f"{root.rstrip('/')}/fleetlens/{name}-{uuid4().hex}"
