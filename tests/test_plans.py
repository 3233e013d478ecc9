"""Physical plans: what must hold at any size."""

import contextlib
import io
import re

import pytest
from fixtures import pings, requests
from pyspark.sql import functions as F

from fleetlens.operators.changelog import check_changes
from fleetlens.operators.joins import match_rides, reduce_matches
from fleetlens.operators.quality import check_pings, check_requests
from fleetlens.operators.windows import idle_sessions
from fleetlens.plans.catalog import QUERIES
from fleetlens.session import work_dir
from fleetlens.sources.events import read_requests

SF_DIR = "/root/testdata/sf0.01"
BATCH = sorted(name for name in QUERIES if not name.endswith("_stream"))
RANKED = {"top_hot_zones", "top_surge_zones"}


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def gathered(text: str) -> list[str]:
    """What each single-partition exchange takes in."""
    lines = text.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]


@pytest.mark.parametrize("name", BATCH)
def test_batch_plans(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text
    # One task takes in only one-row partial bounds and the k rows of a ranked read.
    for child in gathered(text):
        assert re.search(r"Aggregate\(keys?=\[\], functions=\[partial_max", child)
    if name not in RANKED:
        assert "windowspecdefinition(specifiedwindowframe" not in text


def scan(text: str) -> set[str]:
    return set(re.search(r"FileScan parquet \[([^\]]*)\]", text)[1].replace("L", "").split(","))


def test_scans_read_only_what_is_used(spark):
    columns = {re.sub(r"#\d+", "", c) for c in scan(plan(QUERIES["hot_zones"](spark, SF_DIR)))}
    assert columns == {"ts", "user_id", "props"}


def test_nested_fields_are_pruned(spark):
    path = work_dir(spark, "nested")
    from fleetlens.plans import tables

    tables.request_events(tables.table(spark, SF_DIR, "events")).write.parquet(path)
    text = plan(read_requests(spark, path).select("ride_id", "h3_cell"))
    schema = re.search(r"ReadSchema: (.*)", text)[1]
    assert "ride_id" in schema and "dropoff" not in schema and "envelope" not in schema


def test_sessions_are_aggregated_before_the_shuffle(spark):
    text = plan(idle_sessions(pings(spark, [("a", 0)])))
    below = text[text.rindex("Exchange hashpartitioning"):]
    assert "partial_count(1)" in below


def test_hot_cell_is_split_at_run_time(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    many = spark.range(0, 60000, numPartitions=8)
    hot = F.col("id") % 3 == 0
    seen = many.select(
        F.concat(F.lit("d"), F.col("id") % 500).alias("driver_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 997)).alias("h3_cell"),
        F.when(hot, F.timestamp_millis(F.lit(90_000)))
        .otherwise(F.timestamp_millis(F.col("id") * 100)).alias("event_time"),
    )
    asked = requests(spark, [(f"r{i}", 0, f"c{i}") for i in range(50)]).drop("event_time")
    asked = asked.withColumn("event_time", F.timestamp_millis(F.lit(100_000))).withColumn(
        "h3_cell", F.when(F.col("ride_id") == "r7", "hot").otherwise(F.col("h3_cell")))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        matches = match_rides(asked, seen)
        found = matches.where("h3_cell = 'hot'").count()
        rows = matches.collect()
        text = plan(matches)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "skew=true" in text
    assert found == 20000 == sum(r.h3_cell == "hot" for r in rows)
    assert reduce_matches(matches).where("h3_cell = 'hot'").count() == 500


def test_matches_are_compared_by_ready_bounds(spark):
    """The join's condition compares instants and adds no interval for each pair."""
    text = plan(match_rides(requests(spark, [("r", 100, "c")]), pings(spark, [("a", 100, "c")])))
    joins = [line for line in text.splitlines() if "Join" in line]
    assert len(joins) == 1 and "first_time" in joins[0] and "INTERVAL" not in joins[0]


@pytest.mark.parametrize("check", [check_pings, check_requests])
def test_checks_are_methods_that_get_compiled(spark, check):
    """The virtual machine only interprets methods above 8000 bytes."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        check(spark.createDataFrame([("{}",)], "value string")).explain("codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_sound_changes_are_not_described(spark):
    """The schema of a value is only worked out for values that aren't sound."""
    rows = spark.createDataFrame([(b"k", b"{}", 0, 1)], "key binary, value binary, partition int, offset bigint")
    text = plan(check_changes(rows, "k string", ["k"]))
    first = re.search(r"CASE WHEN (.*?) THEN", text)[1]
    assert "parseJson" in first and "schemaOfVariant" not in first
