"""Connected components by alternating large-star and small-star steps, all in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import stored

MOST_STEPS = 60


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Rows (id, component): the least id reachable from each linked id.

    ``links`` has the columns a and b in any order; loops and repeats do no harm. Ids without a link
    to another are not returned. Every step is a hash aggregation and a join by node, and its edges go
    to the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.where("a != b").distinct(), "edges")
    state = _state(edges)
    for _ in range(MOST_STEPS if state[0] else 0):
        # Large star: every greater neighbour of a node meets the least of its neighbourhood.
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select("v", "m").distinct().toDF("u", "v")
        # Small star: a node and its lesser neighbours meet the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select("v", "m").union(least)
        edges = stored(small.distinct().toDF("a", "b"), "edges")
        state, before = _state(edges), state
        if state == before:
            break
    else:
        if state[0]:
            raise RuntimeError(f"components did not settle in {MOST_STEPS} steps")
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
