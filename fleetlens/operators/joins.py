"""Ride matching and ride enrichment."""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.timing import LATENESS, interval, millis, pane_start, watermarked

BEFORE = timedelta(seconds=60)
AFTER = timedelta(seconds=120)
# Time slice of a driver's track in a cell that one task sorts.
CHUNK = timedelta(hours=1)
# Buckets that one interval is cut into where matches are listed in batch.
PANES = 4
# Pairs of rides and drivers that one task reduces in memory.
BLOCK_PAIRS = 2_000_000
# Parts of the drivers for each part of the rides: requests, the smaller side, are copied that many times more often.
DRIVER_CUTS = 4


def match_rides(
    requests: DataFrame,
    pings: DataFrame,
    *,
    before: timedelta = BEFORE,
    after: timedelta = AFTER,
    lateness: timedelta = LATENESS,
    slices: int = 1,
    side: int = 1,
) -> DataFrame:
    """Pings in the pickup cell from ``before`` a request until ``after`` it, both inclusive.

    Both sides meet on the cell and a time bucket as wide as the interval: the few requests
    are copied into the two buckets their interval touches, pings are not copied. In batch,
    AQE's skew join splits a bucket that is still too large. In a stream the state is
    bounded by the interval, a row is compared with its bucket only, and ``slices`` > 1
    spreads a busy bucket's pings over that many state partitions, at the price of one
    request copy for each. In batch, ``side`` > 1 (:func:`block_side`) deals both sides by block and
    adds the column ``block``, by which :func:`reduce_matches` reduces them in place; otherwise buckets are
    ``PANES`` times narrower, so that few of the pairs that are compared lie outside the interval.
    """
    streaming = requests.isStreaming or pings.isStreaming
    panes = 1 if streaming or side > 1 else PANES
    width = max((before + after) / panes, timedelta(milliseconds=1))
    asked_ms = F.unix_millis("request_time")
    touched = F.sequence(
        pane_start(asked_ms - millis(before), width),
        pane_start(asked_ms + millis(after), width),
        F.lit(millis(width)),
    )
    asked = watermarked(requests, lateness).select(
        "ride_id", "h3_cell", F.col("event_time").alias("request_time"))
    seen = watermarked(pings, lateness).select(
        "driver_id", F.col("h3_cell").alias("ping_cell"), F.col("event_time").alias("match_time"))
    if side > 1:
        # Rows without a cell or a time match nothing and are not copied.
        seen, asked = _in_blocks(seen.dropna(subset=["ping_cell", "match_time"]),
                                 asked.dropna(subset=["h3_cell", "request_time"]), side)
    asked = asked.withColumn("bucket", F.explode(touched))
    seen = seen.withColumn("ping_bucket", pane_start(F.unix_millis("match_time"), width))
    first = F.col("request_time") - F.expr(f"INTERVAL {interval(before)}")
    last = F.col("request_time") + F.expr(f"INTERVAL {interval(after)}")
    if not streaming:
        # Once per request and not per pair; a stream needs them in the condition, to bound its state.
        asked = asked.select("*", first.alias("first_time"), last.alias("last_time")).drop("request_time")
        first, last = F.col("first_time"), F.col("last_time")
    on = (
        (F.col("h3_cell") == F.col("ping_cell"))
        & (F.col("bucket") == F.col("ping_bucket"))
        & F.col("match_time").between(first, last)
    )
    if slices > 1:
        asked = asked.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        spread = F.pmod(F.xxhash64("driver_id", "match_time"), F.lit(slices)).cast("int")
        seen = seen.withColumn("ping_slice", spread)
        on = on & (F.col("slice") == F.col("ping_slice"))
    columns = ["ride_id", "driver_id", "match_time", "h3_cell"]
    if side > 1:
        on = on & (F.col("block") == F.col("ride_block"))
        columns.append("block")
    return seen.join(asked, on).select(*columns)


def reduce_matches(matches: DataFrame) -> DataFrame:
    """Latest match per (ride, driver); combined in the join's own stage before any shuffle, and without
    one if the matches lie by block."""
    at = F.unix_millis("match_time").alias("at")
    within = [name for name in matches.columns if name == "block"]
    return _latest(matches.select("ride_id", "driver_id", "h3_cell", at, *within), *within)


def _latest(matches: DataFrame, *within: str) -> DataFrame:
    """One row per (ride, driver): the latest match, and of matches at one instant the one in
    the greatest cell. A ride requested again from another cell still is one ride.

    Rows are sorted once and ranked; a digest of the pair comes first, so that few texts are compared."""
    pair = F.xxhash64("ride_id", "driver_id")
    newest = Window.partitionBy("pair", *within, "ride_id", "driver_id").orderBy(F.desc("at"), F.desc("h3_cell"))
    ranked = matches.withColumn("pair", pair).withColumn("rank", F.row_number().over(newest))
    return ranked.where("rank = 1").select("ride_id", "driver_id", "h3_cell", F.col("at").alias("match_time_ms"))


def match_candidates(
    requests: DataFrame,
    pings: DataFrame,
    *,
    before: timedelta = BEFORE,
    after: timedelta = AFTER,
    chunk: timedelta = CHUNK,
    slices: int = 1,
) -> DataFrame:
    """Latest match per (ride, driver) without listing every match. Batch only.

    A ping is a driver's latest in its cell until that driver's next ping there, and counts
    for requests whose interval ends in that span and began no later than the ping. So the
    task is to find the spans that hold a point in time. Spans are filed under the smallest
    pane size that is not shorter (sizes grow eightfold), where a span touches at most two
    panes, and a request looks once into each size. A request then meets one span of a driver
    at most, however often the driver pings. Tracks are cut into chunks that are sorted in
    separate tasks; the ends of a driver's chunks meet in a second pass.

    So the pairs of a ride with one request are candidates as they are joined, and are not
    shuffled. Rides requested again are reduced, in blocks if there are many pairs. ``slices`` > 1 spreads a
    busy cell's spans by driver over that many join keys, with a copy of a request's looks for each.
    """
    width = millis(before + after)
    sizes = [8]
    while sizes[-1] <= width:
        sizes.append(sizes[-1] * 8)
    size = F.col("size")

    at = F.col("at")
    track = Window.partitionBy("h3_cell", "driver_id", "chunk").orderBy("at")
    # Ends of chunks share the NULL lane; of equal times the one without a next comes last.
    lane = Window.partitionBy("h3_cell", "driver_id", "lane").orderBy("at", F.col("next_at").asc_nulls_last())
    is_end = F.lag("at").over(track).isNull() | F.col("next_at").isNull()
    spans = (
        pings.where(F.col("h3_cell").isNotNull() & F.col("event_time").isNotNull())
        .select("h3_cell", "driver_id", F.unix_millis("event_time").alias("at"))
        .withColumn("chunk", pane_start(at, chunk))
        .withColumn("next_at", F.lead("at").over(track))
        .withColumn("lane", F.when(~is_end, F.col("chunk")))
        .withColumn("next_at", F.coalesce("next_at", F.lead("at").over(lane)))
        .withColumn("until", F.least(at + width, F.col("next_at") - 1))
        .where("until >= at")
    )
    length = F.col("until") - at + 1
    fitting = F.lit(sizes[-1]).cast("long")
    for shorter in reversed(sizes[:-1]):
        fitting = F.when(length <= shorter, F.lit(shorter).cast("long")).otherwise(fitting)
    first, last = (ms - F.pmod(ms, size) for ms in (at, F.col("until")))

    def filed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("size", fitting).select(
            "*", F.pmod(F.xxhash64("driver_id"), F.lit(slices)).cast("int").alias("slice"),
            F.explode(F.array_distinct(F.array(first, last))).alias("pane"))

    spans = spans.select(F.col("h3_cell").alias("cell"), "driver_id", "at", "until")
    high = F.unix_millis("event_time") + millis(after)
    again = requests.groupBy("ride_id").count().where("count > 1").select(F.col("ride_id").alias("again"))
    on = (
        (F.col("cell") == F.col("h3_cell"))
        & (size == F.col("look"))
        & (F.col("pane") == F.col("look_pane"))
        & (F.col("slice") == F.col("look_slice"))
        & F.col("high").between(at, F.col("until"))
    )

    def asked(how: str) -> DataFrame:
        rides = requests.join(again, F.col("ride_id").eqNullSafe(F.col("again")), how)
        return rides.select("ride_id", "h3_cell", high.alias("high"))

    def looks(rows: DataFrame) -> DataFrame:
        return (
            rows.withColumn("look", F.explode(F.array(*(F.lit(s).cast("long") for s in sizes))))
            .withColumn("look_pane", F.col("high") - F.pmod("high", "look"))
            .withColumn("look_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        )

    once = filed(spans).join(looks(asked("left_anti")), on).select(
        "ride_id", "driver_id", "h3_cell", F.col("at").alias("match_time_ms"))
    repeated = requests.join(again, F.col("ride_id").eqNullSafe(F.col("again")), "left_semi")
    side = block_side(repeated, pings, before=before, after=after)
    if side == 1:
        pairs = filed(spans).join(looks(asked("left_semi")), on)
        several = _latest(pairs.select("ride_id", "driver_id", "h3_cell", "at"))
    else:
        left, right = _in_blocks(spans, asked("left_semi").dropna(subset=["h3_cell", "high"]), side)
        pairs = filed(left).join(looks(right), on & (F.col("block") == F.col("ride_block")))
        several = _latest(pairs.select("ride_id", "driver_id", "h3_cell", "at", "block"), "block")
    return once.unionByName(several)


def block_side(
    requests: DataFrame, pings: DataFrame, *, before: timedelta = BEFORE, after: timedelta = AFTER
) -> int:
    """Into how many parts rides are cut, and drivers into ``DRIVER_CUTS`` times as many, so that a block of both has
    about ``BLOCK_PAIRS`` pairs.

    Pairs are counted by cell and pane, at one row per pane: a request meets at most the pings of two panes, of which
    its interval is half.
    """
    width = max(before + after, timedelta(milliseconds=1))
    at = F.unix_millis("event_time")

    def held(rows: DataFrame, ms: Column, name: str) -> DataFrame:
        placed = rows.select("h3_cell", pane_start(ms, width).alias("pane"))
        return placed.groupBy("h3_cell", "pane").agg(F.count("*").cast("double").alias(name))

    both = held(requests, at - millis(before), "asked").join(held(pings, at, "seen"), ["h3_cell", "pane"])
    pairs = both.select(F.sum(F.col("asked") * F.col("seen"))).first()[0] or 0.0
    return 1 if pairs <= BLOCK_PAIRS else max(2, math.ceil(math.sqrt(pairs / BLOCK_PAIRS / DRIVER_CUTS)))


def _in_blocks(seen: DataFrame, asked: DataFrame, side: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join dealt by (part of the rides, part of the drivers), pings copied ``side`` times and requests
    ``DRIVER_CUTS`` times as often.

    A block is one task's and has every match of its (ride, driver) pairs, so pairs are reduced where they are
    joined: copies are shuffled, and pairs, the product of both sides, are not. Blocks are dealt by number: rows dealt
    by a digest come several blocks to a task, and Spark deals them again by all keys of the join, and then
    the pairs, where they have fewer partitions than it has for a shuffle.
    """
    rides, drivers = side, side * DRIVER_CUTS

    def part(name: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(parts)).cast("int")

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")

    seen = seen.select("*", each(rides)).withColumn("block", F.col("part") * drivers + part("driver_id", drivers))
    asked = asked.select("*", each(drivers)).withColumn("ride_block", part("ride_id", rides) * drivers + F.col("part"))
    blocks = rides * drivers
    # Spark's sizes don't count copies: without the hint it may broadcast all blocks' rows to every block.
    return (seen.drop("part").repartitionById(blocks, "block").hint("merge"),
            asked.drop("part").repartitionById(blocks, "ride_block").hint("merge"))


def pings_in_reach(
    requests: DataFrame,
    pings: DataFrame,
    *,
    before: timedelta = BEFORE,
    after: timedelta = AFTER,
) -> DataFrame:
    """The pings that match some request, each once: what a look at few rides needs. Batch only."""
    asked = requests.select(F.col("h3_cell").alias("cell"), F.unix_millis("event_time").alias("asked"))
    at = F.unix_millis("event_time")
    near = at.between(F.col("asked") - millis(before), F.col("asked") + millis(after))
    return pings.join(asked, (F.col("h3_cell") == F.col("cell")) & near, "left_semi")


def last_match(candidates: DataFrame) -> DataFrame:
    """One row per ride: the time of its last match, and its cell then."""
    last = F.max(F.struct("match_time_ms", "h3_cell")).alias("last")
    return candidates.groupBy("ride_id").agg(last).select(
        "ride_id",
        F.col("last.h3_cell").alias("h3_cell"),
        F.col("last.match_time_ms").alias("last_match_ms"),
    )


def last_matches(
    requests: DataFrame,
    pings: DataFrame,
    *,
    before: timedelta = BEFORE,
    after: timedelta = AFTER,
) -> DataFrame:
    """``last_match`` of the candidates without listing them: rows in and out are of the order of the input.
    Batch only.

    A ride's last match is the last ping of a cell up to the end of a request's interval, whoever sent it. Both sides
    meet in (cell, pane) with panes as wide as the interval, a request in the two panes it touches, and one pass in the
    order of time looks up each request. Of pings at one instant in a cell one is kept ahead of the shuffle.
    """
    width = max(before + after, timedelta(milliseconds=1))
    asked_ms = F.unix_millis("event_time")
    low, high = asked_ms - millis(before), asked_ms + millis(after)
    asked = requests.where("h3_cell is not null and event_time is not null").select(
        "h3_cell", high.alias("t"), F.lit(None).cast("long").alias("at"), "ride_id", low.alias("low"),
        F.explode(F.array_distinct(F.array(pane_start(low, width), pane_start(high, width)))).alias("pane"),
    )
    ride = dict(requests.dtypes)["ride_id"]
    seen = (
        pings.where("h3_cell is not null and event_time is not null")
        .select("h3_cell", F.unix_millis("event_time").alias("t"))
        .distinct()
        .select("h3_cell", "t", F.col("t").alias("at"), F.lit(None).cast(ride).alias("ride_id"),
                F.lit(None).cast("long").alias("low"), pane_start(F.col("t"), width).alias("pane"))
    )
    # Pings, which have no lower end, come before requests that end at the same instant.
    upto = Window.partitionBy("h3_cell", "pane").orderBy("t", F.col("low").asc_nulls_first())
    found = seen.unionByName(asked).withColumn("match_time_ms", F.last("at", ignorenulls=True).over(
        upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return last_match(found.where("match_time_ms >= low").select("ride_id", "h3_cell", "match_time_ms"))


def newest_candidates(
    requests: DataFrame,
    pings: DataFrame,
    k: int,
    *,
    before: timedelta = BEFORE,
    after: timedelta = AFTER,
) -> DataFrame:
    """Candidates that hold the ``k`` latest ones, whatever the order of ties. Batch only.

    The last matches of k rides belong to k candidates, so the k-th latest of them is a bound: every candidate from
    that instant on is listed, all earlier pings are left out. Fewer rides than k set no bound.
    """
    newest = last_matches(requests, pings, before=before, after=after)
    newest = newest.select("last_match_ms").orderBy(F.desc("last_match_ms")).limit(k)
    bound = newest.select(F.when(F.count("*") == k, F.min("last_match_ms"))).first()[0]
    if bound is not None:
        pings = pings.where(F.unix_millis("event_time") >= bound)
        requests = requests.where(F.unix_millis("event_time") + millis(after) >= bound)
    return match_candidates(requests, pings, before=before, after=after)


def rider_driver_id(rider_id: Column) -> Column:
    """The driver a rider is joined to: the first four digits after the 'rdr-' prefix."""
    return F.concat(F.lit("drv-"), F.substring(rider_id, 5, 4))


def enrich_rides(requests: DataFrame, drivers: DataFrame) -> DataFrame:
    """Every ride with its driver's current columns; unknown drivers leave them NULL.

    ``drivers`` holds one row per driver_id. No broadcast is forced: Spark broadcasts the
    dimension while its measured size is below the threshold and shuffles both sides beyond.
    """
    rides = requests.select(
        "ride_id",
        "rider_id",
        F.col("h3_cell").alias("pickup_h3"),
        F.col("event_time").alias("request_time"),
        rider_driver_id(F.col("rider_id")).alias("driver_id"),
    )
    known = drivers.select(
        "driver_id", "name", "vehicle_type", "rating", "active", F.lit(True).alias("found")
    )
    return (
        rides.join(known, "driver_id", "left")
        .withColumn("enriched", F.coalesce("found", F.lit(False)))
        .select("ride_id", "rider_id", "pickup_h3", "request_time", "driver_id", "name",
                "vehicle_type", "rating", "active", "enriched")
    )
