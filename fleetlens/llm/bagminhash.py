"""Near-duplicates by weighted Jaccard similarity of five-word shingles, with BagMinHash signatures.

A text is a bag of shingles whose weights are their counts. Weights are cut at the levels 1, 2, 4, ...;
the span between two levels is a Poisson process with the span's length as rate, whose points carry
a signature slot and a position in the span. A point counts for a bag whose weight reaches that
position, so a shingle of weight w costs about log w processes and not w. A slot keeps the earliest
point, and two bags agree in a slot with the probability of their weighted Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import text as tx
from fleetlens.llm.common import bitmap, in_bitmap, map_arrow, stored
from fleetlens.llm.components import components

THRESHOLD = 0.8
BANDS, ROWS = 32, 6
SLOTS = BANDS * ROWS
# Slots of a pair at the threshold that agree: this many standard deviations below the mean pass.
SLACK = 4.5
BLOCK = 2048
_U = np.uint64


def bags(shingles: tx.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with counts, ordered by text."""
    order = np.lexsort((shingles.hashes, shingles.text))
    text, h = shingles.text[order], shingles.hashes[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return text[at], h[at], np.diff(np.append(at, len(h)))


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int):
    """Per text SLOTS 64-bit values (the earliest point of each slot); texts without shingles: 0."""
    best = np.full(n * SLOTS, np.inf)
    name = np.zeros(n * SLOTS, dtype=np.uint64)
    # Node j > 0 spans the weights (2^(j-1), 2^j], node 0 spans (0, 1].
    depth = np.where(weight > 1, np.ceil(np.log2(weight)), 0).astype(np.int64)
    at = np.repeat(np.arange(len(text)), depth + 1)
    first = np.cumsum(depth + 1) - (depth + 1)
    node = np.arange(len(at)) - first[at]
    owner, limit = text[at], weight[at]
    low = np.where(node > 0, _U(1) << np.maximum(node - 1, 0).astype(np.uint64), _U(0)).astype(np.int64)
    span = np.maximum(low, 1)
    seed = tx.mix(shingle[at] + node.astype(np.uint64) * _U(0xD1342543DE82EF95))
    time = np.zeros(len(at))
    step = 0
    while len(seed):
        step += 1
        draw = tx.mix(seed + _U(step * 0x9E3779B97F4A7C15 % (1 << 64)))
        uniform = ((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / span
        point = tx.mix(draw ^ _U(0xA0761D6478BD642F))
        place = low + 1 + ((point >> _U(20)) % span.astype(np.uint64)).astype(np.int64)
        slot = owner * SLOTS + (point % _U(SLOTS)).astype(np.int64)
        hit = np.flatnonzero((place <= limit) & (time < best[slot]))
        if len(hit):
            # The earliest of the points that fall into one slot in this step.
            order = hit[np.lexsort((time[hit], slot[hit]))]
            lead = np.ones(len(order), dtype=bool)
            lead[1:] = slot[order][1:] != slot[order][:-1]
            order = order[lead]
            best[slot[order]], name[slot[order]] = time[order], point[order]
        # Points only get later: a process ends once all slots of its text have earlier ones.
        latest = best.reshape(n, SLOTS).max(axis=1)
        live = time < latest[owner]
        if not live.all():
            seed, time, owner, limit = seed[live], time[live], owner[live], limit[live]
            low, span = low[live], span[live]
    return tx.mix(name).reshape(n, SLOTS)


def _digests(words: tx.Words) -> list[str | None]:
    """A digest of each word sequence: two sums over its words, mixed with their places."""
    turn = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], words.counts)
    turn = turn.astype(np.uint64)
    one = tx.sums(tx.mix(words.hashes + turn * _U(0x9E3779B97F4A7C15)), words.first)
    two = tx.sums(tx.mix(words.hashes ^ tx.mix(turn + _U(7))), words.first)
    return [f"{a:016x}{b:016x}" if n else None for a, b, n in zip(one, two, words.counts)]


def _signed_digests(texts: pa.Array) -> list[str | None]:
    return _digests(tx.hash_words(texts))


def _signed(batch: pa.RecordBatch) -> dict:
    """Per text a digest of its word sequence, its band values and a byte per slot."""
    words = tx.hash_words(batch.column(1))
    out = {"id": batch.column(0), "digest": _digests(words), "bands": [], "slots": []}
    for at, end in tx.parts(words, 1 << 17):
        lo, hi = words.first[at], words.first[end]
        part = tx.Words(words.hashes[lo:hi], words.first[at : end + 1] - lo)
        runs = tx.shingles(part)
        text, shingle, weight = bags(runs)
        names = signatures(text, shingle, weight, end - at)
        band = np.zeros((end - at, BANDS), dtype=np.uint64)
        for k in range(ROWS):
            band = tx.mix(band * _U(31) + names[:, k * BANDS : (k + 1) * BANDS])
        band = tx.mix(band + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
        byte = names.astype(np.uint8)
        for i, n in enumerate(runs.counts):
            out["bands"].append(band[i] if n else None)
            out["slots"].append(byte[i].tobytes() if n else None)
    return out


def _bags_of(texts: pa.Array) -> list[np.ndarray]:
    """Per text its sorted shingles, the k-th repeat of one as a value of its own: the weighted Jaccard
    similarity of two bags is the plain one of these sets."""
    runs = tx.shingles(tx.hash_words(texts))
    text, shingle, weight = bags(runs)
    repeat = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    value = tx.mix(np.repeat(shingle, weight) + repeat.astype(np.uint64)).view(np.int64)
    first = np.searchsorted(np.repeat(text, weight), np.arange(len(texts) + 1))
    return [np.sort(value[a:b]) for a, b in zip(first[:-1], first[1:])]


def overlap(x: np.ndarray, y: np.ndarray) -> float:
    """Similarity of two sorted bags."""
    both = np.concatenate((x, y))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(x) + len(y) - common) if len(both) else 0.0


def links_within(ids: np.ndarray, block: np.ndarray, slots: np.ndarray, bag: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect texts of a cluster as all links at the threshold do, checked by exact counts.

    Signatures sort out pairs that can't reach the threshold. The rest are counted from the most alike on,
    but for pairs that links found before connect already. With two blocks only pairs across count.
    """
    parent = list(range(len(ids)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    mean = SLOTS * THRESHOLD
    least = mean - SLACK * np.sqrt(mean * (1 - THRESHOLD))
    across = block.min() != block.max()
    pairs = []
    for at in range(0, len(ids) - 1, 64):
        end = min(at + 64, len(ids))
        same = (slots[at:end, None, :] == slots[None, at:, :]).sum(axis=2)
        i, j = np.nonzero(same >= least)
        score, i, j = same[i, j], i + at, j + at
        keep = i < j
        if across:
            keep &= block[i] != block[j]
        pairs.append(np.stack((-score[keep], i[keep], j[keep]), axis=1))
    out = []
    every = np.concatenate(pairs) if pairs else np.zeros((0, 3), np.int64)
    for _, i, j in every[np.argsort(every[:, 0], kind="stable")].tolist():
        a, b = root(i), root(j)
        if a != b and overlap(bag[i], bag[j]) >= THRESHOLD - 1e-12:
            parent[a] = b
            out.append((int(ids[i]), int(ids[j])))
    return out


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each cluster's pair of blocks; rows come sorted by it."""
    waiting: list[pa.RecordBatch] = []
    key = None

    def finish() -> pa.RecordBatch:
        table = pa.Table.from_batches(waiting).combine_chunks()
        slots = np.frombuffer(b"".join(table["slots"].to_pylist()), np.uint8).reshape(-1, SLOTS)
        bag = [np.asarray(v.values) for v in table["bag"]]
        found = links_within(table["id"].to_numpy(), table["block"].to_numpy(), slots, bag)
        columns = list(zip(*found)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    for batch in batches:
        keys = batch.column(0).to_pylist()
        at = 0
        for end in [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]] + [len(keys)]:
            if waiting and keys[at] != key:
                yield finish()
                waiting = []
            key = keys[at]
            waiting.append(batch.slice(at, end - at))
            at = end
    if waiting:
        yield finish()


def near_duplicates(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row (key, copy_of, class_id, kept) per distinct key.

    ``copy_of`` is the least key with the same word sequence, ``class_id`` the least key of all texts that
    links at a similarity of 0.8 or more connect, ``kept`` whether the row is that one. Texts that are
    null, empty or without a word link with nothing; rows with a null key are left out. A
    key that comes more than once counts as one document with the text of the least digest. Band values
    find candidates (a pair at 0.8 shares none with a chance of 6e-5, at 0.85 of 5e-8).

    Texts that share band values, directly or through others, form a cluster. A cluster above
    BLOCK texts is cut into blocks, and each pair of blocks is compared in a task of its own, so a
    task's memory is bounded by two blocks. What leaves a task are links that join components, at most one per
    text, and never all pairs of a group.
    """
    texts = documents.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    texts = texts.where("id is not null")
    schema = "id bigint, digest string, bands array<bigint>, slots binary"
    every = stored(map_arrow(texts, _signed, schema), "signed")
    # One digest per key, then one key per digest; both are partial aggregations.
    named = every.groupBy("id").agg(F.min(F.coalesce("digest", F.lit(""))).alias("digest"))
    leaders = named.where("digest != ''").groupBy("digest").agg(F.min("id").alias("leader"))
    leaders = stored(leaders, "leaders")
    leading = leaders.select(F.col("leader").alias("id"), "digest")
    signed = every.join(leading, ["id", "digest"], "left_semi").dropDuplicates(["id"])
    signed = stored(signed, "leading")

    members = signed.select(F.explode("bands").alias("bucket"), "id")
    buckets = members.groupBy("bucket").agg(F.min("id").alias("pivot"), F.count("*").alias("n"))
    stars = members.join(buckets.where("n > 1"), "bucket").where("id != pivot")
    clusters = components(stars.select(F.col("pivot").alias("a"), F.col("id").alias("b")))
    clusters = stored(clusters.withColumnRenamed("component", "cluster"), "clusters")
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    placed = clusters.join(sizes, "cluster").join(signed.select("id", "digest", "slots"), "id")

    # The texts of clusters: a bitmap lets few others pass, and the join is exact.
    spark = documents.sparkSession
    bits = spark.sparkContext.broadcast(bitmap(clusters.select(F.xxhash64("id").alias("h")), "h"))

    def bagged(batch: pa.RecordBatch) -> dict | None:
        batch = batch.filter(pa.array(in_bitmap(bits.value, batch.column(2).to_numpy().view(np.uint64))))
        if not batch.num_rows:
            return None
        digest = _signed_digests(batch.column(1))
        return {"id": batch.column(0), "digest": digest, "bag": _bags_of(batch.column(1))}

    found = texts.select("id", "text", F.xxhash64("id").alias("h"))
    found = map_arrow(found, bagged, "id bigint, digest string, bag array<bigint>").dropDuplicates(["id", "digest"])
    rows = placed.join(found, ["id", "digest"])
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda b: F.struct(F.least(own, b).alias("low"), F.greatest(own, b).alias("high")),
    )
    rows = rows.select("cluster", "id", "slots", "bag", own.alias("block"), F.explode(pairs).alias("pair"))
    rows = rows.select(F.concat_ws(":", "cluster", "pair.low", "pair.high").alias("task"), "id", "block", "slots", "bag")
    rows = rows.repartition("task").sortWithinPartitions("task", "id")
    links = stored(rows.mapInArrow(_linked, "a bigint, b bigint"), "links")
    group = components(links)

    out = named.join(leaders, "digest", "left").select(
        F.col("id"), F.coalesce("leader", "id").alias("copy_of")
    )
    out = out.join(group.withColumnRenamed("id", "copy_of"), "copy_of", "left")
    class_id = F.coalesce("component", "copy_of")
    return out.select(
        F.col("id").alias(key), "copy_of", class_id.alias("class_id"), (class_id == F.col("id")).alias("kept")
    )
