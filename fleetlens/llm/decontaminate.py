"""Benchmark decontamination by greedy string tiling over shared five-word seeds.

Documents and benchmark items share seeds: hashes of five words in a row. A bitmap of the
items' seeds, of fixed size, lets each document keep only the stretches that seeds cover; those are
joined with the items exactly. For each pair, Karp-Rabin matching marks the longest matches that
do not overlap, again and again down to five words, and the marked share of the item decides. Since
tiles may stand in any order, reordered passages count.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import text as tx
from fleetlens.llm.common import bitmap, in_bitmap, map_arrow, stored

TILE = 5
COVERAGE = 0.8
_MOD = (1 << 61) - 1
_RADIX = 0x1F3D5B79A2C4E6


def tiles(text: list[list[int]], item: list[int], least: int = TILE) -> list[tuple[int, int, int, int]]:
    """Greedy string tiling of an item by runs of words of a document: (run, start in the run, start in
    the item, length), longest first and, among equals, first in the item, then in the document.

    Karp-Rabin hashes of the least length find the diagonals (start in the run less start in the item) that hold a
    match. Each is compared word by word, which gives every match that can't be extended; there is at most one per place
    of a diagonal, also where one word repeats. The longest one is marked if all of it is free. What earlier
    tiles leave of one goes back into the queue at its own length, so the order is that of marking again and
    again the longest match of free words.
    """
    if len(item) < least:
        return []
    table: dict[int, list[int]] = {}
    for j, h in _windows(item, least):
        table.setdefault(h, []).append(j)
    words = np.array(item, dtype=np.int64)
    queue: list[tuple[int, int, int, int]] = []
    for r, run in enumerate(text):
        row = np.array(run, dtype=np.int64)
        for shift in _diagonals(run, len(item), table, least):
            i, j = max(shift, 0), max(-shift, 0)
            n = min(len(run) - i, len(item) - j)
            for at, k in _stretches(row[i : i + n] == words[j : j + n], least):
                queue.append((-k, j + at, r, i + at))
    heapq.heapify(queue)
    free_item = np.ones(len(item), dtype=bool)
    free_text = [np.ones(len(run), dtype=bool) for run in text]
    out: list[tuple[int, int, int, int]] = []
    while queue:
        k, j, r, i = heapq.heappop(queue)
        k = -k
        free = free_item[j : j + k] & free_text[r][i : i + k]
        if free.all():
            free_item[j : j + k] = free_text[r][i : i + k] = False
            out.append((r, i, j, k))
        else:
            for at, left in _stretches(free, least):
                heapq.heappush(queue, (-left, j + at, r, i + at))
    return out


def _diagonals(run: list[int], item_words: int, table: dict[int, list[int]], least: int) -> Iterable[int]:
    """The diagonals of a run with a common window; all of them where there are many more windows than those."""
    every = range(least - item_words, len(run) - least + 1)
    found, pairs = set(), 0
    for i, h in _windows(run, least):
        starts = table.get(h, ())
        pairs += len(starts)
        if pairs > 4 * len(every):
            return every
        found.update(i - j for j in starts)
    return sorted(found)


def _stretches(same: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Start and length of each stretch of at least that many marks."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).astype(np.int8)))
    return [(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2]) if b - a >= least]


def _windows(words: list[int], size: int):
    """Karp-Rabin hashes of all windows."""
    lead = pow(_RADIX, size - 1, _MOD)
    h = 0
    for i, word in enumerate(words):
        if i >= size:
            h = (h - words[i - size] * lead) % _MOD
        h = (h * _RADIX + word) % _MOD
        if i >= size - 1:
            yield i - size + 1, h


def _seeds(words: tx.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the seed at each word, and whether the text has TILE words from there on."""
    runs = tx.shingles(words, TILE)
    seed = np.zeros(len(words.hashes), dtype=np.uint64)
    whole = np.zeros(len(words.hashes), dtype=bool)
    n = np.maximum(words.counts - TILE + 1, 0)
    at = np.repeat(words.first[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    source = np.repeat(runs.first[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    seed[at], whole[at] = runs.hashes[source], True
    return seed, whole


def _items(batch: pa.RecordBatch) -> dict:
    words = tx.hash_words(batch.column(1))
    seed, whole = _seeds(words)
    out = {"item": batch.column(0), "words": [], "seeds": []}
    for a, b in zip(words.first[:-1], words.first[1:]):
        out["words"].append(words.hashes[a:b].view(np.int64))
        out["seeds"].append(seed[a:b][whole[a:b]].view(np.int64))
    return out


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """Pairs (key, item, item_words, tiled_words, n_tiles, coverage) whose tiles cover at least the given share
    of an item's words.

    Items of fewer than five words hold no seed and match nothing; null and empty texts match nothing,
    nor do rows with a null key. Keys or items that come more than once count by each of their texts,
    and the pair's best coverage is returned.
    """
    bench = benchmark.select(F.col(item).cast("bigint").alias("item"), F.col(item_text).alias("text"))
    bench = bench.where("item is not null and text is not null").distinct()
    schema = "item bigint, words array<bigint>, seeds array<bigint>"
    bench = map_arrow(bench, _items, schema).where(F.size("seeds") > 0)
    bench = stored(bench.withColumn("row", F.xxhash64("item", "words")), "bench")
    seeds = bench.select("row", F.size("words").alias("n"), F.explode("seeds").alias("seed"))
    seeds = seeds.groupBy("row", "n", "seed").agg(F.count("*").alias("times"))
    bits = documents.sparkSession.sparkContext.broadcast(bitmap(seeds.select("seed").distinct(), "seed"))

    def stretches(batch: pa.RecordBatch) -> dict | None:
        words = tx.hash_words(batch.column(1))
        seed, whole = _seeds(words)
        hit = whole & in_bitmap(bits.value, seed)
        at = np.flatnonzero(hit)
        if not len(at):
            return None
        owner = np.searchsorted(words.first, at, side="right") - 1
        rows = np.unique(owner)
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        out = {"doc": keys[rows], "runs": [], "seeds": []}
        for row in rows:
            mine = at[owner == row] if len(rows) < 2 else at[np.searchsorted(owner, row) : np.searchsorted(owner, row, "right")]
            # Hits closer than a seed's length are one stretch of words.
            cut = np.flatnonzero(np.diff(mine) > TILE) + 1
            out["runs"].append(
                [words.hashes[p[0] : p[-1] + TILE].view(np.int64) for p in np.split(mine, cut)]
            )
            out["seeds"].append(np.unique(seed[mine].view(np.int64)))
        return out

    rows = documents.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    schema = "doc bigint, runs array<array<bigint>>, seeds array<bigint>"
    found = map_arrow(rows.where("doc is not null"), stretches, schema)
    found = stored(found.withColumn("part", F.xxhash64("doc", "runs")), "stretches")
    shared = found.select("doc", "part", F.explode("seeds").alias("seed")).join(seeds, "seed")
    # Tiles of five words or more hold a seed per five words at least: fewer can't reach the share.
    pairs = shared.groupBy("doc", "part", "row", "n").agg(F.sum("times").alias("hits"))
    pairs = pairs.where(F.col("hits") * TILE + 1e-9 >= F.col("n") * coverage)
    pairs = pairs.select("doc", "part", "row")
    pairs = pairs.join(found.select("doc", "part", "runs"), ["doc", "part"])
    pairs = pairs.join(bench.select("row", "item", "words"), "row").select("doc", "item", "runs", "words")

    def cover(batch: pa.RecordBatch) -> dict:
        n, tiled, total = [], [], []
        for runs, words in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            runs = [[w % _MOD for w in run] for run in runs]
            marked = tiles(runs, [w % _MOD for w in words])
            n.append(len(words))
            tiled.append(sum(t[3] for t in marked))
            total.append(len(marked))
        return {"doc": batch.column(0), "item": batch.column(1), "n": n, "tiled": tiled, "total": total}

    covered = map_arrow(pairs, cover, "doc bigint, item bigint, n int, tiled int, total int")
    best = F.max(F.struct((F.col("tiled") / F.col("n")).alias("coverage"), "tiled", "n", "total")).alias("best")
    covered = covered.groupBy("doc", "item").agg(best).where(F.col("best.coverage") >= coverage)
    return covered.select(
        F.col("doc").alias(key),
        F.col("item").alias(item),
        F.col("best.n").alias("item_words"),
        F.col("best.tiled").alias("tiled_words"),
        F.col("best.total").alias("n_tiles"),
        F.col("best.coverage").alias("coverage"),
    )
