"""Near-duplicate vectors by a robust-pruned flat graph over overlapping cluster shards.

Distinct vectors go to the shards of their nearest clusters. In each shard a graph is built by inserting
batches of growing size: a greedy beam search finds a vector's surroundings, and robust pruning keeps
neighbours in different directions. Adjacency lists of all shards are united per vector. Every
vector then searches from the shard's medoids, and once in range it expands all neighbours in range. Links
across shards follow from united edges that lead out of a shard. All links are checked by cosine in
double precision, and recall is audited against brute force until enough vectors with links were asked; if
more overlapping shards don't reach it either, all vectors are compared.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import map_arrow, small_batches, stored
from fleetlens.llm.components import components

THRESHOLD = 0.9
# Clusters are fitted on a sample of so many vectors, and so many at most (both fixed bounds).
FIT_VECTORS, MOST_CLUSTERS = 16_384, 2048
PER_CLUSTER = 600
# A shard above this many vectors is cut into blocks, and every pair of blocks is a shard.
MOST_IN_BLOCK = 1500
OVERLAPS = (3, 6, 12)
DEGREE, BEAM, POOL, ALPHA = 20, 32, 64, 1.2
MEDOIDS = 12
# Nodes this far below the threshold are still expanded.
MARGIN = 0.08
AUDITED, LEAST_RECALL = 200, 0.95
# A vector with more links is dense. So many vectors are compared with all others at a time, at first and at most.
DENSE, ASKED, MOST_ASKED = 64, 2048, 16_384
# Groups of audited vectors below this size are judged together.
LEAST_GROUP = 20


class Graph:
    """A flat graph over unit vectors: ``near[i]`` lists neighbours, -1 where there are fewer."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x.astype(np.float32)
        self.near = np.full((len(x), DEGREE), -1, dtype=np.int32)
        self.medoids = self._spread()

    def _spread(self) -> np.ndarray:
        """Medoids of rough groups: the vectors closest to the means around far-apart ones."""
        n = len(self.x)
        picks = [int((self.x @ self.x.mean(axis=0)).argmax())]
        close = self.x @ self.x[picks[0]]
        while len(picks) < min(MEDOIDS, n):
            picks.append(int(close.argmin()))
            close = np.maximum(close, self.x @ self.x[picks[-1]])
        group = (self.x @ self.x[picks].T).argmax(axis=1)
        out = []
        for g in np.unique(group):
            own = np.flatnonzero(group == g)
            out.append(own[(self.x[own] @ self.x[own].mean(axis=0)).argmax()])
        return np.array(out, dtype=np.int32)

    def beam(self, queries: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy search of many queries at once: ids and similarities of the best BEAM nodes."""
        q = len(queries)
        ids = np.full((q, BEAM), -1, dtype=np.int32)
        sims = np.full((q, BEAM), -2.0, dtype=np.float32)
        first = queries @ self.x[starts].T
        order = np.argsort(-first, axis=1)[:, :BEAM]
        ids[:, : order.shape[1]] = starts[order]
        sims[:, : order.shape[1]] = np.take_along_axis(first, order, 1)
        done = ids < 0
        active = np.arange(q)
        while len(active):
            waiting = np.where(done[active], -2.0, sims[active])
            pick = waiting.argmax(axis=1)
            more = waiting[np.arange(len(active)), pick] > -2.0
            active, pick = active[more], pick[more]
            if not len(active):
                break
            done[active, pick] = True
            near = self.near[ids[active, pick]]
            old = (near[:, :, None] == ids[active][:, None, :]).any(axis=2) | (near < 0)
            score = np.einsum("qd,qrd->qr", queries[active], self.x[near])
            score[old] = -2.0
            all_ids = np.concatenate((ids[active], near), axis=1)
            all_sims = np.concatenate((sims[active], score), axis=1)
            all_done = np.concatenate((done[active], old), axis=1)
            best = np.argpartition(-all_sims, BEAM - 1, axis=1)[:, :BEAM]
            ids[active] = np.take_along_axis(all_ids, best, 1)
            sims[active] = np.take_along_axis(all_sims, best, 1)
            done[active] = np.take_along_axis(all_done, best, 1)
        ids[sims <= -2.0] = -1
        return ids, sims

    def prune(self, nodes: np.ndarray, pool: np.ndarray) -> np.ndarray:
        """Robust pruning: of the pool, nearest first, keep those that no kept one is nearer to by a
        factor."""
        pool = np.where(pool == nodes[:, None], -1, pool)
        order = np.sort(pool, axis=1)
        twice = np.zeros_like(order, dtype=bool)
        twice[:, 1:] = order[:, 1:] == order[:, :-1]
        pool = np.where(twice, -1, order)
        own = self.x[nodes]
        gap = 1 - np.einsum("nd,ncd->nc", own, self.x[pool])
        gap[pool < 0] = np.inf
        order = np.argsort(gap, axis=1)[:, :POOL]
        pool, gap = np.take_along_axis(pool, order, 1), np.take_along_axis(gap, order, 1)
        vectors = self.x[pool]
        alive, out = gap < np.inf, np.full((len(nodes), DEGREE), -1, dtype=np.int32)
        rows = np.arange(len(nodes))
        for r in range(DEGREE):
            pick = alive.argmax(axis=1)
            some = alive[rows, pick]
            if not some.any():
                break
            out[some, r] = pool[rows, pick][some]
            between = 1 - np.einsum("nd,ncd->nc", vectors[rows, pick], vectors)
            # Squared distances of unit vectors go with 1 - cosine, hence the squared factor.
            alive &= ~((ALPHA * ALPHA * between <= gap) & some[:, None])
            alive[rows, pick] = False
        return out

    def build(self) -> Graph:
        """Insert all vectors in batches that double, then add the edges back."""
        rng = np.random.default_rng(11)
        n = len(self.x)
        order = np.concatenate((self.medoids, rng.permutation(np.setdiff1d(np.arange(n), self.medoids))))
        at = 0
        size = len(self.medoids)
        while at < n:
            nodes = order[at : at + size].astype(np.int32)
            if at == 0:
                pool = np.tile(nodes, (len(nodes), 1))
            else:
                pool, _ = self.beam(self.x[nodes], self.medoids)
                # Some random earlier nodes give long edges.
                pool = np.concatenate((pool, rng.choice(order[:at], (len(nodes), 8)).astype(np.int32)), axis=1)
            self.near[nodes] = self.prune(nodes, pool)
            self._back(nodes)
            at += size
            size = min(at, 1024)
        return self

    def _back(self, nodes: np.ndarray) -> None:
        source = np.repeat(nodes, DEGREE)
        target = self.near[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        which, first, count = np.unique(target, return_index=True, return_counts=True)
        if not len(which):
            return
        # New edges of a node beyond the pool's size wait: both ends already have one direction.
        wide = np.full((len(which), min(int(count.max()), POOL)), -1, dtype=np.int32)
        place = np.arange(len(target)) - np.repeat(first, count)
        row = np.repeat(np.arange(len(which)), count)
        fits = place < wide.shape[1]
        wide[row[fits], place[fits]] = source[fits]
        self.near[which] = self.prune(which.astype(np.int32), np.concatenate((self.near[which], wide), axis=1))

    def _close_edges(self, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Edges of at least some similarity in both directions, as row bounds and targets: a vector
        in range is reached from its own neighbours too, wherever pruning left the edge."""
        source, place = np.nonzero(self.near >= 0)
        target = self.near[source, place].astype(np.int64)
        keep = np.zeros(len(source), dtype=bool)
        for b in range(0, len(source), 1 << 17):
            e = b + (1 << 17)
            keep[b:e] = np.einsum("nd,nd->n", self.x[source[b:e]], self.x[target[b:e]]) >= least
        source, target = source[keep], target[keep]
        n = len(self.x)
        code = np.unique(np.concatenate((source * n + target, target * n + source)))
        return np.searchsorted(code // n, np.arange(n + 1)), code % n

    def in_range(self, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query row, node) at a similarity of ``least`` or more, by range-expanding search."""
        n = len(self.x)
        first, to = self._close_edges(least - MARGIN)
        out_q, out_n = [], []
        for at in range(0, len(queries), 512):
            part = queries[at : at + 512]
            ids, sims = self.beam(part, self.medoids)
            seen = np.zeros((len(part), n), dtype=bool)
            rows, cols = np.nonzero(ids >= 0)
            nodes = ids[rows, cols]
            seen[rows, nodes] = True
            score = sims[rows, cols]
            while len(rows):
                hit = score >= least
                out_q.append(rows[hit] + at)
                out_n.append(nodes[hit])
                go = score >= least - MARGIN
                rows, nodes = rows[go], nodes[go]
                count = first[nodes + 1] - first[nodes]
                skip = np.repeat(first[nodes] - np.cumsum(count) + count, count)
                rows, nodes = np.repeat(rows, count), to[skip + np.arange(len(skip))]
                new = ~seen[rows, nodes]
                code = np.unique(rows[new].astype(np.int64) * n + nodes[new])
                rows, nodes = code // n, code % n
                seen[rows, nodes] = True
                score = np.empty(len(rows), dtype=np.float32)
                for b in range(0, len(rows), 1 << 17):
                    e = b + (1 << 17)
                    score[b:e] = np.einsum("nd,nd->n", part[rows[b:e]], self.x[nodes[b:e]])
        if not out_q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(out_q), np.concatenate(out_n)


def _matrix(column: pd.Series) -> np.ndarray:
    x = np.array(column.to_list(), dtype=np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _centres(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means of a bounded sample."""
    rng = np.random.default_rng(3)
    centres = sample[rng.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        group = (sample @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, group, sample)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(size > 0, total / np.maximum(size, 1e-12), centres)
    return centres.astype(np.float32)


def _sharded(vectors: DataFrame, overlap: int) -> DataFrame:
    """Rows (shard, id, x): each vector in the shards of its nearest clusters."""
    sizes = {r["dim"]: r["n"] for r in vectors.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).collect()}
    n = max(sum(sizes.values()), 1)
    draw = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    sample = vectors.where(draw < min(1.0, FIT_VECTORS / n)).limit(2 * FIT_VECTORS).select("x").toPandas()["x"]
    centres = {}
    for dim, count in sizes.items():
        own = [v for v in sample if len(v) == dim]
        k = min(max(1, round(count / PER_CLUSTER)), MOST_CLUSTERS, max(len(own) // 4, 1))
        centres[dim] = _centres(_matrix(pd.Series(own)).astype(np.float32), k) if own else np.zeros((1, dim), np.float32)
    share = vectors.sparkSession.sparkContext.broadcast(centres)

    def assign(batch: pa.RecordBatch) -> dict:
        out = {"dim": [], "cluster": [], "id": [], "x": []}
        for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            centre = share.value[len(x)]
            near = centre @ (np.array(x, dtype=np.float64) / np.linalg.norm(x)).astype(np.float32)
            for c in np.argsort(-near, kind="stable")[:overlap].tolist():
                out["dim"].append(len(x))
                out["cluster"].append(c)
                out["id"].append(i)
                out["x"].append(x)
        return out

    rows = map_arrow(vectors.select("id", "x"), assign, "dim int, cluster int, id bigint, x array<double>")
    rows = stored(rows, "assigned")
    size = rows.groupBy("dim", "cluster").agg(F.ceil(F.count("*") / F.lit(MOST_IN_BLOCK)).cast("int").alias("blocks"))
    rows = rows.join(size, ["dim", "cluster"])
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # A block meets every block of its shard, itself included when it is alone.
    pairs = F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("blocks") - 1, F.lit(0))),
        lambda b: F.struct(F.least(own, b).alias("low"), F.greatest(own, b).alias("high")),
    )
    pairs = F.when(F.col("blocks") > 1, F.filter(pairs, lambda p: p["low"] != p["high"])).otherwise(pairs)
    return rows.select("dim", "cluster", "id", "x", F.explode(pairs).alias("pair")).select(
        F.concat_ws(":", "dim", "cluster", "pair.low", "pair.high").alias("shard"), "cluster", "id", "x"
    )


def _graphs(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.drop_duplicates("id").sort_values("id")
    ids = frame["id"].to_numpy()
    graph = Graph(_matrix(frame["x"])).build()
    near = [ids[row[row >= 0]] for row in graph.near]
    return pd.DataFrame({"shard": frame["shard"].iloc[0], "id": ids, "near": pd.Series(near, dtype=object)})


def _searched(frame: pd.DataFrame) -> pd.DataFrame:
    """Links of each vector of a shard, found over the united adjacency lists within the shard."""
    frame = frame.drop_duplicates("id").sort_values("id")
    ids = frame["id"].to_numpy()
    x = _matrix(frame["x"])
    graph = Graph(x)
    near = [np.asarray(row, dtype=np.int64) for row in frame["near"]]
    at = [np.searchsorted(ids, row) for row in near]
    at = [a[(a < len(ids)) & (ids[np.minimum(a, len(ids) - 1)] == row)] for a, row in zip(at, near)]
    graph.near = np.full((len(ids), max(map(len, at), default=1) or 1), -1, dtype=np.int32)
    for i, row in enumerate(at):
        graph.near[i, : len(row)] = row
    a, b = graph.in_range(graph.x, THRESHOLD - 1e-5)
    a, b = a[a < b], b[a < b]
    keep = np.zeros(len(a), dtype=bool)
    for s in range(0, len(a), 1 << 17):
        e = s + (1 << 17)
        keep[s:e] = np.einsum("nd,nd->n", x[a[s:e]], x[b[s:e]]) >= THRESHOLD
    a, b = a[keep], b[keep]
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    who, first = np.unique(a, return_index=True)
    lists = [ids[p] for p in np.split(b, first[1:])] if len(who) else []
    return pd.DataFrame({"a": ids[who], "b": pd.Series(lists, dtype=object)})


def _crossing(links: DataFrame, members: DataFrame, edges: DataFrame, vectors: DataFrame) -> DataFrame:
    """Links between vectors without a common shard: neighbours, in another home cluster, of a linked one."""
    places = members.groupBy("id").agg(F.collect_set("shard").alias("places"))
    lead = edges.select("id", F.explode("near").alias("to")).distinct()
    near = lead.join(places, "id").join(places.toDF("to", "there"), "to")
    # Only edges to vectors that lie in a shard the source isn't in can lead out.
    lead = near.where(F.size(F.array_except("there", "places")) > 0).select("id", "to", "there")
    both = links.union(links.select("b", "a")).toDF("q", "id")
    pairs = both.join(lead, "id").join(places.toDF("q", "here"), "q")
    pairs = pairs.where(~F.arrays_overlap("here", "there") & (F.col("q") != F.col("to")))
    pairs = pairs.select(F.least("q", "to").alias("a"), F.greatest("q", "to").alias("b")).distinct()
    pairs = pairs.join(vectors.select(F.col("id").alias("a"), F.col("x").alias("u")), "a")
    pairs = pairs.join(vectors.select(F.col("id").alias("b"), F.col("x").alias("v")), "b")
    return pairs.where(_cosine("u", "v") >= THRESHOLD).select("a", "b")


def _cosine(u: str, v: str):
    dot = F.aggregate(F.zip_with(u, v, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda t, x: t + x * x))
    return dot / (norm(u) * norm(v))


def _asked(vectors: DataFrame, low: float, high: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The vectors whose hash lies in a range of [0, 1), by length: ids and unit vectors."""
    place = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1 << 30)) / float(1 << 30)
    drawn = vectors.where((place >= low) & (place < high)).select("id", "x").toPandas()
    out = {}
    for dim, own in drawn.groupby(drawn["x"].map(len)):
        out[dim] = own["id"].to_numpy(), _matrix(own["x"])
    return out


def _compared(vectors: DataFrame, asked: dict, schema: str, write) -> DataFrame:
    """Compare vectors with all: ``write`` gets ids asked, ids of a batch, and which pairs of them are links."""
    share = vectors.sparkSession.sparkContext.broadcast(asked)

    def compare(batch: pa.RecordBatch) -> dict:
        out = {f.split()[0]: [] for f in schema.split(", ")}
        ids, xs = np.array(batch.column(0).to_pylist(), dtype=np.int64), batch.column(1).to_pylist()
        size = np.array([len(x) for x in xs])
        for dim in np.unique(size).tolist():
            if dim not in share.value:
                continue
            mine = np.flatnonzero(size == dim)
            keys, queries = share.value[dim]
            rows = _matrix(pd.Series([xs[i] for i in mine]))
            for at in range(0, len(mine), 512):
                part, own = rows[at : at + 512], ids[mine[at : at + 512]]
                sims = queries.astype(np.float32) @ part.astype(np.float32).T
                hit = sims >= THRESHOLD + 1e-5
                # What single precision can't tell is settled in double.
                q, r = np.nonzero(~hit & (sims >= THRESHOLD - 1e-5))
                hit[q, r] = np.einsum("nd,nd->n", queries[q], part[r]) >= THRESHOLD
                hit &= keys[:, None] != own[None, :]
                write(out, keys, own, hit)
        return out

    return map_arrow(vectors.select("id", "x"), compare, schema)


def audit(vectors: DataFrame, links: DataFrame, queries: int = AUDITED) -> float:
    """Recall of the links per vector, the mean over vectors drawn by hash, against brute force.

    More are drawn until so many vectors that aren't dense have a link, or all were asked. Vectors with
    one link, some, many and very many form groups, and the group with the least recall decides.
    """
    n = vectors.count()
    both = links.select("a").union(links.select("b")).toDF("id")
    degree = stored(both.groupBy("id").agg(F.count("*").alias("found")), "degrees")

    def count(out: dict, keys: np.ndarray, own: np.ndarray, hit: np.ndarray) -> None:
        total = hit.sum(axis=1)
        out["id"] += keys[total > 0].tolist()
        out["n"] += total[total > 0].tolist()

    true, share, low, size = [], [], 0.0, ASKED
    while low < 1.0 and sum(t <= DENSE for t in true) < queries:
        high = min(1.0, low + size / max(n, 1))
        asked = _asked(vectors, low, high)
        linked = _compared(vectors, asked, "id bigint, n bigint", count).groupBy("id").agg(F.sum("n").alias("n"))
        for row in linked.join(degree, "id", "left").select("n", F.coalesce("found", F.lit(0))).toLocalIterator():
            true.append(row[0])
            share.append(min(1.0, row[1] / row[0]))
        low, size = high, min(2 * size, MOST_ASKED)
    if not true:
        return 1.0
    group, share = np.digitize(true, [2, 8, DENSE + 1]), np.array(share)
    count_of = np.bincount(group, minlength=4)
    small = count_of[group] < LEAST_GROUP
    means = [share[group == g].mean() for g in range(4) if count_of[g] >= LEAST_GROUP]
    return float(min([*means, *([share[small].mean()] if small.any() else [])]))


def exact_links(vectors: DataFrame) -> DataFrame:
    """All links, by comparing block after block of the vectors with all."""

    def pairs(out: dict, keys: np.ndarray, own: np.ndarray, hit: np.ndarray) -> None:
        for k in np.flatnonzero(hit.any(axis=1)):
            more = own[hit[k] & (own > keys[k])]
            if len(more):
                out["a"].append(int(keys[k]))
                out["b"].append(more.tolist())

    n = vectors.count()
    blocks = max(1, -(-n // MOST_ASKED))
    found = []
    for i in range(blocks):
        asked = _asked(vectors, i / blocks, (i + 1) / blocks)
        found.append(stored(_compared(vectors, asked, "a bigint, b array<bigint>", pairs), "exact"))
    return functools.reduce(DataFrame.union, found).select("a", F.explode("b").alias("b"))


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row (key, n_links, component_id, kept) per row with a key.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing, and
    neither do vectors of different lengths. Equal vectors are searched once and count as links of one
    another. A key that comes again counts once with its least vector; rows with a null key are left out.
    If the audit finds less than 0.95 of the links, the search runs again over more overlapping shards, and
    after the last overlap all vectors are compared.
    """
    small_batches(rows.sparkSession)
    given = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    given = given.where("id is not null").groupBy("id").agg(F.min("x").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    # Squares that overflow or vanish would spoil the cosine: scale by the largest component.
    top = F.array_max(F.transform("x", F.abs))
    sound = F.when(finite & (F.size("x") > 0) & (top > 0), F.transform("x", lambda v: v / top))
    given = stored(given.select("id", "x", sound.alias("y")), "vectors")
    usable = given.where("y is not null")
    classes = usable.groupBy("x").agg(F.min("id").alias("leader"), F.count("*").alias("copies"), F.first("y").alias("y"))
    classes = stored(classes, "classes")
    vectors = classes.select(F.col("leader").alias("id"), F.col("y").alias("x"))
    links = None
    for overlap in OVERLAPS:
        members = stored(_sharded(vectors, overlap), "shards")
        edges = members.groupBy("shard").applyInPandas(_graphs, "shard string, id bigint, near array<bigint>")
        edges = stored(edges, "edges")
        united = edges.select("id", F.explode_outer("near").alias("near")).groupBy("id")
        united = stored(united.agg(F.collect_set("near").alias("near")), "united")
        search = members.select("shard", "id", "x").join(united, "id")
        found = search.groupBy("shard").applyInPandas(_searched, "a bigint, b array<bigint>")
        found = found.select("a", F.explode("b").alias("b")).distinct()
        links = stored(found, "found")
        cross = stored(_crossing(links, members, united, vectors), "crossing")
        links = stored(links.union(cross).distinct(), "links")
        if audit(vectors, links) >= LEAST_RECALL:
            break
    else:
        links = stored(exact_links(vectors), "links")
    group = components(links)
    both = links.union(links.select("b", "a")).toDF("leader", "other")
    weight = classes.select(F.col("leader").alias("other"), F.col("copies").alias("weight"))
    degree = both.join(weight, "other").groupBy("leader").agg(F.sum("weight").alias("others"))
    per_class = classes.join(degree, "leader", "left").join(group.withColumnRenamed("id", "leader"), "leader", "left")
    per_class = per_class.select(
        "x",
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "leader").alias("component_id"),
    )
    out = usable.select("id", "x").join(per_class, "x").select("id", "n_links", "component_id")
    alone = given.where("y is null").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    out = out.union(alone)
    return out.select(
        F.col("id").alias(key), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )
