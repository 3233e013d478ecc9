"""Toxicity score: logistic regression on hashed words and word pairs, regularised by counterfactuals.

Labelled sentences that name a group are copied with the name swapped for another one of its kind; the
fit penalises the squared change of the sentence's score, so that naming a group by itself moves a
score little. Features are presences, chosen by chi-square among hashed words and word pairs.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import text as tx
from fleetlens.llm.common import map_arrow

BITS = 20
# Weaker features are left out: about one bucket in seventy gets there by chance.
LEAST_CHI2 = 6.0
# Names of groups; terms in one line are swapped for one another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "straight", "lesbian", "bisexual", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("african", "american", "european", "mexican", "chinese", "indian", "turkish", "polish"),
    ("old", "young", "elderly", "disabled", "blind", "deaf"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("femmes", "hommes", "filles", "garçons"),
    ("mujeres", "hombres", "niñas", "niños"),
)


@dataclass(frozen=True)
class Model:
    # Sorted feature buckets and their weights.
    features: np.ndarray
    weights: np.ndarray
    bias: float


def features_of(column: pa.Array) -> tx.Words:
    """Distinct feature buckets of each text: its words and pairs of neighbouring words."""
    words = tx.hash_words(column)
    out, counts = [np.zeros(0, np.int64)], []
    for at, end in tx.parts(words):
        lo, hi = words.first[at], words.first[end]
        part = tx.Words(words.hashes[lo:hi], words.first[at : end + 1] - lo)
        text = part.text
        paired = text[1:] == text[:-1]
        pairs = tx.mix(part.hashes[:-1] * np.uint64(3) + part.hashes[1:])[paired]
        bucket = np.concatenate((part.hashes, pairs)) >> np.uint64(64 - BITS)
        owner = np.concatenate((text, text[1:][paired])).astype(np.int64)
        both = np.unique((owner << BITS) | bucket.astype(np.int64))
        out.append(both & ((1 << BITS) - 1))
        counts.append(np.bincount(both >> BITS, minlength=end - at))
    first = np.concatenate(([0], *counts)).cumsum() if counts else np.zeros(1, np.int64)
    return tx.Words(np.concatenate(out), first)


def _packed(found: tx.Words) -> list[bytes]:
    data = found.hashes.astype("<i4")
    return [data[a:b].tobytes() for a, b in zip(found.first[:-1], found.first[1:])]


def swapped_sentences(text: str, terms=IDENTITY_TERMS) -> list[tuple[str, str]]:
    """Each sentence that names a group, with each copy that names another group of that kind instead;
    names of other kinds in it stay."""
    out = []
    for sentence in re.split(r"(?<=[.!?])\s+|\n+", text):
        for group in terms:
            pattern = _names((group,))
            if not pattern.search(sentence):
                continue
            for shift in range(1, len(group)):
                other = dict(zip(group, group[shift:] + group[:shift]))
                out.append((sentence, pattern.sub(lambda m: other[m[0].lower()], sentence)))
    return out


def _drawn(pairs: list[tuple[str, str]], most: int) -> list[tuple[str, str]]:
    """At most so many pairs, those of the least digests."""
    return sorted(pairs, key=lambda p: zlib.crc32("\0".join(p).encode()))[:most] if len(pairs) > most else pairs


@cache
def _names(terms) -> re.Pattern:
    names = sorted((re.escape(name) for group in terms for name in group), key=len, reverse=True)
    return re.compile(rf"(?<!\w)(?:{'|'.join(names)})(?!\w)", re.IGNORECASE)


def learn(
    documents: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    fit_bytes: int = 32_000_000,
    n_features: int = 4096,
    counterfactual: float = 1.0,
    terms=IDENTITY_TERMS,
    text_pairs: int = 16,
) -> Model:
    """Fit on a bounded sample of labelled texts: about ``fit_bytes`` bytes of whole texts, drawn by a
    hash of the key, or all if there are fewer; ``text_pairs`` swapped sentences of a text at most, drawn by a hash too.

    Rows without text, key or label teach nothing; a label other than 0 counts as 1; a key labelled
    more than once takes the larger label; repeated rows of a document each count. Without both classes the model scores every text alike, by
    the share of the class.
    """
    marked = labels.select(F.col(key).alias("key"), (F.col(label) != 0).cast("int").alias("label"))
    marked = marked.where("key is not null and label is not null")
    marked = marked.groupBy("key").agg(F.max("label").alias("label"))
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    # Sizes meet the labels without the texts, and only drawn texts meet them at all.
    sizes = rows.select("key", F.octet_length("text").alias("bytes")).join(marked, "key")
    total = sizes.agg(F.sum("bytes")).first()[0] or 1
    draw = F.pmod(F.xxhash64(F.col("key")), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.where(draw < min(1.0, fit_bytes / total)).join(marked, "key").select("label", "text")
    pattern = _names(terms)

    def encode(batch: pa.RecordBatch) -> dict:
        label_, texts = batch.column(0).to_pylist(), batch.column(1)
        packed = _packed(features_of(texts))
        named = (t for t in texts.to_pylist() if pattern.search(t))
        pairs = [p for t in named for p in _drawn(swapped_sentences(t, terms), text_pairs)]
        kinds = label_ + [2, 3] * len(pairs)
        if pairs:
            packed += _packed(features_of(pa.array([s for pair in pairs for s in pair])))
        return {"kind": kinds, "features": packed}

    sample = map_arrow(rows, encode, "kind int, features binary").toArrow()
    kind = sample["kind"].to_numpy()
    found = [np.frombuffer(x.as_buffer(), "<i4") for x in sample["features"]]
    texts = [(found[i], kind[i]) for i in range(len(found)) if kind[i] < 2]
    # Both sentences of a pair follow each other in their batch.
    pairs = [(found[i], found[i + 1]) for i in range(len(found)) if kind[i] == 2]
    return _fit(texts, pairs, n_features, counterfactual)


def _matrix(rows: list[np.ndarray], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the chosen features in each row, and the row of each."""
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = np.concatenate(rows).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.searchsorted(features, flat)
    hit = features[np.minimum(at, len(features) - 1)] == flat if len(features) else flat < 0
    return at[hit], owner[hit]


def _fit(texts, pairs, n_features, counterfactual, steps=400, ridge=2e-5) -> Model:
    y = np.array([label for _, label in texts], dtype=np.float64)
    empty = np.zeros(0, np.int64)
    if not len(y) or y.min() == y.max():
        rate = y.mean() if len(y) else 0.5
        return Model(empty, np.zeros(0), float(np.log((rate + 1e-3) / (1 - rate + 1e-3))))
    size = 1 << BITS
    toxic = np.bincount(np.concatenate([f for f, t in texts if t] or [empty]), minlength=size)
    clean = np.bincount(np.concatenate([f for f, t in texts if not t] or [empty]), minlength=size)
    seen, n1, n = toxic + clean, y.sum(), len(y)
    expected = seen * n1 / n
    spread = expected * (1 - n1 / n) * np.maximum(1 - seen / n, 1e-9)
    score = np.where(seen >= 5, (toxic - expected) ** 2 / np.maximum(spread, 1e-9), 0)
    order = np.lexsort((np.arange(size), -score))[:n_features]
    features = np.sort(order[score[order] >= LEAST_CHI2])
    k = len(features)
    col, row = _matrix([f for f, _ in texts], features)
    left, left_row = _matrix([a for a, _ in pairs], features)
    right, right_row = _matrix([b for _, b in pairs], features)
    weights, bias = np.zeros(k), float(np.log(n1 / (n - n1)))
    # Diagonal curvature bounds make one step size fit rare and frequent features.
    width = np.bincount(row, minlength=n)
    curve = 0.25 * np.bincount(col, weights=width[row] + 1.0, minlength=k) / n + ridge
    if pairs:
        many = np.bincount(left_row, minlength=len(pairs)) + np.bincount(right_row, minlength=len(pairs))
        for c, r in ((left, left_row), (right, right_row)):
            curve += counterfactual * np.bincount(c, weights=many[r], minlength=k) / len(pairs)
    bias_curve = 0.25 * (width.mean() + 1)
    ahead, ahead_bias, t = weights.copy(), bias, 1.0
    for _ in range(steps):
        z = np.bincount(row, weights=ahead[col], minlength=n) + ahead_bias
        gap = (1 / (1 + np.exp(-z)) - y) / n
        grad = np.bincount(col, weights=gap[row], minlength=k) + ridge * ahead
        if pairs:
            change = np.bincount(left_row, weights=ahead[left], minlength=len(pairs))
            change = change - np.bincount(right_row, weights=ahead[right], minlength=len(pairs))
            change = change * counterfactual / len(pairs)
            grad += np.bincount(left, weights=change[left_row], minlength=k)
            grad -= np.bincount(right, weights=change[right_row], minlength=k)
        new, new_bias = ahead - grad / curve, ahead_bias - gap.sum() / bias_curve
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - weights)
        ahead_bias = new_bias + (t - 1) / t_new * (new_bias - bias)
        weights, bias, t = new, new_bias, t_new
    return Model(features, weights, float(bias))


def scores_of(column: pa.Array, model: Model) -> np.ndarray:
    weight = np.zeros(1 << BITS)
    weight[model.features] = model.weights
    found = features_of(column)
    z = tx.sums(weight[found.hashes], found.first) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(
    documents: DataFrame, model: Model, text: str = "text", keys: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The given key columns plus score (0 to 1) and predicted (1 if the score is 0.5 or more).

    A null text counts as empty and gets the score of the bias alone. Every row gets one; columns
    other than the keys and the text are not read.
    """
    rows = documents.select(*keys, F.col(text).alias("_text"))
    share = documents.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        value = scores_of(batch.column(len(keys)), share.value)
        out = {name: batch.column(i) for i, name in enumerate(keys)}
        return out | {"score": value, "predicted": (value >= 0.5).astype(np.int32)}

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_arrow(rows, run, f"{fields}, score double, predicted int")
