"""Language of a text as a mixture: expectation-maximisation over per-word likelihoods.

Each language has a model of hashed byte 4-grams within words. A word's likelihood under a language is
the product over its n-grams; a text is a mixture of languages over its words. EM estimates the
mixture's proportions, and languages stay in a text's set only while they raise the likelihood by more
than a penalty per language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import text as tx
from fleetlens.llm.common import map_arrow, small_batches

UNDETERMINED = "und"
BITS = 16
GRAM = 4
STEPS = 8
# Pseudo-words spread over all languages: keeps the score of a very short text moderate.
PRIOR = 1.0
# Log-likelihood that a further language must add, besides half a log of the number of words.
LANGUAGE_PENALTY = 4.0
# A word's evidence is cut there, so that no single word decides a long text.
MOST_PER_WORD = 12.0


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    # Log-probabilities, one row per n-gram bucket and one column per language.
    log_p: np.ndarray


def word_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each n-gram, the first n-gram of each word, the first word of each text.

    N-grams lie within a word and the space on both sides of it; digits are spaces here.
    """
    data, offsets = tx.texts_of(column)
    letters = tx._IS_WORD.copy()
    letters[ord("0") : ord("9") + 1] = False
    grams, starts, words = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    n = 0
    for at, end in tx.slices(data):
        inside = letters[data[at:end]]
        part = np.zeros(end - at + GRAM, dtype=np.uint32)
        part[1 : 1 + end - at] = np.where(inside, data[at:end], 32)
        part[part == 0] = 32
        code = part[: -GRAM + 1].copy()
        for k in range(1, GRAM):
            code |= part[k : len(part) - GRAM + 1 + k] << np.uint32(8 * k)
        edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(first):
            continue
        # From the space before the word to its last gram: at least one per word.
        count = np.maximum(last - first + 2 - GRAM + 1, 1)
        ends = np.cumsum(count)
        where = np.repeat(first - (ends - count), count) + np.arange(ends[-1])
        mixed = code[where] * np.uint32(0x9E3779B1)
        grams.append((mixed >> np.uint32(32 - BITS)).astype(np.int64))
        starts.append(ends - count + n)
        words.append(first + at)
        n += int(ends[-1])
    at = np.concatenate(words) if words else np.zeros(0, np.int64)
    return (
        np.concatenate(grams),
        np.append(np.concatenate(starts), n),
        np.searchsorted(at, offsets),
    )


def learn(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    fit_chars: int = 3_000_000,
    smoothing: float = 0.5,
) -> Model:
    """Fit the n-gram models on a bounded sample: of each language about ``fit_chars`` characters of
    whole texts, drawn by a hash of the text, or all if it has fewer.

    Rows without a text or a language teach nothing. Without any language the model is empty.
    """
    rows = documents.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where("text is not null and lang is not null and text != ''")
    # One row per language, as the model has: as literals, so that no text is hashed by its language.
    sizes = rows.groupBy("lang").agg((fit_chars / F.sum(F.length("text"))).alias("share")).collect()
    shares = F.create_map(*(F.lit(value) for row in sizes for value in row))
    share = F.element_at(shares, F.col("lang")) if sizes else F.lit(0.0)
    draw = (F.xxhash64("text").bitwiseAND((1 << 30) - 1)) / float(1 << 30)
    drawn = rows.where(draw < share).select("lang", "text")

    def count(batch: pa.RecordBatch) -> dict | None:
        langs = batch.column(0).dictionary_encode()
        out = {"lang": [], "bucket": [], "n": []}
        for i, name in enumerate(langs.dictionary.to_pylist()):
            mine = batch.column(1).filter(pa.compute.equal(langs.indices, i))
            counts = np.bincount(word_grams(mine)[0], minlength=1 << BITS)
            seen = np.flatnonzero(counts)
            out["lang"].extend([name] * len(seen))
            out["bucket"].append(seen)
            out["n"].append(counts[seen])
        if not out["lang"]:
            return None
        return out | {k: np.concatenate(out[k]).astype(np.int64) for k in ("bucket", "n")}

    counts = map_arrow(drawn, count, "lang string, bucket bigint, n bigint")
    # One row per language and bucket: bounded by the number of languages.
    found = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    n = np.full((1 << BITS, len(languages)), smoothing)
    which = np.searchsorted(np.array(languages, dtype=object), found["lang"].to_numpy())
    n[found["bucket"].to_numpy(dtype=np.int64), which] += found["n"].to_numpy(dtype=np.float64)
    return Model(languages, np.log(n / n.sum(axis=0)).astype(np.float32))


def _fit(likelihood, first, allowed):
    """EM proportions per text over the languages that ``allowed`` marks, and log-likelihoods."""
    words = np.diff(first)
    text = np.repeat(np.arange(len(words)), words)
    share = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
    prior = PRIOR * allowed / allowed.shape[1]
    for _ in range(STEPS):
        part = likelihood * share[text]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-30)
        share = tx.sums(part, first) + prior
        share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-30)
    level = np.log(np.maximum((likelihood * share[text]).sum(axis=1), 1e-30))
    return share, tx.sums(level, first)


def mixtures(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Per text the proportions of all languages, and of the set chosen by penalised likelihood."""
    grams, starts, first = word_grams(column)
    texts, k = len(first) - 1, len(model.languages)
    free, chosen = np.zeros((texts, k)), np.zeros((texts, k))
    at = 0
    while at < texts:
        # Some texts at a time, so that the tables of words by languages stay small.
        end = int(np.searchsorted(first, first[at] + (1 << 17), side="right")) - 1
        end = min(max(end, at + 1), texts)
        own = first[at : end + 1] - first[at]
        if own[-1]:
            bounds = starts[first[at] : first[end] + 1]
            level = tx.sums(model.log_p[grams[bounds[0] : bounds[-1]]], bounds - bounds[0])
            level = np.maximum(level - level.max(axis=1, keepdims=True), -MOST_PER_WORD)
            free[at:end], chosen[at:end] = _choose(np.exp(level), own)
        at = end
    return free, chosen


def _choose(likelihood, first):
    texts, k = len(first) - 1, likelihood.shape[1]
    words = np.diff(first)
    cost = LANGUAGE_PENALTY + 0.5 * np.log(np.maximum(words, 1))
    allowed = np.ones((texts, k))
    free, level = _fit(likelihood, first, allowed)
    share = free.copy()
    value = level - cost * (k - 1)
    # One language alone is best if even the full likelihood can't pay for a second one.
    best = free.argmax(axis=1)
    alone = np.log(likelihood[np.arange(len(likelihood)), np.repeat(best, words)])
    alone = tx.sums(alone, first)
    single = alone >= level - cost
    share[single] = np.eye(k)[best[single]]
    open_ = np.flatnonzero(~single & (words > 0))
    # Backward steps for the rest: leave out the smallest share while that pays.
    while len(open_):
        out = np.where(allowed[open_] > 0, share[open_], 2).argmin(axis=1)
        trial = allowed[open_].copy()
        trial[np.arange(len(open_)), out] = 0
        some = trial.sum(axis=1) > 0
        open_, trial = open_[some], trial[some]
        if not len(open_):
            break
        rows = np.repeat(first[open_] - np.concatenate(([0], np.cumsum(words[open_])[:-1])), words[open_])
        rows = rows + np.arange(len(rows))
        own = np.concatenate(([0], np.cumsum(words[open_])))
        new, level = _fit(likelihood[rows], own, trial)
        gain = level - cost[open_] * (trial.sum(axis=1) - 1)
        better = gain >= value[open_]
        open_, trial = open_[better], trial[better]
        allowed[open_], share[open_], value[open_] = trial, new[better], gain[better]
    return free, share


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _judge(texts: pa.Array, letter: np.ndarray, model: Model) -> dict[str, list | np.ndarray]:
    """lang_pred, score and langs of some texts."""
    n = len(texts)
    languages = np.array(model.languages, dtype=object)
    if not len(languages):
        return {"lang_pred": [UNDETERMINED] * n, "score": [0.0] * n, "langs": [""] * n}
    free, chosen = mixtures(texts, model)
    best = chosen.argmax(axis=1)
    known = letter & (chosen.sum(axis=1) > 0)
    langs = []
    for row, ok in zip(chosen, known):
        order = [i for i in np.argsort(-row, kind="stable") if ok and row[i] > 0]
        langs.append(",".join(f"{languages[i]}:{row[i]:.3f}" for i in order))
    score = np.clip(free[np.arange(n), best], 0.0, 1.0)
    return {
        "lang_pred": np.where(known, languages[best], UNDETERMINED),
        "score": np.where(known, score, 0.0),
        "langs": langs,
    }


def predict(
    documents: DataFrame, model: Model, text: str = "text", keys: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The given key columns plus lang_pred, score and langs (the chosen set by share, as name:share).

    lang_pred is the language with the largest proportion in the chosen set, score its proportion
    among all languages (0 to 1). A null text, or one without a letter, gives ``und`` with score 0, as
    does an empty model. Repeated rows each get a row; columns other than the keys are not read.
    """
    schema = documents.select(*keys).schema
    rows = documents.select(*keys, has_letter(F.col(text)).alias("_letter"), F.col(text).alias("_text"))
    share = documents.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        letter = batch.column(len(keys)).to_numpy(zero_copy_only=False)
        out = {name: batch.column(i) for i, name in enumerate(keys)}
        return out | _judge(batch.column(len(keys) + 1), letter, share.value)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return map_arrow(rows, run, f"{fields}, lang_pred string, score double, langs string")


def judged(documents: DataFrame, model: Model, text: str = "text") -> Column:
    """``predict`` as a struct column, for filters: only the text goes to Python."""
    small_batches(documents.sparkSession)
    share = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,langs:string>")
    def judge(texts: pa.Array, letter: pa.Array) -> pa.Array:
        found = _judge(texts, letter.to_numpy(zero_copy_only=False), share.value)
        kinds = {"lang_pred": pa.string(), "score": pa.float64(), "langs": pa.string()}
        return pa.StructArray.from_arrays([pa.array(found[k], t) for k, t in kinds.items()], list(kinds))

    return judge(F.col(text), has_letter(F.col(text)))
