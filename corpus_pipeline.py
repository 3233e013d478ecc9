"""A corpus pipeline in five stages over ``documents``; each stage's result is written as Parquet and
reread as the next one's input.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with their columns; the last one
returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import bagminhash, decontaminate, langid, packing, pii
from fleetlens.llm.common import bucket_of, row_key, stored, table
from fleetlens.llm.tokens import word_vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told: those without a letter, a null text too. Mixtures stay."""
    model = langid.learn(docs.where(bucket_of(F.col("doc_id"), 4) != 2))
    if not model.languages:
        return docs.where(langid.has_letter(F.col("text")))
    judged = docs.withColumn("_language", langid.judged(docs, model))
    kept = judged.where(F.col("_language.lang_pred") != langid.UNDETERMINED)
    return kept.select(*docs.columns)


def _keyed(docs: DataFrame) -> DataFrame:
    """``_key``: the id, or for rows without one a number above all ids from the values of the row."""
    own = F.xxhash64(row_key(*(F.col(c) for c in docs.columns)))
    own = own.bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("bigint"), own))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group. Of rows with the same id the one with the least text is compared and
    stays; rows without an id are documents of their own."""
    rows = _keyed(docs)
    # Equal rows without an id are copies if they have a word.
    several = rows.where(F.col("doc_id").isNotNull() | F.col("text").rlike("[A-Za-z0-9]|[^\\x00-\\x7f]"))
    once = several.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1")
    twice = stored(once.select("_key"), "repeated")
    if not twice.isEmpty():
        least = several.join(twice, "_key", "left_semi")
        key = row_key(*(F.col(c) for c in docs.columns))
        first = least.groupBy("_key").agg(F.min_by(F.struct(*docs.columns), F.struct("text", key)).alias("r"))
        rows = rows.join(twice, "_key", "left_anti").unionByName(first.select("r.*", "_key"))
    kept = bagminhash.near_duplicates(rows, key="_key").where("kept").select("_key")
    return rows.join(kept, "_key", "left_semi").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that cover a benchmark item."""
    rows = _keyed(docs)
    found = decontaminate.contaminated(rows, table(spark, sf_dir, "benchmark"), key="_key")
    return rows.join(found.select("_key").distinct(), "_key", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars follows the new text."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return clean.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return packing.pack(docs, word_vocabulary())


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("personal_data", personal_data),
    ("packing", pack),
]

# Signatures, mixtures and packing can't be written in SQL: tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
