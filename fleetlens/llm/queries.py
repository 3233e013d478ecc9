"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import (
    alignment,
    bagminhash,
    chat,
    decontaminate,
    langid,
    linedensity,
    packing,
    pii,
    tokenstore,
    toxicity,
    vectorgraph,
    whitening,
    wordtable,
)
from fleetlens.llm.common import bucket_of, table
from fleetlens.llm.tokens import byte_vocabulary, piece_model, word_vocabulary
from fleetlens.session import work_dir

# Fixed value: a conversation whose texts hold the template's own control strings.
CONTROL_CONVERSATION = -7
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = [(CONTROL_CONVERSATION, i, role, CONTROL_TEXT) for i, role in enumerate(("user", "assistant"))]
    more = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.expand(given.unionByName(more)))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = bucket_of(F.col("doc_id"), 5) == 0
    model = toxicity.learn(documents.where(~held_out), table(spark, sf_dir, "labels"))
    return toxicity.score(documents.withColumn("held_out", held_out), model, keys=("doc_id", "held_out"))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def packing_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_vocabulary())


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = bucket_of(F.col("doc_id"), 4) == 2
    model = langid.learn(documents.where(~held_out))
    rows = documents.select("doc_id", held_out.alias("held_out"), "text")
    return langid.predict(rows, model, keys=("doc_id", "held_out"))


def token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-store")
    tokenstore.write(table(spark, sf_dir, "documents"), path, word_vocabulary())
    return tokenstore.read(path, spark)


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.annotate(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=("doc_id",))
    kinds = [_count(kind) for kind in pii.KINDS]
    base, spans = pii.joined("_pii_base"), pii.joined("_pii_spans")
    return found.select("doc_id", *kinds, F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


def _count(kind: str):
    own = F.filter("_pii_base", lambda s: s["kind"] == kind)
    return F.size(own).cast("bigint").alias(f"n_{kind}")


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorgraph.near_vectors(table(spark, sf_dir, "embeddings"))


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedensity.extract(table(spark, sf_dir, "pages"))


def whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.agreement(table(spark, sf_dir, "documents"), byte_vocabulary(), piece_model())


def piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = wordtable.encode(table(spark, sf_dir, "documents"), piece_model())
    both = wordtable.decode(encoded, piece_model())
    said = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(said, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_chat_formatting": chat_formatting,
    "op2_toxicity": toxicity_scores,
    "op3_decontamination": benchmark_decontamination,
    "op4_near_duplicates": near_duplicates,
    "op5_packing": packing_pieces,
    "op6_language_id": languages,
    "op7_token_store": token_store,
    "op8_personal_data": personal_data,
    "op9_near_vectors": near_vectors,
    "op10_main_text": main_texts,
    "op11_whitening": whitened_vectors,
    "op12_tokenizer_alignment": tokenizer_alignment,
    "op13_piece_encoding": piece_round_trip,
}

# The other operators' results can't be written in SQL, so each is tested against a brute-force version.
ORACLE = {
    "op1_chat_formatting": """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
written AS (
  SELECT *, '### ' || replace(regexp_replace(role, '(\\\\|###|</turn>)', '\\\\\\1', 'g'), chr(10), '\\n') || chr(10)
         || regexp_replace(text, '(\\\\|###|</turn>)', '\\\\\\1', 'g') || chr(10) || '</turn>' || chr(10) AS w
  FROM turns),
placed AS (
  SELECT *, sum(length(w)) OVER t AS upto,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back
  FROM written WINDOW t AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' OR back = 1 THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id"""
}
