"""The pipeline's stages on small made-up documents, and against the operators by hand."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from fleetlens.llm.tokens import pieces, word_vocabulary

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kind string, span int"
EN = "the quick brown fox jumps over the lazy dog and runs far away from here into woods "
DE = "der schnelle braune fuchs springt ueber den faulen hund und rennt weit weg von hier "
ITEM = "benchmark question about seven green apples and nine yellow pears in one wooden box"


def words(seed: int, n: int = 60) -> str:
    return " ".join(f"w{chr(97 + (seed * 31 + i * 7) % 26)}{chr(97 + (seed * 17 + i * i) % 26)}{chr(97 + i % 26)}" for i in range(n))


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = []
    for i in range(20):
        rows.append((i, f"{EN}{words(i)}", "en", "s", 1))
    for i in range(20, 30):
        rows.append((i, f"{DE * 2}{words(i)}", "de", "s", 1))
    rows += [
        (100, rows[3][1], "en", "s", 1),
        (100, rows[3][1], "en", "s", 1),
        (101, rows[4][1] + " end", "en", "t", 1),
        (102, f"{EN} {ITEM} {words(77)}", "en", "s", 1),
        (103, f"{EN} write to a.b@example.com or 10.2.3.4 {words(78)}", "en", "s", 1),
        (104, None, "en", "s", 1),
        (105, "", None, None, None),
        (106, "12 ... 45 !", "en", "s", 1),
        (None, f"{EN}{words(99)}", "en", "s", 1),
        (107, f"{EN}{words(55, 5000)}", "en", "s", 1),
    ]
    rows = [(*r, "x", 1) for r in rows]
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(f"{path}/documents.parquet")
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, "too short")], "item_id bigint, text string")
    bench.write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_decide_and_keep_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    gone = []
    for name, stage in cp.STAGES[:-1]:
        after = cp.stored(stage(spark, docs, sf_dir), name)
        assert after.columns == docs.columns
        before = {r.doc_id for r in docs.collect()}
        gone.append(before - {r.doc_id for r in after.collect()})
        docs = after
    assert gone == [{104, 105, 106}, {100, 101}, {102}, set()]
    clean = docs.where("doc_id = 103").first()
    assert "write to [EMAIL] or [IP] " in clean.text and clean.n_chars == len(clean.text)
    assert docs.where("doc_id is null").count() == 1


def test_pieces_hold_every_id_once(spark, sf_dir):
    pieces_ = cp.run(spark, sf_dir).collect()
    by_doc = {}
    for p in pieces_:
        by_doc.setdefault(p.doc_id, []).append(p)
    assert {103, 107, None} < set(by_doc) and not {100, 101, 102, 104} & set(by_doc)
    encode = pieces(word_vocabulary()).encode
    text = f"{EN}{words(55, 5000)}"
    ids = encode(text) + (2).to_bytes(4, "little")
    mine = sorted(by_doc[107], key=lambda p: p.start)
    assert len(mine) > 1 and sum(p.length for p in mine) == len(ids) // 4 == mine[0].doc_tokens
    for p in mine:
        assert p.ids_crc32 == zlib.crc32(ids[p.start * 4 : (p.start + p.length) * 4])


def test_empty_documents(spark, sf_dir, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert cp.benchmark(spark, docs, str(tmp_path)).count() == docs.count()


def test_rows_of_one_id_become_one(spark, sf_dir):
    docs = spark.createDataFrame(
        [(1, "b " * 9, "en", "s", 1, "x", 1), (1, "a c d e f g h", "en", "s", 1, "x", 1), (2, None, None, None, None, None, None)], SCHEMA
    )
    out = cp.near_duplicates(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in out.collect()) == [1, 2]
    assert out.where(F.col("doc_id") == 1).first().text == "a c d e f g h"


def test_rows_without_an_id_are_checked(spark, sf_dir):
    one, two = EN + words(1), EN + words(2)
    texts = [(1, one), (None, one), (None, two), (None, two), (None, ITEM + " " + words(3)), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 1) for i, t in texts], SCHEMA)
    out = cp.near_duplicates(spark, docs, sf_dir)
    assert out.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, [texts[0], texts[2], *texts[4:]]))
    assert ITEM not in str(cp.benchmark(spark, out, sf_dir).collect()) and cp.benchmark(spark, out, sf_dir).count() == 4


def test_the_compared_text_of_an_id_stays(spark, sf_dir):
    one = EN + words(1)
    docs = [(1, one), *((i, t) for i in range(10, 22) for t in (one, f"a{i} " + words(i)))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 1) for i, t in docs], SCHEMA)
    got = {r.doc_id: r.text for r in cp.near_duplicates(spark, docs, sf_dir).collect()}
    assert got == {1: one} | {i: f"a{i} " + words(i) for i in range(10, 22)}


def test_mixtures_and_short_texts_keep_their_place(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = [(201, f"{EN}{DE}", None, "s", 1, "x", 1), (202, "the", None, "s", 1, "x", 1), (203, "7 !", None, "s", 1, "x", 1)]
    kept = cp.language(spark, docs.unionByName(spark.createDataFrame(more, SCHEMA)), sf_dir)
    assert {r.doc_id for r in kept.where("doc_id > 200").collect()} == {201, 202}
