"""Two tokenizers over the same bytes, and pieces by a table of words, against the libraries on whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.llm import alignment, wordtable
from fleetlens.llm.alignment import Fragment, fragment
from fleetlens.llm.common import table
from fleetlens.llm.queries import QUERIES
from fleetlens.llm.tokens import byte_vocabulary, piece_model

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id string, text string, row int, key string, block int, pair string"
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\n b", "\t x", "▁", "a▁b", " ▁ ", "<s> </s>", "<0x41>", "\x00", "x\x00 y",
       "<|endoftext|> it's", "ﬁ ① Å é", "日本語 テキスト", "😀 😀😀", "a b  c", "'s 's  's", "1234 56  7", "\x1c a", "é" * 40,
       "a" * 3000, "ab " * 50, " " * 70, "\r\n\r\n x"]
words = st.text(st.sampled_from("ab é'1,.\n\t▁😀日 <>|"), max_size=30)


@pytest.fixture(scope="module")
def both():
    return alignment.Tokenizers(byte_vocabulary(), piece_model())


def tokens(both, text):
    """Ids of a whole text by both tokenizers, empty if the bytes differ."""
    if not text:
        return [], []
    a = both.a.encode(" " + text, add_special_tokens=False).ids
    b = wordtable.model(piece_model()).encode(text)
    given = (" " + text).encode()
    same = b"".join(both.a_bytes[i] for i in a) == given == b"".join(both.b_bytes[i] for i in b)
    return (a, b) if same else ([], [])


def plain(both, texts):
    """The contract, token by token and pair by pair."""
    each = []
    for text in texts:
        a, b = tokens(both, text)
        ends = [np.cumsum([len(of[i]) for i in ids]).tolist() for ids, of in ((a, both.a_bytes), (b, both.b_bytes))]
        groups, left, right = [], [], []
        sides = sorted([(e, 0, i) for e, i in zip(ends[0], a)] + [(e, 1, i) for e, i in zip(ends[1], b)])
        common = set(ends[0]) & set(ends[1])
        for at, side, i in sides:
            (right if side else left).append(i)
            if at in common and side:
                groups.append((left, right))
                left, right = [], []
        linked = [(x, y) for g in groups for x in g[0] for y in g[1]]
        said = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups)
        each.append((len(a), len(b), len(groups), linked, hashlib.sha256(said.encode()).hexdigest() if said else ""))
    count = Counter(p for e in each for p in set(e[3]))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return [
        (e[0], e[1], e[2], len(e[3]), sum(count[p] == most[p[0]] for p in e[3]), sum(count[p] for p in e[3]), e[4])
        for e in each
    ]


def rows(frame):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return {r.doc_id: tuple(r[n] for n in names) for r in frame.collect()}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=30), st.lists(st.integers(1, 4), max_size=30), st.integers(0, 200))
def test_fragments_form_a_monoid(left, right, seed):
    """Any cut into ranges and any order of joining gives the groups of the whole."""
    rng = random.Random(seed)
    a, b = np.cumsum(left, dtype=np.int64), np.cumsum(right, dtype=np.int64)
    a_ids, b_ids = np.arange(len(a)), 100 + np.arange(len(b))
    whole = fragment(a_ids.tolist(), a.tolist(), b_ids.tolist(), b.tolist())
    cuts = sorted(rng.sample(range(130), rng.randint(0, 6)))
    parts = []
    for low, high in zip([-1, *cuts], [*cuts, 200]):
        x, y = (a > low) & (a <= high), (b > low) & (b <= high)
        parts.append(fragment(a_ids[x].tolist(), a[x].tolist(), b_ids[y].tolist(), b[y].tolist()))
    assert sum(parts, Fragment()) == whole
    while len(parts) > 1:
        at = rng.randrange(len(parts) - 1)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    assert parts == [whole] == [Fragment() + whole] == [whole + Fragment()]


@settings(max_examples=200, deadline=None)
@given(words)
def test_words_encode_like_whole_texts(both, text):
    parts = alignment.safe_words(text)
    if text:
        assert " ".join(parts) == text
        a = [i for one in both.encode(parts) for i in one[0]]
        b = [i for one in both.encode(parts) for i in one[1]]
        assert a == both.a.encode(" " + text, add_special_tokens=False).ids
        if wordtable.MARK not in text:
            assert b == wordtable.model(piece_model()).encode(text)
    marked = wordtable.segment(wordtable.marked_words(text), piece_model())
    assert [i for one in marked for i in one] == wordtable.model(piece_model()).encode(text)


def long_texts():
    rng = random.Random(4)
    bits = ["word", "Wort,", "日本", "é\n", "x  y", "123456", "naïve—dash", "😀", "a" * 40, "unbelievable", "\t", "I'll"]
    out = [" ".join(rng.choices(bits, k=n)) for n in (40, 300, 3000)]
    return [*out, "ab" * 4000, "日本語" * 900, "x " * 2000, " " * 5000, "long▁mark " * 400, "a\n" * 3000]


def test_alignment_equals_the_plain_one(spark, both):
    texts = [None, *ODD, *long_texts(), long_texts()[0], "a"]
    data = [(f"t{i}", t, 1, "k", 2, "p") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(data, DOCUMENTS)
    whole, met = alignment.align(frame, byte_vocabulary(), piece_model(), width=256, segment=700)
    counts = alignment.pair_counts(met)
    sums = met.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("n")).alias("count_sum")
    )
    got = rows(whole.join(sums, "row", "left").fillna(0, ["n_best", "count_sum"]))
    want = plain(both, texts)
    assert {i: got[f"t{i}"] for i in range(len(texts))} == dict(enumerate(want))
    assert rows(alignment.agreement(frame, byte_vocabulary(), piece_model())) == got


def test_alignment_of_odd_tables(spark, monkeypatch, both):
    frame = spark.createDataFrame([(None, "a b", 1, "", 1, ""), (None, "a b", 1, "", 1, ""), ("x", None, 1, "", 1, "")], DOCUMENTS)
    assert alignment.agreement(frame.limit(0), byte_vocabulary(), piece_model()).count() == 0
    monkeypatch.setattr(alignment, "MOST_BROADCAST", 0)
    got = alignment.agreement(frame, byte_vocabulary(), piece_model()).collect()
    assert sorted((r.doc_id or "", r.n_links, r.count_sum) for r in got) == [("", 2, 4), ("", 2, 4), ("x", 0, 0)]


def test_the_alignment_query(spark, both):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    got = rows(QUERIES["op12_tokenizer_alignment"](spark, SF))
    assert got == dict(zip([d.doc_id for d in docs], plain(both, [d.text for d in docs])))


def expected(text):
    loaded = wordtable.model(piece_model())
    ids = [*loaded.encode(text or ""), 2]
    return ids, loaded.decode(ids)


def test_pieces_of_odd_texts(spark, monkeypatch):
    texts = [None, *ODD, *long_texts(), "a", "a"]
    frame = spark.createDataFrame([(f"t{i}" if i else None, t, 1, "k", 2, "p") for i, t in enumerate(texts)], DOCUMENTS)
    monkeypatch.setattr(wordtable, "SLICE_WORDS", 40)
    for chars in (wordtable.BLOCK_CHARS, 50):
        monkeypatch.setattr(wordtable, "BLOCK_CHARS", chars)
        found = wordtable.decode(wordtable.encode(frame.repartition(3), piece_model()), piece_model())
        got = {r.doc_id: (r.ids, r.decoded) for r in found.collect()}
        assert got == {f"t{i}" if i else None: expected(t) for i, t in enumerate(texts)}
    assert wordtable.decode(wordtable.encode(frame.limit(0), piece_model()), piece_model()).count() == 0


def test_the_piece_query(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_piece_encoding"](spark, SF).collect()}
    for d in docs:
        ids, text = expected(d.text)
        said = " ".join(map(str, ids))
        digests = (hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        assert got[d.doc_id] == (len(ids), *digests)
    assert len(got) == len(docs)
