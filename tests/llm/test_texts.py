"""Operators over texts: edge cases, and brute-force versions on small tables."""

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import bagminhash, decontaminate, langid, packing, pii, tokenstore, toxicity
from fleetlens.llm import text as tx
from fleetlens.llm.common import bucket_of, table
from fleetlens.llm.queries import QUERIES
from fleetlens.llm.tokens import pieces, word_vocabulary
from fleetlens.session import work_dir

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "   \n"), (4, "Hello hello"), (4, "Hello hello"), (None, "x y z"), (5, "é" * 70_000), (6, "1.2.3")]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, SCHEMA)
    # Names that operators use for columns of their own.
    names = ("id", "digest", "bucket", "score", "start", "kind", "spans", "row", "part", "lang")
    return rows.select("*", *(F.lit(1).alias(n) for n in names))


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SF, "documents").select("doc_id", "text", "lang").toPandas()


def shingles_of(text: str) -> Counter:
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())
    runs = [tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))]
    return Counter(runs)


def test_words_do_not_depend_on_slices():
    texts = pa.array(["Ab, cd-ef É1", None, "", "x" * 300, "ab cd EF é1"])
    words = tx.hash_words(texts)
    assert words.counts.tolist() == [4, 0, 0, 1, 4]
    assert words.hashes[:4].tolist() == words.hashes[5:].tolist()
    data, _ = tx.texts_of(texts)
    assert [bytes(data[a:b]) for a, b in tx.slices(data, 4)] and sum(b - a for a, b in tx.slices(data, 4)) == len(data)


def test_signatures_are_unbiased():
    rng, gaps = np.random.default_rng(1), []
    for _ in range(40):
        base = rng.integers(0, 9999, 60).tolist()
        a, b = base + rng.integers(0, 9999, 20).tolist(), base + base[:9] * 3
        one, two = Counter(a), Counter(b)
        text = np.array([0] * len(one) + [1] * len(two))
        shingle = tx.mix(np.array([*one, *two], dtype=np.uint64))
        names = bagminhash.signatures(text, shingle, np.array([*one.values(), *two.values()]), 2)
        gaps.append((names[0] == names[1]).mean() - (one & two).total() / (one | two).total())
    assert abs(np.mean(gaps)) < 0.02 and np.std(gaps) < 0.06


def test_near_duplicates_match_brute_force(spark, documents):
    bags = {d: shingles_of(t) for d, t in zip(documents.doc_id, documents.text) if t}
    index = {}
    for d, bag in bags.items():
        for s in bag:
            index.setdefault(s, set()).add(d)
    label = {d: d for d in documents.doc_id}
    links = set()
    for d, bag in bags.items():
        for e in set().union(*(index[s] for s in bag)) if bag else ():
            if d < e and (bag & bags[e]).total() >= 0.8 * (bag | bags[e]).total():
                links.add((d, e))
    for _ in range(len(label)):
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    got = {r.doc_id: r.class_id for r in QUERIES["op4_near_duplicates"](spark, SF).collect()}
    assert got == label and len(links) > 5


def test_blocks_of_a_cluster_find_the_same_groups(spark, monkeypatch):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join([*base[:k], f"new{k}", *base[k + 1 :]]) for k in range(25)] + ["other text of six words here"]
    rows = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    monkeypatch.setattr(bagminhash, "BLOCK", 4)
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(rows).collect()}
    assert got == {i: 0 if i < 25 else 25 for i in range(26)}


def test_near_duplicates_of_odd_rows(spark, odd):
    got = {r.doc_id: (r.copy_of, r.class_id, r.kept) for r in bagminhash.near_duplicates(odd).collect()}
    assert got == {i: (i, i, True) for i in range(1, 7)}
    assert bagminhash.near_duplicates(odd.limit(0)).count() == 0


def test_tiles_find_reordered_passages():
    item = list(range(30))
    runs = [item[15:] + [99] + item[:15], [7, 7, 7, 7]]
    assert sorted((j, k) for _, _, j, k in decontaminate.tiles(runs, item)) == [(0, 15), (15, 15)]
    assert decontaminate.tiles([[1, 2, 3, 4]], item) == []
    same = [5] * 12
    assert sum(t[3] for t in decontaminate.tiles([[5] * 7], same)) == 7


def test_tiles_take_what_longer_tiles_leave():
    item = list(range(40))
    runs = [item[10:17], item[15:23], [99] * 9]
    assert sorted((j, k) for _, _, j, k in decontaminate.tiles(runs, item)) == [(10, 5), (15, 8)]


def test_contamination(spark, odd):
    item = "one two three four five six seven eight nine ten eleven twelve"
    words = item.split()
    bench = [(1, item), (2, "short item"), (3, None), (4, " ".join(["same"] * 20)), (1, item)]
    docs = [(1, f"x {item.upper()}!"), (2, " ".join(words[6:] + ["and"] + words[:6])), (3, " ".join(words[:7])),
            (4, " ".join(["same"] * 30)), (5, "clean text"), (5, item), (None, item)]
    bench = spark.createDataFrame(bench, "item_id bigint, text string")
    found = decontaminate.contaminated(spark.createDataFrame(docs, SCHEMA), bench)
    assert sorted((r.doc_id, r.item_id, r.n_tiles) for r in found.collect()) == [(1, 1, 1), (2, 1, 2), (4, 4, 1), (5, 1, 1)]
    assert decontaminate.contaminated(odd, bench).count() == 0
    assert decontaminate.contaminated(odd, bench.limit(0)).count() == 0


def test_contamination_against_plain_search(spark, documents):
    def plain(text):
        return " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower()))

    items = table(spark, SF, "benchmark").collect()
    want = {(d, r.item_id) for d, t in zip(documents.doc_id, documents.text) for r in items
            if f" {plain(r.text)} " in f" {plain(t)} " and len(plain(r.text).split()) >= 5}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_decontamination"](spark, SF).collect()}
    assert want <= got and want


def test_languages_of_held_out_documents(spark):
    got = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").where("held_out")
    truth = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    right = got.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_mixed_and_odd_languages(spark, odd, documents):
    rows = spark.createDataFrame(documents.dropna())
    model = langid.learn(rows)
    texts = dict(zip(documents.lang, documents.text))
    mixed = f"{texts['en'][:900]} {texts['de'][:600]}"
    got = langid.predict(spark.createDataFrame([(9, mixed)], SCHEMA), model).first()
    assert got.lang_pred == "en" and [x.split(":")[0] for x in got.langs.split(",")] == ["en", "de"]
    found = {r.doc_id: (r.lang_pred == "und", r.score) for r in langid.predict(odd, model).collect()}
    assert [i for i in (1, 2, 3, 6) if found[i] == (True, 0.0)] == [1, 2, 3, 6] and not found[4][0]
    empty = langid.learn(rows.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {"und"}


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op2_toxicity"](spark, sf).where("held_out")
    rows = got.join(table(spark, sf, "labels"), "doc_id").select("score", "toxic").toPandas()
    bad, fine = rows.score[rows.toxic == 1].to_numpy(), rows.score[rows.toxic == 0].to_numpy()
    assert (bad[:, None] > fine[None]).mean() > 0.95 and (fine >= 0.5).mean() < 0.01


def test_counterfactuals_calm_group_names(spark):
    """Toxic sentences name one group more often; with the penalty naming it moves a score less."""
    rows, labels = [], []
    for i in range(300):
        toxic = i % 3 == 0
        group = "muslim" if toxic == (i % 5 > 0) else "christian"
        rows.append((i, f"the {group} man went home {'idiot' if toxic and i % 2 else ''} number w{i % 7}"))
        labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    pair = pa.array(["a muslim came", "a christian came"])

    def gap(weight):
        score = toxicity.scores_of(pair, toxicity.learn(docs, marks, counterfactual=weight))
        return np.ptp(np.log(score / (1 - score)))

    assert gap(5.0) < 0.3 * gap(0.0)
    turned = [b for _, b in toxicity.swapped_sentences("A gay man. Nothing.")]
    assert "A straight man." in turned and "A gay girl." in turned and len(turned) == 7


def test_counterfactuals_spare_neutral_mentions_in_given_texts(spark):
    """The given labelled texts name no group, so names are planted: half of the toxic texts and few others name one.
    The penalty lowers the share of clean held-out texts that are flagged for naming it."""
    sf = "/root/testdata/sf0.1"
    docs = table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "labels"), "doc_id")
    named = F.when((F.col("toxic") == 1) & (F.col("doc_id") % 2 == 0), " The muslim family sat there.")
    other = F.when((F.col("toxic") == 0) & (F.col("doc_id") % 9 == 0), " The christian family sat there.")
    masked = F.regexp_replace("text", "(?i)\\b(trash|pathetic|idiot|disgusting|worthless|stupid)\\b", "word")
    docs = docs.withColumn("text", F.concat(masked, F.coalesce(named, other, F.lit("")))).cache()
    train, held = docs.where("doc_id % 5 <> 0").select("doc_id", "text"), docs.where("doc_id % 5 = 0 and toxic = 0")
    neutral = held.withColumn("text", F.concat(F.substring("text", 1, 300), F.lit(" The muslim family came home.")))

    def flagged(weight):
        model = toxicity.learn(train, docs.select("doc_id", "toxic"), counterfactual=weight)
        return toxicity.score(neutral, model).agg(F.avg("score"), F.avg("predicted")).first()

    without, with_penalty = flagged(0.0), flagged(20.0)
    assert with_penalty[0] < 0.5 * without[0] and with_penalty[1] <= without[1]


def test_fit_reaches_the_least_of_its_loss():
    """Against plain descent in dense arrays on a small table."""
    rng = np.random.default_rng(0)
    texts = [(np.flatnonzero(rng.random(6) < 0.5).astype("<i4"), int(rng.random() < 0.4)) for _ in range(200)]
    texts = [(f, int(t or 0 in f and rng.random() < 0.6)) for f, t in texts]
    pairs = [(np.array([0, 2], "<i4"), np.array([1, 2], "<i4"))] * 3
    model = toxicity._fit(texts, pairs, 6, 2.0, steps=4000)
    x = np.zeros((200, len(model.features)))
    for i, (f, _) in enumerate(texts):
        x[i] = np.isin(model.features, f)
    y = np.array([t for _, t in texts])
    turn = np.isin(model.features, [0, 2]).astype(float) - np.isin(model.features, [1, 2])

    def loss(w, b):
        z = x @ w + b
        return np.mean(np.log1p(np.exp(z)) - y * z) + 1e-5 * w @ w + (turn @ w) ** 2

    w, b = np.zeros(len(model.features)), 0.0
    for _ in range(20000):
        gap = (1 / (1 + np.exp(-(x @ w + b))) - y) / 200
        w, b = w - 0.1 * (x.T @ gap + 2e-5 * w + 2 * turn * (turn @ w)), b - 0.1 * gap.sum()
    assert len(w) and abs(loss(model.weights, model.bias) - loss(w, b)) < 1e-6


def test_toxicity_of_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.score(odd.limit(0), toxicity.learn(odd.limit(0), none)).count() == 0
    got = toxicity.score(odd, toxicity.learn(odd, none)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)


def test_bucket_of_a_null_key(spark):
    got = spark.createDataFrame([(None,), (12,)], "x bigint").select(bucket_of(F.col("x"), 5)).collect()
    assert [r[0] for r in got] == [0, zlib.crc32(b"12") % 5]


def encoded(text, end):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(word_vocabulary()).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], dtype="<u4")


def test_pieces_equal_the_tokenizer():
    encode = pieces(word_vocabulary()).encode
    for text in ["Don't stop, É1é ß…", "a<|endoftext|>b  c\td\x1ce", "'s 've x'll ###", "漢字 🙂 ﬁ Ａ", ""]:
        assert encode(text) == encoded(text, 0)[:-1].tobytes()


def test_ids_are_written_from_a_table():
    cores = pieces(word_vocabulary()).cores
    assert [cores.ids[i] for i in (0, 258, 49407)] == [i.to_bytes(4, "little") for i in (0, 258, 49407)]
    assert cores["unbelievabletoken"] == encoded("unbelievabletoken", 0)[:-1].tobytes()


def test_packing_of_odd_rows(spark, odd):
    got = packing.pack(odd, word_vocabulary(), length=64, open_windows=2).collect()
    want = Counter((i, len(encoded(t, 2))) for i, t in ODD)
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == want
    texts = {5: dict(ODD)[5], 2: ""}
    for doc, text in texts.items():
        ids = encoded(text, 2)
        mine = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        assert sum(r.length for r in mine) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in mine)
    windows = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in windows.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 64
    assert packing.pack(odd.limit(0), word_vocabulary()).count() == 0


def test_the_best_window_gets_a_piece():
    packer = packing.Packer(0, open_windows=2, length=10)
    for doc, n in enumerate((6, 7, 3, 5)):
        packer.add(doc, bytes(4 * n))
    # 3 fills the window of 7; 5 fits nowhere while only one window is open, so it opens another.
    assert [(r[0], r[2], r[6]) for r in packer.rows] == [(1, 7, 0), (2, 3, 7)]
    packer.add(4, bytes(4 * 8))
    assert [(r[0], r[2]) for r in packer.rows[2:]] == [(0, 6)]


def test_token_store_round_trip(spark, odd):
    path = work_dir(spark, "store")
    tokenstore.write(odd, path, word_vocabulary(), segment=50)
    got = tokenstore.read(path, spark).orderBy("start").collect()
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for doc, text in order:
        ids = encoded(text, 1)
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    empty = work_dir(spark, "store")
    tokenstore.write(odd.limit(0), empty, word_vocabulary())
    assert tokenstore.read(empty, spark).count() == 0


@pytest.mark.parametrize("n, top", [(1, 1), (7, 7), (500, 10**6), (3000, 10**11), (9000, 9000)])
def test_elias_fano(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top + 1, n))
    packed = tokenstore.EliasFano.encode(values)
    assert (packed.all() == values).all()
    assert all(packed[i] == values[i] for i in range(0, n, max(n // 50, 1)))
    assert 8 * (len(packed.low) + len(packed.high)) <= n * (2 + max(np.log2(max(top / n, 1)), 0) + 1) + 64


def plain_spans(text):
    rules = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, rule in rules.items():
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
            fine = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 13 <= len(digits) <= 19 and luhn % 10 == 0, "phone": 9 <= len(digits) <= 15}
            if fine[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_match_plain_rules(spark):
    rng = np.random.default_rng(4)
    bits = ["a@b.co", "@", ".", "_", "+", "1", "255", "300", " ", "-", "\n", "(", "é", "🙂", "4111 1111 1111 1111",
            "4111111111111111", "+1 (555) 123-4567", "1.2.3.4", "x", "%", "a.b"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 13))) for _ in range(400)] + [None, "", "9" * 9000, "a" * 9000 + "@", "1 " * 4000]
    rows = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    found = pii.annotate(rows, keep=("doc_id",)).select("doc_id", pii.joined("_pii_base").alias("s"))
    assert {r.doc_id: r.s for r in found.collect()} == {i: plain_spans(t or "") for i, t in enumerate(texts)}


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"please call me at +1 (555) 123-{4000 + i} or write to user{i}@ex.com ok") for i in range(12)]
    rows += [(50, "please call me at 0555-778899 now"), (51, "the year is 123456 now"), (52, None), (None, "call me at 0555-778899")]
    got = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[3] == "please call me at [PHONE] or write to [EMAIL] ok"
    assert got[50] == "please call me at [PHONE] now" and got[51] == rows[13][1] and got[52] is None
    assert got[None] == "call me at [PHONE]"


def test_unseen_identifiers_of_other_shapes(spark):
    rows = [(i, f'please call me at +1 (555) 123-{4000 + i} or write to "user{i}@ex.com" ok') for i in range(100, 140)]
    shapes = {
        20: ('please call me at "0555-778899" now', 'please call me at "[PHONE]" now'),
        21: ("please call me at (0555-778900) now", "please call me at ([PHONE]) now"),
        22: ("please call me at <0555-778901>, thanks", "please call me at <[PHONE]>, thanks"),
        23: ("please call me at «0555-778902» now", "please call me at «[PHONE]» now"),
        24: ("please call me at 0555 77 89 03, thanks", "please call me at [PHONE], thanks"),
        25: ("please or write to ann at host dot org today", "please or write to [EMAIL] today"),
        26: ("please or write to [ann.bo(at)host.org] today", "please or write to [[EMAIL]] today"),
        27: ("please or write to ann@localhost, thanks", "please or write to [EMAIL], thanks"),
        28: ("the sum of 12 34 56 and 'abc12345' at home", "the sum of 12 34 56 and 'abc12345' at home"),
    }
    rows += [(i, text) for i, (text, _) in shapes.items()]
    got = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: got[i] for i in shapes} == {i: want for i, (_, want) in shapes.items()}
    assert got[103] == 'please call me at [PHONE] or write to "[EMAIL]" ok'


def test_personal_data_of_odd_rows(spark, odd):
    assert sorted(pii.redact(odd).columns) == sorted(odd.columns)
    assert Counter((r.doc_id, r.text) for r in pii.redact(odd).collect()) == Counter(ODD)
    assert pii.redact(odd.limit(0)).count() == 0


def _longest_first(text, item, least):
    """Greedy string tiling as it is defined: look for the longest free match anew for each tile."""
    free, marks, out = [True] * len(item), [[True] * len(run) for run in text], []
    while True:
        best = None
        for r, run in enumerate(text):
            for i in range(len(run)):
                for j in range(len(item)):
                    k = 0
                    while (
                        i + k < len(run) and j + k < len(item) and run[i + k] == item[j + k]
                        and marks[r][i + k] and free[j + k]
                    ):
                        k += 1
                    if k >= least and (best is None or (-k, j, r, i) < best):
                        best = (-k, j, r, i)
        if best is None:
            return out
        k, j, r, i = -best[0], *best[1:]
        free[j : j + k] = marks[r][i : i + k] = [False] * k
        out.append((r, i, j, k))


def test_tiles_are_those_of_the_definition():
    rng = random.Random(5)
    for _ in range(1500):
        kinds = rng.choice([1, 2, 3, 6])
        text = [[rng.randrange(kinds) for _ in range(rng.randrange(25))] for _ in range(rng.randrange(1, 4))]
        item, least = [rng.randrange(kinds) for _ in range(rng.randrange(22))], rng.choice([2, 3, 5])
        assert decontaminate.tiles(text, item, least) == _longest_first(text, item, least)


def test_a_word_repeated_ten_thousand_times_is_tiled_fast():
    start = time.perf_counter()
    assert decontaminate.tiles([[7] * 10_000], [7] * 1200) == [(0, 0, 0, 1200)]
    assert time.perf_counter() - start < 10


@pytest.mark.parametrize("low, high", [(-(2**63), 2**63 - 1), (0, 50), (-5, 5), (10**12, 10**12 + 10**6)])
def test_segments_round_trip(low, high):
    rng = np.random.default_rng(abs(high) % 1000)
    for n in range(40):
        keys = [None] * int(rng.integers(0, 3)) + sorted(rng.integers(low, high, n, endpoint=True).tolist())
        sizes = rng.integers(1, 5, len(keys))
        ends, ids = np.cumsum(sizes).astype(np.uint64), rng.integers(0, 70_000, int(sizes.sum())).astype("<u4")
        read_keys, bounds, read_ids = tokenstore.read_segment(tokenstore.pack_segment(keys, ends, ids.tobytes()))
        assert read_keys == keys and (read_ids == ids).all()
        assert [bounds[i] for i in range(len(keys))] == ends.tolist() == bounds.all().tolist()
