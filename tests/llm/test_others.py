"""Conversations, pages and vectors: edge cases, and brute-force versions on small tables."""

import hashlib
import random
import time

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from fleetlens.llm import chat, linedensity, vectorgraph
from fleetlens.llm.common import table
from fleetlens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, id int, x string"
TURNS = "conv_id bigint, turn bigint, role string, text string, example string"


def test_turns_are_read_back_exactly():
    rng = random.Random(1)
    bits = ["\\", "#", "##", "###", "</turn>", "\n", "a", "n", "<", "/", " ", "### Assistant:", "é"]
    for _ in range(2000):
        role, text = ("".join(rng.choices(bits, k=rng.randint(0, 9))) for _ in range(2))
        written, start = chat.format_turn(role, text)
        assert chat.parse(written + written) == [(role, text)] * 2
        assert chat.unescape(written[start : -len("\n</turn>\n")]) == text


def test_every_reply_becomes_an_example(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "### a"), (1, 2, "user", None), (1, 3, "assistant", "b\\"),
            (1, 4, "user", "bye"), (2, 0, "user", "alone"), (None, None, None, None), (3, 1, "assistant", "z"),
            (3, 1, "assistant", "z")]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], TURNS)
    got = chat.expand(turns).orderBy("conv_id", "example").collect()
    one = [r for r in got if r.conv_id == 1]
    assert [r.text[r.loss_start : r.loss_end] if r.loss_start else None for r in one] == ["\\### a", "b\\\\", None]
    assert [len(chat.parse(r.text)) for r in one] == [2, 4, 5] and [r.last for r in one] == [False, False, True]
    digest = {r.conv_id: r for r in chat.digests(chat.expand(turns)).collect()}
    assert (digest[1].n_turns, digest[1].loss_chars) == (5, 7)
    assert digest[1].loss_sha256 == hashlib.sha256(b"### ab\\").hexdigest()
    assert (digest[2].loss_chars, digest[3].loss_chars, digest[None].n_turns) == (0, 2, 1)
    assert chat.digests(chat.expand(turns.limit(0))).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == ""


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav><div class="cookie-notice"><p>%s</p></div>
<article><h1>Head &amp; line</h1><p>One&nbsp; <b>two</b>three<br>four<p>short<div class=ad>buy now</div><ul><li>item &lt;1&gt;</ul>
<form><p>mail</p><input name=q></form><!-- note --></article><aside>%s</aside>
<section id="comments"><p>%s</p></section><footer>end</footer></body></html>""".replace("%s", "many words " * 40)


def test_main_text_of_a_marked_page():
    assert linedensity.main_text(PAGE) == "Head & line\n\nOne twothree four\n\nshort\n\nitem <1>"


def test_main_text_of_an_unmarked_page():
    page = PAGE.replace("<article>", "<div>").replace("</article>", "</div>").replace("four", "four " * 30)
    assert linedensity.main_text(page).startswith("Head & line\n\nOne twothree four four")
    assert "many words" not in linedensity.main_text(page) and "Site" not in linedensity.main_text(page)


LONG = [f"Paragraph {i} of the main text says " + "something of some length " * 12 for i in range(6)]


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize("start", ["post comments-open", "comments-open", "entry comments-closed"])
def test_a_state_of_comments_is_no_comment(start):
    page = f"<body><div class='{start}'>" + "".join(f"<p>{t}</p>" for t in LONG) + "</div></body>"
    assert linedensity.main_text(page) == "\n\n".join(map(str.strip, LONG))


def test_reader_comments_go_with_or_without_a_class():
    text = "".join(f"<p>{t}</p>" for t in LONG)
    reply = "<p>I liked this a lot and will surely come back for more of it soon.</p>" * 3
    for start in ("<div class='comments'>", "<section><h2>Reader comments</h2>", "<div><h3>3 replies</h3>"):
        end = f"</{start[1:start.index('>')].split()[0]}>"
        page = f"<body><article>{text}</article>{start}{reply}{end}</body>"
        assert linedensity.main_text(page) == "\n\n".join(map(str.strip, LONG))


def test_quotes_count_in_values_only():
    page = "<body><p title=it's>" + LONG[0] + "</p><p alt=\"a > b\">" + LONG[1] + "</p><p>it's 1 < 2</p></body>"
    got = linedensity.main_text(page)
    assert got == "\n\n".join([LONG[0].strip(), LONG[1].strip(), "it's 1 < 2"])


@pytest.mark.parametrize("bit", ["<a ", '<a x="', '<a =">="', "<", "<a x='>", "<script>", "<!--", "<p>", "</", "&"])
def test_a_megabyte_of_broken_markup_is_read_once(bit):
    start = time.perf_counter()
    linedensity.main_text(bit * (10**6 // len(bit)))
    assert time.perf_counter() - start < 20


def test_teaser_articles_do_not_hide_the_main_text():
    cards = "".join(f"<article><h3><a href=x>Card {i}</a></h3><p>A teaser of a few words.</p></article>" for i in range(8))
    page = f"<body><div class=story><h1>Head</h1>{paragraphs(LONG)}</div><div>{cards}</div></body>"
    assert linedensity.main_text(page) == "\n\n".join(["Head", *map(str.strip, LONG)])


def test_given_pages_without_marks(spark):
    import re

    for r in table(spark, SF, "pages").collect():
        plain = re.sub(r"(</?)(?:article|main)\b", r"\1div", r.html)
        assert linedensity.main_text(plain) == linedensity.main_text(r.html) != ""


@pytest.mark.parametrize("inline", ["<div class=ad>buy</div>", "<div id=notice>note</div>", "<form>mail <input></form>"])
def test_parts_beside_an_inline_container_stay(inline):
    for before, after in (("<div class=content>", "</div>"), ("<article>", "</article>"), ("", "")):
        page = f"<body>{before}<h2>Start</h2>{inline}{paragraphs(LONG)}{inline}<p>The end.</p>{after}<footer>f</footer></body>"
        assert linedensity.main_text(page) == "\n\n".join(["Start", *map(str.strip, LONG), "The end."])


def test_link_lines_between_kept_lines_stay():
    page = f"<body><ul><li><a href=a>Menu</a></ul><div>{paragraphs(LONG[:3])}<p><a href=x>See this page</a></p>{paragraphs(LONG[3:])}</div></body>"
    assert linedensity.main_text(page) == "\n\n".join([*map(str.strip, LONG[:3]), "See this page", *map(str.strip, LONG[3:])])


@pytest.mark.parametrize("start", ["<div class='content has-sidebar'>", "<article class='post category-social'>", "<div class=widget>", "<article class='post social'>"])
def test_a_hint_does_not_drop_the_main_text(start):
    page = f"<body><div class=sidebar><p>Other things</p></div>{start}{paragraphs(LONG)}</{start[1:].split()[0]}><div class=ad>buy</div></body>"
    assert linedensity.main_text(page) == "\n\n".join(map(str.strip, LONG))


def test_hinted_boilerplate_goes():
    comments = "<div id=comments>" + paragraphs(LONG * 3) + "</div>"
    related = "<div class='content related'>" + "<p><a href=x>Some other page with a long title</a></p>" * 9 + "</div>"
    page = f"<body><div class=post>{paragraphs(LONG[:2])}</div>{related}{comments}</body>"
    assert linedensity.main_text(page) == "\n\n".join(map(str.strip, LONG[:2]))


def test_surge_and_dive():
    assert linedensity.stretches([0, 0, 5, 0, 9, 0, 0, 0, 4, 0]) == [(2, 5, 14), (8, 9, 4)]


def test_odd_pages(spark):
    pages = ["", None, "plain  text", "<p>1 < 2</p>", "<p>a<!-- open", "<div class=ad>x</div>", "<p>" + "w " * 50_000, "</p></div>", "<nav>n"]
    rows = spark.createDataFrame([(i, "u", p, "clash") for i, p in enumerate(pages)], "page_id bigint, url string, html string, text string")
    got = {r.page_id: r.text for r in linedensity.extract(rows).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 4, 5, 7, 8)] == ["", "", "plain text", "1 < 2", "a", "", "", ""]
    assert len(got[6]) == 99_999 and linedensity.extract(rows.limit(0)).count() == 0


def test_articles_of_the_given_pages(spark):
    import html
    import re

    pages = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    for r in QUERIES["op10_main_text"](spark, SF).collect():
        article = pages[r.page_id].split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def brute(ids, x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    label = np.array(ids)
    for _ in ids:
        label = np.where(near, label[None, :], label.max()).min(axis=1)
    return {i: (int(n) - 1, int(c)) for i, n, c in zip(ids, near.sum(axis=1), label)}


@pytest.mark.parametrize("block", [1500, 90])
def test_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectorgraph, "MOST_IN_BLOCK", block)
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(200, 16)), *(rng.normal(size=16) + 0.25 * rng.normal(size=(n, 16)) for n in (150, 20, 3))])
    x[5] = x[4]
    rows = spark.createDataFrame([(i + 1, v.tolist(), 0, "") for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, id int, x string")
    want = brute(list(range(1, len(x) + 1)), x)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectorgraph.near_vectors(rows).collect()}
    found, true = (sum(v[0] for v in d.values()) for d in (got, want))
    assert found >= 0.98 * true and all(got[i][0] <= want[i][0] for i in want)
    assert np.mean([got[i] == want[i] for i in want]) > 0.95


def vectors_of(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, x array<double>")


def pairs_of(x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    return sorted((int(a), int(b)) for a, b in np.argwhere(np.triu(unit @ unit.T >= 0.9, 1)))


def test_the_audit_sees_pairs_beside_a_dense_ball(spark):
    rng = np.random.default_rng(4)
    ball = rng.normal(size=64) + 0.01 * rng.normal(size=(80, 64))
    single = rng.normal(size=(30, 64))
    x = np.concatenate([ball, single, single + 0.01 * rng.normal(size=(30, 64))])
    vectors, true = vectors_of(spark, x), pairs_of(x)
    assert len(true) == 80 * 79 // 2 + 30
    for links, least, most in ((true, 1, 1), (true[:-30], 0, 0.1), (true[-30:], 0, 0.1)):
        assert least <= vectorgraph.audit(vectors, spark.createDataFrame(links, "a bigint, b bigint")) <= most


def test_the_audit_looks_for_rare_links(spark, monkeypatch):
    monkeypatch.setattr(vectorgraph, "ASKED", 200)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 32))
    x[2999] = x[0] + 0.01 * rng.normal(size=32)
    vectors = vectors_of(spark, x)
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert vectorgraph.audit(vectors, none) == 0
    assert vectorgraph.audit(vectors, spark.createDataFrame([(0, 2999)], "a bigint, b bigint")) == 1


def test_all_vectors_are_compared_where_the_graph_finds_too_little(spark, monkeypatch):
    import pandas as pd

    nothing = lambda frame: pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype=object)})
    monkeypatch.setattr(vectorgraph, "_searched", nothing)
    monkeypatch.setattr(vectorgraph, "OVERLAPS", (1,))
    monkeypatch.setattr(vectorgraph, "MOST_ASKED", 50)
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(100, 16)), *(rng.normal(size=16) + 0.25 * rng.normal(size=(n, 16)) for n in (40, 5, 2))])
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectorgraph.near_vectors(vectors_of(spark, x).toDF("vec_id", "embedding")).collect()}
    assert got == brute(list(range(len(x))), x)


def test_odd_vectors(spark):
    nan, big = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [1.0, 0.0], [2.0, 0.0], None, [], [0.0, 0.0], [nan, 1.0], [big, 0.0], [None, 1.0], [1.0, 0.0, 0.0], [1e-30, 1e-30]]
    rows = spark.createDataFrame([(i, v, 1, "c") for i, v in enumerate(vectors)] + [(None, [1.0, 0.0], 1, "c"), (0, [1.0, 0.0], 1, "c")], VECTORS)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectorgraph.near_vectors(rows).collect()}
    assert [got[i] for i in (0, 1, 2)] == [(2, 0, True), (2, 0, False), (2, 0, False)]
    assert all(got[i] == (0, i, True) for i in range(3, 11))
    assert vectorgraph.near_vectors(rows.limit(0)).count() == 0


def test_every_vector_has_a_row(spark):
    got = QUERIES["op9_near_vectors"](spark, SF)
    assert got.count() == table(spark, SF, "embeddings").count()
    assert got.where(F.col("kept") != (F.col("vec_id") == F.col("component_id"))).count() == 0
