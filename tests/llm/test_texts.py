"""HTML extraction, chat formatting and the pipeline."""

import hashlib
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from dimweave.llm import chat, html_text, queries

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var x = "</p><article>no</article>";</script></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie-notice">We use cookies and a long text about them that goes on and on.</div>
<article><header><h1>Head &lt;line&gt;</h1></header><p>First &amp;amp; <b>bold</b>
 text.<br>Next&nbsp;line</p><!-- <p>no</p> --><div class="ad">Buy now</div><p>Short.<p>Unclosed <a href="x">linked words</a> here
<form><input value="no"><button>Send</button></form><aside>Also read this long piece of text about something else</aside>
<ul><li>item one</li><li>item two</li></ul><section class="comments"><p>A reader's comment, quite long, about all and everything.</p></section></article>
<div id="sidebar"><p>Some more words that are not the article at all, in a sidebar.</p></div><footer>&copy; me</footer></body></html>"""


@pytest.fixture(scope="module")
def paths(spark):
    return html_text.train(spark)


def test_article_of_a_page(paths):
    assert html_text.main_text(PAGE, paths).split("\n\n") == ["Head <line>", "First &amp; bold text. Next line", "Short.", "Unclosed linked words here", "item one", "item two"]


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain words only, without any tag at all but enough of them to be a paragraph", "plain words only, without any tag at all but enough of them to be a paragraph"),
    ("<article><p>a < b and c</article>", "a < b and c"), ("<article>x<!-- never closed <p>y", "x"), ("<article><p title='a>b'>t</p></ARTICLE><p>no", "t"),
    ("<div class=ad><article><p>in", "in"), ("<script>never closed <article>x</article>", ""), ("<main><p>one</p><nav>no</nav></main><p>no</p>", "one"),
    ("<article><p>a<span class='advert'>no</span>b</p></article>", "ab"), ("<article>&#233;&eacute;&notanentity; &#x1F600;</article>", "éé¬anentity; \U0001f600"),
])
def test_odd_pages(paths, page, text):
    assert html_text.main_text(page, paths) == text


def test_every_labelled_block_is_learned(paths):
    import numpy as np

    rows = np.array(html_text.LABELLED, float)
    assert (html_text.is_main(rows[:, :-1], paths) == (rows[:, -1] == 1)).all()


def test_pages_of_plain_divs_are_decided_by_neighbours(paths):
    """No element says what it is for: a short line is text between paragraphs, and is none beside links or at the end."""
    used = {html_text.FEATURES[column] for path in paths for column, *_ in path}
    assert used & {"words_before", "words_after", "links_before", "links_after"}
    long = ["one " * 60, "two " * 45, "three " * 30]
    page = ("<div><div class=x1><a href=a>Home</a></div><div><a href=b>News</a></div><div>Thursday</div><div class=x2><div>" + long[0] + "</div><div>A short heading</div><div>"
            + long[1] + "</div><div>Another</div><div>" + long[2] + "</div></div><div>Five words at the end</div><div><a href=c>More like this</a></div></div>")
    assert html_text.main_text(page, paths).split("\n\n") == [long[0].strip(), "A short heading", long[1].strip(), "Another", long[2].strip()]


def test_pages_with_nulls(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", ""), (3, "w", "<article><p>" + "word " * 60_000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(html_text.extract(pages).collect(), key=lambda r: (r["page_id"] is not None, r["page_id"] or 0, r["n_chars"]))
    assert [(r["page_id"], r["n_chars"]) for r in got][:1] == [(None, 0)]
    assert got[1]["text"] == got[2]["text"] != ""
    assert got[-1]["n_chars"] == 5 * 60_000 - 1
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.extract(pages.where("false")).count() == 0


HARD = ["</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "<", "[", "a\\", "<\\s>", "[TEXT]", "[/ROLE]", "$1 \\1", "\n\n", "", None, "\U0001f600 é", "</</s>s>", "[[INST]INST]"]


def test_turns_read_back_and_loss_marks(spark):
    rng = random.Random(1)
    roles = ["system", "user", "assistant", "tool", "[TEXT]", "", None]
    rows = [(c if c else None, t, rng.choice(roles), "".join(str(rng.choice(HARD) or "") for _ in range(rng.randrange(3)))) for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(50, i, "user" if i % 2 == 0 else "assistant", x) for i, x in enumerate(HARD)] + [(51, None, "user", "x"), (51, 0, "user", "y"), (51, 0, "user", "y")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("number", F.lit(3)).withColumn("state", F.lit("s"))
    formatted = chat.format_turns(table)
    got = {r["conv_id"]: r for r in chat.conversation_digests(chat.read_turns(formatted)).collect()}
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    whole = [F.array_join("segments.text", "")]
    for r in formatted.select("segments", *whole).collect():
        assert sum(r["segments"][k]["text"].count(c) for k in range(1, len(r["segments"]), 2) for c in chat.CONTROLS) == 0
    assert chat.format_turns(table.where("false")).count() == 0


def test_machine_flags_turns_out_of_order(spark):
    order = ["system", "user", "assistant", "user", "user", "assistant", "assistant", "system", "tool"]
    table = spark.createDataFrame([(1, i, r, "x") for i, r in enumerate(order)], "conv_id long, turn long, role string, text string")
    flags = [r["allowed"] for r in chat.format_turns(table).orderBy("number").collect()]
    assert flags == [True, True, True, True, False, True, False, False, False]


def test_controls_cannot_arise_at_seams():
    for c in chat.CONTROLS:
        assert c[0] in "<["
        assert not any(x in c[1:] for x in "<[\\")


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_queries_match_sql(spark, sf_dir, con, name):
    from compare import difference

    assert difference(queries.QUERIES[name](spark, sf_dir), con, queries.ORACLE_SQL[name]) is None


@pytest.mark.parametrize("page", ["<div>" + "<span class=x>word " * 50_000, "<p>a <b" * 150_000, "<div class=menu><ul>" * 40_000 + "text", "<article><p>x</i></b>" * 40_000,
                                  "<p>" + "<i>a</i>" * 100_000])
def test_a_megabyte_of_tags_is_read_once(page):
    began = time.process_time()
    html_text.blocks(page)
    assert time.process_time() - began < 8  # a second or two; walking the open elements for each piece took minutes


def test_purposes_follow_the_open_elements():
    page = "<article><header>in</header><div class=ad>ad<p>more</p></div><p>text <span class=ad>note</span> on</p></article><p>out</p></article><div class=menu>menu</nav><p>still</div><p>free"
    assert [(t, art, other) for t, _, art, other in html_text.blocks(page)] == [
        ("in", True, False), ("ad", False, True), ("more", False, True), ("text on", True, False), ("out", False, False), ("menu", False, True), ("still", False, True), ("free", False, False)]
