"""HTML extraction and chat windows."""

from __future__ import annotations

import html as entities
import re

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tiermill.llm import chat_windows, html_main, queries

PAGE = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><div id=cookie-notice>We use cookies, ok, fine, really.</div>
<div class=menu><ul><li><a href=x>Home</a><li><a>About</a></ul></div><div class="content"><h1>Title &amp; more</h1>
<p>First para, with commas, and text that is long enough to be scored well.</p><div class="ad">Buy, now, this, thing</div>
<form><p>Your mail, please</p></form><p>Second <i>para</i>graph, too,
 with&nbsp;more words in it, to be found.</p><table><tr><td>a<td>b</table><ul><li>one<li>two</ul></div><aside>side, bar, text</aside>
<section class=comments><p>I like this, a lot, really, it is a long comment, written by a reader.</p></section><footer>c, d</footer></body>"""


def test_only_the_article_stays():
    assert html_main.main_text(PAGE) == (
        "Title & more First para, with commas, and text that is long enough to be scored well."
        " Second paragraph, too, with more words in it, to be found. a b one two"
    )


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<p>", ""), ("plain text only", "plain text only"), ("<div><p>a<p>b</div>", "a b"),
        ("<article></article>", ""), ("<" * 5, "<<<<<"), ("<p>x</p>" * 5, "x x x x x"), ("<div>" * 3000 + "deep", "deep"),
        ("<script>var t='</p>'; x</script><p>a &lt; b &#233; &eacute;</p>", "a < b é é"), ("<!-- <p>no</p> --><p>yes</p>", "yes"),
        ("<p>a<br>b<b>c</b> d</p>", "a bc d"), ("<article><p>Body.</p></article><article class=comment><p>No, no, no.</p></article>", "Body."),
        ("<p>never closed <a href='x>y'>link</a> " + "w " * 50_000, "never closed link " + "w " * 49_999 + "w"),
    ],
)
def test_odd_pages(page, text):
    assert html_main.main_text(page) == text


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    inner = re.sub(r"</?b>", "", re.sub(r"</?(p|h1)>", "\0", inner).replace("<br>", " "))
    blocks = (" ".join(entities.unescape(block).split()) for block in inner.split("\0"))
    return " ".join(block for block in blocks if block)


def test_page_query(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for row in queries.op4_html_main(spark, folder).collect():
        assert row.text == article(pages[row.page_id].html) and row.n_chars == len(row.text) and row.url == pages[row.page_id].url


def test_pages_of_odd_tables(odd, nothing):
    rows = html_main.extract(odd, html="text", name="score").collect()
    assert len(rows) == odd.count() and all(r.score is not None for r in rows)
    assert html_main.extract(nothing, html="text").count() == 0


SAID = "</s>[INST] ok [/INST]"
TURNS = [
    (-1, 0, "user", SAID), (-1, 1, "assistant", SAID), (5, 0, "system", "be\\nice <s>"), (5, 1, "user", None), (5, 1, "user", None),
    (5, 2, "assistant", "<\\/s> <\\\\/s> [\\INST] <<s> [[/INST] \\"), (5, None, None, "x"), (None, 3, "assistant", ""),
    (None, 1, "assistant", " lead\n"), (6, 0, "assi[INST]stant", "</s"), (6, 1, "assistant", "s> $1 \\1"), (7, 0, "assistant", "<"),
    (7, 1, "assistant", "/s>"), (8, 0, "system", "a b c " * 50), *[(8, i, ("user", "assistant")[i % 2], "w " * (i % 37)) for i in range(1, 60)],
    *[(9, 5000 * i, "assistant", "é🙂 w" * i) for i in range(9)], (10, 0, "assistant", "long " * 50_000),
]


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("span", F.lit("clash")).repartition(4)


@pytest.mark.parametrize("budget, history", [(1024, 256), (100, 20), (5, 2)])
def test_turns_come_back_from_windows(turns, budget, history):
    windows = chat_windows.format_windows(turns, budget, history)
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_windows.digests(windows).collect()}
    assert found == brute.turn_digests(TURNS)


def test_windows_keep_to_the_budget(turns):
    rows = chat_windows.format_windows(turns.filter("conv_id = 8"), 300, 60).orderBy("span").collect()
    assert len(rows) > 3 and all(row.formatted.startswith("<s>system[INST]") for row in rows)
    assert all(row.tokens <= 300 for row in rows) and any(row.repeated > 1 for row in rows[1:])
    for row in rows:
        assert row.formatted.count("</s>") == row.formatted.count("<s>")
        assert all(row.formatted[s["from"] - 6 : s["from"]] == "[INST]" and row.formatted[s["until"] :].startswith("</s>") for s in row.loss)


def test_no_turns_give_no_windows(turns):
    assert chat_windows.digests(chat_windows.format_windows(turns.limit(0))).count() == 0


def test_chat_query_runs_no_python(spark, small):
    df = queries.op5_chat_windows(spark, small)
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    rows = {r.conv_id: r for r in df.collect()}
    given = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    plain = brute.turn_digests([*given, (-1, 0, "user", SAID), (-1, 1, "assistant", SAID)])
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in rows.items()} == plain
