"""Pages nested deeper than any usual one."""

from __future__ import annotations

import time

import pytest

from tiermill.llm import html_main
from tiermill.llm.html_main import main_text

STORY = "A long sentence of the story, with commas, and with enough words to count as a paragraph of it."


@pytest.mark.parametrize("depth", [10, 255, 300, 20_000])
def test_depth_does_not_change_what_is_main_text(depth):
    inner = f"<div><p>{STORY}</p><div class='ad-banner'><div><p>Buy now, {STORY}</p></div></div><p>{STORY}</p></div>"
    menu = "<nav><p>Home, away, and more of the menu</p></nav>"
    page = f"<body>{'<div>' * depth}{inner}{menu}{'</div>' * depth}</body>"
    assert main_text(page) == f"{STORY} {STORY}"


def test_end_tags_of_deep_elements_close_only_these():
    deep = "<div>" * 300 + "x" + "</div>" * 300
    page = f"<body><div><article>{deep}<p>{STORY}</p><p>{STORY}</p></article><div>later text, not part of it</div></div></body>"
    assert main_text(page) == f"x {STORY} {STORY}"


def _seconds(depth):
    page = f"<body>{f'<div><p>{STORY}</p>' * depth}</body>"
    begin = time.process_time()
    assert STORY in main_text(page)
    return time.process_time() - begin


def test_time_is_in_proportion_to_depth():
    _seconds(100)
    short, long = (min(_seconds(depth) for _ in range(3)) for depth in (1_000, 8_000))
    assert long < 20 * short


def plain_sizes(node):
    """Characters and those in links, walked anew for the node."""
    size = links = 0
    for part in [] if node.out else node.parts:
        more = (len("".join(part.split())), 0) if isinstance(part, str) else plain_sizes(part)
        size, links = size + more[0], links + more[1]
    return size, size if node.name == "a" and not node.out else links


def test_sizes_equal_plain_ones(spark, small):
    for row in spark.read.parquet(f"{small}/pages.parquet").select("html").limit(60).collect():
        root = html_main.parse(row.html or "")
        html_main._measure(root)
        stack = [root]
        while stack:
            node = stack.pop()
            assert (node.size, node.links) == plain_sizes(node)
            stack += [part for part in node.parts if not isinstance(part, str)]
