"""Layouts that the training pages' generator did not write."""
import time

import pytest

from rolefeed.llm import html_extract

LEAD = "The harbour was quiet when the ferry came in at dawn."
MORE = "Nobody had expected the council to vote so early in the year."
MENU = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>'
FOOT = "<footer>&copy; 2024 The Harbour Times</footer>"
TALK = '<div class="comments"><h3>Comments</h3><p>I was there and it was loud.</p><p>Great piece, thanks!</p></div>'

CASES = {
    "section": (f"{MENU}<section><h1>Ferry news</h1><p>{LEAD}</p><p>{MORE}</p></section>{FOOT}", ["Ferry news", LEAD, MORE]),
    "no container": (f"{MENU}<h1>Ferry news</h1><p>{LEAD}</p><p>{MORE}</p>{FOOT}", ["Ferry news", LEAD, MORE]),
    "short, comments after": (f"{MENU}<article><p>{LEAD}</p></article>{TALK}{FOOT}", [LEAD]),
    "short with a heading, comments after": (f"{MENU}<article><h1>Ferry news</h1><p>{LEAD}</p></article>{TALK}{FOOT}", ["Ferry news", LEAD]),
    "comments within": (f"{MENU}<article><h1>Ferry news</h1><p>{LEAD}</p><p>{MORE}</p>{TALK}</article>{FOOT}", ["Ferry news", LEAD, MORE]),
    "table at the end": (f"{MENU}<article><h1>Ferry news</h1><p>{LEAD}</p><table><tr><th>Ship</th><th>Hour</th></tr><tr><td>Alma</td><td>06:10</td></tr></table></article>{FOOT}",
                         ["Ferry news", LEAD, "Ship", "Hour", "Alma", "06:10"]),
    "definitions": (f"{MENU}<main><h1>Terms at sea</h1><p>{LEAD}</p><dl><dt>Bow</dt><dd>The front of a ship.</dd></dl></main>{FOOT}",
                    ["Terms at sea", LEAD, "Bow", "The front of a ship."]),
    "advert within": (f"{MENU}<article><h1>Ferry news</h1><p>{LEAD}</p><div class='ad'>Buy boots now</div><p>{MORE}</p></article>{FOOT}", ["Ferry news", LEAD, MORE]),
    "sidebar": (f"{MENU}<div class='content'><h1>Ferry news</h1><p>{LEAD}</p><p>{MORE}</p></div><div class='sidebar'><h3>Related</h3><ul><li><a href='/x'>Boats</a></li></ul></div>{FOOT}",
                ["Ferry news", LEAD, MORE]),
}


@pytest.fixture(scope="module")
def model():
    return html_extract.trained()


@pytest.mark.parametrize("name", CASES)
def test_layout(model, name):
    body, want = CASES[name]
    page = f"<html><head><title>t</title></head><body>{body}</body></html>"
    assert html_extract.main_text(page, model).split("\n") == want


def test_deeply_nested_elements_are_read_in_linear_time():
    for page in ("<div>" * 100_000 + "text", "<div><p>" * 50_000, "<section>" * 100_000 + "</section>" * 100_000):
        started = time.time()
        html_extract.blocks(page)
        assert time.time() - started < 5
