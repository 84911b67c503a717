"""Pages written by hand with the exact text that is to come out, and pages that nest deeply."""

import time

import pandas as pd
import pytest

from tidemark.llm import html_text as H

P1, P2, P3 = ("The river rose three metres in one night and took the old bridge with it.", "Nobody was hurt, but the mill on the left bank will have to be built again.",
              "Engineers expect the new crossing to open before the end of the summer, the council said on Monday.")
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/s">Sport</a></li></ul></nav>'
MENU = '<div class="menu"><a href="/">Home</a> <a href="/a">About us</a> <a href="/c">Contact</a></div>'
FOOT = "<footer><p>&copy; 2024 The Valley Post &middot; All rights reserved</p></footer>"
AD = '<div class="ad"><p>Buy two tyres and get the third one for free this week only!</p></div>'
ASIDE = "<aside><p>Also read: the ten best walks along the river this spring.</p></aside>"
TALK = '<section class="comments"><h3>Comments</h3><p>I crossed that bridge every day of my life.</p><p>Good riddance, it was ugly.</p></section>'
FORM = '<form><label>Your address</label><input name="m"><p>Sign up for our weekly letter.</p><button>Send</button></form>'
COOKIE = '<div class="cookie"><p>This site uses cookies to give you a better experience.</p></div>'


def p(*xs):
    return "".join(f"<p>{x}</p>" for x in xs)


def page(body, head="<title>T</title>"):
    return f"<!doctype html><html><head>{head}</head><body>{body}</body></html>"


GOLD = [
    (page(f"<header>The Valley Post</header>{NAV}<article><h1>Flood</h1>{p(P1, P2, P3)}</article>{FOOT}"), ["Flood", P1, P2, P3]),
    (page(f"{NAV}<article><h1>Flood</h1>{p(P1)}{ASIDE}{p(P2, P3)}</article>{FOOT}"), ["Flood", P1, P2, P3]),
    (page(f"{NAV}<article>{p(P1)}{AD}{p(P2, P3)}</article>{FOOT}"), [P1, P2, P3]),
    (page(f"{NAV}<article><h1>Flood</h1>{p(P1, P2)}{TALK}</article>{FOOT}"), ["Flood", P1, P2]),
    (page(f"{COOKIE}{NAV}<article><h1>Flood</h1>{p(P1)}{FORM}{p(P2)}</article>{FOOT}"), ["Flood", P1, P2]),
    (page(f'{NAV}<article>{p(P1)}<p style="display:none">Hidden words for robots only, not for people.</p>{p(P2)}<div hidden><p>More of them.</p></div></article>{FOOT}'), [P1, P2]),
    (page(f"{NAV}<article>{p(P1)}<table><tr><th>Year</th><th>Level</th></tr><tr><td>1993</td><td>2.1 m</td></tr></table>{p(P2)}</article>{FOOT}"),
     [P1, "Year", "Level", "1993", "2.1 m", P2]),
    (page(f"{NAV}<article>{p(P1)}<pre>level = 3.2\nprint(level)</pre>{p(P2)}</article>{FOOT}"), [P1, "level = 3.2 print(level)", P2]),
    (page(f"{NAV}<article>{p(P1)}<ul><li>the bridge</li><li>the mill</li></ul>{p(P2)}</article>{FOOT}"), [P1, "the bridge", "the mill", P2]),
    (page(f"{NAV}<article>{p(P1)}<table><tr><td>a</td><td>b</td></tr></table><pre>x = 1</pre></article>{FOOT}"), [P1, "a", "b", "x = 1"]),
    (page(f'{MENU}<div class="content"><h1>Flood</h1>{p(P1, P2, P3)}</div><div class="footer">&copy; 2024 Valley | Imprint</div>'), ["Flood", P1, P2, P3]),
    (page(f'{MENU}<div id="article-text">{p(P1, P2)}{AD}{p(P3)}</div><div class="sidebar">{p("Weather: rain until Friday, then a little sun.")}</div>'), [P1, P2, P3]),
    (page(f"<div class=\"wrapper\">{MENU}<main><h1>Flood</h1>{p(P1)}<blockquote>{P2}</blockquote>{p(P3)}</main>{TALK}{FOOT}</div>"), ["Flood", P1, P2, P3]),
    (page(f'{NAV}<div role="main">{p(P1, P2, P3)}</div><div id="comments"><p>First comment of a reader who was there.</p></div>{FOOT}'), [P1, P2, P3]),
    (page(f'{NAV}<article>{p(P1, P2)}<div class="related"><ul><li><a href="/1">Bridges of the valley</a></li><li><a href="/2">Mills</a></li></ul></div></article>{FOOT}'), [P1, P2]),
    (page(f'{NAV}<article>{p(P1, P2)}<div class="reader-comments"><article><p>I saw it fall and I will not forget it.</p></article></div></article>{FOOT}'), [P1, P2]),
    (page(f'{NAV}<article><h1>Flood</h1><p>{P1}<p>{P2}</article>{FOOT}'), ["Flood", P1, P2]),
    (page(f'{NAV}<article><p>Caf&eacute; &amp; mill:\n\t  3&nbsp;&lt; 4,   the <b>bridge</b> is <a href="/x">gone</a> now, they say.</p>{p(P2)}</article>{FOOT}'),
     ["Café & mill: 3 < 4, the bridge is gone now, they say.", P2]),
    (page(f'{NAV}<article><script>var p = "<p>{P3}</p>";</script><style>p {{ color: red }}</style><!-- {P3} -->{p(P1, P2)}<noscript><p>Turn scripts on.</p></noscript></article>{FOOT}'), [P1, P2]),
    (page(f'{NAV}<article><h1>Flood</h1>{p(P1)}<h2>What now</h2>{p(P2)}<figure><img src="b.png"><figcaption>The bridge in the spring of last year, before the flood.</figcaption></figure>{p(P3)}'
          f'<div class="share"><ul><li><a href="#">Share</a></li><li><a href="#">Mail</a></li></ul></div></article>{FOOT}'),
     ["Flood", P1, "What now", P2, "The bridge in the spring of last year, before the flood.", P3]),
    (page(f'{COOKIE}{MENU}<section><h1>Flood</h1>{p(P1, P2, P3)}</section><div class="newsletter">{p("Get our letter every Friday morning for free.")}</div>{FOOT}'), ["Flood", P1, P2, P3]),
    (page(""), []),
    ("", []),
]


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def field(request):
    pages = pd.read_parquet(f"/root/testdata/{request.param}/pages.parquet", columns=["html"]).html
    return H.learn([x for x in pages if x is not None][:200])


@pytest.mark.parametrize("k", range(len(GOLD)))
def test_gold_page(field, k):
    html, lines = GOLD[k]
    assert H.main_text(html, field).split("\n") == (lines or [""])


def test_deep_and_long_pages_are_linear(field):
    took = []
    for n in (10_000, 20_000):
        html = "<article>" + "<div class=a>x " * n
        began = time.process_time()
        assert len(H.main_text(html, field)) >= 0
        took.append(time.process_time() - began)
    assert took[1] < 10 and took[1] < 4 * took[0] + 0.5
    assert len(H.blocks_of("<p>word " * 50_000)) == 50_000


def test_hidden_by_attribute_or_style():
    def texts(html):
        return [b.text for b in H.blocks_of(html)]

    assert texts("<div hidden>a</div><div hidden=''>b</div><p data-hidden=1>c</p><p class=hidden>d</p><p style='color:red; Display : none'>e</p>") == ["c", "d"]
    assert texts('<p title="hidden">a</p><p hidden>b<b>c</b></p>d') == ["a", "d"]
