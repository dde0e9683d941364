import random
import re
from html import unescape
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from narrascope.llm.html_blocks import read_page
from narrascope.llm.html_extract import USUAL, extract_main_text, fit, main_text, min_cut, train_blocks
from narrascope.llm.queries import op12_html_extraction
from tests.llm.cases import clashing

SENTENCE = "The committee met on Tuesday, and after a long debate it agreed to publish the figures. "
ARTICLE = ["A heading of the page", ("First: " + SENTENCE * 3).strip(), "Short.", ("Second: " + SENTENCE * 2).strip(), "Last words, with a link in them."]
BODY = (
    f"<h1>{ARTICLE[0]}</h1><p>{ARTICLE[1]}</p><p>{ARTICLE[2]}</p><p>{ARTICLE[3]}</p>"
    '<p>Last words, with <a href="/x">a link</a> in them.</p>'
)
MENU = "<ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "About us")) + "</ul>"
COMMENT = "I do not agree at all, this was a very long debate and the figures are wrong. "


@pytest.mark.parametrize("page", [
    f"<!doctype html><html><head><title>t</title></head><body><nav>{MENU}</nav><article>{BODY}</article><footer>&copy; us</footer></body></html>",
    f"<header><p>Our site, the best.</p>{MENU}</header><main>{BODY}</main><aside><p>{SENTENCE}</p></aside>",
    f'<body class="has-sidebar no-comments"><div id="cookie-notice"><p>{SENTENCE}</p></div><article class="post">{BODY}</article>'
    f'<div class="sidebar-left"><p>{SENTENCE}</p></div><section id="comments"><h2>Comments</h2><article class="comment"><p>{COMMENT * 30}</p></article></section>',
    f'<article><header><h1>{ARTICLE[0]}</h1></header>{BODY.split("</h1>")[1].replace("<p>Second", "<div class=ad><p>Buy this, now.</p></div><p>Second")}'
    f'<div class="comment-list"><p>{COMMENT}</p></div><form><label>Your name</label><textarea>x <p> y</textarea><button>Send</button></form></article>',
    f'<form id="aspnet"><div role="navigation">{MENU}</div><div role=main>{BODY}</div><div class="newsletter-signup"><p>{SENTENCE}</p></div></form>',
    f"<div><div>{MENU}</div><div><div>{BODY}</div></div><div>{MENU}</div></div>",
    f'<div class="entry-content"><div class="shareButtons">{MENU}</div>{BODY}</div><script>var a = "</p><p>no</p>";</script><style>p::after{{content:"<p>"}}</style>',
    f"<main>{BODY}<noscript><p>Turn it on.</p></noscript><select><option>One</select><!-- <p>hidden</p> --><div hidden><p>{SENTENCE}</p></div></main>",
    f"<body><article>{BODY.replace('</p>', '')}<aside>{SENTENCE}</aside></article><footer><p>{SENTENCE}</p></footer><p class='x",
])
def test_article_is_found(page):
    assert main_text(page).split("\n\n") == ARTICLE


@pytest.mark.parametrize("html, blocks", [
    ("", []), ("   ", []), ("plain &amp; simple", ["plain & simple"]), ("a<b>b</b>c<br>d", ["abc d"]),
    ("<p>one<p>two<div>three</div>four", ["one", "two", "three", "four"]),
    ("<p>a\n\t b c</p>", ["a b c"]), ("x < y &am; &lt;b&gt; &#x41;&#66", ["x < y &am; <b> AB"]),
    ("<ul><li>1<ul><li>2</ul><li>3</ul>", ["1", "2", "3"]), ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ("a<!-->b--><!-- c --!>d<!-- e", ["ab-->d"]), ("<script>x</script\n>y<SCRIPT>z", ["y"]),
    ('<p title="a>b" data-x=\'<p>\'>in</p><p don\'t>out</p>', ["in", "out"]), ("a</p>b</div>c", ["abc"]),
    ("<button>no</button>yes<svg><text>no</text></svg>", ["yes"]), ("t<p", ["t"]), ("<h2>a<h3>b</h2>c", ["a", "b", "c"]),
])
def test_blocks(html, blocks):
    assert [b.text for b in read_page(html).blocks] == blocks


def cost(gains, links, kept):
    lost = sum(g for g, k in zip(gains, kept) if g > 0 and not k) + sum(-g for g, k in zip(gains, kept) if g < 0 and k)
    return lost + sum(w for a, b, w in links if kept[a] != kept[b])


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_cut_is_the_cheapest(data):
    n = data.draw(st.integers(1, 7))
    gains = data.draw(st.lists(st.integers(-20, 20), min_size=n, max_size=n))
    node = st.integers(0, n - 1)
    links = [l for l in data.draw(st.lists(st.tuples(node, node, st.integers(0, 15)), max_size=14)) if l[0] != l[1]]
    kept = min_cut(gains, links)
    costs = {k: cost(gains, links, k) for k in product([False, True], repeat=n)}
    best = min(costs.values())
    assert costs[tuple(kept)] == best
    assert sum(kept) == min(sum(k) for k, c in costs.items() if c == best)


def test_long_pages_are_read_whole():
    rng = random.Random(2)
    parts = ["".join(rng.choice("abc ,.") for _ in range(rng.randint(1, 60))) + "z" for _ in range(20_000)]
    page = f"<nav>{MENU}</nav><article>" + "".join(f"<p>{p}</p>" for p in parts) + f"</article><footer>{MENU}</footer>"
    assert main_text(page) == "\n\n".join(" ".join(p.split()) for p in parts)
    assert main_text("<div>" * 3000 + "deep, deep text. " * 20).startswith("deep")


def expected(html):
    """What the tables' own pages hold: all blocks of the article element."""
    inside = re.search("<article>(.*?)</article>", html, re.S).group(1).replace("<br>", " ")
    parts = re.split("</?p>|</?h1>", re.sub("</?b>", "", inside))
    return "\n\n".join(t for t in (" ".join(unescape(p).split()) for p in parts) if t)


def test_pages_of_the_tables(spark):
    folder = "/root/testdata/sf0.001"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = op12_html_extraction(spark, folder)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert len(rows) == len(html)
    for row in rows:
        assert row.text == expected(html[row.page_id]) and row.n_chars == len(row.text)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "u", f"<main>{BODY}</main>"), (1, "u", f"<main>{BODY}</main>"), (None, None, None), (2, "v", ""), (3, "w", "<nav>x</nav>")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string")).repartition(3)
    pages = pages.withColumns({c: pages["url"] for c in ("text", "n_chars")})
    found = extract_main_text(pages, ["page_id", "url"]).collect()
    text = "\n\n".join(ARTICLE)
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in found) == sorted(
        [("1", text, len(text))] * 2 + [("None", "", 0), ("2", "", 0), ("3", "", 0)]
    )
    empty = extract_main_text(pages.limit(0), ["page_id"])
    assert empty.count() == 0 and empty.columns == ["page_id", "text", "n_chars"]


def test_weights_are_learned_where_labels_are(spark):
    folder = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    weights = train_blocks(pages)
    assert not np.allclose(weights, USUAL) and weights[3] < 0  # links speak against a block
    assert np.allclose(train_blocks(pages.repartition(5)), weights)
    assert np.array_equal(train_blocks(pages.limit(0)), USUAL)
    assert np.array_equal(fit(np.ones((3, USUAL.size)), np.ones(3)), USUAL)
