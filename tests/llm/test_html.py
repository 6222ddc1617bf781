import re
import time
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from weirflow.llm.html import extract_main_text, main_text, smoothed, threshold

LONG = "A paragraph of the article with a good number of words in it, more than any menu."


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("  \n ", ""),
        ("just text", "just text"),
        ("<p>a<p>b", "a\n\nb"),
        (f"<nav><a>x</a></nav><article><h1>T</h1><p>{LONG}</p></article><footer>f</footer>", f"T\n\n{LONG}"),
        ("<article><h1>T&amp;&quo</h1><p><b>un\n closed <br> &eacute;&#33;<p>next</p></article>", "T&&quo\n\nun closed é!\n\nnext"),
        ("<script>var t='</p>';</script><style>p{}</style><article><p>x</p></article>", "x"),
        (f"<article><p>{LONG}</p><div class='ad'>buy</div><aside>side</aside><p>end</p></article>", f"{LONG}\n\nend"),
        (f"<div class='content has-sidebar'><p>{LONG}</p><div class='ad'>buy</div><p>end</p></div>", f"{LONG}\n\nend"),
        (f"<div id='cookie-notice'>We use</div><div><p>{LONG}</p></div><section id='comments'><p>I say {LONG}</p></section>", LONG),
        ("<main><h1>T</h1><p>x</p></main><article class='comment'>me too</article>", "T\n\nx"),
        (f"<header>site</header><article><header><h1>T</h1></header><p>{LONG}</p></article>", f"T\n\n{LONG}"),
        (f"<article><p>{LONG}</p><form>name <input></form><p hidden>no</p></article>", LONG),
        ("<article><p>a</p><ul><li>one</li><li>two</li></ul></article>", "a\n\none\n\ntwo"),
        ("<article>" + "<p>x</p>" * 3_000 + "</article>", "\n\n".join("x" * 3_000)),
        (f"<article><p>{LONG} <button>share</button> and <span class='ad'>buy <b>now</b></span>more</p></article>", f"{LONG} and more"),
        (f"<article><p>{LONG}<span class='ad'>buy</p><p>next</p></article>", f"{LONG}\n\nnext"),
        ("<!-- c --><article><p>cut off &am", "cut off &am"),
    ],
)
def test_main_text(html, text):
    assert main_text(html) == text


def test_clusters_tell_lists_of_links_from_text():
    links = "".join(f"<div><a href='/{i}'>l{i}</a> <a href='/x'>y</a></div>" for i in range(9))
    assert main_text(f"<body>{links}<div><p>{LONG}</p><p>short</p><p>{LONG}</p></div>{links}</body>") == f"{LONG}\n\nshort\n\n{LONG}"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<div><p>{LONG}</p></div><article class='card'><p>Teaser</p></article>", LONG),
        (f"<article class='card'><p>Teaser</p></article><div><p>{LONG}</p><p>end</p></div>", f"{LONG}\n\nend"),
        (f"<article><p>{LONG}</p><p>end</p></article><div><a>x</a> <a>y</a></div>", f"{LONG}\n\nend"),
        (f"<div><p>{LONG}</p></div><main><p>short</p></main>", f"{LONG}\n\nshort"),
    ],
)
def test_regions_outside_of_articles_compete(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize(
    ("part", "text"),
    [
        (f"<section id='related-work'><h2>Before</h2><p>{LONG}</p></section>", f"Before\n\n{LONG}"),
        (f"<section id='discussion'><h2>What</h2><p>{LONG}</p><p>short</p></section>", f"What\n\n{LONG}\n\nshort"),
        (f"<h2 id='search'>Search</h2><p>{LONG}</p>", f"Search\n\n{LONG}"),
        (f"<div class='dialog'><p>{LONG}</p></div>", LONG),
        ("<p>He <span class='dialog'>said</span> so</p>", "He said so"),
        ("<div class='related'><a href='/1'>One</a> <a href='/2'>Two</a></div>", None),
        ("<ul class='share'><li><a href='/1'>One</a></li><li><a href='/2'>Two</a></li></ul>", None),
        (f"<div class='cookie-notice'><p>{LONG}</p></div>", None),
        (f"<div role='dialog'><p>{LONG}</p></div>", None),
        (f"<div class='comments'><p>{LONG}</p></div>", None),
    ],
)
def test_ambiguous_names_inside_an_article_need_their_ratio(part, text):
    around = f"<h1>T</h1><p>{LONG}</p>"
    wanted = ["T", LONG, *([text] if text else []), "end"]
    assert main_text(f"<article>{around}{part}<p>end</p></article>") == "\n\n".join(wanted)


def test_smoothing_and_threshold():
    assert smoothed([5.0, 5.0, 5.0]) == pytest.approx([5.0, 5.0, 5.0])
    assert smoothed([0.0, 9.0, 0.0])[1] > smoothed([0.0, 9.0, 0.0])[0] > 0
    assert 2 < threshold([1.0, 2.0, 1.5, 80.0, 90.0]) < 80
    assert threshold([4.0, 4.0]) == 4.0


def test_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    rows = [(1, "u", "<p>é</p>", "old", 3), (None, None, None, None, None), (1, "u", "<p>é</p>", "old", 3)]
    found = extract_main_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, found), key=str) == [(1, "u", "é", 1), (1, "u", "é", 1), (None, None, "", 0)]
    assert found[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert extract_main_text(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize(
    "page",
    [
        "<div class='container right-sidebar'><article><p>{}</p></article></div>",
        "<div class='layout-sidebar'><div class='content'><p>{}</p></div></div>",
        "<div id='social'><article><p>{}</p></article></div>",
        "<form id='aspnetForm'><div><article><p>{}</p></article></div></form>",
        "<form><div class='popup'><main><p>{}</p></main></div></form><footer>foot</footer>",
        "<div class='sidebar'><div><p>{}</p></div><div class='menu'><a>x</a></div></div><div>up</div>",
        "<article><div class='ad-hoc-analysis'><p>{}</p></div></article>",
        "<article><div class='widget-guide'><p>{}</p></div><div class='ad-slot'><p>buy</p></div></article>",
        "<main><p>{}</p></main><div class='comments'><article><p>me too, and more than that, I say</p></article></div>",
    ],
)
def test_no_page_is_empty_because_of_a_name(page):
    assert main_text(page.format(LONG)).startswith(LONG)
    assert "buy" not in main_text(page.format(LONG)) and "me too" not in main_text(page.format(LONG))


@pytest.mark.parametrize(
    "page",
    [
        "<i>" * 110_000 + "</b>" * 110_000,
        "<b><div>" + "<i>" * 110_000 + "</b>" * 110_000,
        "<a " * 350_000,
        "<a " * 350_000 + ">",
        "<!-- " * 200_000,
        "</ " * 350_000,
        "<![ " * 250_000,
        "<![ x> " * 100_000,
        "<div class=sidebar>" * 50_000 + "x",
        "<form><p>" * 100_000 + "x",
        "<p>x" * 150_000,
    ],
)
def test_time_is_linear(page):
    start = time.process_time()
    main_text(f"<article><p>{LONG}</p></article>{page}")
    assert time.process_time() - start < 6  # 1 MB; a quadratic pass takes minutes


def test_unfinished_markup_is_no_text():
    assert main_text(f"<p>{LONG}</p><a href='x") == LONG
    assert main_text(f"<p>{LONG}</p><!-- never closed <p>hidden</p>") == LONG
    assert main_text(f"<p>{LONG}</p>a < b") == f"{LONG}\n\na < b"
    assert main_text(f"<![CDATA[x]]><p>{LONG}</p><![if IE]>") == LONG


class _Tree(HTMLParser):
    """All elements of a page as nested lists: name, attributes, children."""

    def __init__(self):
        super().__init__()
        self.path = [["", {}, []]]

    def handle_starttag(self, tag, attrs):
        node = [tag, dict(attrs), []]
        self.path[-1][2].append(node)
        if tag not in ("br", "img", "meta", "link", "input", "hr"):
            self.path.append(node)

    def handle_endtag(self, tag):
        names = [n[0] for n in self.path]
        if tag in names:
            del self.path[len(names) - 1 - names[::-1].index(tag) :]

    def handle_data(self, data):
        self.path[-1][2].append(data)


def _found(node, tag):
    if isinstance(node, str):
        return []
    return [node] * (node[0] == tag) + [x for child in node[2] for x in _found(child, tag)]


def _blocks(node, out):
    """Text of the article's blocks, without asides, forms, scripts and adverts."""
    if isinstance(node, str):
        out[-1] += node
        return
    name, attrs, children = node
    if name in ("script", "style", "aside", "form", "nav", "footer", "noscript", "button", "figure") or attrs.get("class") == "ad":
        out.append("")
        return
    block = name in ("p", "h1", "h2", "h3", "h4", "li", "ul", "ol", "div", "section", "blockquote", "pre", "table", "tr", "td", "article", "header")
    if block:
        out.append("")
    if name == "br":
        out[-1] += " "
    for child in children:
        _blocks(child, out)
    if block:
        out.append("")


def test_pages_equal_a_walk_of_their_tree():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()
    for html in pages:
        tree = _Tree()
        tree.feed(html)
        tree.close()
        (article,) = _found(tree.path[0], "article")
        out = [""]
        _blocks(article, out)
        wanted = [re.sub(r"\s+", " ", x).strip() for x in out]
        assert main_text(html) == "\n\n".join(x for x in wanted if x)
