import re
from html import unescape

import duckdb
import pytest
from conftest import FOLDER

from cofre.llm import html_extraction
from cofre.llm.queries import op6_html_extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<div class="cookie-notice"><p>We use cookies</p></div><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></li><li><a href="/a">A &amp; B</a></li></ul></nav>
<div id="wrap"><div class="post-body"><h2>%s</h2><p>%s</p><p>Tom &amp; Jerry&nbsp;&lt;3 <b>bold</b><i>er</i><br>next</p><ul><li>one<li>two</ul>
<form><p>Your mail</p><input></form><aside><p>Related</p></aside></div>
<div class="sidebar"><p>Popular now</p></div><section id="comments"><p>First!</p></section></div>
<div class="advert">Buy</div><footer><p>&copy; 2020</p></footer></body></html>"""


def page(i):
    return PAGE % (f"Title {i}", f"Some long text of page {i}, with   enough words\n to be the main part of it. " * (i + 2))


def wanted(i):
    text = f"Some long text of page {i}, with enough words to be the main part of it. " * (i + 2)
    return "\n".join([f"Title {i}", text.strip(), "Tom & Jerry <3 bolder next", "one", "two"])


def test_every_article_of_the_table(spark):
    got = {r.page_id: (r.text, r.n_chars) for r in op6_html_extraction(spark, FOLDER).collect()}
    for key, html in duckdb.sql(f"select page_id, html from '{FOLDER}/pages.parquet'").fetchall():
        article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(b for b in blocks if b)
        assert got[key] == (text, len(text))


@pytest.mark.parametrize("i", [0, 3])
def test_parts_that_are_left_out(i):
    assert html_extraction.main_text(page(i), None) == wanted(i)


def test_host_without_named_elements(spark):
    def bare(i):
        return f"<body><div><a href='x'>menu</a><a href='y'>menu two</a></div><div><p>{'text of ' * 9}page {i}</p><p>more {i}</p></div><div>small print</div></body>"

    rows = [(i, f"http://bare.example/{i}", bare(i)) for i in range(8)] + [(20 + i, f"https://u@Blog.example:80/{i}", page(i)) for i in range(3)]
    rows += [(50, None, page(1)), (51, "x", None), (52, "http://bare.example/9", ""), (53, "http://bare.example/9", "no <b markup"), (None, "http://bare.example/9", bare(9)), (20, "https://u@Blog.example:80/0", page(0))]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, host string, `key` int")
    got = html_extraction.extract_text(df).collect()
    assert len(got) == len(rows)
    texts = {r.key: r.text for r in got}
    for i in range(8):
        assert texts[i] == f"{'text of ' * 9}page {i}\nmore {i}"
    assert texts[None].endswith("page 9\nmore 9")
    assert [texts[k] for k in (20, 21, 22, 50)] == [wanted(0), wanted(1), wanted(2), wanted(1)]
    assert (texts[51], texts[52]) == ("", "")
    hosts = {r.host for r in html_extraction.infer_wrappers(df).collect()}
    assert hosts == {"bare.example", "blog.example", ""}


def test_wrapper_is_a_regular_expression_without_union():
    def doc(parts):
        return html_extraction.wrap(html_extraction.parse(f"<article><h1>Same</h1>{parts}</article>"))

    merged = doc("<p>a</p>")
    for parts in ("<p>b</p><p>c</p>", "<p>d</p><blockquote>q</blockquote>", "<dl><dt>x</dt><dd>y</dd><dt>z</dt><dd>w</dd></dl><p>e</p>"):
        merged = html_extraction.merge(merged, doc(parts))
    text = html_extraction.expression(merged)
    assert "<h1>text</h1>" in text and "(<p>#text</p>)+" in text and "?" in text and "|" not in text
    assert merged["n"] == 4


def test_template_texts_inside_the_article(spark):
    """What all pages of a host say at the same place is the template's, also between paragraphs that repeat."""
    def doc(i, host):
        follow = "<p>Follow us on all the usual channels for more</p>" if host == "a" else ""
        return f"<body><article><h1>Title {i}</h1><p>{f'first {i} words ' * 9}</p>{follow}<p>{f'more {i} of it ' * 9}</p></article></body>"

    rows = [(10 * h + i, f"http://{host}.example/{i}", doc(i, host)) for h, host in enumerate("ab") for i in range(6)]
    copies = [(100 + i, f"http://copies.example/{i}", doc(1, "a")) for i in range(6)]
    few = [(200 + i, f"http://few.example/{i}", doc(i, "a")) for i in range(3)]
    df = spark.createDataFrame(rows + copies + few, "page_id long, url string, html string").repartition(3)
    got = {r.key: r.text for r in html_extraction.extract_text(df).collect()}
    for key, url, _ in rows:
        i = key % 10
        assert got[key] == f"Title {i}\n{(f'first {i} words ' * 9).strip()}\n{(f'more {i} of it ' * 9).strip()}"
    assert all("Follow us" in got[100 + i] and "Title 1" in got[100 + i] for i in range(6))  # copies are no template
    assert all("Follow us" in got[200 + i] for i in range(3))  # too few to tell


@pytest.mark.parametrize("around", ['class="wrap has-sidebar"', 'id="page-header-and-content"', 'class="social-policy story"', 'class="sidebar"', 'id="without-ads"'])
def test_names_around_the_article_do_not_lose_it(around):
    html = f"<body><nav>menu</nav><div {around}><h1>Title</h1><p>{'long text ' * 30}</p><div class='share-buttons'>Share</div></div><div class='cookie-notice'>x</div></body>"
    assert html_extraction.main_text(html, None) == "Title\n" + ("long text " * 30).strip()


def test_comments_longer_than_the_article_go():
    html = f"<body><article><p>{'text of it ' * 10}</p><div class='post-comments'><p>{'I say ' * 100}</p></div></article><div id='comments-list'>{'me too ' * 90}</div></body>"
    assert html_extraction.main_text(html, None) == ("text of it " * 10).strip()


@pytest.mark.parametrize("depth", [90, 150, 1200, 100_000])
def test_pages_of_any_depth(depth):
    html = "<div>" * depth + "<p>one<div>two</div><nav>menu</nav>three<p>four" + "</div>" * depth
    assert html_extraction.main_text(html, None).split("\n") == ["one", "two", "three", "four"]
    assert html_extraction.main_text("<article>" * depth + "x<article>y" + "</nav>" * depth, "article") != ""


def test_deep_pages_in_spark(spark):
    rows = [(i, f"http://deep.example/{i}", "<div>" * 3000 + f"<p>text {i} here") for i in range(3)]
    got = html_extraction.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.key: r.text for r in got} == {i: f"text {i} here" for i in range(3)}


def _size(node):
    return 1 + sum(map(_size, node["items"]))


def test_generated_names_do_not_grow_the_wrapper():
    import random

    sizes, held, pick = {}, None, random.Random(4)
    for i in range(1, 61):
        name = lambda: "".join(pick.choices("abcdefghijkl", k=9))
        blocks = "".join(f"<section id='{name()}'><p>text {i} {j}</p></section><div class='x{j}y{i}'><h2>t</h2></div>" for j in range(10))
        page = html_extraction.wrap(html_extraction.parse(f"<article>{blocks}</article>"))
        held = page if held is None else html_extraction.merge(held, page)
        sizes[i] = _size(held)
    assert sizes[60] <= 1.2 * sizes[20] and sizes[60] < 600


def plain_lcs(a, b):
    if not a or not b:
        return 0
    return plain_lcs(a[1:], b[1:]) + 1 if a[0] == b[0] else max(plain_lcs(a[1:], b), plain_lcs(a, b[1:]))


@pytest.mark.parametrize("seed", range(20))
def test_alignment_against_all_ways_of_it(seed):
    """As many elements are matched as the longest common subsequence has; the others are optional, in their order."""
    import random

    pick = random.Random(seed)

    def level():
        tags = [pick.choice("abcde")]
        while len(tags) < 7:
            tags.append(pick.choice([t for t in "abcdefgh" if t != tags[-1]]))
        return tags

    def nodes(tags):
        return [html_extraction.wrap(html_extraction.Element("div", f"div {t}", False)) for t in tags]

    a, b = level(), level()
    found = html_extraction.align(nodes(a), nodes(b), within=False)
    flat = []

    def flatten(items):
        for x in items:
            flat.append(x) if x["tag"] else flatten(x["items"])

    flatten(found)
    if not any(x["rep"] for x in found):
        assert sum(not x["opt"] for x in flat) == plain_lcs(a, b)
        assert len(flat) == len(a) + len(b) - plain_lcs(a, b)


def test_long_groups_repeat():
    group = "".join(f"<div class='{c}'>x</div>" for c in ("one", "two", "three", "four", "five"))
    wrapper = html_extraction.wrap(html_extraction.parse(f"<article>{group * 4}</article>"))
    inner = wrapper["items"][0]["items"]
    assert len(inner) == 1 and inner[0]["rep"] and len(inner[0]["items"]) == 5


def test_broken_markup_ends():
    for html in ("<" * 5000, "<p" * 3000, "<div>" * 800 + "x", "<a href='" + "<p>" * 2000, "<!--" * 2000, "<article><nav><p>menu<article><p>text", "<script>" * 500, "a < b > c"):
        assert isinstance(html_extraction.main_text(html, "article"), str)
    assert html_extraction.main_text("<nav><p>menu<article><p>text", None) == "text"
    assert html_extraction.main_text("<p>a < b &#x41;&eacute;", None) == "a < b Aé"


def test_empty_table(spark):
    assert html_extraction.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
