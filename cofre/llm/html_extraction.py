"""Main text of web pages by wrappers that are inferred for each host.

A page is a tree of block elements. A wrapper is a union-free regular expression over such trees: neighbours that
repeat are one repeated group, elements that only some pages have are optional, texts that differ between pages are
slots. Wrappers are inferred by alignment: two wrappers (a page is the simplest) are matched element by element
along their longest common subsequence; what is left over becomes optional. Every page takes part: tasks fold the pages
they hold into one wrapper per host, and these are folded again, first in salted parts, then per host, so a host with
a third of all pages is one wrapper per task.

Elements are matched by tag and names. Names with digits are generated and don't count, and where a level still has more than
:data:`WIDEST` different elements, those that the fewest pages have are matched by their tag alone. So a wrapper's size depends on the
pages' layouts, not on their number.

The wrapper tells in which element of a host's pages the article is: the one that says so by its name, else the one
that holds most of the text outside links. It also tells which texts in there are the same on all pages: those are the template's, not the
article's. A page is read along the wrapper's elements: texts in slots are given, texts of the template are left out, if the wrapper
stands for at least :data:`TEMPLATE_PAGES` pages and the template isn't most of the page (copies of one article). Parts that
tag, role or class names give as menus, headers, footers, sidebars, notices, adverts, forms or comments are left out,
unless next to nothing would remain.

Defined results: null and empty pages have an empty text. A null address belongs to the host without name. A page
without the host's element is judged by its own tree. Elements that are not closed end with their parent, and an
article also ends a part that was to be left out. Elements nested deeper than :data:`DEEPEST` part blocks but are no elements of their own for the
wrapper; their text is kept. Texts of any length are read whole. Repeated rows are extracted each; of equally fitting elements the first
counts. An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre.llm.common import Scratch, bounded

SALTS = 16
#: Levels of elements that a wrapper tells apart.
DEEPEST = 100
#: Different elements of a level that are told apart by their names.
WIDEST = 64
#: Pages that must agree on a text for it to be the template's.
TEMPLATE_PAGES = 5

# Elements that part text into blocks, that have no content, whose content is no markup, and that hold no
# part of an article.
BLOCKS = frozenset(
    "html body div section article main header footer nav aside form fieldset p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd "
    "table thead tbody tfoot tr td th caption blockquote pre address figure figcaption details summary dialog menu "
    "center hgroup search".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
DROPPED_TAGS = frozenset("nav footer aside form head dialog menu button select svg template object audio video canvas search".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
DROPPED_NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer header masthead topbar banner ad ads "
    "adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices alert newsletter subscribe subscription signup popup modal overlay share sharing social related comment "
    "comments reply replies respond disqus login search widget toolbar pagination pager skip tracking paywall".split()
)
# Words that say nothing about what an element holds, and words that say that it merely has such a part.
GENERAL_NAMES = frozenset(
    "area bar block body bottom box btn button buttons col column container content control desktop fixed footer global group header holder icon "
    "icons inner item items left link links list main menu mobile module nav outer page panel primary right row secondary section site slot "
    "sticky text title top unit wrap wrapper zone".split()
)
PART_NAMES = frozenset("has with without no hide show is after before above below".split())
ARTICLE_NAMES = frozenset("article articlebody post entry story content maincontent".split())
NAMELESS = ("div", "section", "td", "center")
LINE_TAGS = ("p", "li", "dt", "dd", "tr", "td", "th")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PARTS = re.compile(r"[a-zA-Z]+")


@dataclass
class Element:
    """An element of a page. ``sign`` is its tag with class, id, role and itemprop words; items are elements, texts and None, which
    parts two blocks. ``named``: dropped for its names alone. ``chars``: text outside links and dropped tags."""

    tag: str
    sign: str
    dropped: bool
    named: bool = False
    items: list = field(default_factory=list)
    chars: int = 0

    @property
    def key(self) -> str:
        """What elements are matched by: the sign, and for one without names also the signs inside."""
        if self.sign not in NAMELESS:
            return self.sign
        inner = sorted({x.sign for x in self.items if isinstance(x, Element)})
        return f"{self.sign}({' '.join(inner)})" if len(inner) <= WIDEST else self.sign


def _unwanted(token: str, inside_article: bool) -> bool:
    """A class or id names a part that isn't the article's: by its last word, or by its first if the others are general."""
    words = _NAME_PARTS.findall(token)
    if not words or words[0] in PART_NAMES:
        return False
    for word, others in ((words[-1], words[:-1]), (words[0], words[1:])):
        if word in DROPPED_NAMES and not (word == "header" and inside_article):
            if word is words[-1] and not ({"content", "article", "and"} & set(others)):
                return True
            if GENERAL_NAMES.issuperset(others):
                return True
    return False


def _open(tag: str, attributes: str, inside_article: bool) -> Element:
    names: set[str] = set()
    dropped = tag in DROPPED_TAGS or (tag == "header" and not inside_article)
    named = False
    for kind, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        tokens = next(filter(None, values), "").lower().split()
        for token in tokens:
            if not any(c.isdigit() for c in token):
                names.update(_NAME_PARTS.findall(token))
        if kind.lower() == "role":
            dropped |= bool(DROPPED_ROLES.intersection(tokens)) and not (inside_article and tokens == ["banner"])
        elif kind.lower() != "itemprop":
            named |= any(_unwanted(token, inside_article) for token in tokens)
    if tag in ("html", "body", "article", "main"):
        dropped = named = False
    return Element(tag, " ".join([tag, *sorted(names)]), dropped or named, named and not dropped)


def parse(html: str | None) -> Element:
    """The block elements of a page with their texts; (text, True) is a text in a link."""
    html = html or ""
    root = Element("html", "html", False)
    stack, opened, dropping = [root], Counter(), []  # open elements, how many of each tag, and where dropped ones are
    named: list[Element] = []
    at, size, links, articles = 0, len(html), 0, 0

    def close(depth: int) -> None:
        nonlocal articles
        while len(stack) > depth:
            gone = stack.pop()
            opened[gone.tag] -= 1
            articles -= gone.tag in ("article", "main")
            if dropping and dropping[-1] == len(stack):
                dropping.pop()
            if not gone.dropped or gone.named:
                stack[-1].chars += gone.chars
            if len(stack) > DEEPEST:
                stack[-1].items.append(None)

    def add_text(text: str) -> None:
        if text:
            whole = unescape(text) if "&" in text else text
            stack[-1].items.append((whole, links > 0))
            if not links and not whole.isspace():
                stack[-1].chars += len(whole)

    for found in _TOKEN.finditer(html):
        if found.start() < at:
            continue  # inside raw text
        add_text(html[at : found.start()])
        at = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        if found["end"] or found["end2"]:
            if tag == "a":
                links = max(links - 1, 0)
            elif opened[tag]:
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                close(depth)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else size
        elif tag == "a":
            links = 1
        elif tag == "br":
            add_text("\n")
        elif tag in VOID:
            continue
        elif (tag in BLOCKS or tag in DROPPED_TAGS) and tag not in ("html", "body"):
            if tag in ("article", "main"):
                if dropping:
                    close(dropping[0])
                articles += 1
            if stack[-1].tag == "p" or (tag in LINE_TAGS and stack[-1].tag == tag):
                close(len(stack) - 1)
            links = 0
            element = _open(tag, found["rest"] or found["rest2"] or "", articles > 0)
            if len(stack) <= DEEPEST:
                stack[-1].items.append(element)
            elif not element.dropped:  # its texts are those of the deepest element that counts
                stack[-1].items.append(None)
                element.items = stack[-1].items
            if element.dropped:
                dropping.append(len(stack))
            if element.named:
                named.append(element)
            stack.append(element)
            opened[tag] += 1
    add_text(html[at:])
    close(1)
    _rescue(root, named)
    return root


def _rescue(root: Element, named: list[Element]) -> None:
    """If next to nothing would remain, names were misread, and the elements with half of the text and more stay."""
    remaining = root.chars - sum(x.chars for x in _outermost(root))
    if named and remaining < 0.2 * root.chars:
        for element in named:
            if 2 * element.chars >= root.chars:
                element.dropped = element.named = False


def _outermost(element: Element) -> Iterator[Element]:
    """Elements that are dropped for their names and lie in no other dropped one."""
    for item in element.items:
        if isinstance(item, Element):
            if item.named:
                yield item
            elif not item.dropped:
                yield from _outermost(item)


# Wrappers. A node is a dict: sign, tag, drop, rep, opt, n (pages), chars (outside links), text (hash of the constant
# text, "" for none, null for a slot), same (hashes of texts that all its pages have), items.


def _mark(text: str) -> str:
    return blake2b(" ".join(text.split()).encode("utf-8", "surrogatepass"), digest_size=6).hexdigest()


def _own_text(element: Element) -> str:
    return "".join(x[0] for x in element.items if isinstance(x, tuple))


def wrap(element: Element) -> dict:
    """The wrapper of one page."""
    plain = [x[0] for x in element.items if isinstance(x, tuple) and not x[1] and not x[0].isspace()]
    words = _own_text(element)
    mark = _mark(words) if words.strip() else ""
    return {
        "key": element.key, "sign": element.sign, "tag": element.tag, "drop": element.dropped, "rep": False, "opt": False, "n": 1,
        "chars": sum(map(len, plain)), "text": mark, "same": [mark] if mark else [],
        "items": fold([wrap(x) for x in element.items if isinstance(x, Element)]),
    }


def fold(items: list[dict]) -> list[dict]:
    """Neighbours that repeat become one repeated group."""
    items = _fold_groups(items, 1)
    if len(items) > WIDEST:
        items = _fold_groups(_general(items), 1)
    size = 2
    while 2 * size <= len(items):
        items = _fold_groups(items, size)
        size += 1
    return items


def _general(items: list[dict]) -> list[dict]:
    """So many items with the fewest pages are matched by their tag alone that at most :data:`WIDEST` others are left."""
    few = sorted(range(len(items)), key=lambda i: items[i]["n"])[: len(items) - WIDEST]
    few = {i for i in few if items[i]["tag"]}
    return [x | {"key": x["tag"]} if i in few else x for i, x in enumerate(items)]


def _fold_groups(items: list[dict], size: int) -> list[dict]:
    keys = [x["key"] for x in items]
    found: list[dict] = []
    at = 0
    while at < len(items):
        if size == 1:
            if found and found[-1]["key"] == keys[at]:
                found[-1] = merge(found[-1], items[at], within=True) | {"rep": True}
            else:
                found.append(items[at])
            at += 1
            continue
        group = keys[at : at + size]
        if len(group) < size or group != keys[at + size : at + 2 * size]:
            found.append(items[at])
            at += 1
            continue
        node = _group(items[at : at + size])
        at += size
        while keys[at : at + size] == group:
            node = merge(node, _group(items[at : at + size]), within=True)
            at += size
        found.append(node | {"rep": True})
    return found


def _group(items: list[dict]) -> dict:
    key = "(" + " ".join(x["key"] for x in items) + ")"
    return {"key": key, "sign": key, "tag": "", "drop": False, "rep": False, "opt": False, "n": 1, "chars": 0, "text": "", "same": [], "items": items}


def merge(a: dict, b: dict, within: bool = False) -> dict:
    """One wrapper for both; ``within`` one page, neighbours are joined and count as one page."""
    same = set(a["same"]) | set(b["same"]) if within else set(a["same"]) & set(b["same"])
    return {
        "key": a["key"], "sign": a["sign"], "tag": a["tag"], "drop": a["drop"] and b["drop"], "same": sorted(same), "rep": a["rep"] or b["rep"], "opt": a["opt"] or b["opt"],
        "n": max(a["n"], b["n"]) if within else a["n"] + b["n"], "chars": a["chars"] + b["chars"],
        "text": a["text"] if a["text"] == b["text"] else None, "items": align(a["items"], b["items"], within),
    }


def align(a: list[dict], b: list[dict], within: bool) -> list[dict]:
    """Match along the longest common subsequence of keys; the rest is optional."""
    if [x["key"] for x in a] == [x["key"] for x in b]:
        return [merge(x, y, within) for x, y in zip(a, b, strict=True)]
    longest = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            same = a[i]["key"] == b[j]["key"]
            longest[i][j] = longest[i + 1][j + 1] + 1 if same else max(longest[i + 1][j], longest[i][j + 1])
    found, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i]["key"] == b[j]["key"]:
            found.append(merge(a[i], b[j], within))
            i, j = i + 1, j + 1
        elif longest[i + 1][j] >= longest[i][j + 1]:
            found.append(a[i] | {"opt": True})
            i += 1
        else:
            found.append(b[j] | {"opt": True})
            j += 1
    return fold(found + [x | {"opt": True} for x in a[i:] + b[j:]])


def expression(node: dict) -> str:
    """The wrapper as a regular expression, for reading."""
    text = "" if node["text"] == "" else "#text" if node["text"] is None else "text"
    inner = " ".join(filter(None, [text, *map(expression, node["items"])]))
    whole = f"({inner})" if node["tag"] == "" else f"<{node['sign']}>{inner}</{node['tag']}>"
    return f"({whole})" * (node["rep"] or node["opt"]) + "+" * node["rep"] + "?" * node["opt"] or whole


def _mass(node: dict) -> int:
    return 0 if node["drop"] else node["chars"] + sum(map(_mass, node["items"]))


def _kept(node: dict) -> Iterator[dict]:
    if not node["drop"]:
        yield node
        for item in node["items"]:
            yield from _kept(item)


def region(wrapper: dict) -> str:
    """The key of the element that holds the article."""
    total = _mass(wrapper)
    nodes = [x for x in _kept(wrapper) if x["tag"]]
    named = (
        lambda x: x["tag"] == "article" or "articlebody" in x["sign"].split()[1:],
        lambda x: x["tag"] == "main" or "main" in x["sign"].split()[1:],
        lambda x: not ARTICLE_NAMES.isdisjoint(x["sign"].split()[1:]),
    )
    for wanted in named:
        found = [x for x in nodes if wanted(x) and x["tag"] not in LINE_TAGS]
        best = max(found, key=_mass, default=None)
        if best and _mass(best) >= 0.3 * total and _mass(best) > 0:
            return best["key"]
    node = wrapper
    while True:
        inner = [x for x in node["items"] if not x["drop"] and x["tag"] not in (*LINE_TAGS, "")]
        best = max(inner, key=_mass, default=None)
        if best is None or best["rep"] or _mass(best) < 0.7 * total:
            return node["key"]
        node = best


def _place(path: str, mark: str) -> str:
    return _mark(f"{path} {mark}")


def template(wrapper: dict, key: str) -> list[str]:
    """Texts that all pages have at the same place inside the element with ``key``, each as a digest of place and text."""
    found: set[str] = set()

    def inside(node: dict, path: str) -> None:
        if node["drop"]:
            return
        if node["tag"]:
            path = f"{path}>{node['key']}"
            if node["n"] >= max(TEMPLATE_PAGES, wrapper["n"] / 2):
                found.update(_place(path, mark) for mark in node["same"])
        for item in node["items"]:
            inside(item, path)

    def seek(node: dict) -> None:
        if node["key"] == key and node["tag"]:
            inside(node, "")
        elif not node["drop"]:
            for item in node["items"]:
                seek(item)

    if wrapper["n"] >= TEMPLATE_PAGES:
        seek(wrapper)
    return sorted(found)


def _find(element: Element, key: str) -> Iterator[Element]:
    for item in element.items:
        if isinstance(item, Element) and not item.dropped:
            if item.key == key:
                yield item
            else:
                yield from _find(item, key)


def _blocks(element: Element, path: str, constant: frozenset[str], pieces: list[tuple[str | None, bool]]) -> None:
    """(text, whether it is the template's) of blocks; a text of None parts two blocks."""
    path = f"{path}>{element.key}" if constant else ""
    words = _own_text(element) if constant else ""
    is_template = bool(words.strip()) and _place(path, _mark(words)) in constant
    for item in element.items:
        if isinstance(item, tuple):
            pieces.append((item[0], is_template))
        elif item is None:
            pieces.append((None, False))
        elif not item.dropped:
            pieces.append((None, False))
            _blocks(item, path, constant, pieces)
            pieces.append((None, False))


def _lines(pieces: list[tuple[str | None, bool]]) -> Iterator[str]:
    block: list[str] = []
    for piece, _ in [*pieces, (None, False)]:
        if piece is None:
            if line := " ".join("".join(block).split()):
                yield line
            block = []
        else:
            block.append(piece)


def main_text(html: str | None, key: str | None, constant: frozenset[str] = frozenset()) -> str:
    """The text of a page from the elements with the host's key, without the template's ``constant`` texts, else with the key of
    its own wrapper."""
    page = parse(html)
    found = [page] if key == page.key else list(_find(page, key)) if key else []
    if not found:
        own, constant = region(wrap(page)), frozenset()
        found = [page] if own == page.key else list(_find(page, own))
    lines: list[str] = []
    for element in found:
        pieces: list[tuple[str | None, bool]] = []
        _blocks(element, "", constant, pieces)
        sizes = [(len(text.strip()), fixed) for text, fixed in pieces if text]
        if 2 * sum(n for n, fixed in sizes if fixed) <= sum(n for n, _ in sizes):
            pieces = [("" if fixed else text, False) for text, fixed in pieces]
        lines.extend(_lines(pieces))
    return "\n".join(lines)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def _dump(held: dict[str, dict], salt: int) -> pd.DataFrame:
    return pd.DataFrame({"host": list(held), "salt": salt, "wrapper": [json.dumps(x) for x in held.values()]})


def _fold_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A wrapper per host for every batch, so that the hosts held are bounded."""
    for batch in batches:
        held: dict[str, dict] = {}
        salt = 0
        for host, salt, html in zip(batch["host"], batch["salt"], batch["html"], strict=True):
            page = wrap(parse(html))
            held[host] = merge(held[host], page) if host in held else page
        if held:
            yield _dump(held, salt)


def _fold_wrappers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by host."""
    host, salt, held = None, 0, None
    for batch in batches:
        done: dict[str, dict] = {}
        for following, salt, text in zip(batch["host"], batch["salt"], batch["wrapper"], strict=True):
            wrapper = json.loads(text)
            if following == host:
                held = merge(held, wrapper)
            else:
                if held is not None:
                    done[host] = held
                host, held = following, wrapper
        if done:  # an empty frame has no text columns
            yield _dump(done, salt)
    if held is not None:
        yield _dump({host: held}, salt)


def infer_wrappers(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, wrapper (JSON): a row per host, from all its pages."""
    shape = "host string, salt int, wrapper string"
    pages = df.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    salted = pages.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    partial = salted.mapInPandas(_fold_pages, shape)
    parts = partial.repartition("host", "salt").sortWithinPartitions("host", "salt").mapInPandas(_fold_wrappers, shape)
    whole = parts.repartition("host").sortWithinPartitions("host").mapInPandas(_fold_wrappers, shape)
    return whole.select("host", "wrapper")


def _regions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        wrappers = [json.loads(x) for x in batch["wrapper"]]
        places = [region(x) for x in wrappers]
        texts = [template(x, place) for x, place in zip(wrappers, places, strict=True)]
        yield pd.DataFrame({"host": batch["host"], "place": places, "constant": texts})


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        given = zip(batch.pop("html"), batch.pop("place"), batch.pop("constant"), strict=True)
        yield batch.assign(text=[main_text(html, place, frozenset(() if texts is None else texts)) for html, place, texts in given])


def extract_text(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``df``: key, url, text."""
    scratch = Scratch(df.sparkSession, "html")
    wrappers = scratch.write(infer_wrappers(df, url, html), "wrappers")
    places = scratch.write(wrappers.mapInPandas(_regions, "host string, place string, constant array<string>"), "regions")
    places = bounded(places.withColumnRenamed("host", "its_host"))
    pages = df.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    joined = pages.join(places, host_of(F.col("url")) == F.col("its_host"), "left").drop("its_host")
    kinds = [df.schema[c].dataType.simpleString() for c in (key, url)]
    return joined.mapInPandas(_extract, f"key {kinds[0]}, url {kinds[1]}, text string")
