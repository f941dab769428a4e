"""Main text of web pages with a site style tree.

Pages are read into trees of elements.  The trees of one host are merged: an element's
place in the style tree is its path of (tag, class) from the root.  Over the pages that
have a place, the entropy of what stands there (its row of children, and its text),
divided by the logarithm of their number, is the importance of the place: near 0
where all pages show the same, near 1 where each has its own.  Places of low importance
on enough pages go from every page, and so do branches whose element, class, id or role
says that they are menus, headers, footers, sidebars, notices, adverts, forms or reader
comments.  Places inside article and main elements are weighed like all others.  So that
copied articles do not look like a template, pages whose articles say the same have one
vote on their host: a place counts what distinct articles show there.  Inside an article
an element of running text (``INLINE``) is weighed with its block, not alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import slices, small_batches, written

#: Distinct articles that must have a place, and importance under which it is a template's.
MIN_PAGES, LOW = 8, 0.3

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|"""
                 r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

# Elements of HTML by what they do to the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("head script style title noscript template iframe nav footer aside form button select option textarea "
                    "input menu dialog svg canvas object embed video audio".split())
ARTICLE = frozenset("article main".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
SCOPE = frozenset("html body article section div main table ul ol dl nav aside footer header form".split())

# Words of a class, id or role that say a branch is not the article.
SIGNS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted banner banners cookie "
                  "cookies consent gdpr notice notices alert alerts popup modal overlay nav navbar navigation menu menus "
                  "breadcrumb breadcrumbs sidebar sidebars aside footer header masthead topbar toolbar comment comments "
                  "commentlist discussion replies disqus respond share sharing social related recommended newsletter subscribe "
                  "subscription signup login search form widget widgets pagination pager contentinfo complementary "
                  "dialog skip legal copyright".split())
#: Signs that an article's own header may carry.
HEADING = frozenset("header masthead banner".split())
#: Signs that inside an article may as well name a part of it, and elements that never are a branch there.
SPOKEN = frozenset("search legal comment form discussion replies notice notices alert alerts footer skip copyright respond share "
                   "related recommended dialog overlay".split())
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr table tbody thead pre blockquote figure figcaption".split())


@dataclass
class Node:
    tag: str
    signs: frozenset[str]
    label: str
    hidden: bool = False
    #: Signs that are all a class, id or role says.
    alone: frozenset[str] = frozenset()
    children: list = field(default_factory=list)


def parse(source: str | None) -> Node:
    """Tree of a page: elements and decoded strings in page order.  Open elements end as
    HTML has it (a paragraph before the next block, an item before the next one); an end
    tag without a start is ignored."""
    root = Node("#", frozenset(), "#")
    if not source:
        return root
    stack, at, n = [root], 0, len(source)

    def text(a: int, b: int) -> None:
        if a < b:
            stack[-1].children.append(html.unescape(source[a:b]))

    while at < n:
        m = TAG.search(source, at)
        if not m:
            text(at, n)
            break
        text(at, m.start())
        at = m.end()
        slash, name, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            if m[0].startswith("<![CDATA["):
                text(m.start() + 9, at - 3)
            continue
        name = name.lower()
        if slash:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    del stack[k:]
                    break
                if name in INLINE and stack[k].tag in SCOPE:
                    break
            continue
        if name in CLOSES_P or name in SAME:
            ends = SAME.get(name, {"p"})
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    del stack[k:]
                    if name not in ("tr", "tbody", "thead"):
                        break
                elif stack[k].tag in SCOPE:
                    break
        node = _node(name, attrs)
        stack[-1].children.append(node)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else n
        elif name not in VOID and not attrs.rstrip().endswith("/"):
            stack.append(node)
    return root


def _node(name: str, attrs: str) -> Node:
    if not attrs.strip(" /\t\n\r"):
        return Node(name, frozenset(), name)
    got = {k.lower(): (v or "").strip("\"'") for k, v in ATTR.findall(attrs)}
    said = " ".join(got.get(k, "") for k in ("class", "id", "role"))
    said = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", said)
    signs = SIGNS.intersection(re.split(r"[^a-z]+", said.lower()))
    hidden = "hidden" in got or "display:none" in got.get("style", "").replace(" ", "").lower()
    alone = signs.intersection(got.get(k, "").strip().lower() for k in ("class", "id", "role"))
    return Node(name, frozenset(signs), f"{name}.{got.get('class', '')}" if got.get("class") else name, hidden, frozenset(alone))


def dropped(node: Node, inside: bool) -> bool:
    """Whether a branch says itself that it is not the article."""
    if node.tag in DROPPED or node.hidden or node.tag == "header" and not inside:
        return True
    if node.tag in ("html", "body") or node.tag == "article" and not node.signs & {"comment", "comments", "ad", "related"}:
        return False
    if inside and node.tag != "article":
        # Its author's words: a section on search or a legal analysis is no menu.
        return node.tag not in RUNNING and bool(node.signs - HEADING - (SPOKEN - node.alone))
    return bool(node.signs)


def _hash(text: str, seed: int = 0) -> int:
    return _signed(xxhash.xxh3_64_intdigest(text, seed & (2 ** 64 - 1)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _joined(parts: list[int]) -> int:
    """What stands in an element, from what stands in its children: nothing is 0, and an
    element around a single one says the same."""
    if len(parts) < 2:
        return parts[0] if parts else 0
    return _signed(xxhash.xxh3_64_intdigest(b"".join(p.to_bytes(8, "little", signed=True) for p in parts)))


def places(root: Node) -> tuple[int, list[tuple[int, int, int]]]:
    """The page's vote, which is what its articles say (its main elements, or all of it,
    where there is none), and (place, children's style, content) of the elements that are
    to be weighed.  A place is a hash of the labels from the root on."""
    out: list[tuple[int, int, int]] = []
    said: dict[str, list[int]] = {"article": [], "main": []}
    # Frames: element, place, inside, below an article, children still to come, contents found.
    stack = [(root, 0, False, False, iter(root.children), [])]
    whole = 0
    while stack:
        node, place, inside, article, rest, parts = stack[-1]
        for child in rest:
            if isinstance(child, str):
                if words := " ".join(child.split()):
                    parts.append(_hash(words))
            elif not dropped(child, inside):
                stack.append((child, _hash(child.label, place), inside or child.tag in ARTICLE, article or child.tag == "article", iter(child.children), []))
                break
        else:
            stack.pop()
            content = _joined(parts)
            if node.tag not in ("#", "html", "body") and content and not (inside and node.tag in INLINE):
                kinds = ",".join(c.label for c in node.children if isinstance(c, Node))
                out.append((place, _hash(kinds), content))
            if not stack:
                whole = content
                continue
            if content:
                stack[-1][5].append(content)
            if node.tag in said and not stack[-1][3]:
                said[node.tag].append(content)
    return _joined(said["article"] or said["main"] or [whole]), out


def main_text(root: Node, noise: frozenset[int]) -> str:
    """Text of the main and article elements, or of the page where there is none, without
    dropped branches and places of low importance; blocks are joined by one space."""
    def low(node: Node, place: int, inside: bool) -> bool:
        return place in noise and not (inside and node.tag in INLINE)

    articles: list[tuple[Node, int]] = []
    stack = [(root, 0, iter(root.children))]
    while stack:
        _, place, rest = stack[-1]
        for child in rest:
            if isinstance(child, Node) and not dropped(child, False):
                here = _hash(child.label, place)
                if low(child, here, False):
                    continue
                if child.tag in ARTICLE:
                    articles.append((child, here))
                else:
                    stack.append((child, here, iter(child.children)))
                    break
        else:
            stack.pop()

    blocks: list[str] = []
    for top, start in articles or [(root, 0)]:
        blocks.append(" ")
        open_ = [(top, start, bool(articles), iter(top.children))]
        while open_:
            node, place, inside, rest = open_[-1]
            for child in rest:
                if isinstance(child, str):
                    blocks.append(child)
                    continue
                if child.tag == "br":
                    blocks.append(" ")
                    continue
                here = _hash(child.label, place)
                if dropped(child, inside) or low(child, here, inside):
                    continue
                if child.tag not in INLINE:
                    blocks.append(" ")
                open_.append((child, here, inside or child.tag in ARTICLE, iter(child.children)))
                break
            else:
                open_.pop()
                if node.tag not in INLINE:
                    blocks.append(" ")
    return " ".join("".join(blocks).split())


def host(url):
    """Host of a url column, without port and in lower case; null without one."""
    found = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(found != "", found)


def style_tree(pages: DataFrame) -> DataFrame:
    """(_host, _noise): the weighed places of a host whose importance is low.
    pages: _host, html.  Pages without a host are not weighed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                rows = []
                for h, s in zip(*(part.column(c).to_pylist() for c in ("_host", "html"))):
                    vote, found = places(parse(s))
                    rows += [(h, vote, *x) for x in dict.fromkeys(
                        x for place, kinds, content in found
                        for x in ((place, KINDS, kinds), (place, CONTENT, content), (place, VOTE, vote)))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], NAMES)

    seen = pages.where("_host IS NOT NULL").mapInArrow(run, "_host string, _vote long, place long, what int, is long")
    counted = seen.distinct().groupBy("_host", "place", "what", "is").agg(F.count("*").alias("n"))
    entropy = (counted.groupBy("_host", "place", "what")
               .agg(F.count("*").alias("kinds"), F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nln"))
               .withColumn("importance", F.when(F.col("m") > 1, (F.log("m") - F.col("nln") / F.col("m")) / F.log("m")).otherwise(1.0)))
    votes, weighed = F.col("what") == VOTE, F.col("what") != VOTE
    return (entropy.groupBy("_host", "place")
            .agg(F.max(F.when(votes, F.col("kinds"))).alias("m"), F.max(F.when(weighed, F.col("importance"))).alias("importance"))
            .where((F.col("m") >= MIN_PAGES) & (F.col("importance") < LOW))
            .groupBy("_host").agg(F.collect_set("place").alias("_noise")))


#: What a row of a place says: its children's style, its content, or the vote that has it.
KINDS, CONTENT, VOTE = 0, 1, 2
TYPES = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
NAMES = ["_host", "_vote", "place", "what", "is"]


def extract(pages: DataFrame) -> DataFrame:
    """Every row of ``pages`` (page_id, url, html) with text, the main text of its html.

    Null or empty html: ''.  Null urls share no host, so only the page itself speaks.
    Character references are decoded; white space of any kind becomes one space.  Repeated
    rows get equal texts; an input column text is replaced."""
    small_batches(pages.sparkSession)
    base = pages.drop("text")
    keyed = base.withColumn("_host", host(F.col("url")))
    # Stored, so that its size is known before the pages are dealt out for the join.
    noise = written(style_tree(keyed.select("_host", "html")), "low-places")
    joined = keyed.join(noise, "_host", "left")
    columns = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                out = [main_text(parse(s), frozenset(x or ()))
                       for s, x in zip(part.column("html").to_pylist(), part.column("_noise").to_pylist())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(out, pa.string())],
                                                 [*columns, "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return joined.mapInArrow(run, schema + ", text string")
