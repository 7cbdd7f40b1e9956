"""Main text of web pages by the style tree of their site.

All pages of a host are merged into one tree. A node is an element by its path (tags with their classes);
it knows on how many pages it stands, which child sequences (presentations) it has there, which texts, and how many words,
linked or not. Two things make a branch unimportant:

* Its texts and presentations repeat. The importance of a node's text is 1 less the mean entropy of its texts over the pages; a
  node's own importance is the entropy of its presentations; both are composed bottom-up as in the published method (weight 0.9
  to the power of the number of presentations for the node itself). A branch that is low all through, taken against the
  most important text of its host, is removed from every page.
* It holds little that is new beside the host's content. The content root is the deepest branch with half of the host's
  new, unlinked words (words weighed by the importance of their text). A branch beside it is low if four fifths of
  its words are links, or if a page of it has under a quarter of the new words of a page of the root and its blocks are shorter than a
  paragraph (``PARAGRAPH`` words). Such a branch is removed from the pages that have the root. One with an ``h1`` is
  judged by its links alone, as it may hold the page's title.

The tree speaks for branches on ``LEAST_PAGES`` pages or more. Under it, what an element is for (tag, role, class and id) has a say
where a site has too few pages: comments go; so do menus, headers and footers of the page, sidebars, notices, adverts
and forms. A class token marks an element if all its parts are such words or mere nouns of layout ("sidebar", "cookie-notice",
"share-bar"; not "with-sidebar", "comments-open"). Where nothing but headings is left, branches that only a class or a form marks come
back, if most of their words are no links. Where one article has half of the words that are left, what stands outside of articles stays only as an ``h1`` or
as a paragraph of ``PARAGRAPH`` unlinked words.

Pages are read twice, each time row by row; only counts of (host, path, text hash) are shuffled, summed per task
before, so a host with most of the pages is no single task. A host's low branches are one row.

Defined cases: a null or empty page has an empty text, as has one of marked branches alone; a page without a url belongs to the host without a name; repeated
rows are extracted one by one; an empty table gives no rows; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hazlake.session import stage

LEAST_PAGES = 4
LEAST_IMPORTANCE = 0.25
OWN_WEIGHT = 0.9
ROOT_SHARE = 0.5
LINK_SHARE = 0.8
PARAGRAPH = 20

# Element names of the HTML standard, by how text in and around them is read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
UNSHOWN = frozenset(
    "head script style title template noscript iframe object canvas audio video svg math noembed noframes button select "
    "datalist textarea option".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}, "option": {"option"}, "body": {"head"},
}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}

# What marks an element as something other than the article.
ASIDE_TAGS = frozenset("nav footer aside dialog menu".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner sidebar sidebars aside "
    "menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup "
    "modal overlay subscribe subscription newsletter signup login share sharing social related recommended recommendations "
    "widget widgets toolbar pagination pager skip topbar cookiebar adsbygoogle taboola outbrain".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies reply response responses discussion discussions feedback".split())
#: Parts that say nothing of their own beside a mark.
LAYOUT_WORDS = frozenset(
    "area bar block body box button buttons col column container content foot form group head inner item items left link links list main "
    "article articles card cards global local mobile reader readers user users visitor visitors outer panel post posts right rail row section site page primary secondary slot stories story thread top bottom unit wrap wrapper".split()
)
#: Levels of importance: a class or a form may be wrong, an element's own tag or role is not.
ASIDE_PRIOR = 0.1
NEVER_PRIOR = 0.01
ARTICLE_SHARE = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>?)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HEADING = re.compile(r"h[1-6]\Z")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")


class Open(NamedTuple):
    """An open element: its path, and what holds for all inside it."""

    tag: str
    path: str
    unshown: bool
    prior: float  # the least factor of importance of what is open
    article: int  # number of the outermost article or main part that is open, 0 if none
    hidden: bool
    linked: bool
    heading: str  # tag of the heading that is open


class Text(NamedTuple):
    block: int
    path: str
    prior: float
    article: int
    text: str
    linked: bool = False
    heading: str = ""


@lru_cache(1 << 16)
def _marked(token: str, words: frozenset[str]) -> bool:
    """Whether a class token or an id as a whole says that an element is one of ``words``."""
    found = [w.lower() for w in _WORD.findall(token)]
    parts = set(found)
    return "".join(found) in words or bool(parts & words) and parts <= ASIDE_WORDS | COMMENT_WORDS | LAYOUT_WORDS | {"header"}


def _opened(tag: str, attributes: str, above: Open, number: int) -> Open:
    path, prior, article, hidden = above.path, above.prior, above.article, above.hidden
    heading = tag if _HEADING.match(tag) else above.heading
    unshown = above.unshown or tag in UNSHOWN
    marks, role = "", ""
    if "=" in attributes or "hidden" in attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), entities.unescape(a or b or c)
            if name in ("class", "id"):
                marks += " " + value
            elif name in ("role", "itemprop"):
                role = value.lower() if name == "role" or value.lower() == "articlebody" else role
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "").lower()):
                hidden = True
    tokens = marks.split()
    begins = tag in ("article", "main") or role in ("main", "article", "articlebody")
    if tag in ("html", "body", "main"):
        pass
    elif any(_marked(t, COMMENT_WORDS) for t in tokens):
        prior = min(prior, NEVER_PRIOR)
    elif not begins and (tag in ASIDE_TAGS or role in ASIDE_ROLES):
        prior = min(prior, NEVER_PRIOR)
    elif not begins and (
        tag == "form" or role == "form" or (tag == "header" and not article) or any(_marked(t, ASIDE_WORDS) for t in tokens)
        or (not article and any(_marked(t, frozenset({"header"})) for t in tokens))
    ):
        prior = min(prior, ASIDE_PRIOR)
    if begins and not article and prior == 1:
        article = number
    if tag not in INLINE or marks:
        own = ".".join([tag, *_DIGITS.sub("0", marks).split()])
        path = f"{path}/{own}" if path else own
    return Open(tag, path, unshown, prior, article, hidden, above.linked or tag == "a", heading)


def read_page(html: str) -> tuple[list[Text], dict[str, list[str]]]:
    """(the texts in page order, {path: keys of its children in order})."""
    stack = [Open("", "", False, 1.0, 0, False, False, "")]
    texts: list[Text] = []
    children: dict[str, list[str]] = {}
    block = at = 0
    size = len(html)
    while at < size:
        found = _TOKEN.search(html, at)
        end = found.start() if found else size
        if end > at:
            top = stack[-1]
            piece = html[at:end]
            if not top.unshown:
                texts.append(Text(block, top.path, 0.0 if top.hidden else top.prior, top.article, entities.unescape(piece) if "&" in piece else piece, top.linked, top.heading))
        if not found:
            break
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        breaks = tag not in INLINE and tag not in UNSHOWN
        block += breaks
        if found[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in VOID:
            continue
        if tag in CLOSES:
            within = HOLDS.get(tag, frozenset())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in within:
                    break
                if stack[k].tag in CLOSES[tag]:
                    del stack[k:]
        elif breaks and any(x.tag == "p" for x in stack):
            # A block ends the paragraph that is open, if nothing that holds blocks was opened inside it.
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag not in INLINE:
                    break
        attributes = found[3]
        new = _opened(tag, attributes, stack[-1], at)
        if new.path != stack[-1].path:
            below = children.setdefault(stack[-1].path, [])
            key = new.path.rpartition("/")[2]
            if not below or below[-1] != key:
                below.append(key)
        if tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
            if tag not in UNSHOWN and not new.unshown:
                texts.append(Text(block, new.path, 0.0, new.article, html[at : close.start() if close else size]))
            at = close.start() if close else size
            stack.append(new)
        elif not attributes.rstrip(">").endswith("/") or tag not in ("svg", "math"):
            stack.append(new)
    return texts, children


def host_of(url):
    """Host of a url, lower-cased; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


_PAGES, _CONTENT, _STYLE, _WORDS, _LINKED = range(5)


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, kind, value, n): pages a path stands on, and how many of them have a text or a presentation there; words in all, and linked ones."""
    for batch in batches:
        seen: Counter = Counter()
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            texts, children = read_page(html or "")
            blocks: dict[tuple[int, str], str] = {}
            for t in texts:
                blocks[t.block, t.path] = blocks.get((t.block, t.path), "") + t.text
                if n := len(t.text.split()):
                    seen[host, t.path, _WORDS, ""] += n
                    if t.linked:
                        seen[host, t.path, _LINKED, ""] += n
            content = {(path, joined) for (_, path), text in blocks.items() if (joined := " ".join(text.split()))}
            on_page = {path for path, _ in content} | children.keys()
            seen.update((host, path, _PAGES, "") for path in on_page)
            seen.update((host, path, _CONTENT, text) for path, text in content)
            seen.update((host, path, _STYLE, "\t".join(keys)) for path, keys in children.items())
        if seen:
            hosts, paths, kinds, values = zip(*seen)
            hashes = pd.util.hash_array(np.array(values, dtype=object)).view(np.int64)
            columns = [pa.array(hosts), pa.array(paths), pa.array(kinds, pa.int32()), pa.array(hashes), pa.array(list(seen.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["host", "path", "kind", "value", "n"])


def _composed(rows: dict, below: dict[str, list[str]], upwards: list[str]) -> set[str]:
    """The branches whose texts and presentations are of low importance all through."""
    composed: dict[str, float] = {}
    for path in upwards:
        r = rows[path]
        kids = below.get(path, [])
        parts = [(rows[k].pages, composed[k]) for k in kids]
        if r.texts:
            parts.append((r.pages, 1 - r.text_entropy / r.texts))
        inside = sum(w * x for w, x in parts) / sum(w for w, _ in parts) if parts else 0.0
        own = OWN_WEIGHT ** r.styles if r.styles and kids else 0.0
        composed[path] = (1 - own) * inside + own * r.style_entropy if not r.texts else inside
    most = max((1 - r.text_entropy / r.texts for r in rows.values() if r.texts), default=0.0)
    whole: dict[str, bool] = {}
    for path in upwards:
        whole[path] = composed[path] < LEAST_IMPORTANCE * most and all(whole[k] for k in below.get(path, []))
    return {p for p, x in whole.items() if x and p}


class Held(NamedTuple):
    """What a branch holds on all pages."""

    new: float  # unlinked words, each weighed by the importance of its text
    words: int
    linked: int
    blocks: int
    titled: bool


def _beside(rows: dict, below: dict[str, list[str]], upwards: list[str]) -> tuple[str, set[str]]:
    """(content root, the branches beside it that hold little that is new)."""
    held: dict[str, Held] = {}
    for path in upwards:
        r = rows[path]
        new = (r.words - r.linked) * (1 - r.text_entropy / r.texts) if r.texts else 0.0
        title = path.rpartition("/")[2].partition(".")[0] == "h1"
        parts = [Held(new, r.words, r.linked, r.blocks, title), *(held[k] for k in below.get(path, []))]
        held[path] = Held(*(sum(column) for column in zip(*(p[:4] for p in parts))), any(p.titled for p in parts))
    root = ""
    while root in rows:
        inner = [k for k in below.get(root, []) if below.get(k) and held[k].new >= ROOT_SHARE * held[""].new > 0]
        if not inner:
            break
        root = inner[0]
    beside: set[str] = set()
    steps = root.split("/") if root else []
    for depth in range(len(steps)):
        above = "/".join(steps[:depth])
        for path in below.get(above, []):
            h = held[path]
            if path == "/".join(steps[: depth + 1]) or not h.words:
                continue
            small = h.new / rows[path].pages < LEAST_IMPORTANCE * held[root].new / rows[root].pages and h.words - h.linked < PARAGRAPH * max(h.blocks, 1)
            if h.linked >= LINK_SHARE * h.words or (small and not h.titled):
                beside.add(path)
    return root, beside


def _removed(group: pd.DataFrame) -> pd.DataFrame:
    """The low branches of one host's tree; rows as ``style_tree`` gives them."""
    rows = {r.path: r for r in group.itertuples()}
    below: dict[str, list[str]] = {}
    for path in rows:
        if path:
            below.setdefault(path.rpartition("/")[0], []).append(path)
    upwards = sorted(rows, key=lambda p: -p.count("/") - bool(p))
    root, beside = _beside(rows, below, upwards) if "" in rows else ("", set())
    return pd.DataFrame([{"host": group["host"].iloc[0], "removed": sorted(_composed(rows, below, upwards)), "root": root, "beside": sorted(beside)}])


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, pages, texts, text_entropy, styles, style_entropy, blocks, words, linked) of the branches on enough pages.

    ``text_entropy`` sums the entropies of the node's texts, to the base of its pages; ``style_entropy`` is that of its presentations.
    """
    rows = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    seen = rows.mapInArrow(_observed, "host string, path string, kind int, value long, n long")
    counts = seen.groupBy("host", "path", "kind", "value").agg(F.sum("n").alias("n"))
    content, style = F.col("kind") == _CONTENT, F.col("kind") == _STYLE
    nodes = counts.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == _PAGES, F.col("n"))).alias("pages"),
        F.count_if(content).alias("texts"),
        F.coalesce(F.sum(F.when(content, F.ln("n"))), F.lit(0.0)).alias("text_logs"),
        F.coalesce(F.sum(F.when(content, F.col("n"))), F.lit(0)).alias("blocks"),
        F.coalesce(F.sum(F.when(F.col("kind") == _WORDS, F.col("n"))), F.lit(0)).alias("words"),
        F.coalesce(F.sum(F.when(F.col("kind") == _LINKED, F.col("n"))), F.lit(0)).alias("linked"),
        F.count_if(style).alias("styles"),
        F.coalesce(F.sum(F.when(style, F.col("n"))), F.lit(0)).alias("styled"),
        F.coalesce(F.sum(F.when(style, F.col("n") * F.ln("n"))), F.lit(0.0)).alias("style_logs"),
    ).filter(F.col("pages") >= LEAST_PAGES)
    base = F.ln("pages")
    entropy = F.when(F.col("styled") > 0, (F.ln("styled") - F.col("style_logs") / F.col("styled")) / base).otherwise(0.0)
    return nodes.select("host", "path", "pages", "texts", (F.col("text_logs") / base).alias("text_entropy"), "styles", entropy.alias("style_entropy"), "blocks", "words", "linked")


def removed_branches(pages: DataFrame) -> DataFrame:
    """(host, removed, root, beside): paths of low importance of every host, those removed beside its content root apart."""
    return style_tree(pages).groupBy("host").applyInPandas(_removed, "host string, removed array<string>, root string, beside array<string>")


def main_text(html: str, removed: frozenset[str], root: str = "", beside: frozenset[str] = frozenset()) -> str:
    """The page's text without branches that are removed or not the article; ``beside`` counts if the page has ``root``."""
    read, children = read_page(html)
    if beside and root in children:
        removed = removed | beside
    held: dict[str, bool] = {"": True}

    def stays(path: str) -> bool:
        if path not in held:
            held[path] = path not in removed and stays(path.rpartition("/")[0])
        return held[path]

    texts = [(t, len(t.text.split())) for t in read if t.prior > NEVER_PRIOR and stays(t.path)]
    weak = [(n, t.linked) for t, n in texts if t.prior < 1]
    plain = any(n for t, n in texts if t.prior == 1 and not t.heading)
    if not plain and 2 * sum(n for n, linked in weak if linked) < sum(n for n, _ in weak):
        # Nothing but headings stands outside the branches that a class or a form marks: these are the page.
        kept = texts
    else:
        kept = [(t, n) for t, n in texts if t.prior == 1]

    by_article: Counter = Counter()
    unlinked: Counter = Counter()
    for t, n in kept:
        by_article[t.article] += n
        if not t.linked:
            unlinked[t.block] += n
    largest = max((n for article, n in by_article.items() if article), default=0)
    articles_only = largest and largest >= ARTICLE_SHARE * by_article.total()

    blocks: dict[int, str] = {}
    for t, _ in kept:
        if t.article or not articles_only or t.heading == "h1" or unlinked[t.block] >= PARAGRAPH:
            blocks[t.block] = blocks.get(t.block, "") + t.text
    return " ".join(" ".join(blocks.values()).split())


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of (page_id, url, html)."""
    low = stage(removed_branches(pages), "removed")

    def texts(batches):
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("html", "removed", "root", "beside")]
            out = [main_text(h or "", frozenset(gone or ()), root or "", frozenset(beside or ())) for h, gone, root, beside in zip(*columns)]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html")).withColumn("host", host_of(F.col("url")))
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    return rows.join(low, "host", "left").select("page_id", "url", "html", "removed", "root", "beside").mapInArrow(texts, schema)
