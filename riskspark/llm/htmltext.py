"""Main text of web pages by site template removal.

Pages are parsed into elements; an element's subtree is hashed from its tag,
class, id, text and children, so that links and other attributes may differ.
Spark counts each (host, subtree) over the pages it occurs on, with partial sums
per block, so a host with a third of all pages is no hot group.  Subtrees on many
pages of their host (``MIN_PAGES``, whatever the host's size) are the site's
template and are deleted, but for text blocks inside the article, where a
recurring paragraph is the article's own.  Elements that HTML or their class and
id names mark as menus, adverts, notices, comments and the like go as well, text
blocks inside the article excepted.  The text is that of all articles, else of all
marked main parts, else of what is left.

The template keys reach the tasks as one sorted array if there are at most
``BROADCAST_KEYS`` of them; beyond that, a join brings each page its own.

Defined cases: null or empty html has an empty text; a url without a host has the
host ""; rows without a page_id and repeated rows are extracted one by one; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, map_arrow, read_table, written

#: A subtree is template if on so many pages of its host.
MIN_PAGES = 10
#: Template keys (8 bytes each) sent to every task; more are joined to the pages.
BROADCAST_KEYS = 2_000_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|iframe|svg|math|object|canvas|select|title"
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset("head nav aside footer form button dialog menu input label legend fieldset audio video".split())
#: Elements whose start ends an open element of the same family.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
#: Name parts of class, id and role that mark what is not main text.
MARKS = frozenset(
    "nav navigation navbar menu menubar breadcrumb breadcrumbs masthead topbar footer contentinfo sidebar aside "
    "complementary widget widgets related recommended ad ads advert advertisement advertisements adsense sponsor "
    "sponsored promo promotion cookie cookies consent gdpr notice notices banner popup modal overlay newsletter "
    "subscribe subscription signup share sharing social comment comments reply replies respond disqus login search "
    "pagination pager toolbar skip copyright disclaimer alert dialog form".split())
#: Parts that mark it only outside the article's own parts.
WEAK = frozenset("header head".split())
OWN = frozenset("article post entry content story main body text page".split())
CONTENT = frozenset("article post entry content story main".split())
TEXT_BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 blockquote pre table thead tbody tr td th dl dt dd figcaption figure b i em "
    "strong a span u s code sub sup small mark q cite abbr time br li ul ol header hgroup article main".split())

_SKIP = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[|\]\]>|<[!?][^>]*>", re.S | re.I)
#: One attribute: name, and its value in double, single or no quotes.  Nothing is tried twice.
_ATTRIBUTE = r"""[^\s=>/"'][^\s=>/]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+"""
_TAG = re.compile(rf"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[\s/]++|{_ATTRIBUTE}|["'=][^\s>]*+)*+)>""")
_ATTR = re.compile(r"""([^\s=>/"'][^\s=>/]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?+)?+|["'=][^\s>]*+""")
_CLOSED = re.compile(r"""(?:^|[\s"'])/\s*$""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)")


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


class Element:
    __slots__ = ("tag", "names", "children", "parts", "hidden")

    def __init__(self, tag: str, attributes: str):
        self.tag = tag
        self.children: list = []  # elements and strings
        self.names = ""
        self.parts: frozenset[str] = frozenset()
        self.hidden = False
        if attributes and not attributes.isspace():
            given = {}
            for k, a, b, c in _ATTR.findall(attributes):
                given.setdefault(k.lower(), a or b or c)
            found = [(k, v) for k, v in given.items() if k in ("class", "id", "role") and v]
            if found:
                self.names = ";".join(f"{k}={v}" for k, v in found)
                self.parts = frozenset(p.lower() for _, v in found for p in _PARTS.findall(v))
            self.hidden = ("hidden" in given or given.get("aria-hidden", "").lower() == "true"
                           or "display:none" in "".join(given.get("style", "").lower().split()))


def parse(source: str) -> Element:
    """Element tree of a page; unclosed and stray tags are mended as browsers do in the main."""
    source = _SKIP.sub(" ", source)
    root = Element("#page", "")
    stack = [root]
    last = 0
    for m in _TAG.finditer(source):
        if m.start() > last:
            stack[-1].children.append(source[last:m.start()])
        last = m.end()
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("article", "body", "main", "section", "table") and tag not in BLOCK:
                    break
            continue
        if tag in BLOCK:
            ends = CLOSES.get(tag, set()) | {"p"}
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    del stack[i:]
                    break
                if stack[i].tag in BLOCK and not (tag == "tr" and stack[i].tag in ("td", "th")):
                    break
        element = Element(tag, m[3])
        stack[-1].children.append(element)
        if tag not in VOID and not _CLOSED.search(m[3]):
            stack.append(element)
    if last < len(source):
        stack[-1].children.append(source[last:])
    return root


def subtree_hashes(element: Element, out: dict[int, int] | None = None) -> dict[int, int]:
    """id(element) -> hash of its subtree, for elements holding text."""
    out = {} if out is None else out
    for e in _post_order(element):
        content, has_text = [e.tag, e.names], False
        for c in e.children:
            if isinstance(c, str):
                t = " ".join(c.split())
                if t:
                    content.append(t)
                    has_text = True
            elif id(c) in out:
                content.append(str(out[id(c)]))
                has_text = True
        if has_text:
            digest = hashlib.blake2b("\0".join(content).encode("utf-8", "surrogatepass"), digest_size=8).digest()
            out[id(e)] = int.from_bytes(digest, "little", signed=True)
    return out


def _post_order(root: Element) -> list[Element]:
    order, stack = [], [root]
    while stack:
        e = stack.pop()
        order.append(e)
        stack += [c for c in e.children if isinstance(c, Element)]
    return order[::-1]


def marked(e: Element, inside: bool) -> bool:
    """Whether the element is by tag or names not main text."""
    if e.tag in DROPPED or e.hidden or (e.tag == "header" and not inside):
        return True
    if e.tag in ("body", "html", "#page", "article", "main") and not e.parts & {"comment", "comments", "related", "ad"}:
        return False
    if e.parts & MARKS:
        return not (inside and e.tag in TEXT_BLOCKS)  # names of a paragraph inside the article do not tell
    return bool(e.parts & WEAK) and not inside and not e.parts & OWN


def prune(root: Element, template: set[int], hashes: dict[int, int]) -> None:
    """Delete template subtrees and marked elements."""
    stack = [(root, False)]
    while stack:
        e, inside = stack.pop()
        inside = inside or e.tag in ("article", "main")
        kept = []
        for c in e.children:
            if isinstance(c, Element):
                if marked(c, inside) or (hashes.get(id(c)) in template and not (inside and c.tag in TEXT_BLOCKS)
                                         and c.tag not in ("article", "main", "body", "html")):
                    kept.append(" ")
                    continue
                stack.append((c, inside))
            kept.append(c)
        e.children = kept


def text_of(root: Element) -> str:
    """Blocks in page order, white space inside turned into one space, joined by one space."""
    out: list[str] = []
    stack: list = [root]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        if x.tag == "br":
            out.append(" ")
        edge = x.tag in BLOCK
        if edge:
            out.append(" ")
            stack.append(" ")
        stack += x.children[::-1]
    return " ".join(html.unescape("".join(out)).split())


def main_text(root: Element) -> str:
    """Text of all articles in page order, else of all main parts, else of the page."""
    for wanted in (lambda e: e.tag == "article", lambda e: e.tag == "main" or "role=main" in e.names,
                   lambda e: e.tag in ("div", "section") and e.parts & CONTENT):
        text = " ".join(t for t in map(text_of, outermost(root, wanted)) if t)
        if text:
            return text
    return text_of(root)


def outermost(root: Element, wanted) -> list[Element]:
    """Elements that are ``wanted`` and in none that is, in page order."""
    found, stack = [], [root]
    while stack:
        e = stack.pop()
        if wanted(e):
            found.append(e)
        else:
            stack += [c for c in e.children[::-1] if isinstance(c, Element)]
    return found


def _count(batches):
    for batch in blocks(batches, "html"):
        counts: dict[tuple[int, int], int] = {}
        for url, source in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            host = _key(host_of(url))
            root = parse(source or "")
            for h in set(subtree_hashes(root).values()):
                counts[host, h] = counts.get((host, h), 0) + 1
        yield pa.record_batch([pa.array([k[0] for k in counts], pa.int64()), pa.array([k[1] for k in counts], pa.int64()),
                               pa.array(list(counts.values()), pa.int64())], names=["host", "subtree", "pages"])


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little",
                          signed=True)


def templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, subtree) keys of subtrees on many pages of their host."""
    return (map_arrow(pages.select("url", "html"), _count, "host long, subtree long, pages long")
            .groupBy("host", "subtree").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= min_pages)
            .select("host", "subtree"))


def _mixed(host, subtree):
    return host ^ (subtree * 3)


def _extract(shared):
    """``shared``: broadcast sorted keys, or None where each page brings its own."""
    def run(batches):
        keys = shared.value if shared is not None else None
        for batch in blocks(batches, "html"):
            own = batch.column("templates").to_pylist() if shared is None else None
            out = []
            for i, (url, source) in enumerate(zip(batch.column("url").to_pylist(), batch.column("html").to_pylist())):
                root = parse(source or "")
                hashes = subtree_hashes(root)
                values = np.array(list(hashes.values()), np.int64)
                if own is not None:
                    template = set(own[i] or ())
                elif len(keys) and len(values):
                    wanted = _mixed(np.int64(_key(host_of(url))), values)
                    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                    template = set(values[keys[at] == wanted].tolist())
                else:
                    template = set()
                prune(root, template, hashes)
                out.append(main_text(root))
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()),
                                   pa.array([len(t) for t in out], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])
    return run


def _subtrees(batches):
    for batch in blocks(batches, "html"):
        rows = ([], [], [])
        for row, url, source in zip(*(batch.column(c).to_pylist() for c in ("row", "url", "html"))):
            host = _key(host_of(url))
            for h in set(subtree_hashes(parse(source or "")).values()):
                for col, v in zip(rows, (row, host, h)):
                    col.append(v)
        yield pa.record_batch([pa.array(c, pa.int64()) for c in rows], names=["row", "host", "subtree"])


SCHEMA = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """(page_id, url, text, n_chars) of pages (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    found = written(templates(pages), "templates")
    if found.count() <= broadcast_keys:
        rows = found.toPandas()  # at most broadcast_keys rows
        keys = np.sort(_mixed(rows["host"].to_numpy(np.int64), rows["subtree"].to_numpy(np.int64)))
        return map_arrow(pages, _extract(pages.sparkSession.sparkContext.broadcast(keys)), SCHEMA)
    rows = pages.withColumn("row", F.xxhash64("page_id", "url", "html"))
    own = (map_arrow(rows.select("row", "url", "html"), _subtrees, "row long, host long, subtree long").distinct()
           .join(found, ["host", "subtree"]).groupBy("row").agg(F.collect_list("subtree").alias("templates")))
    return map_arrow(rows.join(own, "row", "left").select("page_id", "url", "html", "templates"), _extract(None), SCHEMA)


def op7_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
