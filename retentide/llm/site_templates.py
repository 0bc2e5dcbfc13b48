"""Main text of web pages without what a site repeats.

Every element's subtree is hashed. The hashes of elements outside the main content are counted per
host in Spark; a subtree that comes back on many pages of its host is template and is deleted, like the
elements that by their tag or class are menus, headers, footers, forms, notices, adverts or comments.
Inside the main content (article or main) paragraphs that come back are kept, as they are part of the article:
there subtrees that consist of links mostly are deleted as template, and containers (div, section, lists and the
like) that come back on a larger share of the host's pages and are a small part of their article, as notices are.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentide.llm.spark_util import checkpoint

#: A subtree is template if at least so many pages of its host, and this share of them, have it.
MIN_PAGES, MIN_SHARE = 3, 0.05
#: The same for containers inside the main content, and the greatest part of its letters that they may have.
INNER_PAGES, INNER_SHARE, INNER_PART = 5, 0.2, 0.25
#: Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
DROPPED = frozenset(
    "head script style noscript template nav header footer aside form button select option textarea input label fieldset iframe object embed svg math canvas audio video dialog menu title".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: A start tag of the first kind ends an open p; the others end an open element of their own kind.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
FENCES = frozenset("table ul ol dl select body html article main section div".split())
#: Words of class, id and role that mark what isn't main text.
MARKS = frozenset(
    "ad ads advert advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget "
    "comment comments disqus respond replies reply notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations pagination pager toolbar contentinfo complementary search form alert skip skiplink hidden copyright disclaimer legal tags".split()
)
MAIN = frozenset(["article", "main"])
#: What can be deleted as a whole inside the main content.
CONTAINERS = frozenset("blockquote center details div dl figure ol section table ul".split())
NEVER = frozenset("#text #root html body head script style noscript template title".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|[^<]+|<""", re.S)
_MARKED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?=[\s=/]|$)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_BLANK = re.compile(r"\s+")


@dataclass
class Element:
    """An element, or with tag `#text` a run of text."""

    tag: str
    marked: bool = False
    main: bool = False
    text: str = ""
    children: list[Element] = field(default_factory=list)


def _marks(attributes: str) -> tuple[bool, bool]:
    """Whether attributes mark an element as not main text, and as main text."""
    marked = main = False
    for name, value in _MARKED.findall(attributes) if attributes else ():
        value, name = value.strip("\"'").lower(), name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            marked = True
        elif name != "aria-hidden":
            main |= name == "role" and value in ("main", "article")
            marked |= not MARKS.isdisjoint(_SPLIT.split(value))
    return marked and not main, main


def parse(page: str) -> Element:
    """The tree of a page; whatever is wrong with it, as browsers do in the common cases."""
    root = Element("#root")
    stack = [root]
    opened: Counter[str] = Counter()
    at, n = 0, len(page)

    def close(k: int) -> None:
        opened.subtract(e.tag for e in stack[k:])
        del stack[k:]

    while at < n:
        found = _TOKEN.match(page, at)
        whole = found.group()
        at = found.end()
        name = found.group(2)
        if name is None:
            if not whole.startswith(("<!", "<?")):
                stack[-1].children.append(Element("#text", text=whole))
            continue
        name = name.lower()
        if found.group(1):
            # without a start tag there is nothing to look for
            for k in range(len(stack) - 1, 0, -1) if opened[name] else ():
                if stack[k].tag == name:
                    close(k)
                    break
                if stack[k].tag in FENCES and name in INLINE | {"p"}:
                    break  # an end tag without a start tag inside this element
            continue
        if name in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag not in INLINE:
                    break
        for k in range(len(stack) - 1, 0, -1) if name in SIBLINGS else ():
            if stack[k].tag in SIBLINGS[name]:
                close(k)
                break
            if stack[k].tag in FENCES:
                break
        marked, main = _marks(found.group(3)) if name not in ("html", "body") else (False, False)
        element = Element(name, marked, main or name in MAIN)
        stack[-1].children.append(element)
        if name in RAW:
            end = re.compile(rf"</{name}\s*[^>]*>", re.I).search(page, at)
            element.children.append(Element("#text", text=page[at : end.start() if end else n]))
            at = end.end() if end else n
        elif name not in VOID:
            stack.append(element)
            opened[name] += 1
    return root


def _hashes(element: Element, out: dict[int, int], lengths: dict[int, tuple[int, int]], linked: bool = False) -> int:
    """Hash of each element's subtree by its identity, and the letters in it and in links in it."""
    # without recursion, as pages can nest deeply
    order, queue = [], [(element, linked)]
    while queue:
        node, inside = queue.pop()
        order.append((node, inside))
        queue.extend((c, inside or node.tag == "a") for c in node.children)
    for node, inside in reversed(order):
        if node.tag == "#text":
            text = _BLANK.sub(" ", node.text).strip()
            out[id(node)] = xxhash.xxh64_intdigest(text) if text else 0
            lengths[id(node)] = (len(text), len(text) if inside else 0)
        else:
            parts = [out[id(c)] for c in node.children if out[id(c)]]
            out[id(node)] = xxhash.xxh64_intdigest(np.array([len(parts), *parts], np.uint64).tobytes(), seed=xxhash.xxh32_intdigest(node.tag))
            lengths[id(node)] = tuple(sum(lengths[id(c)][k] for c in node.children) for k in (0, 1))
    return out[id(element)]


def _regions(root: Element) -> list[Element]:
    """The outermost main elements that aren't part of what is dropped."""
    out, queue = [], [root]
    while queue:
        node = queue.pop()
        if node.main and not node.marked:
            out.append(node)
        elif not (node.marked or node.tag in DROPPED):
            queue.extend(reversed(node.children))
    return out


def _name(subtree: int, inner: bool) -> int:
    """How a subtree is known in the counts: its last bit says whether it is a container inside main content."""
    return subtree & ~1 | inner


def _is_inner(node: Element, region: Element, lengths: dict[int, tuple[int, int]]) -> bool:
    return node.tag in CONTAINERS and node is not region and lengths[id(node)][0] <= INNER_PART * lengths[id(region)][0]


def template_candidates(page: str) -> tuple[int, list[int]]:
    """A hash of the page's text outside of what is dropped in any case, by which copies of a page are known,
    and the hashes of its subtrees that may be template, each once."""
    root = parse(page)
    hashes: dict[int, int] = {}
    lengths: dict[int, tuple[int, int]] = {}
    _hashes(root, hashes, lengths)
    regions = {id(x): x for x in _regions(root)}
    found, texts = set(), []
    queue: list[tuple[Element, Element | None]] = [(root, None)]
    while queue:
        node, inside = queue.pop()
        inside = inside or regions.get(id(node))
        letters, in_links = lengths[id(node)]
        if letters and node.tag not in NEVER and id(node) not in regions:
            if not inside or 2 * in_links > letters:
                found.add(_name(hashes[id(node)], False))
            if inside and _is_inner(node, inside, lengths):
                found.add(_name(hashes[id(node)], True))
        if not (node.marked or node.tag in DROPPED):
            queue.extend((c, inside) for c in node.children if c.tag != "#text")
            texts += [hashes[id(c)] for c in node.children if c.tag == "#text" and hashes[id(c)]]
    return xxhash.xxh64_intdigest(np.array(texts, np.uint64).tobytes()), sorted(found)


def main_text(page: str, template: set[int]) -> str:
    """Blocks of the main content, one a line; of the whole body where no element is marked as main."""
    root = parse(page)
    hashes: dict[int, int] = {}
    lengths: dict[int, tuple[int, int]] = {}
    if template:
        _hashes(root, hashes, lengths)
    regions = _regions(root)

    def recurs(node: Element, region: Element) -> bool:
        if not template:
            return False
        letters, in_links = lengths[id(node)]
        if _name(hashes[id(node)], False) in template and (not regions or 2 * in_links > letters):
            return True
        return bool(regions) and _name(hashes[id(node)], True) in template and _is_inner(node, region, lengths)

    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = _BLANK.sub(" ", html.unescape("".join(line))).strip()
        line.clear()
        if text:
            blocks.append(text)

    for region in regions or [root]:
        queue: list[Element | None] = [region]
        while queue:
            node = queue.pop()
            if node is None:
                flush()
            elif node.tag == "#text":
                line.append(node.text)
            elif node is not region and (node.marked or node.tag in DROPPED or recurs(node, region)):
                if node.tag not in INLINE:
                    flush()
            elif node.tag == "br":
                line.append(" ")
            else:
                if node.tag not in INLINE:
                    flush()
                    queue.append(None)
                queue.extend(reversed(node.children))
        flush()
    return "\n".join(blocks)


def host_of(url: F.Column) -> F.Column:
    """The host of a URL in lower case, without port; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_templates) for each row of `pages` (page_id, url, html).

    Character references are decoded, white space inside a block becomes one space, blocks are trimmed and
    joined by line feeds, empty blocks are left out. NULL or empty html gives empty text; pages without a
    host are counted together; repeated rows each get a row; pages of the same text count as one page of
    their host, whatever their urls; other columns are ignored.
    n_templates counts the page's subtrees that its host repeats."""
    spark = pages.sparkSession
    # rows have no key of their own: ids and urls may be NULL or come twice
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.struct("page_id", "url", F.xxhash64("html").alias("h")).alias("key"))
    keyed = pages.select("html", host_of(F.col("url")).alias("host"), F.xxhash64("key").alias("page"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [template_candidates(x) for x in batch.column("html").to_pylist()]
            content = np.array([c for c, _ in both], np.uint64).view(np.int64)
            found = [np.array(x, np.uint64).view(np.int64).tolist() for _, x in both]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("page"), pa.array(content), pa.array(found, pa.list_(pa.int64()))], ["host", "page", "content", "found"])

    # a page without candidates counts for its host all the same
    seen = checkpoint(keyed.mapInArrow(scan, "host string, page long, content long, found array<long>"))
    hosts = seen.groupBy("host").agg(F.countDistinct("content").alias("pages"))
    # copies of a page have one vote
    votes = seen.groupBy("host", "content").agg(F.min("found").alias("found")).select("host", F.explode("found").alias("subtree"))
    each = seen.select("host", "page", F.explode("found").alias("subtree"))
    counted = votes.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES).join(hosts, "host")
    inner = F.col("subtree").bitwiseAND(F.lit(1)) == 1
    often = F.when(inner, (F.col("n") >= INNER_PAGES) & (F.col("n") >= INNER_SHARE * F.col("pages"))).otherwise(F.col("n") >= MIN_SHARE * F.col("pages"))
    repeated = counted.where(often).select("host", "subtree")
    # pages are told their template subtrees; only hashes are moved for that
    of_page = each.join(repeated, ["host", "subtree"]).groupBy("page").agg(F.collect_set("subtree").alias("template"))
    joined = pages.withColumn("page", F.xxhash64("key")).join(of_page, "page", "left").select("page_id", "url", "html", "template")

    def text_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            template = batch.column("template").to_pylist()
            text = [main_text(x, set(np.array(t or [], np.int64).view(np.uint64).tolist())) for x, t in zip(batch.column("html").to_pylist(), template, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64()), pa.array([len(t or []) for t in template], pa.int32())],
                ["page_id", "url", "text", "n_chars", "n_templates"],
            )

    return joined.mapInArrow(text_of, "page_id long, url string, text string, n_chars long, n_templates int")
