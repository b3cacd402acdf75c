"""Main text of web pages by removal of site templates.

Every page is parsed into a tree, and every subtree that could be part of its site's template gets a
hash of tags, classes and text. Spark counts per host, and per host and first path segment, in how many different pages each
hash occurs; subtrees that recur across many pages there are deleted. "Many" grows with the square root of the pages. What the
markup itself declares to be no content (menus, forms, scripts, adverts, comments, ...) is deleted too, and a
declared main element (``article``, ``main``) narrows the text to it. Inside such an element the
paragraphs and headings are its author's and stay, even if other pages quote them.

Pages that are equal as a whole count once, so a site with many copies of a page does not
delete the page.

Hosts with at least a ten-thousandth of all pages are at most ten thousand; their templates are
broadcast (after a check of their number). Pages of the other hosts meet their own templates in a
join, which has no hot key then.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import slices
from larder.session import stage

#: A subtree is template of a host, or of a section of it, if at least this many different pages there have it, and at least the square root of their number.
LEAST_PAGES = 4

#: Template rows that may be broadcast.
MOST_BROADCAST = 1_000_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
#: Start tags that end an open element of the same list, up to one of the containers.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd tr figcaption".split())

#: Elements without content of their own page, whatever they hold.
CHROME = frozenset("nav footer aside form button select dialog menu search head".split())
#: Words of classes, ids and roles that say the same.
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "newsletter subscribe subscription signup popup modal overlay sidebar aside widget widgets menu menus nav navbar navigation breadcrumb "
    "breadcrumbs topbar masthead header footer complementary contentinfo share sharing social related recommended recommendations login "
    "search pagination pager toolbar skip alert".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist discussion disqus replies reply respond responses".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(?:(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>|[!?/][^>]*+(?:>|\Z)|[a-zA-Z][^>]*+\Z)""", re.S)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Element:
    """An element: tag, the words of class, id and role, children (elements and decoded text).

    ``own``: the markup declares it to be the main text; ``inside``: it lies in such an element; ``main``, ``holds_main``, ``holds_h1``: something
    main is it or lies below, a declared main text lies below, a first-level heading does. ``gone``: deleted, or below something deleted.
    """

    __slots__ = ("tag", "words", "hidden", "children", "parent", "own", "inside", "main", "holds_main", "holds_h1", "hash", "size", "solid", "gone")

    def __init__(self, tag: str, attributes: str = "", parent: Element | None = None, declared: bool = True):
        self.tag, self.hidden, self.children, self.parent, self.hash, self.size, self.solid = tag, False, [], parent, 0, 0, 0
        self.main = self.holds_main = self.holds_h1 = self.gone = False
        words: list[str] = []
        for name, a, b, c in _NAMED.findall(attributes) if attributes else ():
            name, value = name.lower(), a or b or c
            if name == "hidden" or (name == "style" and _HIDDEN.search(value)) or (name == "aria-hidden" and value == "true"):
                self.hidden = True
            elif name in ("class", "id", "role"):
                words += _WORDS.findall(value.lower())
        self.words = words
        named = declared and (tag in ("article", "main") or "main" in words)
        self.main = named and tag not in RAW
        self.own = named and not COMMENT_WORDS.intersection(words)
        self.inside = parent is not None and (parent.own or parent.inside)


class Open:
    """The open elements of a parse, with the places of each tag and of all blocks, so that no search walks down the stack."""

    def __init__(self, root: Element):
        self.stack, self.places, self.blocks = [root], {}, []

    def push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.stack))
        if element.tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(element)

    def last(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element with one of ``tags``, 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def cut(self, place: int) -> None:
        """Close the element at ``place`` and all within."""
        while len(self.stack) > place:
            tag = self.stack.pop().tag
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def close(self, tags: Iterable[str], barrier: int) -> None:
        """Close the innermost of ``tags`` unless the element at ``barrier`` lies within it."""
        place = self.last(tags)
        if place and place >= barrier:
            self.cut(place)


def parse(text: str, declared: bool = True) -> list[Element]:
    """The elements of the page in page order, the root first. Unclosed, stray and cut-off tags are tolerated as browsers do, roughly.

    With ``declared=False`` no element counts as main text. Time and memory are linear in tags and text, however deep elements lie.
    """
    root = Element("html", declared=declared)
    elements, opened, at = [root], Open(root), 0
    while True:
        found = _TOKEN.search(text, at)
        if found is None or found.start() > at:
            piece = text[at : found.start() if found else len(text)]
            opened.stack[-1].children.append(html.unescape(piece))
        if found is None:
            break
        at = found.end()
        name = found[2]
        if not name:
            continue
        tag = name.lower()
        if found[1]:
            if opened.places.get(tag):
                # An inline end tag does not end blocks.
                whole = tag in BLOCK or tag in ("td", "th", "table")
                opened.close((tag,), 0 if whole or not opened.blocks else opened.blocks[-1])
            continue
        if tag in ("html", "body"):
            if tag == "body":
                opened.cut(1)
            continue
        if tag in BLOCK and opened.places.get("p"):
            opened.close(("p",), opened.last(("td", "th", "table", "button", "object")))
        if tag in ENDS:
            ended, within = ENDS[tag]
            opened.close(ended, opened.last(within))
        element = Element(tag, found[3], opened.stack[-1], declared)
        opened.stack[-1].children.append(element)
        elements.append(element)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(text, at)
            at = end.end() if end else len(text)
        elif tag not in VOID and not found[3].endswith("/"):
            opened.push(element)
    return elements


def measured(elements: list[Element]) -> None:
    """Fill in the hash of every subtree and the characters of its text, children first."""
    for element in reversed(elements):
        parts, size = [element.tag, *element.words, "\0"], 0
        for child in element.children:
            if isinstance(child, str):
                squeezed = " ".join(child.split())
                size += len(squeezed)
                parts.append(squeezed)
                continue
            element.holds_main |= child.own or child.holds_main
            element.holds_h1 |= child.tag == "h1" or child.holds_h1
            if child.tag not in RAW:
                size += child.size
                element.main |= child.main
                parts.append(str(child.hash))
        element.size = size
        element.hash = xxhash.xxh64_intdigest("\1".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def is_chrome(element: Element, whole: int) -> bool:
    """Whether the markup says that the element is no content. ``whole``: characters of the page."""
    if element.tag in RAW or element.hidden or element.tag in CHROME:
        return True
    words = set(element.words)
    if COMMENT_WORDS & words and element.tag not in ("html", "body"):
        return not (element.main and element.tag not in ("article", "section", "div")) and not element.holds_main
    if element.tag == "header":
        return not (element.inside and element.holds_h1)
    if not CHROME_WORDS & words or element.tag in ("article", "main"):
        return False
    return not (element.main or 2 * element.size > whole or ("header" in words and element.holds_h1))


def may_be_template(element: Element, whole: int) -> bool:
    """Whether a subtree may be template: not the bulk of a page, nothing main, no paragraph of a main text."""
    return not (element.own or element.main or 2 * element.size > whole or (element.inside and element.tag in PARAGRAPHS))


def candidates(elements: list[Element]) -> Iterator[int]:
    """Hashes of the subtrees that are counted: blocks and named elements with text that may be template."""
    whole, left_out = elements[0].size, set()
    for element in elements[1:]:
        if element.tag in RAW or id(element.parent) in left_out or (element.inside and element.tag in PARAGRAPHS):
            left_out.add(id(element))
        elif element.size and (element.tag in BLOCK or element.words) and may_be_template(element, whole):
            yield element.hash


def pruned(elements: list[Element], templates: frozenset[int] | set[int], declared: bool = True) -> None:
    """Mark what goes: chrome if ``declared`` (scripts and the like always), template subtrees, and all below them."""
    whole = elements[0].size
    for element in elements[1:]:
        element.gone = (
            element.parent.gone
            or (is_chrome(element, whole) if declared else element.tag in RAW)
            or (element.hash in templates and may_be_template(element, whole))
        )


def main_element(elements: list[Element]) -> Element:
    """The declared main text if there is one: the article that has most of it, else the ``main`` element, else everything.

    Of several with equally much text (characters that are not white space) the first one counts.
    """
    for element in reversed(elements):
        element.solid = 0 if element.gone else sum(len("".join(c.split())) if isinstance(c, str) else c.solid for c in element.children)
    mains = [e for e in elements[1:] if e.own and not e.gone]
    scope = max((e for e in mains if e.tag != "article"), key=lambda e: e.solid, default=elements[0])
    within: set[int] = {id(scope)}
    best = None
    for element in elements[1:]:
        if id(element.parent) in within:
            within.add(id(element))
            if element.own and not element.gone and element.tag == "article" and (best is None or element.solid > best.solid):
                best = element
    if best is None or (scope is not elements[0] and 2 * best.solid < scope.solid):
        return scope
    return best


def blocks(element: Element) -> list[str]:
    """Text of the blocks in page order, white space inside a block squeezed."""
    out, current = [], []

    def flush() -> None:
        text = " ".join("".join(current).split())
        if text:
            out.append(text)
        current.clear()

    walk = [(element, iter(element.children))]
    while walk:
        node, children = walk[-1]
        child = next(children, None)
        if child is None:
            walk.pop()
            if walk and node.tag in BLOCK:
                flush()
            elif walk and node.tag in ("br", "td", "th"):
                current.append(" ")
        elif isinstance(child, str):
            current.append(child)
        elif not child.gone:
            if child.tag in BLOCK:
                flush()
            walk.append((child, iter(child.children)))
    flush()
    return out


def main_text(page: str, templates: frozenset[int] | set[int] = frozenset(), declared: bool = True) -> str:
    """The main text of one page, given the hashes of its site's template. ``declared=False``: by these alone, whatever tags and classes say."""
    elements = parse(page, declared)
    measured(elements)
    pruned(elements, templates, declared)
    return "\n".join(blocks(main_element(elements) if declared else elements[0]))


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; none is the empty text."""
    return F.lower(F.coalesce(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def section_of(url: Column) -> Column:
    """First segment of a URL's path, the empty text if there is none."""
    return F.coalesce(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]*)", 1), F.lit(""))


def page_subtrees(pages: DataFrame, declared: bool = True) -> DataFrame:
    """``host, section, page, hashes``: the subtrees that may be template, for every different page of a section. Stored.

    ``pages`` has ``host, section, html``; equal pages fold to one, before the shuffle too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            lists = []
            for page in batch.column("html").to_pylist():
                elements = parse(page or "", declared)
                measured(elements)
                lists.append(sorted(set(candidates(elements))))
            kept = {c: batch.column(c) for c in ("host", "section", "page")}
            yield pa.RecordBatch.from_pydict({**kept, "hashes": pa.array(lists, pa.list_(pa.int64()))})

    found = pages.select("host", "section", F.xxhash64("html").alias("page"), "html")
    found = found.mapInArrow(run, "host string, section string, page long, hashes array<long>")
    return stage(found.groupBy("host", "section", "page").agg(F.min("hashes").alias("hashes")), "template-pages")


def template_counts(subtrees: DataFrame) -> DataFrame:
    """``host, section, hash, pages``: the templates with the number of different pages that have them, ``of`` so many.

    Templates of a whole host have a null section. A page that lies in several sections counts in each, and once for the host.
    """

    def counted(single: DataFrame, keys: list[str]) -> DataFrame:
        of = single.groupBy(*keys).agg(F.count(F.lit(1)).alias("of")).filter(F.col("of") >= LEAST_PAGES)
        each = single.select(*keys, F.explode("hashes").alias("hash")).groupBy(*keys, "hash").agg(F.count(F.lit(1)).alias("pages"))
        return each.filter(F.col("pages") >= LEAST_PAGES).join(of, keys).filter(F.col("pages") >= F.sqrt("of"))

    whole = counted(subtrees.groupBy("host", "page").agg(F.min("hashes").alias("hashes")), ["host"]).withColumn("section", F.lit(None).cast("string"))
    return counted(subtrees, ["host", "section"]).unionByName(whole)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", declared: bool = True) -> DataFrame:
    """``page_id, url, text`` of every page; ``text`` is empty where nothing is left.

    A null page is empty. Repeated rows get equal results. A null URL has the host of the empty text. Pages of any length, depth and
    disorder are read whole. With ``declared=False`` only recurring subtrees decide, not what tags, classes and roles say.
    """
    spark = pages.sparkSession
    url = F.col(url_col)
    rows = pages.select(
        F.col(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"), section_of(url).alias("section"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    )
    subtrees = page_subtrees(rows, declared)
    templates = stage(template_counts(subtrees).select("host", "section", "hash"), "template-counts")
    # Hosts that may be hot: few enough to broadcast what is known about them.
    sizes = stage(rows.groupBy("host").agg(F.count(F.lit(1)).alias("rows")), "template-hosts")
    bar = max((sizes.agg(F.sum("rows")).first()[0] or 0) // 10_000, 1)
    while True:
        large = sizes.filter(F.col("rows") >= bar).select("host")
        known = templates.join(large, "host", "left_semi").limit(MOST_BROADCAST + 1).toPandas()
        if len(known) <= MOST_BROADCAST:
            break
        bar *= 10
    scopes: dict[tuple[str, str | None], set[int]] = {}
    for host, section, hashed in known.itertuples(index=False):
        scopes.setdefault((host, section if isinstance(section, str) else None), set()).add(hashed)
    shared = spark.sparkContext.broadcast(scopes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing: set[int] = set()
        for batch in slices(batches, "html"):
            columns = (batch.column(c).to_pylist() for c in ("host", "section", "html", "hashes"))
            texts = []
            for host, section, page, own in zip(*columns):
                if own is None:
                    known = shared.value.get((host, None), nothing) | shared.value.get((host, section), nothing)
                else:
                    known = set(own)
                texts.append(main_text(page, known, declared))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    large = F.broadcast(large)
    hot = rows.join(large, "host", "left_semi").withColumn("hashes", F.lit(None).cast("array<long>"))
    columns = ["page_id", "url", "host", "section", "html", "hashes"]
    both = hot.select(*columns)
    if not sizes.filter(F.col("rows") < bar).isEmpty():
        # A page of another host takes its own subtrees that are template: a list no longer than the page.
        each = subtrees.join(large, "host", "left_anti").select("host", "section", "page", F.explode("hashes").alias("hash"))
        met = each.join(templates.filter("section IS NOT NULL"), ["host", "section", "hash"], "left_semi").unionByName(
            each.join(templates.filter("section IS NULL"), ["host", "hash"], "left_semi")
        )
        own = met.groupBy("host", "section", "page").agg(F.collect_set("hash").alias("hashes"))
        rest = rows.join(large, "host", "left_anti").withColumn("page", F.xxhash64("html"))
        rest = rest.join(own, ["host", "section", "page"], "left").withColumn("hashes", F.coalesce("hashes", F.array().cast("array<long>")))
        both = both.unionByName(rest.select(*columns))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return both.mapInArrow(run, f"page_id {kinds['page_id']}, url string, text string")
