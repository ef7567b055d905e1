"""Main text of web pages, with site templates removed.

A page becomes a tree. Every element subtree has a hash of its tag and all that it
holds; subtrees of containers are counted per host, and per section of it, over distinct pages in
Spark, and those that recur on many pages there are its template, deleted with the
elements that are never part of an article (menus, forms, scripts, adverts,
comments and so on). What is left of the article is its text, block by block.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.llm.common import cut_lineage, ship_package

#: A subtree belongs to the template when this share of the distinct pages of the host or section, and at least so many, hold it.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.5, 5

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes template svg math".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul caption""".split())
#: A template is made of containers, and outside articles of paragraphs, of some words or links; what else recurs, such as a
#: word in a sentence, a cell or an item of a list, goes only with a container that recurs as a whole.
TEMPLATE_WORDS = 3
CONTAINERS = frozenset("""address aside blockquote center details dialog dir div dl fieldset figure footer form header menu nav ol section
    table ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER = frozenset("""head nav footer aside form button select option input textarea label dialog menu script style noscript template iframe
    object embed canvas svg math audio video title xmp noembed noframes""".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
NAMES = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu menubar
    header masthead footer sidebar aside breadcrumb breadcrumbs comment comments disqus reply replies cookie cookies consent gdpr notice
    notification banner popup modal overlay newsletter subscribe signup login share sharing social related recommended pagination pager
    toolbar widget skip""".split())
#: Names of what readers or other articles say; an article there is none of the page's own while the page has another.
OTHERS = frozenset("comment comments disqus reply replies related recommended".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPES = frozenset("html body article main section div ul ol dl table nav aside header footer form td th blockquote".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>", re.S)
# One attribute, each starting where the one before it ends; a quote that nothing closes reaches to the end of the tag.
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/][^\s/=]*+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s]*)))?")
_WORDS = re.compile(r"[^a-z0-9]+")


@dataclass(slots=True)
class Element:
    tag: str
    dropped: bool = False
    named: frozenset = frozenset()  # of NAMES, those that its class and id say
    main: bool = False
    holds: bool = False  # whether it is or holds an article or main element
    hash: int = 0
    parts: list = field(default_factory=list)  # elements and texts in order


def _names(value: str) -> Iterator[str]:
    """The NAMES in a class or id: whole tokens, or tokens made of nothing but such names and numbers."""
    for token in value.split():
        pieces = [p for p in _WORDS.split(token) if p and not p.isdigit()]
        if NAMES.issuperset(pieces):
            yield from pieces


def _described(tag: str, attributes: str) -> tuple[bool, bool, frozenset]:
    """Whether the attributes say that the element is no article text, that it is the main part, and the NAMES it has."""
    if not attributes or tag in HEADINGS or tag in ("html", "body"):
        return False, False, frozenset()
    found: dict[str, str] = {}  # of a repeated attribute the first counts
    for match in _ATTRIBUTE.finditer(attributes):
        found.setdefault(match[1].lower(), (match[2] or match[3] or match[4] or "").lower())
    role = found.get("role", "")
    dropped = role in ROLES or found.get("hidden") in ("", "true", "hidden") or found.get("aria-hidden") == "true"
    return dropped, role == "main", frozenset(n for name in ("class", "id") for n in _names(found.get(name, "")))


def parse(text: str) -> Element:
    """Tree of a page. Ends that are left out close as browsers close them; stray end tags are passed over."""
    root = Element("#page")
    stack, at = [root], 0
    for match in _TAG.finditer(text):
        if match.start() < at:
            continue  # inside a script or another raw element
        if match.start() > at:
            stack[-1].parts.append(text[at:match.start()])
        at = match.end()
        name = match[2] or match[5]
        if not name:
            continue
        tag, closing = name.lower(), (match[1] or match[4]) == "/"
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if stack[depth].tag in SCOPES and tag not in SCOPES:
                    break
            continue
        attributes = match[3] or match[6] or ""
        if tag in BLOCKS and tag not in ("html", "body"):
            _close(stack, {"p"})
        if tag in CLOSES:
            _close(stack, CLOSES[tag])
        dropped, main, named = _described(tag, attributes)
        own = Element(tag, dropped or tag in NEVER, named, main or tag == "main")
        stack[-1].parts.append(own)
        if own.main or tag == "article":
            own.holds = True
            for above in reversed(stack):
                if above.holds:
                    break
                above.holds = True
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(text, at)
            inner_end, at = (end.start(), end.end()) if end else (len(text), len(text))
            own.parts.append(text[match.end():inner_end])
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append(own)
    if at < len(text):
        stack[-1].parts.append(text[at:])
    return root


def _close(stack: list[Element], tags: set[str]) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            del stack[depth:]
            return
        if stack[depth].tag in SCOPES and stack[depth].tag not in tags:
            return


def _walk(root: Element) -> Iterator[tuple[Element, bool]]:
    """Each element twice: before what it holds (False) and after (True), without recursion."""
    todo = [(root, False)]
    while todo:
        element, done = todo.pop()
        yield element, done
        if not done:
            todo.append((element, True))
            todo += [(p, False) for p in reversed(element.parts) if isinstance(p, Element)]


def _may_recur(element: Element, inside: bool) -> bool:
    return element.tag in CONTAINERS or element.tag == "p" and not inside


def hash_subtrees(root: Element) -> list[int]:
    """Set the hash of every element; the distinct hashes of those that may be a template, with enough words or a link."""
    found = {}
    weights: dict[int, int] = {}  # words below an element; a link counts as enough
    articles = 0
    for element, done in _walk(root):
        own_article = element.tag == "article" or element.main
        if not done:
            articles += own_article
            continue
        articles -= own_article
        digest, words = xxhash.xxh3_64(element.tag), TEMPLATE_WORDS if element.tag == "a" else 0
        for part in element.parts:
            if isinstance(part, Element):
                digest.update(part.hash.to_bytes(8, "little"))
                words += weights.pop(id(part), 0)
            elif own := part.split():
                digest.update("\0".join(own))
                words += len(own)
        element.hash = digest.intdigest()
        weights[id(element)] = words
        if words >= TEMPLATE_WORDS and _may_recur(element, articles > 0):
            found[element.hash] = None
    return [h - (1 << 64) if h >> 63 else h for h in found]


def _dropped(element: Element, templates: set[int], inside: bool, others: bool = True) -> bool:
    """``inside`` an article or main element a header stays; ``others``: whether articles named as others' words go."""
    signed = element.hash - (1 << 64) if element.hash >> 63 else element.hash
    if element.dropped or element.tag == "header" and not inside or _may_recur(element, inside) and signed in templates:
        return True
    if element.holds:
        return others and not element.main and not OTHERS.isdisjoint(element.named)
    return bool(element.named - {"header"} if inside else element.named)


def _roots(page: Element, templates: set[int]) -> list[Element]:
    """Outermost articles that are kept; else the main elements; else the page. Articles named as others' words if there is no other."""
    for others in (True, False):
        for wanted in (lambda e: e.tag == "article", lambda e: e.main):
            found, todo = [], [page]
            while todo:
                element = todo.pop()
                if _dropped(element, templates, False, others):
                    continue
                if wanted(element):
                    found.append(element)
                else:
                    todo += [p for p in reversed(element.parts) if isinstance(p, Element)]
            if found:
                return found
    return [page]


def _only_links(element: Element) -> bool:
    """Whether a list or container holds two links or more and hardly a word outside of links."""
    links, linked, free = 0, 0, 0
    todo = [(element, False)]
    while todo:
        own, within = todo.pop()
        within |= own.tag == "a"
        links += own.tag == "a"
        for part in own.parts:
            if isinstance(part, Element):
                todo.append((part, within))
            elif within:
                linked += len(part.split())
            else:
                free += len(part.split())
    return links > 1 and linked > 4 * free


def main_text(text: str | None, templates: list[int] | None = None) -> str:
    if not text:
        return ""
    page, known = parse(text), set(templates or ())
    if known:
        hash_subtrees(page)
    blocks: list[str] = []
    held: list[str] = []

    def end_block() -> None:
        words = html.unescape("".join(held)).split()
        held.clear()
        if words:
            blocks.append(" ".join(words))

    for root in _roots(page, known):
        inside = root.tag != "#page"
        todo: list = [root]
        while todo:
            part = todo.pop()
            if isinstance(part, str):
                held.append(part)
            elif part is None:
                end_block()
            elif part is not root and _dropped(part, known, inside) or not inside and part.tag in ("ul", "ol", "div", "table") and _only_links(part):
                if part.tag in BLOCKS:
                    end_block()
            elif part.tag in BLOCKS:
                end_block()
                todo.append(None)
                todo += reversed(part.parts)
            else:
                if part.tag in ("br", "td", "th", "img"):
                    held.append(" ")
                todo += reversed(part.parts)
        end_block()
    return "\n".join(blocks)


def host_of(url: Column | str) -> Column:
    column = F.col(url) if isinstance(url, str) else url
    return F.lower(F.regexp_extract(F.coalesce(column, F.lit("")), r"(?s)^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _section_of(url: Column) -> Column:
    """Host and first folder of the path; null where the page is in no folder."""
    folder = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/+([^/?#]+)/", 1)
    return F.when((folder != "") & (host_of(url) != ""), F.concat(host_of(url), F.lit("/"), folder))


def _subtree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, hashes = [], []
        for i, text in enumerate(batch.column("html").to_pylist()):
            own = hash_subtrees(parse(text)) if text else []
            rows += [i] * len(own)
            hashes += own
        at = pa.array(np.array(rows, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in ("host", "section", "page")], pa.array(hashes, pa.int64())],
                                         ["host", "section", "page", "hash"])


def site_templates(pages: DataFrame, share: float = TEMPLATE_SHARE, least: int = TEMPLATE_PAGES) -> DataFrame:
    """(place, templates): hashes of the subtrees that recur on many distinct pages of a place, which is a host or a section of one.

    Pages of equal html count once, so copies of an article are no template. A place's
    list has at most ``1 / share`` times the subtrees of its average page, however many
    pages it has. Pages without a host have no template.
    """
    ship_package(pages.sparkSession)
    url = F.col("url").cast("string")
    rows = (pages.select(host_of(url).alias("host"), _section_of(url).alias("section"), F.col("html").cast("string").alias("html"))
            .where("host <> '' and html is not null").withColumn("page", F.xxhash64("html")))
    places = F.explode(F.array_compact(F.array("host", "section"))).alias("place")
    sizes = rows.select(places, "page").distinct().groupBy("place").agg(F.count("*").alias("n_pages"))
    counts = (rows.mapInArrow(_subtree_rows, "host string, section string, page long, hash long").select(places, "page", "hash").distinct()
              .groupBy("place", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= least))
    return (counts.join(sizes, "place").where(F.col("n") >= F.lit(share) * F.col("n_pages"))
            .groupBy("place").agg(F.collect_list("hash").alias("templates")))


def extract_text(pages: DataFrame, share: float = TEMPLATE_SHARE, least: int = TEMPLATE_PAGES) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every row of ``pages(page_id, url, html)``.

    Null and empty html give the empty text. Blocks are joined by a line break; white
    space in a block, line-break elements and table cells become one space. Character
    references are decoded. Repeated rows give repeated results.
    """
    # Written first, so that Spark knows its size: a small list of hosts goes to the pages, and the pages are not shuffled.
    templates = cut_lineage(site_templates(pages, share, least))
    of_host, of_section = (templates.select(F.col("place").alias(f"__{c}"), F.col("templates").alias(f"of_{c}")) for c in ("host", "section"))
    url = F.col("url").cast("string")
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(url).alias("host"), _section_of(url).alias("section"))

    def texts(page: pa.Array, known: pa.Array) -> pa.Array:
        return pa.array([main_text(h, t) for h, t in zip(page.to_pylist(), known.to_pylist())], type=pa.string())

    known = F.concat(*[F.coalesce(c, F.array().cast("array<long>")) for c in ("of_host", "of_section")])
    return (rows.join(of_host, F.col("host") == F.col("__host"), "left").join(of_section, F.col("section") == F.col("__section"), "left")
            .select("page_id", "url", F.arrow_udf(texts, "string")("html", known).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
