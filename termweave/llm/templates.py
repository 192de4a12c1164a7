"""Main text of web pages by removal of site templates.

Each element subtree of a page, articles included, is hashed (its tag, its text and its children's hashes), and Spark
counts on how many different pages a subtree stands at a place, a place being a host and the chain of tags and classes that
leads to the element.  A subtree is a template if it stands on many pages (``LEAST_PAGES``), at a place of which nearly all
subtrees do (``PLACE_SHARE``): menus, adverts and footers rotate among a few variants, while
articles that are copied between pages share their place with others that are not.  Copies of a whole page count once.
Templates are deleted at their places; an equal subtree elsewhere in a page stays.

What a page's own markup declares as something else than text goes as well, since it may occur once
only: elements such as ``nav``, ``footer``, ``form``, ``script``, and those whose class, id or role names a menu,
an advert, comments and so on, all words of the name being such words (``site-footer``, but not ``share-price``); headings stay, and inside
an article fewer words count.  Of what is left, articles stand alone if they hold most of it, all of them in page order; else, in the same way, main
parts; else the whole body.  A page whose article is all template keeps the article; any other such page is empty.

Null and empty pages have an empty text, and a table without rows gives none.  Broken markup is read as browsers do in the common cases: elements
left open, end tags without a start, a tag cut off at the end.  Pages without url or host share the host ''.
Rows that repeat are extracted each.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import if_small, written
from termweave.operators.skew import lookup_join

LEAST_PAGES = 10
PLACE_SHARE = 0.9
# So many templates (16 bytes each) are broadcast at most.
FEW_TEMPLATES = 200_000

# Element names of the HTML standard by how they are treated.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol"
    " option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("caption dd dt body html legend li option summary tbody td tfoot th thead tr".split())
# An element that ends an open one of the second set, up to an element of the third.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
# What is not an article, by element, by role, and by words of class and id.
OTHER_TAGS = frozenset(
    "head script style noscript template nav footer aside form button select input textarea iframe"
    " object embed svg canvas dialog menu title label audio video map noembed noframes".split()
)
OTHER_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar"
    " toolbar status".split()
)
OTHER_WORDS = frozenset(
    "ad ads advert advertisement advertisements adverts adsense sponsor sponsored promo promotion nav navbar"
    " navigation menu breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent gdpr"
    " notice notices alert popup modal newsletter subscribe signup social share sharing related"
    " recommended comment comments commentlist disqus reply replies respond pagination pager toolbar"
    " login search skip banner widget".split()
)
# Those that say as much inside an article, and words that say nothing by themselves.
INSIDE_WORDS = OTHER_WORDS - frozenset(
    "header masthead banner notice notices alert search login widget skip menu toolbar footer".split()
)
NEUTRAL_WORDS = frozenset(
    "site top bottom left right global list box block container wrapper inner area bar links link"
    " item items post unit slot primary secondary mobile desktop panel overlay form thread".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KEPT_TAGS = frozenset("html body main article hgroup".split()) | HEADINGS

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
# Each attribute by itself, so that neither values nor longer names are taken for one.
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WORD = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("tag", "place", "other", "inside", "children", "key", "spot")

    def __init__(self, tag: str, place: str, other: bool, inside: bool = False):
        self.tag, self.place, self.other = tag, place, other
        self.inside = inside or tag in ("article", "main")  # whether its children are in an article
        self.children: list = []
        self.key = 0
        self.spot = (0, 0)  # hash of host and place, key


def _names_other(names: str, words: frozenset[str]) -> bool:
    """Whether one of the names consists of words for what is no article, and of neutral ones."""
    for name in names.split():
        parts = set(WORD.findall(name))
        if not parts.isdisjoint(words) and parts <= words | NEUTRAL_WORDS:
            return True
    return False


def _declared(tag: str, attributes: str, inside: bool) -> tuple[str, bool]:
    """Class names of a start tag, and whether it says that it is not part of an article."""
    if not attributes or attributes.isspace():
        return "", tag in OTHER_TAGS
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or "").lower())
    names = ".".join(sorted(found.get("class", "").split()))
    if tag in OTHER_TAGS:
        return names, True
    hidden = (
        "hidden" in found
        or found.get("aria-hidden") == "true"
        or "display:none" in found.get("style", "").replace(" ", "")
    )
    if hidden or tag in KEPT_TAGS:
        return names, hidden and tag not in KEPT_TAGS
    words = INSIDE_WORDS if inside else OTHER_WORDS
    role = found.get("role", "") in OTHER_ROLES
    return names, role or any(_names_other(found.get(at, ""), words) for at in ("class", "id"))


def parse(html: str) -> Node:
    """The tree of a page."""
    root = Node("", "", False)
    stack = [root]
    at, raw = 0, None

    def text(piece: str) -> None:
        if piece:
            stack[-1].children.append(piece)

    position = 0
    while found := TOKEN.search(html, position):
        position = found.end()
        closing, tag, attributes = found[1], found[2], found[3]
        if found.start() > at:
            text(entities.unescape(html[at : found.start()]))
        at = position
        if tag is None:  # a comment or a declaration
            continue
        tag = tag.lower()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    del stack[depth:]
                    break
                if stack[depth].tag in BLOCKS:
                    break
        if tag in SIBLINGS:
            ended, limits = SIBLINGS[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in limits:
                    break
                if stack[depth].tag in ended:
                    del stack[depth:]
        inside = stack[-1].inside
        names, other = _declared(tag, attributes, inside)
        if tag == "header":
            other = other or not inside
        place = f"{stack[-1].place}>{tag}.{names}" if names else f"{stack[-1].place}>{tag}"
        node = Node(tag, place, other, inside)
        stack[-1].children.append(node)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS and tag not in RAW:
            continue
        if tag in RAW:
            raw = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
            stop = raw.start() if raw else len(html)
            node.children.append(html[at:stop])
            at = position = raw.end() if raw else len(html)
            continue
        stack.append(node)
    rest = html[at:]
    cut = re.search(r"<[a-zA-Z/!?][^>]*\Z", rest)
    text(entities.unescape(rest[: cut.start()] if cut else rest))
    _hash(root)
    return root


def _hash(root: Node) -> None:
    """Keys of all subtrees, children first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [child for child in node.children if isinstance(child, Node)]
    for node in reversed(order):
        parts = [node.tag]
        for child in node.children:
            if isinstance(child, Node):
                parts.append(f"<{child.key}>")
            elif clean := " ".join(child.split()):
                parts.append(clean)
        node.key = xxhash.xxh3_64_intdigest("\0".join(parts)) - (1 << 63)


def subtrees(root: Node, host: str) -> Iterator[tuple[int, int]]:
    """``(place, key)`` of all elements outside the page's head; a place belongs to a host.

    The elements keep it as their ``spot``, by which templates are found again.
    """
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag:
            node.spot = xxhash.xxh3_64_intdigest(f"{host}\0{node.place}") - (1 << 63), node.key
            yield node.spot
        todo += [
            child for child in node.children if isinstance(child, Node) and child.tag != "head"
        ]


def _find(root: Node, tags: tuple[str, ...], gone: frozenset[tuple[int, int]]) -> list[Node]:
    """The outermost elements of these kinds that are not inside something removed."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag in tags:
            out.append(node)
            continue
        todo += [
            child
            for child in reversed(node.children)
            if isinstance(child, Node) and not child.other and child.spot not in gone
        ]
    return out


def blocks(root: Node, gone: frozenset[tuple[int, int]] = frozenset()) -> list[str]:
    """The texts of the blocks below an element, in page order."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        if clean := " ".join("".join(line).split()):
            out.append(clean)
        line.clear()

    todo: list = [(root, False)]
    while todo:
        item, ended = todo.pop()
        if isinstance(item, str):
            line.append(item)
        elif ended:
            end()
        elif item.tag == "br":
            line.append(" ")
        elif item is root or not item.other and item.spot not in gone:
            inner = item.children
            if item.tag == "header":  # inside an article: of its lines, the title is text
                inner = [c for c in inner if isinstance(c, Node) and c.tag in HEADINGS | {"hgroup"}]
            if item.tag in BLOCKS:
                end()
                todo.append((item, True))
            todo += [(child, False) for child in reversed(inner)]
    end()
    return out


def _parts(root: Node, tag: str, gone: frozenset[tuple[int, int]]) -> list[str]:
    """The blocks of all outermost elements of a kind, in page order."""
    return [block for node in _find(root, (tag,), gone) for block in blocks(node, gone)]


def main_text(root: Node, templates: frozenset[tuple[int, int]] = frozenset()) -> str:
    """The article's blocks with an empty line between them, without ``(place, key)`` that are templates."""
    whole = blocks(root, templates)
    size = sum(map(len, whole))
    for tag in ("article", "main"):
        part = _parts(root, tag, templates)
        if part and 2 * sum(map(len, part)) >= size:
            return "\n\n".join(part)
    return "\n\n".join(whole or _parts(root, "article", frozenset()))


def _host() -> Column:
    host = F.lower(F.regexp_extract("url", r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.coalesce(host, F.lit(""))


def _subtrees(pages: DataFrame) -> DataFrame:
    """``(page, place, key)``: each subtree of a page once."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (page, place, key)
                for page, host, html in zip(
                    batch["page"], batch["host"], batch["html"], strict=True
                )
                for place, key in set(subtrees(parse(html or ""), host))
            ]
            yield pd.DataFrame(out, columns=["page", "place", "key"])

    columns = pages.select("page", "host", "html")
    return columns.mapInPandas(listed, "page long, place long, key long")


def site_templates(
    found: DataFrame, least_pages: int = LEAST_PAGES, place_share: float = PLACE_SHARE
) -> DataFrame:
    """``(place, key)`` of the template subtrees of all hosts."""
    counts = written(found.groupBy("place", "key").agg(F.count("*").alias("n")))
    many = F.col("n") >= least_pages
    places = (
        counts.groupBy("place")
        .agg(F.sum("n").alias("all"), F.sum(F.when(many, F.col("n"))).alias("recurring"))
        .where(F.col("recurring") >= place_share * F.col("all"))
        .select("place")
    )
    return written(counts.where(many).join(places, "place").select("place", "key"))


def extract_pages(
    pages: DataFrame, least_pages: int = LEAST_PAGES, few: int = FEW_TEMPLATES
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of ``(page_id, url, html)``.

    Up to ``few`` templates are sent to all tasks, which so leave the pages in their place; more are
    joined to the subtrees of each page, and then to the page.  Both give the same texts.
    """
    keyed = pages.select(
        "page_id",
        "url",
        "html",
        _host().alias("host"),
        # Rows that agree in all of these have the same templates.
        F.xxhash64("page_id", "url", "html").alias("page"),
    )
    # Of pages that are equal on a host, one is counted.
    narrow = written(keyed.select("page", F.xxhash64("host", "html").alias("content")))
    firsts = narrow.groupBy("content").agg(F.min("page").alias("first"), F.count("*").alias("n"))
    copies = lookup_join(narrow, written(firsts.where("n > 1")), "content", "n")
    copies = written(copies.where("page != first").select("page").distinct())
    found = _subtrees(keyed.join(if_small(copies), "page", "left_anti"))
    templates = site_templates(found, least_pages)
    if templates.count() <= few:
        known = pages.sparkSession.sparkContext.broadcast(
            frozenset((row["place"], row["key"]) for row in templates.collect())
        )

        @F.pandas_udf("string")
        def extracted(html: pd.Series, host: pd.Series) -> pd.Series:
            texts = []
            for page, name in zip(html, host, strict=True):
                root = parse(page or "")
                gone = frozenset(spot for spot in subtrees(root, name) if spot in known.value)
                texts.append(main_text(root, gone))
            return pd.Series(texts, dtype="str")

        texts = keyed.select("page_id", "url", extracted("html", "host").alias("text"))
    else:
        by_page = (
            _subtrees(keyed).join(templates, ["place", "key"])
            .groupBy("page")
            .agg(F.collect_set(F.array("place", "key")).alias("templates"))
        )

        @F.pandas_udf("string")
        def extracted_by_page(html: pd.Series, host: pd.Series, spots: pd.Series) -> pd.Series:
            texts = []
            for page, name, own in zip(html, host, spots, strict=True):
                root = parse(page or "")
                known = frozenset(() if own is None else (tuple(spot.tolist()) for spot in own))
                gone = frozenset(spot for spot in subtrees(root, name) if spot in known)
                texts.append(main_text(root, gone))
            return pd.Series(texts, dtype="str")

        texts = keyed.join(by_page, "page", "left").select(
            "page_id", "url", extracted_by_page("html", "host", "templates").alias("text")
        )
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))
