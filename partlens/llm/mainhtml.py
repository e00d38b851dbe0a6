"""The main text of web pages: a style tree per site, merged from the pages' trees."""

from __future__ import annotations

import html
import marshal
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partlens.llm.common import bounded_batches, stored, text_of

LEAST_PAGES = 4
LOW = 0.25
# Within an article only what nearly every page of the site has is unimportant.
LOW_INSIDE = 0.05
DECAY = 0.9
# Elements and names by what HTML and common usage say they hold.
RAW = frozenset("script style textarea title xmp noembed noframes plaintext".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
NOT_TEXT = frozenset(
    "head script style title noscript template iframe svg math canvas object embed video audio map nav footer aside form "
    "button select option textarea input fieldset menu dialog noembed noframes".split()
)
NAMED = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead banner footer sidebar sidenav widget widgets ad ads adv "
    "advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments disqus respond reply replies pagination pager toolbar skip hidden".split()
)
# What names of elements add to say where or how large something is, not what.
FILLERS = frozenset(
    "main top bottom left right side inner outer upper lower page site global wrap wrapper box container content section block group item "
    "items list row col column area bar panel unit slot zone holder body header head title link links button buttons icon icons count thread "
    "tree form to up down first last small large big".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
ATTRIBUTE = re.compile(r"([a-zA-Z][-\w:]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass(slots=True)
class Node:
    """A block of the page: its element, the path of labels to it, and text or blocks in page order."""

    tag: str
    label: str
    path: int
    noise: bool
    parts: list = field(default_factory=list)
    style: int | None = None

    def blocks(self) -> list[Node]:
        return [p for p in self.parts if isinstance(p, Node)]


def _hash(*words) -> int:
    value = xxhash.xxh64_intdigest("\x00".join(map(str, words)).encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _named_noise(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether the element says itself that it is no article text. A header within an article heads it.

    Of a class or identifier every part must say so, but for those that say where it is: ``skip-link``, not ``skip-ahead``.
    """
    if tag in NOT_TEXT or (tag == "header" and not inside):
        return True
    if not attributes:
        return False
    if attributes.get("role", "").strip().lower() in ROLES or "hidden" in attributes:
        return True
    if attributes.get("aria-hidden", "").lower() == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    for given in (attributes.get("class", "") + " " + attributes.get("id", "")).split():
        names = {n.lower() for n in NAME_PART.findall(given)}
        if names & NAMED and names <= NAMED | FILLERS:
            return True
        if "header" in names and names <= FILLERS and not inside and tag not in ("body", "main", "article", "html"):
            return True
    return False


def parse(page: str, site: int = 0) -> Node:
    """The tree of block elements. Inline elements are text; what is left open is closed as browsers do.

    Paths start from ``site``, so those of two sites never meet.
    """
    root = Node("", "", site, False)
    stack, inside, at, size = [root], 0, 0, len(page)

    def text(raw: str) -> None:
        if raw:
            stack[-1].parts.append(html.unescape(raw) if "&" in raw else raw)

    def pop() -> None:
        nonlocal inside
        inside -= stack.pop().tag in ("article", "main")

    while at < size:
        found = TAG.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if tag in INLINE:
            if tag in ("br", "img", "wbr"):
                stack[-1].parts.append(" " if tag != "wbr" else "")
            elif not found[1] and found[3] and _named_noise(tag, _attributes(found[3]), bool(inside)):
                # An inline element that is noise is skipped to its end tag.
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else at
            continue
        if found[1]:
            if any(n.tag == tag for n in stack[1:]):
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag in ("article", "main") and not inside:
            # The article does not belong to a menu or an advert that was left open.
            while any(n.noise for n in stack):
                pop()
        if stack[-1].tag == "p":
            pop()
        if stack[-1].tag in CLOSED_BY.get(tag, ()):
            pop()
        attributes = _attributes(found[3]) if found[3] else {}
        label = " ".join([tag, attributes.get("class", ""), attributes.get("id", "")]).strip()
        above = stack[-1]
        node = Node(tag, label, _hash(above.path, label), above.noise or _named_noise(tag, attributes, bool(inside)))
        above.parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = page.find(">", end.start()) + 1 or size if end else size
        elif tag not in VOID and not found[3].endswith("/"):
            stack.append(node)
            inside += tag in ("article", "main")
    return root


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}


def _runs(node: Node) -> Iterator[str]:
    """The texts between a node's blocks, white space as one space."""
    held = []
    for part in [*node.parts, None]:
        if isinstance(part, str):
            held.append(part)
        elif held:
            line = " ".join("".join(held).split())
            held = []
            if line:
                yield line


def _style(node: Node) -> int:
    """The sequence of a node's blocks, repeats in a row as one: lists of any length look alike."""
    if node.style is not None:
        return node.style
    labels = [b.label for b in node.blocks()]
    return _hash(*[a for a, b in zip(labels, [None, *labels]) if a != b]) | 1


def _text(line: str) -> int:
    """The sign of a text; signs of texts are even, those of styles odd, and zero stands for the node."""
    return _hash(line) & ~1 or 2


def signs(root: Node) -> set[tuple[int, int]]:
    """What a page adds to its site's tree: (path, 0) for a node, and (path, sign) for each style and text of it."""
    found = set()
    open_nodes = [root]
    while open_nodes:
        node = open_nodes.pop()
        found.add((node.path, 0))
        below = node.blocks()
        if below:
            found.add((node.path, _style(node)))
            open_nodes += below
        found.update((node.path, _text(line)) for line in _runs(node))
    return found


def region(root: Node) -> tuple[list[Node], float]:
    """The page's articles, or else its main part, or else all of it; and up to which importance a branch of it goes."""
    for tag, low in (("article", LOW_INSIDE), ("main", LOW)):
        tops = tops_of(root, tag)
        if tops:
            return tops, low
    return [root], LOW


def candidates(tops: list[Node]) -> set[tuple[int, int]]:
    """The texts of a page's region, as its site's tree knows them."""
    found, waiting = set(), list(tops)
    while waiting:
        node = waiting.pop()
        found.update((node.path, _text(line)) for line in _runs(node))
        waiting += [b for b in node.blocks() if not b.noise]
    return found


def packed(tops: list[Node], low: float) -> bytes:
    """A page's region as bytes: texts and blocks in page order, a block with its style and, where it ends, None.

    What names itself noise keeps its place alone.
    """
    events: list = [low]
    waiting: list = list(reversed(tops))
    while waiting:
        part = waiting.pop()
        if isinstance(part, Node):
            events.append((part.tag, part.path, part.noise, _style(part) if part.blocks() else 0))
            waiting.append(None)
            if not part.noise:
                waiting += reversed(part.parts)
        else:
            events.append(part)
    return zlib.compress(marshal.dumps(events), 1)


def unpacked(held: bytes) -> tuple[list[Node], float]:
    """The region of :func:`packed`."""
    low, *events = marshal.loads(zlib.decompress(held))
    tops, stack = [], []
    for event in events:
        if isinstance(event, tuple):
            tag, path, noise, style = event
            node = Node(tag, "", path, noise, [], style)
            (stack[-1].parts if stack else tops).append(node)
            stack.append(node)
        elif event is None:
            stack.pop()
        else:
            stack[-1].parts.append(event)
    return tops, low


def importance(node: Node, known: dict[tuple[int, int], float], most: dict[int, float]) -> float:
    """The composite importance of a branch: of its own styles, and the mean of what is in it, less what names itself noise.

    A text on one page alone has importance 1, one on all pages 0. ``known`` has what the
    site's tree says; what it does not list is on one page. ``most`` gets, for each branch,
    the greatest importance in it: a branch is noise if it and all in it are unimportant.
    """
    found: dict[int, float] = {}
    order, waiting = [], [node]
    while waiting:
        one = waiting.pop()
        waiting += [b for b in one.blocks() if not b.noise]
        order.append(one)
    for one in reversed(order):
        below = [b for b in one.blocks() if not b.noise]
        texts = [known.get((one.path, _text(line)), 1.0) for line in _runs(one)]
        inner = [found[id(b)] for b in below] + texts
        if not inner:
            found[id(one)] = most[id(one)] = 0.0
            continue
        mean = sum(inner) / len(inner)
        weight = DECAY ** len(below)
        own = known.get((one.path, _style(one)), 1.0) if one.blocks() else mean
        found[id(one)] = (1 - weight) * own + weight * mean
        most[id(one)] = max([found[id(one)], *texts, *[most[id(b)] for b in below]])
    return found[id(node)]


def tops_of(root: Node, tag: str) -> list[Node]:
    """The outermost elements of a kind, outside of what names itself noise, in page order."""
    tops, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if node.noise:
            continue
        if node.tag == tag:
            tops.append(node)
        else:
            waiting += reversed(node.blocks())
    return tops


def article(root: Node, known: dict[tuple[int, int], float]) -> str:
    """The texts of the article's blocks, one a line.

    The site's tree decides which branches stay, within an article element as in the page's main
    part or, without either, in all of the page. A branch that names itself a menu, an advert and the like is
    unimportant whatever the tree says. Within an article less is unimportant, since nearly all of it is text; where
    nothing in it is important, the page is a copy of the site's others and not made of their frame, and stays whole.
    """
    return region_text(*region(root), known)


def region_text(tops: list[Node], low: float, known: dict[tuple[int, int], float]) -> str:
    """:func:`article` for a region already told from the page."""
    most: dict[int, float] = {}
    for top in tops:
        importance(top, known, most)
    if low == LOW_INSIDE and all(most[id(top)] <= low for top in tops):
        low = -1.0
    lines = []

    def walk(top: Node) -> None:
        waiting: list = [top]
        while waiting:
            part = waiting.pop()
            if isinstance(part, str):
                lines.append(part)
            elif not part.noise and (part is top or most[id(part)] > low):
                texts, ordered, held = _runs(part), [], False
                for piece in [*part.parts, None]:
                    if isinstance(piece, str):
                        held = held or bool(piece.strip())
                        continue
                    if held:
                        ordered.append(next(texts))
                        held = False
                    if piece is not None:
                        ordered.append(piece)
                waiting += reversed(ordered)

    for top in tops:
        walk(top)
    return "\n".join(lines)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: the identifier, the url, and ``text``.

    Every page adds its nodes, styles and texts to the tree of its host, as counts combined
    before the shuffle; so a host with most of the pages is no larger a group than another.
    Importance follows the entropy over a node's m pages: that of its styles to the base m,
    and 1 - log n / log m for a text on n of the pages. Nodes on fewer than
    ``LEAST_PAGES`` pages are taken as they are. Each page then gets the values of its own
    branches and leaves out the unimportant ones. A page is parsed once: the part of its tree that may be text is
    written, packed, beside what it adds to the site's tree. A branch goes only if it holds unimportant texts, so
    values are fetched for pages with such texts alone; Spark shuffles the packed trees to them
    unless those pages' values are few enough to be broadcast.

    Null and empty pages have empty text. A null url is a host of its own name, the empty
    one. Repeated rows count as pages of their own and come out once each; a null
    identifier stays. An empty table gives no rows, and other columns take no part.
    """
    bounded_batches(pages.sparkSession)
    kind = pages.schema[id_col].dataType.simpleString()
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"^\s*(?:[A-Za-z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    page = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.xxhash64(host).alias("_host"), text_of(html_col).alias("_html"))
    # Rows are told apart by what they hold; equal rows get equal results.
    page = page.withColumn("_page", F.xxhash64("_id", "_url", "_html"))

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            roots = [parse(raw, site) for raw, site in zip(batch["_html"], batch["_host"])]
            kept = [region(root) for root in roots]
            trees = batch[["_page", "_id", "_url"]].assign(_tree=[packed(*part) for part in kept])
            found = []
            for number, root, (tops, low) in zip(batch["_page"], roots, kept):
                mine = candidates(tops)
                found += [(number, *sign, low if sign in mine else None) for sign in signs(root)]
            added = pd.DataFrame(found, columns=["_page", "_path", "_sign", "_low"]).astype({"_path": "Int64", "_sign": "Int64", "_low": "float64"})
            yield pd.concat([trees, added], ignore_index=True)

    held = f"_page long, _id {kind}, _url string, _tree binary, _path long, _sign long, _low double"
    parsed = stored(page.select("_page", "_host", "_id", "_url", "_html").mapInPandas(listed, held), "parsed")
    rows = parsed.where("_path IS NOT NULL").select("_page", "_path", "_sign", "_low")
    counted = rows.groupBy("_path", "_sign").agg(F.count(F.lit(1)).alias("_n"))
    style = F.col("_sign") % 2 != 0
    nodes = counted.groupBy("_path").agg(
        F.max(F.when(F.col("_sign") == 0, F.col("_n"))).alias("_m"),
        F.sum(F.when(style, F.col("_n"))).alias("_all"),
        F.sum(F.when(style, F.col("_n") * F.log("_n"))).alias("_weighted"),
    )
    alike = F.when(style, 1 - (F.log("_all") - F.col("_weighted") / F.col("_all")) / F.log("_m")).otherwise(F.log("_n") / F.log("_m"))
    told = stored(
        counted.where(style | ((F.col("_sign") != 0) & (F.col("_n") > 1)))
        .join(nodes.where(F.col("_m") >= LEAST_PAGES), "_path")
        .select("_path", "_sign", F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - alike)).alias("_value")),
        "values",
    )
    unimportant = stored(told.where((F.col("_sign") % 2 == 0) & (F.col("_value") <= LOW)), "unimportant")
    met = rows.where("_low IS NOT NULL").join(unimportant, ["_path", "_sign"]).where("_value <= _low")
    wanted = stored(met.select("_page").distinct(), "wanted")
    own = rows.where("_sign != 0").join(wanted, "_page", "left_semi").join(told, ["_path", "_sign"]).groupBy("_page").agg(
        F.collect_set(F.struct("_path", "_sign", "_value")).alias("_known")
    )
    # Written first, so that its size is known when the trees meet it.
    own = stored(own, "known")
    whole = parsed.where("_path IS NULL").select("_page", "_id", "_url", "_tree").join(own, "_page", "left")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for tree, known in zip(batch["_tree"], batch["_known"]):
                values = {(k["_path"], k["_sign"]): k["_value"] for k in known} if known is not None else {}
                texts.append(region_text(*unpacked(tree), values))
            yield pd.DataFrame({"_id": batch["_id"], "_url": batch["_url"], "text": texts})

    done = whole.mapInPandas(read, f"_id {kind}, _url string, text string")
    return done.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text")
