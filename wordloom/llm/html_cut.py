"""Main text of web pages by a minimum cut.

A page is a row of blocks, each with its place in the DOM. A classifier turns each block's
tags, names, links and text into the costs of calling it content or boilerplate; these are
the capacities to the two terminals. Neighbouring blocks and neighbours under one parent are tied
by edges that get weaker with their distance in the DOM. The minimum cut, found by augmenting
paths, is the cheapest labelling: a short paragraph inside an article stays, a long notice
inside a menu goes.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements read as raw up to their end tag, and others whose content is never text either.
RAW = frozenset("script style noscript title iframe textarea".split())
SILENT = frozenset("template svg math object canvas select button audio video".split())
#: Elements of drawings may close themselves; these end a drawing, those hold ordinary markup in it.
FOREIGN = frozenset(("svg", "math"))
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
INTEGRATION = frozenset("foreignobject desc annotation-xml".split())
#: Elements that end a block, and those that stand empty.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag closes if it is still open: paragraphs and items do not nest.
CLOSES = {t: ("p",) for t in BLOCKS} | {
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "button": ("button",), "select": ("select",),
}
#: Weights of the classifier, in log odds of content.
REGIONS = {"nav": -8.0, "menu": -8.0, "footer": -7.0, "aside": -7.0, "form": -7.0, "dialog": -7.0, "head": -9.0,
           "header": -5.0, "article": 5.0, "main": 4.0}
ROLES = {"navigation": -8.0, "banner": -5.0, "contentinfo": -7.0, "complementary": -7.0, "search": -7.0, "form": -7.0,
         "dialog": -7.0, "alert": -7.0, "alertdialog": -7.0, "main": 4.0, "article": 5.0}
NAMES = {
    -8.0: "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar cookie cookies consent gdpr advert adverts "
          "advertisement ad ads adsense sponsor sponsored promo promotion comment comments reply replies disqus "
          "respond newsletter subscribe signup login popup modal overlay notice notification alert banner masthead "
          "share sharing social related recommended widget toolbar pagination pager copyright legal disclaimer form",
    3.0: "article content story post entry main text body maintext articlebody",
}
#: Words that make a class name say what a page or layout has, not what the element is.
LAYOUT = frozenset("has with without no is not show hide hidden layout page wrapper container grid row col columns site theme".split())
#: Names and tags whose elements are boilerplate however much they hold: what readers write, and what lies above the page.
ALWAYS = frozenset("comment comments reply replies disqus respond cookie cookies consent gdpr advert adverts advertisement "
                   "ad ads adsense popup overlay".split())
#: An element named like boilerplate is a wrapper if it has this share of the page's unlinked text, and content inside.
WRAPPER_SHARE = 0.5
NAME_WEIGHTS = {name: weight for weight, names in NAMES.items() for name in names.split()}
#: Ties: between neighbours, and between neighbours under one parent.
NEAR, SIBLINGS = 1.2, 1.0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-z][^\s/>]*+)([^>]*+)>|<[/!?a-z][^>]*+(?:>|\Z)|([^<]++|<)",
    re.S | re.I,
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
_UNQUOTED_END = re.compile(r"=\s*[^\s\"'>][^\s\"'>]*/\Z")
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_CAPITAL = re.compile(r"([a-z])([A-Z])")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_RIGHTS = re.compile(r"©|\(c\)\s*\d{4}|all rights reserved|copyright", re.I)


@dataclass(slots=True)
class Element:
    """An open element: its tag, depth, parent, and what its and its ancestors' names say."""

    tag: str
    depth: int
    parent: Element | None
    content: float
    own: float
    always: bool
    links: int
    hidden: bool
    foreign: bool
    boilerplate: float = 0.0
    size: int = 0
    holds: bool = False


@dataclass(slots=True)
class Block:
    """A run of text between block tags."""

    parent: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _said(tag: str, value: str) -> list[str]:
    """The words of the names of a class or id; names of what a layout has say nothing."""
    words: list[str] = []
    for name in _CAPITAL.sub(r"\1-\2", value).lower().split():
        parts = _WORD.findall(name)
        if tag not in ("body", "html") and not LAYOUT.intersection(parts):
            words += [w for w in parts if w in NAME_WEIGHTS]
    return words


def _name_weight(tag: str, attributes: str, inside: Element) -> tuple[float, bool]:
    """What an element's tag and names say, and whether it is boilerplate whatever it holds."""
    weight, always = REGIONS.get(tag, 0.0), False
    if tag == "header" and inside.content > 0:
        weight = -1.0  # an article's own head
    for name, a, b, c in _NAMED.findall(attributes) if "=" in attributes else ():
        value = a or b or c
        if name.lower() == "role":
            role = ROLES.get(value.lower(), 0.0)
            weight = min(weight, role) if role < 0 else weight + role
            continue
        words = _said(tag, value)
        said = [NAME_WEIGHTS[w] for w in words]
        if said:
            weight = min(weight, min(said)) if min(said) < 0 else weight + max(said)
            always = always or not ALWAYS.isdisjoint(words)
    return weight, always


def _weigh(elements: list[Element], blocks: list[Block]) -> None:
    """What ancestors say, once it is known what they hold. ``elements``: parents before children."""
    for block in blocks:
        block.parent.size += max(0, len(block.text) - block.linked)
        block.parent.holds = block.parent.holds or block.parent.tag == "h1"
    for e in reversed(elements[1:]):
        e.holds = not e.always and (e.holds or (e.own > 0 and e.size > 0))
        e.parent.size += e.size
        e.parent.holds = e.parent.holds or e.holds
    for e in elements[1:]:
        wraps = e.own < 0 and not e.always and e.holds and e.size > WRAPPER_SHARE * elements[0].size
        e.boilerplate = e.parent.boilerplate if wraps else min(e.parent.boilerplate, e.own)


def parse_blocks(source: str) -> list[Block]:
    """The blocks with text, in page order. Broken markup is read as far as it goes."""
    top = Element("", 0, None, 0.0, 0.0, False, 0, False, False)
    here, blocks, block = top, [], None
    elements, open_tags = [top], Counter()

    def end() -> None:
        nonlocal block
        if block is not None:
            block.text = " ".join(html.unescape("".join(block.parts)).split())
            if block.text:
                blocks.append(block)
            block = None

    def close(tags: tuple[str, ...], stop: frozenset[str] = frozenset()) -> None:
        nonlocal here
        if not any(open_tags[t] for t in tags):
            return
        found = here
        while found.parent is not None and found.tag not in tags:
            if found.tag in stop:
                return
            found = found.parent
        if found.parent is not None:
            leave(found.parent)

    def leave(parent: Element) -> None:
        nonlocal here
        while here is not parent:
            open_tags[here.tag] -= 1
            here = here.parent

    at = 0
    while at < len(source):
        token = _TOKEN.match(source, at)
        at = token.end()
        text = token[7]
        if text is not None:
            if here.hidden:
                continue
            if block is None:
                holder = here
                while holder.parent is not None and holder.tag not in BLOCKS:
                    holder = holder.parent
                block = Block(holder)
            block.parts.append(text)
            if here.links:
                block.linked += len(text)
            continue
        tag = (token[2] or token[5] or "").lower()
        if not tag:
            continue
        if token[1] or token[4]:
            close((tag,))
            if tag in BLOCKS and not here.hidden:
                end()
            continue
        attributes = token[3] or token[6] or ""
        if here.foreign and tag in BREAKOUT:
            while here.foreign:
                leave(here.parent)
        closed = attributes.endswith("/") and (here.foreign or tag in FOREIGN) and not _UNQUOTED_END.search(attributes)
        if closed:
            continue
        if tag in RAW:
            ended = _RAW_END[tag].search(source, at)
            at = ended.end() if ended else len(source)
            continue
        if tag in BLOCKS and not here.hidden:
            end()
        elif tag == "br" and block is not None:
            block.parts.append(" ")
        if tag in EMPTY:
            continue
        if tag in CLOSES:
            for ends in CLOSES[tag]:
                close((ends,), (BLOCKS | SILENT) - {"p", ends})
        weight, always = (0.0, False) if here.hidden else _name_weight(tag, attributes, here)
        here = Element(
            tag, here.depth + 1, here, max(here.content, weight), weight, always, here.links + (tag == "a"),
            here.hidden or tag in SILENT or bool(attributes and _HIDDEN.search(attributes)),
            tag in FOREIGN or (here.foreign and tag not in INTEGRATION),
        )
        elements.append(here)
        open_tags[tag] += 1
    end()
    _weigh(elements, blocks)
    return blocks


def log_odds(block: Block) -> float:
    """The classifier: how much speaks for content."""
    text, parent = block.text, block.parent
    size = len(text)
    marks = sum(map(text.count, ".,;!?"))
    z = -1.0 + parent.content + parent.boilerplate
    z += min(1.5, size / 120) + min(1.0, marks / 3)
    z -= 4.0 * min(1.0, block.linked / size)
    if parent.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        z += 1.0
    elif parent.tag in ("p", "blockquote", "pre"):
        z += 0.5
    if size < 200 and _RIGHTS.search(text):
        z -= 2.0
    return z


def _distance(a: Element, b: Element) -> int:
    """Steps between two elements over their common ancestor."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def ties(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, and between those that come next to each other under one parent's parent."""
    edges = [
        (i, i + 1, NEAR / (1 + _distance(blocks[i].parent, blocks[i + 1].parent))) for i in range(len(blocks) - 1)
    ]
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        family = id(block.parent.parent or block.parent)
        if family in last:
            edges.append((last[family], i, SIBLINGS / 2))
        last[family] = i
    return edges


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of the cheapest cut.

    Cutting a node off from its terminal costs the log odds it has for it; what both terminals
    would cost alike is left out beforehand. Flow goes in phases: distances from all nodes with flow to
    give, then as much as goes along shortest paths, each arc looked at once a phase.
    """
    excess = list(odds)
    near: list[dict[int, float]] = [{} for _ in odds]
    for a, b, weight in edges:
        near[a][b] = near[a].get(b, 0.0) + weight
        near[b][a] = near[b].get(a, 0.0) + weight
    tiny = 1e-9
    while True:
        givers = [i for i, e in enumerate(excess) if e > tiny]
        far, queue, reached = dict.fromkeys(givers, 0), deque(givers), False
        while queue:
            a = queue.popleft()
            for b, room in near[a].items():
                if room > tiny and b not in far:
                    far[b] = far[a] + 1
                    reached = reached or excess[b] < -tiny
                    queue.append(b)
        if not reached:
            return [i in far for i in range(len(odds))]
        arcs: dict[int, tuple[int, ...]] = {}
        looked: dict[int, int] = {}
        for giver in givers:
            path = [giver]
            while path and excess[giver] > tiny:
                a = path[-1]
                if excess[a] < -tiny:
                    flow = min(-excess[a], excess[giver], *(near[x][y] for x, y in zip(path, path[1:])))
                    excess[a] += flow
                    excess[giver] -= flow
                    full = len(path)
                    for i, (x, y) in enumerate(zip(path, path[1:]), 1):
                        near[x][y] -= flow
                        near[y][x] += flow
                        if near[x][y] <= tiny:
                            full = min(full, i)
                    del path[full:]
                    continue
                ends = arcs.get(a) or arcs.setdefault(a, tuple(near[a]))
                at = looked.get(a, 0)
                while at < len(ends) and not (near[a][ends[at]] > tiny and far.get(ends[at]) == far[a] + 1):
                    at += 1
                looked[a] = at
                if at < len(ends):
                    path.append(ends[at])
                else:
                    far[a] = -1
                    path.pop()


def main_text(source: str | None) -> str:
    """The content blocks of a page, joined by line breaks; none for a null or empty page."""
    blocks = parse_blocks(source or "")
    content = minimum_cut([log_odds(b) for b in blocks], ties(blocks))
    return "\n".join(b.text for b, kept in zip(blocks, content) if kept)


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``.

    A null or empty page has an empty text. Repeated rows each stay; an empty table gives no
    rows; other columns are not read. Pages are read whole, row by row, and never shuffled.
    """

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array((main_text(h.as_py()) for h in batch["html"]), pa.string())
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], texts], ["page_id", "url", "text"])

    df = pages.select(pages[key].alias("page_id"), pages[url].alias("url"), pages[source].alias("html"))
    kind = df.schema["page_id"].dataType.simpleString()
    done = df.mapInArrow(extract, f"page_id {kind}, url string, text string")
    return done.select("*", F.length("text").cast("bigint").alias("n_chars"))
