"""Main text of web pages by minimum cut.

A page becomes a row of blocks, the runs of text between block tags. A linear classifier gives
each block a score from its tags, its containers' tags and names, its links and its words: the
capacity towards content if positive, towards boilerplate if negative. Edges keep blocks
together that follow each other, the more the nearer they are in the tree, and blocks of one
container. The cheapest labelling is a minimum cut of this graph, found by maximum flow. Names that
speak for boilerplate weigh more than any edges; all else is weighed so that a block's neighbours
can outvote it, as a paragraph of a word or two in an article.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import map_rows, slices

# Fixed values of HTML: names of tags.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Their contents are not text of the page.
DROPPED_TAGS = frozenset(
    "script style noscript template svg math iframe object canvas video audio select textarea "
    "button title datalist".split()
)
CLOSED_BY_OWN_KIND = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}

# Names in tags, classes, ids and roles that speak for or against content.
AGAINST = frozenset(
    "ad ads adv advert adverts advertisement advertising aside banner bar breadcrumb breadcrumbs "
    "comment comments commenting consent contentinfo cookie cookies copyright dialog "
    "disclaimer discussion disqus footer form gdpr header legal login masthead menu menus modal "
    "nav navbar navbars navigation navigations newsletter notice notices notification "
    "notifications overlay pager pagination popup privacy promo promos promotion promotions "
    "recommended recommendations related reply replies responses search share sharing sidebar "
    "sidebars signup skip social sponsor sponsored sponsors subscribe subscription toolbar "
    "widget widgets alert complementary respond".split()
)
AGAINST_BEGINNINGS = (
    "advert", "banner", "breadcrumb", "comment", "cookie", "footer", "navbar", "newsletter", "promo",
    "sidebar", "sponsor",
)
AGAINST_ENDS = ("footer", "menu", "nav", "sidebar")
FOR = frozenset("article articles body content entry main post story text".split())
# A name for content makes up for little: in its container a block of one word is left to its edges.
AGAINST_SCORE, FOR_SCORE = -8.0, 0.375
# Where a name against content may be about something else, it lowers the score and settles nothing.
LOWERED_SCORE = -2.0
# First words of names that tell what an element has, not what it is.
HAVING = frozenset("has have no with without".split())
POSTS = frozenset("post hentry".split())
# A header counts outside of content only, a form not around an article or the main part.
HEADER_SCORE, FORM_SCORE = -7.5, -7.0

# Attributes as HTML reads them: a quote is one right after "=" only, and ends at the next of its
# kind, however far; one without an end is part of a bare value. Nothing is read twice.
_BLANK = r" \t\n\f\r"
_ATTRIBUTES = (
    rf"(?:[{_BLANK}/]++|[^{_BLANK}/>][^{_BLANK}/>=]*+"
    rf"(?:[{_BLANK}]*+=[{_BLANK}]*+(?:\"[^\"]*+\"|'[^']*+'|[^{_BLANK}>]*+))?+)*+"
)
_TAG = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    rf"([^{_BLANK}/>][^{_BLANK}/>=]*+)"
    rf"(?:[{_BLANK}]*+=[{_BLANK}]*+(?:\"([^\"]*+)\"|'([^']*+)'|([^{_BLANK}>]*+)))?+"
)
_NAMES = re.compile(r"\b(?:class|id|role)$", re.I)
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_WORD_PARTS = re.compile(r"[a-z]+")
_NO_ROOM = 1e-9
_ENDS = (".", "!", "?", ":", "…", "”", "。", ";")


class Element:
    """An open element. ``holder`` is the nearest element around a text that separates blocks, itself
    or one above; elements of that kind know their ``depth`` among themselves and the next ``up``."""

    __slots__ = ("tag", "number", "hint", "shown", "holder", "up", "depth", "open_inline")

    def __init__(self, tag: str, number: int, hint: float, shown: bool, around: Element | None):
        self.tag, self.number, self.hint, self.shown = tag, number, hint, shown
        self.up: Element | None = around.holder if around else None
        if around is None or tag in BLOCK_TAGS:
            self.holder = self
            self.depth = self.up.depth + 1 if self.up else 0
            self.open_inline: dict[str, int] = {}  # inline elements open right inside, by tag
        else:
            self.holder = around.holder


class Block:
    __slots__ = ("text", "words", "link_words", "holder", "hint")

    def __init__(self, text: str, link_words: int, holder: Element, hint: float):
        self.text, self.words = text, text.count(" ") + 1
        self.link_words, self.holder, self.hint = link_words, holder, hint

    @property
    def tag(self) -> str:
        return self.holder.tag


_hints: dict[tuple[str, str, bool], float | None] = {}


def _is_against(name: str) -> bool:
    return name in AGAINST or name.startswith(AGAINST_BEGINNINGS) or name.endswith(AGAINST_ENDS)


def _own_hint(tag: str, attributes: str, lowered: bool = False) -> float | None:
    """What a container's tag and names say; None for what is not shown. With ``lowered``, names
    (but not the tag or role) lower the score only."""
    key = (tag, attributes, lowered)
    if key in _hints:
        return _hints[key]
    hint: float | None = 0.0
    if tag not in ("html", "body"):
        # All words, those against content, and of these the ones that tell what the element is.
        names, against, firm = {tag}, {tag} if _is_against(tag) else set(), set()
        hidden, posted = False, tag == "article"
        for found in _ATTRIBUTE.finditer(attributes) if attributes else ():
            name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
            if name == "hidden":
                hidden = True
            elif name == "aria-hidden":
                hidden |= value.strip().lower().startswith("true")
            elif name == "style":
                hidden |= bool(_NO_DISPLAY.search(value))
            elif _NAMES.search(name):
                for one in value.split():
                    words = _WORD_PARTS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", one).lower())
                    names.update(words)
                    posted |= one.lower() in POSTS
                    if words and words[0] not in HAVING:
                        against.update(filter(_is_against, words))
                        if name == "role":
                            firm.update(filter(_is_against, words))
                        elif _is_against(words[0]) and not lowered and tag != "main":
                            firm.add(words[0])
        if _is_against(tag):
            firm.add(tag)
        hint = FOR_SCORE if names & FOR else 0.0
        if against == {"header"}:
            hint = 0.0 if hint else HEADER_SCORE
        elif against == {"form"}:
            hint = FORM_SCORE
        elif against and not firm and (posted or lowered or tag == "main"):
            hint += LOWERED_SCORE
        elif against:
            hint += AGAINST_SCORE
        if hidden:
            hint = None
    if len(_hints) > 20_000:
        _hints.clear()
    _hints[key] = hint
    return hint


def blocks(page: str, lowered: frozenset[int] = frozenset()) -> list[Block]:
    """Blocks of text in the order of the page, in time linear in its length. Names of the elements
    whose numbers are given only lower the score."""
    found: list[Block] = []
    stack = [Element("", 0, 0.0, True, None)]
    open_blocks: dict[str, int] = {}
    pieces: list[str] = []
    link_text: list[str] = []
    links = number = at = 0

    def finish() -> None:
        nonlocal pieces, link_text
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                in_links = len("".join(link_text).split())
                found.append(Block(text, in_links, stack[-1].holder, stack[-1].hint))
            pieces, link_text = [], []

    def add(text: str) -> None:
        if text and stack[-1].shown:
            text = html.unescape(text)
            pieces.append(text)
            if links:
                link_text.append(text)

    def opened_by(element: Element) -> dict[str, int]:
        """The counter that an open element is in."""
        return open_blocks if element.holder is element else element.holder.open_inline

    def push(element: Element) -> None:
        counts = opened_by(element)
        counts[element.tag] = counts.get(element.tag, 0) + 1
        stack.append(element)

    def pop() -> str:
        element = stack.pop()
        opened_by(element)[element.tag] -= 1
        return element.tag

    size = len(page)
    while at < size:
        match = _TAG.search(page, at)
        if match is None:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        name = match[2]
        if not name:
            continue
        tag = name.lower()
        if match[1]:
            if tag == "a" and links:
                links -= 1
            if tag in BLOCK_TAGS:
                finish()
            # An end tag closes an open element only, and an inline one nothing outside its block.
            around = open_blocks if tag in BLOCK_TAGS else stack[-1].holder.open_inline
            if around.get(tag):
                while pop() != tag:
                    pass
            continue
        attributes = match[3]
        closed = attributes.endswith("/")
        if tag in DROPPED_TAGS:
            if not closed:
                end = _end_tag(tag).search(page, at)
                after = page.find(">", end.end()) if end else -1
                at = after + 1 if after >= 0 else size
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK_TAGS:
            finish()
            # Inline elements left open by a block don't go on in the next one.
            links = 0
            while stack[-1].holder is not stack[-1]:
                pop()
            if stack[-1].tag == "p":
                pop()
            if tag in CLOSED_BY_OWN_KIND and stack[-1].tag in CLOSED_BY_OWN_KIND[tag]:
                pop()
        if tag in VOID_TAGS or closed and tag not in BLOCK_TAGS:
            continue
        if tag == "a":
            links += 1
        own = _own_hint(tag, attributes, number + 1 in lowered)
        around = stack[-1].hint
        if own == HEADER_SCORE and around > 0:
            own = 0.0  # an article's own headline
        number += 1
        hint = around if own is None or not own else (own if own < 0 else around + own)
        if around < LOWERED_SCORE and hint > around and not (around == FORM_SCORE and tag in ("article", "main")):
            hint = around  # nothing inside of boilerplate makes it content again
        elif around == FORM_SCORE and tag in ("article", "main"):
            hint = FOR_SCORE
        shown = stack[-1].shown and own is not None
        push(Element(tag, number, min(hint, FOR_SCORE), shown, stack[-1]))
    finish()
    return found


@cache
def _end_tag(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\b", re.I)


def score(block: Block) -> float:
    """Log odds of content."""
    words, text = block.words, block.text
    link_share = min(1.0, block.link_words / words)
    total = -1.0 + block.hint
    total += 0.12 * min(words, 25)
    total += 1.0 if words >= 4 and text.endswith(_ENDS) else 0.0
    total -= 4.0 * link_share
    if block.tag == "h1":
        total += 2.5
    elif block.tag in ("h2", "h3", "h4", "h5", "h6", "blockquote", "pre"):
        total += 1.0
    elif block.tag in ("td", "th", "li", "dd", "dt"):
        total += 0.7  # cells and items are short where they are content too
    else:
        total += 0.5
    if "©" in text[:40] or text[:9].lower() == "copyright":
        total -= 3.0
    return total


def _steps(one: Element, other: Element) -> int:
    """Elements to leave and to enter from one holder to another. Over a page's blocks in order each
    element is left once and entered once, however deep it is."""
    steps = 0
    while one is not other:
        if one.depth >= other.depth:
            one = one.up
        else:
            other = other.up
        steps += 1
    return steps


def smoothness(found: Sequence[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, and between a block and the next one of its container."""
    edges = []
    last_in: dict[int, int] = {}
    for at, block in enumerate(found):
        holder = block.holder
        container = holder.up.number if holder.up else -1
        if at:
            steps = _steps(found[at - 1].holder, holder)
            edges.append((at - 1, at, 0.2 + 1.6 / (1 + max(0, steps - 1))))
        other = last_in.get(container)
        if other is not None and other != at - 1:
            edges.append((other, at, 0.4))
        last_in[container] = at
    return edges


def min_cut(scores: Sequence[float], edges: Sequence[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the side of content in a cheapest cut.

    A node whose own capacity is at least that of all its edges takes its side in some cheapest
    cut; it is settled first, and what it holds of its neighbours becomes theirs. The others are
    separated by flow along shortest augmenting paths. Of several cheapest cuts, nodes settled by
    an exact tie go by their own score (a score of zero is boilerplate), and of the others the
    fewest are content."""
    count = len(scores)
    own = list(scores)
    near: list[dict[int, float]] = [{} for _ in range(count)]
    for a, b, weight in edges:
        near[a][b] = near[a].get(b, 0.0) + weight
        near[b][a] = near[b].get(a, 0.0) + weight
    side: list[bool | None] = [None] * count
    queue = deque(range(count))
    while queue:
        node = queue.popleft()
        if side[node] is not None or abs(own[node]) < sum(near[node].values()):
            continue
        side[node] = own[node] > 0
        for other, weight in near[node].items():
            own[other] += weight if side[node] else -weight
            del near[other][node]
            queue.append(other)
        near[node] = {}
    left = [node for node in range(count) if side[node] is None]
    if left:
        reached = _flow(left, own, near)
        for node in left:
            side[node] = node in reached
    return [bool(one) for one in side]


def _flow(left: list[int], own: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes that content still reaches when no more flows to boilerplate.

    Flow is pushed along shortest paths, all paths of one length at a time: levels are found once,
    and each edge that leads no further is passed over for good."""
    index = {node: at for at, node in enumerate(left)}
    source, sink = len(left), len(left) + 1
    edges: list[list[int]] = [[] for _ in range(len(left) + 2)]
    heads: list[int] = []
    rooms: list[float] = []

    def connect(a: int, b: int, room: float, back: float) -> None:
        """An edge and its reverse, whose numbers differ in the last bit."""
        for one, other, free in ((a, b, room), (b, a, back)):
            edges[one].append(len(heads))
            heads.append(other)
            rooms.append(free)

    for node in left:
        if own[node] > 0:
            connect(source, index[node], own[node], 0.0)
        elif own[node] < 0:
            connect(index[node], sink, -own[node], 0.0)
        for other, weight in near[node].items():
            if node < other:
                connect(index[node], index[other], weight, weight)
    while True:
        level = [-1] * len(edges)
        level[source] = 0
        queue = deque([source])
        while queue and level[sink] < 0:
            node = queue.popleft()
            for edge in edges[node]:
                other = heads[edge]
                if level[other] < 0 and rooms[edge] > _NO_ROOM:
                    level[other] = level[node] + 1
                    queue.append(other)
        if level[sink] < 0:
            return {left[at] for at in range(len(left)) if level[at] >= 0}
        tried = [0] * len(edges)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                amount = min(rooms[edge] for edge in path)
                for edge in path:
                    rooms[edge] -= amount
                    rooms[edge ^ 1] += amount
                # Go on from before the first edge that is full now.
                full = next(at for at, edge in enumerate(path) if rooms[edge] <= _NO_ROOM)
                node = heads[path[full] ^ 1]
                del path[full:]
                continue
            own_edges = edges[node]
            while tried[node] < len(own_edges):
                edge = own_edges[tried[node]]
                if rooms[edge] > _NO_ROOM and level[heads[edge]] == level[node] + 1:
                    break
                tried[node] += 1
            if tried[node] < len(own_edges):
                path.append(edge)
                node = heads[edge]
            elif path:
                node = heads[path.pop() ^ 1]
                tried[node] += 1
            else:
                break


def main_text(page: str) -> str:
    found = blocks(page)
    text = _content(found)
    if found and not text:
        # Names of a container of most words may be about its layout or its subject.
        words: dict[int, int] = {}
        above: dict[int, int] = {}
        for block in found:
            words[block.holder.number] = words.get(block.holder.number, 0) + block.words
            one = block.holder
            while one.up and one.number not in above:
                above[one.number] = one.up.number
                one = one.up
        # Inner elements have higher numbers than those around them.
        for element in sorted(above, reverse=True):
            words[above[element]] = words.get(above[element], 0) + words.get(element, 0)
        half = sum(block.words for block in found) / 2
        found = blocks(page, frozenset(one for one, n in words.items() if n > half))
        text = _content(found)
        if not text:
            # An article too small to tell by its words: what names for content hold.
            text = " ".join(block.text for block in found if block.hint > 0)
    return text


def _content(found: Sequence[Block]) -> str:
    kept = min_cut([score(block) for block in found], smoothness(found))
    return " ".join(block.text for block, content in zip(found, kept, strict=True) if content)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row, in no shuffle.

    A null or empty page, or one without content, has an empty text. Null ids and urls and
    repeated rows are kept as they are; broken markup is read as far as it goes. Other columns are
    ignored.
    """
    columns = pages.select(
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), "page_id", "url"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            texts = [main_text(page) for page in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = columns.schema["page_id"].dataType.simpleString()
    return map_rows(columns, f"page_id {kind}, url string, text string, n_chars long", work)
