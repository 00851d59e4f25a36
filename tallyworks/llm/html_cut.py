"""Main text of web pages by a minimum cut between content and boilerplate.

A page's text blocks are the nodes of a graph. A linear classifier over cues of each block gives what it costs to call
it boilerplate or content; these costs are the capacities from the source and to the sink. Neighbours in page order
and blocks of one parent are tied by smoothness edges. The minimum cut is the cheapest labelling of all blocks.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import arrow_map

#: Names of HTML elements and attribute values, fixed by the format or by common use.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rb rp rt rtc ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template title textarea select option button svg math iframe object canvas head datalist".split())
RAW = frozenset("script style textarea title".split())
OUTSIDE = frozenset("nav aside form menu dialog footer".split())
CUES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|advertisement|adverts|banner|sponsor|sponsored|promo|promotion|nav|navbar|navigation|menu|menubar|"
    r"breadcrumb|breadcrumbs|sidebar|side|aside|widget|footer|foot|header|masthead|topbar|comment|comments|comment-list|disqus|reply|"
    r"replies|discussion|notice|cookie|cookies|consent|gdpr|popup|modal|overlay|alert|newsletter|subscribe|signup|login|social|share|"
    r"sharing|related|recommended|recommendations|more|pagination|pager|tags|toolbar|search|form|copyright|legal|disclaimer|skip|hidden|"
    r"contentinfo|complementary|dialog)(?:$|[\s_-]|\d)"
)
BODY_CUES = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|body|text)(?:$|[\s_-]|\d)")
#: A class that says how a page is laid out, not what its element is.
LAYOUT = re.compile(r"(?:has|have|no|with|without|show|hide|layout)[_-]")
#: Cues of parts that stay boilerplate even where they are most of a page.
ASIDE = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|comments?|comment-list|disqus|discussion|repl(?:y|ies)|cookies?|consent|gdpr|popup|modal|overlay|dialog)(?:$|[\s_-]|\d)")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S
)
#: The same without a search for the end of quotes.
_LOOSE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|()()()<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Weights of the classifier: positive for content. The evidence of the markup outweighs all smoothness.
WEIGHTS = {"outside": -24.0, "cue": -24.0, "article": 8.0, "body_cue": 4.0, "linked": -5.0, "long": 2.0, "sentence": 1.0, "heading": 1.0, "base": -0.5}
NEXT, SAME_PARENT, PER_STEP = 0.4, 1.0, 0.5


@dataclass
class Block:
    """Text between two block-level tags, and the element it stands in."""

    text: str
    linked: int
    node: int
    cues: frozenset[str]


@dataclass
class _Open:
    name: str
    number: int
    hidden: bool
    cues: frozenset[str]


@dataclass
class Tree:
    """Elements by number, each after its parent; the page itself is 0."""

    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    #: Elements whose cue waits for the whole page, and what it is.
    pending: dict[int, str] = field(default_factory=dict)

    def add(self, parent: int) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.parent) - 1

    def sums(self, values: list[int]) -> list[int]:
        """What each element and all below it hold together."""
        out = list(values)
        for i in range(len(out) - 1, 0, -1):
            out[self.parent[i]] += out[i]
        return out

    def steps(self, a: int, b: int) -> int:
        """Steps from one element to another. Summed over neighbouring blocks, twice the number of elements at most."""
        n = 0
        while a != b:
            if self.depth[a] < self.depth[b]:
                a, b = b, a
            a, n = self.parent[a], n + 1
        return n


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    links: list[str] = field(default_factory=list)


def _cues(name: str, attributes: str, above: frozenset[str]) -> tuple[frozenset[str], bool, str]:
    """What an element says about the text inside it, whether it hides it, and a cue that waits.

    Outside main and article a cue, ``cue`` or ``aside``, waits until the whole page tells whether the element only
    wraps the main text.
    """
    cues, hidden, waiting = above, name in HIDDEN, ""
    words: list[str] = []
    if name in OUTSIDE or name == "header" and "article" not in above:
        cues = cues | {"outside"}
    elif name in ("article", "main"):
        cues = cues | {"article"}
    elif name in ("h1", "h2", "h3", "h4", "h5", "h6"):
        cues = cues | {"heading"}
    if attributes and name not in ("body", "html"):
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), a or b or c
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
            elif key in ("class", "id", "role", "itemprop"):
                value = _CAMEL.sub("-", value).lower()
                if "article" in cues or BODY_CUES.search(value):
                    value = value.replace("header", "")  # an article's own title
                words += value.split()
    words = [x for x in words if not LAYOUT.match(x)]
    marks = [x for x in words if CUES.search(x)]
    body = any(BODY_CUES.search(x) and not CUES.search(x) for x in words)
    if body and not marks:
        cues = cues | {"body_cue"}
    elif marks and "article" in above:
        cues = cues | {"cue"}
    elif marks and not body:  # a body word cancels them
        waiting = "aside" if any(map(ASIDE.search, marks)) else "cue"
    return cues, hidden, waiting


def _settle(blocks: list[Block], tree: Tree, mains: list[int], articles: list[int]) -> None:
    """Make a cue decisive unless its element wraps the main text: it is or holds main, or most of the text and every article."""
    if not tree.pending:
        return
    texts, main, article = ([0] * len(tree.parent) for _ in range(3))
    for b in blocks:
        texts[b.node] += 0 if "outside" in b.cues else len(b.text)
    for numbers, count in ((mains, main), (articles, article)):
        for i in numbers:
            count[i] += 1
    inside, main, article = map(tree.sums, (texts, main, article))
    decided = [False] * len(tree.parent)
    for i in range(1, len(decided)):
        cue = tree.pending.get(i)
        most = cue == "cue" and 2 * inside[i] > inside[0] and article[i] == article[0]
        decided[i] = decided[tree.parent[i]] or cue is not None and not most and not main[i]
    for b in blocks:
        if decided[b.node]:
            b.cues |= {"cue"}


def _ends(page: str) -> tuple[list[int], list[int]]:
    """Places of quotes and closing brackets, and the first bracket outside of quotes for a tag's inside from each on (-1: none)."""
    found = [(m.start(), m.group()) for m in re.finditer("[>\"']", page)]
    ends, after = [-1] * (len(found) + 2), {}
    for i in range(len(found) - 1, -1, -1):
        at, char = found[i]
        ends[i] = at if char == ">" else ends[after.get(char, len(found)) + 1]
        after[char] = i
    return [at for at, _ in found], ends


def _tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it closes, attributes) of all markup in order; comments and the like have no name.

    Markup after the last closing bracket is text, but for an open comment. A tag that no bracket outside of quotes
    ends is read to the first bracket; from the first such tag on, ends are looked up, so that none is searched twice.
    ``send`` goes on at another place.
    """
    at, last, table = 0, page.rfind(">") + 1, None
    while True:
        found = (_TAG if table is None else _LOOSE).search(page, at, last) if at < last else None
        if not found:
            opened = [i for i in (page.find("<!--", at), page.find("<![CDATA[", at)) if i >= 0]
            if opened:
                yield min(opened), len(page), "", False, ""
            return
        start, at, whole = found.start(), found.end(), found.group()
        name = closing = attributes = ""
        if whole.startswith("<!--") and not whole[4:].endswith("-->") or whole.startswith("<![CDATA[") and not whole.endswith("]]>"):
            at = len(page)
        elif table is None and found.group(2):
            closing, name, attributes = found.group(1, 2, 3)
        elif found.group(5):
            closing, name, attributes = found.group(4, 5, 6)
            if table is None:
                table = _ends(page)
            else:
                end = table[1][bisect_left(table[0], found.start(6))]
                if end >= 0:
                    attributes, at = page[found.start(6) : end], end + 1
        jump = yield start, at, name.lower(), bool(closing), attributes or ""
        if jump is not None:
            at = jump
            yield start, at, "", False, ""  # what ``send`` returns


def blocks_of(page: str) -> tuple[list[Block], Tree]:
    """The text blocks of a page in order, and its elements; malformed markup is read as far as it goes."""
    root = _Open("", 0, False, frozenset())
    stack, state, tree, at, in_link = [root], _Page(), Tree(), 0, 0
    open_names: Counter[str] = Counter()
    tops: dict[str, list[int]] = {"main": [], "article": []}

    def text(piece: str) -> None:
        if piece and not stack[-1].hidden:
            state.parts.append(piece)
            if in_link:
                state.links.append(piece)

    def close() -> None:
        if state.parts:
            words = " ".join(html.unescape("".join(state.parts)).split())
            if words:
                linked = len(" ".join(html.unescape("".join(state.links)).split()))
                state.blocks.append(Block(words, linked, stack[-1].number, stack[-1].cues))
            state.parts, state.links = [], []

    def leave() -> str:
        name = stack.pop().name
        open_names[name] -= 1
        return name

    tags = _tags(page)
    for start, end, name, closing, attributes in tags:
        text(page[at:start])
        at = end
        if not name:
            continue
        if name in INLINE and name not in HIDDEN:
            if name == "a":
                in_link = 0 if closing else 1
            elif name == "br":
                text(" ")
            continue
        close()
        if closing:
            if open_names[name] > 0:
                while leave() != name:
                    pass
            in_link = 0
            continue
        if name in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and stack[-1].name in ({name} | {"p"}):
            leave()
        elif stack[-1].name == "p":
            leave()
        if name in VOID or attributes.endswith("/") and name not in RAW:
            continue
        number = tree.add(stack[-1].number)
        cues, hidden, waiting = _cues(name, attributes, stack[-1].cues)
        if waiting:
            tree.pending[number] = waiting
        if name in tops and not {"article", "outside"} & stack[-1].cues and not (hidden or stack[-1].hidden):
            tops[name].append(number)
        if name in RAW:  # their text is no markup
            found = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            at = found.start() if found else len(page)
            tags.send(at)
        stack.append(_Open(name, number, hidden or stack[-1].hidden, cues))
        open_names[name] += 1
    text(page[at:])
    close()
    _settle(state.blocks, tree, tops["main"], tops["article"])
    return state.blocks, tree


def score(block: Block) -> float:
    """Evidence for content, from the classifier."""
    w, cues, n = WEIGHTS, block.cues, len(block.text)
    value = w["base"] + sum(w[c] for c in ("outside", "cue", "article", "body_cue", "heading") if c in cues)
    value += w["linked"] * block.linked / n + w["long"] * min(1.0, n / 200)
    return value + (w["sentence"] if block.text[-1] in ".!?…\"'”»" else 0.0)


def _closeness(a: Block, b: Block, tree: Tree) -> float:
    """Weight of the tie of two neighbours: the less, the more steps through the tree lie between them."""
    same = SAME_PARENT if tree.parent[a.node] == tree.parent[b.node] else 0.0
    return NEXT + (same * PER_STEP ** max(0, tree.steps(a.node, b.node) - 2) if same else 0.0)


def minimum_cut(gain: list[float], ties: dict[tuple[int, int], float]) -> list[bool]:
    """Which nodes stay with the source, for nodes worth ``gain`` there and ties that cost if they are cut.

    A node whose own evidence outweighs all its ties has the same label in every minimum cut; it is fixed first, and
    its ties become evidence of its neighbours. Augmenting paths by breadth decide the rest.
    """
    near: list[dict[int, float]] = [{} for _ in gain]
    for (a, b), weight in ties.items():
        near[a][b] = near[a].get(b, 0.0) + weight
        near[b][a] = near[b].get(a, 0.0) + weight
    gain = list(gain)
    label: list[bool | None] = [None] * len(gain)
    todo = deque(range(len(gain)))
    while todo:
        i = todo.popleft()
        if label[i] is None and abs(gain[i]) > sum(near[i].values()):
            label[i] = gain[i] > 0
            for j, weight in near[i].items():
                gain[j] += weight if label[i] else -weight
                del near[j][i]
                todo.append(j)
            near[i] = {}
    left = [i for i, x in enumerate(label) if x is None]
    if not left:
        return [bool(x) for x in label]
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in left} | {source: {}, sink: {}}
    for i in left:
        a, b = (source, i) if gain[i] > 0 else (i, sink)
        room[a][b] = abs(gain[i])
        room[b].setdefault(a, 0.0)
    while True:
        came, queue = {source: source}, deque([source])
        while queue and sink not in came:
            i = queue.popleft()
            for j, free in room[i].items():
                if free > 1e-9 and j not in came:
                    came[j] = i
                    queue.append(j)
        if sink not in came:
            break
        path, j = [], sink
        while j != source:
            path.append((came[j], j))
            j = came[j]
        flow = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= flow
            room[b][a] = room[b].get(a, 0.0) + flow
    for i in left:
        label[i] = i in came
    return [bool(x) for x in label]


def main_text(page: str) -> str:
    """Text of the blocks on the source's side of the cut, one per line."""
    blocks, tree = blocks_of(page)
    ties: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            ties[i - 1, i] = _closeness(blocks[i - 1], block, tree)
        j = last.get(tree.parent[block.node])
        if j is not None and j < i - 1:
            ties[j, i] = SAME_PARENT
        last[tree.parent[block.node]] = i
    keep = minimum_cut([score(b) for b in blocks], ties)
    return "\n".join([b.text for b, k in zip(blocks, keep, strict=True) if k])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every page from its whole HTML.

    A NULL or empty page, or one without main text, gives an empty text. Repeated rows and NULL ids or addresses stay
    rows of their own; other columns are not read; an empty table gives an empty result.
    """

    def rows(batch: dict[str, list]) -> dict[str, list]:
        texts = [main_text(page or "") for page in batch["html"]]
        return {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    needed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return arrow_map(needed, rows, "page_id long, url string, text string, n_chars long")
