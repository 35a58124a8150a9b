"""Main text of web pages by minimum cut: content on the source side, boilerplate on the sink side.

Each text block is a node. Its terminal capacity is the log-odds of a classifier that it is content: what the nearest
marked element around it says, and what the block's own tag, the classes around it, its links and its words say. Neighbours
in the page and blocks that are close in the element tree are joined by edges, so that a block without evidence goes with
its company. The maximum flow finds the labelling of least cost.

The classifier is trained here: on a bounded sample of pages, blocks under clearly marked elements are its labels. A page
is read in one pass, and its tree kept as parents and depths, so time and memory are in proportion to its length.
"""

from __future__ import annotations

import bisect
import html
import math
import re
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidewire.llm.common import least_rows, mapped

#: Elements that start a block of their own.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, and those of them that show none of it.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that never hold page text.
SILENT = frozenset("script style textarea iframe noembed noframes template noscript svg math canvas object audio video head select button datalist".split())
#: Start tags that end an open element of the second set, up to the nearest of the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

#: Marks in nats, positive for content; the nearest marked element around a block decides.
GOOD_ELEMENTS = {"article": 4.0, "main": 4.0}
BAD_ELEMENTS = {"nav": -8.0, "footer": -8.0, "header": -8.0, "aside": -8.0, "form": -8.0, "menu": -8.0, "title": -8.0, "dialog": -8.0, "search": -8.0, "fieldset": -4.0, "label": -3.0}
#: Elements within which an article is a teaser, no main text.
APART = ("nav", "aside", "footer", "header", "menu", "dialog")
#: Parts of a class, id or role: those that mark boilerplate, and those that say nothing of what an element holds. A name
#: marks boilerplate if it has a part of the first kind and none but these: "share-buttons" does, "social-history" does not.
BAD_PARTS = re.compile(
    r"ads?|adsby\w*|adbox|adslot|adunit|advert\w*|banner|breadcrumbs?|byline|comments?|commentlist|consent|cookies?|copyright|disclaimer|disqus|footer|"
    r"form|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|notification|pagination|pager|popup|promo\w*|recommended|"
    r"related|replies|reply|respond|reviews?|share|sharing|sidebar|skip|social|sponsor\w*|subscribe|tags|toc|toolbar|widgets?|"
    r"alert|signup|login|search|complementary|contentinfo"
)
PLAIN_PARTS = re.compile(
    r"area|articles?|author|bar|block|body|bottom|box|btn|buttons?|col|column|contact|container|content|count|entry|global|group|holder|icons?|inner|items?|js|"
    r"left|links?|list|lower|main|media|meta|mobile|mid|middle|outer|page|panel|post|posts|primary|right|row|secondary|section|site|"
    r"sub|text|title|top|ul|unit|upper|user|wrap|wrapper|x|\d+"
)
GOOD_NAMES = frozenset("article articlebody article-body article-content article-text body content entry entry-content main main-content post post-body post-content post-text story story-body text".split())
BAD, GOOD = -8.0, 3.0
#: Mark of an article among other boilerplate: a teaser, but the page's article if it has no other.
TEASER = -7.0
#: Sample of the classifier: most pages, most blocks of a page in it; ridge; largest log-odds of all but the marks.
SAMPLE_PAGES, SAMPLE_BLOCKS, RIDGE, MOST = 2_000, 32, 1.0, 2.5
#: Words of a block whose words are looked at; log-odds of a word that names boilerplate, most of a learned word or class.
SHORT, SEED, LEARNED = 12, -3.0, 1.5
SEEDS = frozenset(
    "advertisement advertising comment comments cookie cookies copyright login logout menu newsletter password privacy reply replies "
    "reserved share sidebar signup sitemap sponsored subscribe subscribed unsubscribe".split()
)
#: Edges: between neighbours of one parent, of near parents, and others, in nats.
SAME, CLOSE, FAR = 0.6, 0.3, 0.1

_ATTRIBUTES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_HIDDEN_NAME = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)
_SLASH = re.compile(r"(?:^|[\s\"'])/\s*$")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")
_PARTS = re.compile(r"[_-]+")


class Tree:
    """Block elements of a page: each one's parent and depth; 0 is the page."""

    def __init__(self) -> None:
        self.parent, self.depth = [0], [0]

    def grow(self, parent: int) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.parent) - 1

    def apart(self, a: int, b: int, most: int) -> int:
        """Steps between two elements over their lowest common ancestor; more than ``most`` if they are further apart."""
        steps = 0
        while a != b and steps <= most:
            if self.depth[a] >= self.depth[b]:
                a = self.parent[a]
            else:
                b = self.parent[b]
            steps += 1
        return steps


class Block:
    """Text of one block: characters in links, the mark around it, in a heading or not, its element, tag and class names."""

    __slots__ = ("heading", "home", "linked", "mark", "names", "tag", "text", "tree")

    def __init__(self, text: str, linked: int, mark: float, heading: bool, tree: Tree, home: int, tag: str, names: tuple[str, ...]):
        self.text, self.linked, self.mark, self.heading = text, linked, mark, heading
        self.tree, self.home, self.tag, self.names = tree, home, tag, names


class Element:
    """An open element: name, mark that holds in it, shows nothing, block element it lies in, stands apart, its class names."""

    __slots__ = ("apart", "home", "mark", "name", "names", "silent")

    def __init__(self, name: str, mark: float, silent: bool, home: int, apart: bool, names: tuple[str, ...]):
        self.name, self.mark, self.silent, self.home, self.apart, self.names = name, mark, silent, home, apart, names


def tags(page: str) -> Iterator[tuple[str, int, int, str, str, bool]]:
    """(text before, start, end, name, attributes, closing) of each tag, comments and the like with the name ''; at last the rest.

    What is read is never read again: an attribute's quote that nothing closes is no quote, an unfinished tag ends the page.
    The caller may send a position to go on from.
    """
    pos = said = 0
    last = {q: page.rfind(q) for q in "\"'"}
    while True:
        at = page.find("<", pos)
        if at < 0:
            break
        follow = page[at + 1 : at + 2]
        closing = follow == "/"
        name, attributes = "", ""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
        elif (follow and follow in "!?") or (closing and not page[at + 2 : at + 3].isalpha() and at + 2 < len(page)):
            end = page.find(">", at + 2)
            end = len(page) if end < 0 else end + 1
        elif found := _NAME.match(page, at + 1 + closing):
            name = found[0].lower()
            end = _ATTRIBUTES.match(page, found.end()).end()
            while end < len(page) and page[end] != ">":
                # A quote that is the last of its kind.
                end = _ATTRIBUTES.match(page, end + 1).end()
            attributes = page[found.end() : end]
            end = min(len(page), end + 1)
        else:
            pos = at + 1
            continue
        go_on = yield page[said:at], at, end, name, attributes, closing
        pos = said = end if go_on is None else go_on
        if go_on is not None:
            yield "", pos, pos, "", "", False
    yield page[said:], len(page), len(page), "", "", False


def names_of(attributes: str) -> tuple[str, ...]:
    return tuple(n for a, b, c in _NAMED.findall(attributes) for n in (a or b or c).lower().split()) if "=" in attributes else ()


def marks_boilerplate(name: str) -> bool:
    parts = [p for p in _PARTS.split(name) if p]
    bad = [bool(BAD_PARTS.fullmatch(p)) for p in parts]
    return any(bad) and all(b or PLAIN_PARTS.fullmatch(p) for b, p in zip(bad, parts, strict=True))


def blocks(page: str) -> list[Block]:
    """Text blocks in page order; character references decoded, white space inside a block made one blank."""
    out: list[Block] = []
    tree = Tree()
    stack = [Element("", 0.0, False, 0, False, ())]
    # Places in the stack of the open elements of each name, and how many of them are headings.
    opened: defaultdict[str, list[int]] = defaultdict(list)
    headings = links = linked = 0
    parts: list[str] = []

    def top(names: Iterable[str]) -> int:
        return max((opened[n][-1] for n in names if opened[n]), default=0)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                own = stack[-1]
                out.append(Block(text, linked, own.mark, headings > 0, tree, own.home, own.name, own.names))
            parts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].silent:
            text = html.unescape(text)
            parts.append(text)
            if links:
                linked += len(text.strip())

    def close(upto: int) -> None:
        nonlocal links, headings
        while len(stack) > upto:
            own = stack[-1]
            if own.apart:
                flush()
            links -= own.name == "a"
            headings -= own.name in HEADINGS
            opened[own.name].pop()
            stack.pop()

    reader = tags(page)
    for before, _, end, name, attributes, closing in reader:
        say(before)
        if not name:
            continue
        if closing:
            if opened[name]:
                close(opened[name][-1])
            elif name == "p":
                flush()
            continue
        if name in BLOCKS:
            flush()
            if opened["p"] and top(("table", "td", "button", "object")) < opened["p"][-1]:
                close(opened["p"][-1])
        if name in CLOSES:
            ends, stops = CLOSES[name]
            limit = top(stops)
            within = [opened[n][bisect.bisect_right(opened[n], limit) if name == "tr" else -1] for n in ends if opened[n] and opened[n][-1] > limit]
            if within:
                close(min(within) if name == "tr" else max(within))
        if name == "body" and opened["head"]:  # a head ends where the body starts
            close(opened["head"][0])
        if name in VOID:
            if name == "br" and parts:
                parts.append(" ")
            continue
        # A slash closes such an element only if it is no part of a value without quotes.
        if _SLASH.search(attributes) and name not in BLOCKS and name not in RAW:
            continue
        around = stack[-1]
        named = names_of(attributes) if name not in ("html", "body") else ()
        mark = _mark(name, named, around.mark, bool(top(APART)), bool(opened["article"]))
        silent = around.silent or name in SILENT or bool(_HIDDEN.search(attributes) or _HIDDEN_NAME.search(_QUOTED.sub("", attributes)))
        apart = name in BLOCKS or silent or mark < around.mark
        if apart:
            flush()
        home = tree.grow(around.home) if name in BLOCKS else around.home
        opened[name].append(len(stack))
        own = tuple(n for n in named if n not in GOOD_NAMES and not marks_boilerplate(n))
        stack.append(Element(name, mark, silent, home, apart, own or (around.names if name not in BLOCKS else ())))
        links += name == "a"
        headings += name in HEADINGS
        if name in RAW:
            found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, end)
            stop = found.start() if found else len(page)
            if not silent:
                say(page[end:stop])
            if not found:
                close(len(stack) - 1)
            reader.send(stop)
    close(1)
    flush()
    if all(b.mark < 4 for b in out):
        for b in out:
            b.mark = GOOD_ELEMENTS["article"] if b.mark == TEASER else b.mark
    return out


def _mark(name: str, named: tuple[str, ...], around: float, in_apart: bool, in_article: bool) -> float:
    """The mark that holds in an element: its own, or that of the nearest marked one around it."""
    if any(marks_boilerplate(n) for n in named):
        return BAD
    if name == "article" and around < 0:
        # Among boilerplate inside an article, or in a sidebar, it is a teaser or a comment.
        return around if in_apart or in_article else TEASER
    if name in GOOD_ELEMENTS:
        return GOOD_ELEMENTS[name]
    # The header of an article holds its headline; others are the site's.
    if name in BAD_ELEMENTS and not (name == "header" and in_article):
        return min(BAD_ELEMENTS[name], around)
    if around >= 0 and name in BLOCKS and any(n in GOOD_NAMES for n in named):
        return max(GOOD, around)
    return around


@dataclass(frozen=True)
class Model:
    """Weights of ``features``, and log-odds of the words of short blocks, of class names and of tags."""

    weights: tuple[float, ...]
    words: dict[str, float] = field(default_factory=dict)
    names: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)


#: Where a sample marks no block either way.
UNTRAINED = Model((-1.0, 0.7, -4.0, 1.0, 0.5, 0.0, 1.0, 0.0, 0.0))


def text_features(block: Block) -> tuple[float, ...]:
    """One, log of the words, share in links, heading or not, sentence end or not, marks for each word."""
    words = block.text.count(" ") + 1
    marks = sum(block.text.count(c) for c in ".,;:!?")
    return (
        1.0,
        math.log(words),
        min(1.0, block.linked / max(1, len(block.text))),
        float(block.heading),
        float(block.text[-1] in ".!?:;…\"”»)"),
        min(2.0, marks / words),
    )


def short_words(block: Block) -> list[str]:
    """Words of a short block; a long one is told by its shape."""
    return _WORD.findall(block.text.lower()) if block.text.count(" ") < SHORT else []


def features(block: Block, model: Model) -> tuple[float, ...]:
    words = short_words(block)
    said = sum(SEED if w in SEEDS else model.words.get(w, 0.0) for w in words) / math.sqrt(len(words)) if words else 0.0
    named = [model.names.get(n, 0.0) for n in block.names]
    return (*text_features(block), said, sum(named) / max(1, len(named)), model.tags.get(block.tag, 0.0))


def costs(block: Block, model: Model = UNTRAINED) -> float:
    """Log-odds that a block is content: the price of calling it boilerplate if positive, else of keeping it."""
    odds = sum(w * x for w, x in zip(model.weights, features(block, model), strict=False))
    return block.mark + max(-MOST, min(MOST, odds))


def fit_text(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps, towards the untrained weights; both classes count alike."""
    good, bad = int(y.sum()), int(len(y) - y.sum())
    start = np.array(UNTRAINED.weights)
    if not good or not bad:
        return UNTRAINED.weights
    share = np.where(y == 1, 0.5 / good, 0.5 / bad) * len(y)
    ridge = RIDGE * np.eye(x.shape[1])
    weights = start.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ weights).clip(-30, 30)))
        slope = x.T @ (share * (y - p)) - ridge @ (weights - start)
        weights = weights + np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + ridge, slope)
    return tuple(weights.tolist())


def log_odds(held: Iterable[tuple[Iterable[str], float]]) -> dict[str, float]:
    """Smoothed log-odds of content for each word, from the blocks that hold it; classes count alike."""
    seen: dict[str, list[float]] = {}
    total = [0.0, 0.0]
    for words, y in held:
        for w in set(words):
            seen.setdefault(w, [0.0, 0.0])[int(y)] += 1
            total[int(y)] += 1
    if not all(total):
        return {}
    scale = [5.0 * t / sum(total) for t in total]
    odds = {w: math.log((n[1] + scale[1]) / (total[1] + 5)) - math.log((n[0] + scale[0]) / (total[0] + 5)) for w, n in seen.items() if sum(n) >= 5}
    base = math.log(total[1] / (total[1] + 5)) - math.log(total[0] / (total[0] + 5)) + math.log(scale[1] / total[1]) - math.log(scale[0] / total[0])
    return {w: max(-LEARNED, min(LEARNED, v - base)) for w, v in odds.items()}


def train(pages: DataFrame, page: str = "html") -> Model:
    """The classifier, from blocks under elements marked as content (4 or more) or boilerplate (-8 or less).

    The sample is of distinct pages, the SAMPLE_PAGES with the least hashes, and never more blocks of a page than
    SAMPLE_BLOCKS, evenly spaced. Null pages are none; without a marked block of each kind the weights are UNTRAINED's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                marked = [b for b in blocks(text) if b.mark >= 4 or b.mark <= -8]
                some = marked[:: -(-len(marked) // SAMPLE_BLOCKS) or 1]
                columns = [
                    pa.array([text_features(b) for b in some], pa.list_(pa.float64())),
                    pa.array([int(b.mark > 0) for b in some], pa.int32()),
                    pa.array([short_words(b) for b in some], pa.list_(pa.string())),
                    pa.array([b.names for b in some], pa.list_(pa.string())),
                    pa.array([b.tag for b in some], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["x", "y", "words", "names", "tag"])

    there = pages.select(F.col(page).alias("_p")).where("_p IS NOT NULL")
    chosen = least_rows(there.withColumn("_place", F.xxhash64("_p")), SAMPLE_PAGES).select("_p")
    rows = mapped(chosen, run, "x array<double>, y int, words array<string>, names array<string>, tag string").collect()
    y = np.array([r["y"] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return UNTRAINED
    tables = [log_odds((r[c] if c != "tag" else [r[c]], r["y"]) for r in rows) for c in ("words", "names", "tag")]
    half = Model(UNTRAINED.weights, *tables)

    def looked_up(r: Row) -> tuple[float, ...]:
        said = [SEED if w in SEEDS else half.words.get(w, 0.0) for w in r["words"]]
        named = [half.names.get(n, 0.0) for n in r["names"]]
        return (*r["x"], sum(said) / math.sqrt(max(1, len(said))), sum(named) / max(1, len(named)), half.tags.get(r["tag"], 0.0))

    return Model(fit_text(np.array([looked_up(r) for r in rows]), y), *tables)


def nearness(a: Block, b: Block) -> float:
    """Weight of the edge between neighbours, by the steps between their elements."""
    apart = a.tree.apart(a.home, b.home, 4)
    return SAME if apart <= 2 else CLOSE if apart <= 4 else FAR


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: each block with the next, and with the next one under its own parent element."""
    out = [(i, i + 1, nearness(found[i], found[i + 1])) for i in range(len(found) - 1)]
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        home = block.tree.parent[block.home]
        if home in last and last[home] < i - 1:
            out.append((last[home], i, CLOSE))
        last[home] = i
    return out


def source_side(terminal: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source side of a minimum cut; a positive terminal weight ties to the source, a negative to the sink.

    A node whose links cannot outweigh its terminal keeps its side; its links then pull its neighbours to that side, which
    may settle them too. What is still open is cut by flows.
    """
    pull, terminal = [0.0] * len(terminal), list(terminal)
    near: list[list[tuple[int, float]]] = [[] for _ in terminal]
    for a, b, w in links:
        pull[a] += w
        pull[b] += w
        near[a].append((b, w))
        near[b].append((a, w))
    side: list[bool | None] = [None] * len(terminal)
    queue = [i for i, t in enumerate(terminal) if abs(t) > pull[i]]
    while queue:
        i = queue.pop()
        if side[i] is None:
            side[i] = terminal[i] > 0
            for j, w in near[i]:
                if side[j] is None:
                    pull[j] -= w
                    terminal[j] += w if side[i] else -w
                    if abs(terminal[j]) > pull[j] + 1e-9:
                        queue.append(j)
    rest = [i for i, s in enumerate(side) if s is None]
    if rest:
        number = {i: k for k, i in enumerate(rest)}
        own = [(number[a], number[b], w) for a, b, w in links if a in number and b in number]
        for i, s in zip(rest, _flow([terminal[i] for i in rest], own), strict=True):
            side[i] = s
    return side


def _flow(terminal: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """The source side of a minimum cut by blocking flows over level graphs (Dinic)."""
    n = len(terminal)
    if not any(t > 0 for t in terminal) or not any(t < 0 for t in terminal):
        return [any(t > 0 for t in terminal)] * n
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, forth: float, back: float) -> None:
        graph[a].append(len(to))
        to.append(b)
        room.append(forth)
        graph[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, t in enumerate(terminal):
        if t > 0:
            join(source, i, t, 0.0)
        elif t < 0:
            join(i, sink, -t, 0.0)
    for a, b, w in links:
        join(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(i for i, e in enumerate(path) if room[e] <= tiny)
                node = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while at[node] < len(graph[node]):
                e = graph[node][at[node]]
                if room[e] > tiny and level[to[e]] == level[node] + 1:
                    break
                at[node] += 1
            else:
                if node == source:
                    break
                e = path.pop()
                node = to[e ^ 1]
                at[node] += 1
                continue
            path.append(e)
            node = to[e]


def main_text(page: str | None, model: Model = UNTRAINED) -> str:
    """Content blocks of a page joined by an empty line; '' for no page or no content."""
    found = blocks(page) if page else []
    kept = source_side([costs(b, model) for b in found], edges(found))
    return "\n\n".join(b.text for b, content in zip(found, kept, strict=True) if content)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text, n_chars), one row out for each page.

    A null or empty page has the text ''. Whole pages of any length are read. Repeated rows come out as often; pages do not
    influence each other beyond the trained model; an empty table gives no rows; other columns are not carried.
    """
    model = train(pages, page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [main_text(p, model) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))],
                    names=[key, url, "text", "n_chars"],
                )

    rows = pages.select(F.col(key).cast("long").alias(key), F.col(url), F.col(page))
    return mapped(rows, run, f"{key} long, {url} string, text string, n_chars long")
