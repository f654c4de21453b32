"""HTML extraction by minimum-cut labelling.

A page is read once into blocks: the text between block-level tags, with the path of elements around it. A logistic
regression gives each block its log-odds of being content from features that know no page (``FEATURES``): its length,
the share of its text inside links, its tag, whether it ends as a sentence does, and the sections and class and id
words around it. Log-odds are the capacities from the source (content) or to the sink (boilerplate). Neighbouring
blocks, and blocks that follow each other under one parent, are joined by smoothness edges whose capacity falls with
the steps between them in the tree. The minimum cut, found by maximum flow (shortest augmenting paths in levels),
separates content from boilerplate: short items of a list between paragraphs go with these, whatever their own odds.

``train`` learns the weights on at most ``MOST_PAGES`` pages of the corpus that mark their content by an article or
main element: blocks inside are content. There these elements are hidden from the features (read as div), so the
weights hold for pages without them. Weights have a Gaussian prior around ``PRIOR``, which alone is used where no page
marks its content.

Sections and marks are parts of the page, so those of a wrapper are no evidence: of an element around the article (the
longest unmarked article or main, else element of an ``ARTICLE`` word), of one inside it that holds most of its words,
or of one around all blocks and not next to any of them. On elements of running text only a class that is a listed word
as a whole counts.

Defined results: null and empty pages, and pages without content, give an empty text; character references are
decoded; white space inside a block becomes one space and is trimmed, ``<br>`` counts as white space; blocks are
joined by newlines in page order; whole pages are read, however long; broken markup is read as far as it goes (an
unclosed script, style or comment reaches the end); rows that repeat give equal texts; an empty table gives an empty
result; other columns are carried.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .arrow_text import map_texts, whole_row

#: Elements whose content is not text of the page, and those whose content is no markup either.
RAW = frozenset("script style title textarea noscript template iframe svg object canvas audio video select option datalist button head".split())
_CDATA = frozenset("script style title textarea noscript template iframe svg object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: An opening tag of the key closes an open element of the value, up to the nearest of _SCOPE.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table tbody thead tfoot div section article body".split())
#: Elements and roles of a page's sections beside the article; header counts outside of the article.
SECTIONS = frozenset("nav footer aside form menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar toolbar form".split())
#: Words of class and id that mark what is beside the article, and those that mark it.
BOILERPLATE = frozenset("ad ads advert advertisement advertising adsense adslot sponsor sponsored promo promotion banner nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar widget footer masthead cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations pagination pager toolbar comment comments commentlist respond reply replies disqus skip topbar copyright disclaimer".split())
#: Those that mark even an article element, or a part of an article that is longer than the rest.
APART = frozenset("comment comments reply replies related ad sponsored".split())
ARTICLE = frozenset("article content post entry story main body text".split())
PARAGRAPH = frozenset("p blockquote pre dd figcaption math".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of running text, whose classes tell about the text itself.
RUNNING = PARAGRAPH | HEADING | frozenset("li td th dt caption summary span a b i em strong small mark code q cite label u s sub sup time abbr".split())

FEATURES = ("bias", "words", "links", "paragraph", "heading", "sentence", "section", "marked", "article_word")
#: The weights' prior means and precisions. The bias is held: corpora show few unmarked texts beside the article.
PRIOR = np.array([-0.2, 2.0, -4.0, 1.0, 0.5, 0.7, -6.0, -6.0, 1.0])
PRECISION = np.array([1000.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0])
#: Words from which on a block counts as long.
LONG = 30
#: Pages learnt from, and blocks of one of them, at most.
MOST_PAGES, MOST_BLOCKS = 400, 256
#: Capacity between neighbours, and between followers under one parent, the first divided by the steps in the tree.
ADJACENT, PROXIMATE = 1.5, 1.0

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_OPENS_ARTICLE = re.compile(r"<(/?)(?:article|main)(?=[\s/>])", re.I)


class Block:
    __slots__ = ("links", "parent", "path", "text", "words")


class Element:
    __slots__ = ("article", "depth", "good", "marked", "name", "parent", "root", "section", "skip", "words")

    def __init__(self, name: str, parent: Element | None, attributes: str):
        self.name, self.parent = name, parent
        self.depth = parent.depth + 1 if parent else 0
        self.skip = parent.skip if parent else False
        self.article = parent.article if parent else False
        self.root = parent.root if parent else None
        self.words = 0
        #: Class and id words of its own that mark it, and whether some name an article.
        self.marked: frozenset[str] = frozenset()
        self.good = False
        if name in ("article", "main"):
            self.article = True
        self.section = name in SECTIONS or (name == "header" and not self.article)
        if name in RAW:
            self.skip = True
        if "=" in attributes or "hidden" in attributes:
            for key, a, b, c in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), a or b or c
                if key in ("class", "id"):
                    value = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()
                    words = frozenset(value.split() if name in RUNNING else _WORDS.findall(value))
                    self.marked |= words & (BOILERPLATE if name not in ("body", "html", "article", "main") else APART)
                    self.good = self.good or (bool(words & ARTICLE) and name not in ("body", "html"))
                elif key == "role":
                    self.section = self.section or value.lower() in ROLES
                    self.article = self.article or value.lower() in ("main", "article")
                elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDDEN.search(value.lower())):
                    self.skip = True
        outermost = self.article and not parent.article
        if not self.marked and (outermost or (self.good and not self.root)):
            self.root = self


def _around(element: Element | None) -> Iterator[Element]:
    """The element and those around it."""
    while element:
        yield element
        element = element.parent


def _wrappers(blocks: list[Block], elements: list[Element]) -> set[Element]:
    """The elements whose sections, class and id words are no evidence."""
    for e in elements:
        e.words = 0
    for b in blocks:
        b.path.words += b.words
    for e in reversed(elements):  # children come after their parents
        if e.parent:
            e.parent.words += e.words
    apart: dict[Element, bool] = {}  # whether it or an element around it is marked or a section
    for e in elements:
        apart[e] = bool(e.marked) or e.section or (e.parent is not None and apart[e.parent])
    out: set[Element] = set()
    roots = [e for e in elements if e.root is e and e.words]
    if roots:
        # an unmarked one is the article unless one inside marked elements is over four times as long
        root = max(roots, key=lambda e: (e.article, e.words * (1 if apart[e] else 4)))
        out |= set(_around(root))
        out |= {e for e in elements if e.root is root and 4 * e.words > 3 * root.words and not e.marked & APART}
    else:
        inner = [b for b in blocks if not any(e.section for e in _around(b.path))] if any(e.section for e in elements) else blocks
        if inner:
            common = inner[0].parent
            for b in inner[1:]:
                common = _shared(common, b.parent)
            out |= set(_around(common)) - {b.parent for b in inner}
    return out


def _shared(a: Element, b: Element) -> Element:
    """The nearest element around both."""
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return a


def blocks_of(page: str) -> tuple[list[Block], list[Element]]:
    """The blocks of a page in order, without scripts, styles and hidden elements; and all its elements."""
    out: list[Block] = []
    here = Element("", None, "")
    elements = [here]
    open_names: Counter[str] = Counter()
    parts: list[str] = []
    linked = 0
    in_link = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split()) if len(parts) > 1 or "&" in parts[0] else " ".join(parts[0].split())
            parts.clear()
            if text:
                block = Block()
                block.text, block.links, block.path, block.words = text, min(1.0, linked / len(text)), here, text.count(" ") + 1
                out.append(block)
        linked = 0

    def leave(outer: Element) -> None:
        """Close all open elements inside outer."""
        nonlocal here
        while here is not outer:
            open_names[here.name] -= 1
            here = here.parent

    at = 0
    while True:
        tag = _TOKEN.search(page, at)
        end = tag.start() if tag else len(page)
        if end > at and not here.skip:
            parts.append(page[at:end])
            if in_link:
                linked += end - at
        if not tag:
            break
        at = tag.end()
        name = tag[2]
        if not name:
            if page.startswith("<![CDATA[", end) and not here.skip:
                parts.append(html.escape(page[end + 9 : at].removesuffix("]]>")))
            continue
        name = name.lower()
        if tag[1]:
            if name in BLOCK:
                flush()
            if open_names[name]:
                element = here
                while element.name != name:
                    element = element.parent
                leave(element.parent)
            if name == "a":
                in_link = 0
            continue
        if name in BLOCK:
            flush()
            if open_names["p"]:
                element = here
                while element.parent and element.name not in _SCOPE and element.name != "p":
                    element = element.parent
                if element.name == "p":
                    leave(element.parent)
        if open_names["head"] and (name == "body" or (name in BLOCK and here.name == "head")):
            while here.name == "head":
                leave(here.parent)
        if name in CLOSES and any(open_names[x] for x in CLOSES[name]):
            element, last = here, None
            while element.parent and element.name not in _SCOPE:
                if element.name in CLOSES[name]:
                    last = element
                element = element.parent
            if last:
                leave(last.parent)
        if name == "br":
            if not here.skip:
                parts.append(" ")
            continue
        if name in VOID:
            continue
        if name in _CDATA:
            close = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if tag[3].endswith("/>") and name not in BLOCK and not (name == "a" and "href" in tag[3]):
            continue
        here = Element(name, here, tag[3])
        elements.append(here)
        open_names[name] += 1
        if name == "a":
            in_link = 1
    flush()
    _set_parents(out, elements)
    return out, elements


def _set_parents(blocks: list[Block], elements: list[Element]) -> None:
    """A block's parent is the element around its own block-level one, or this itself where it holds other blocks too."""
    inside = Counter(b.path for b in blocks)
    for e in reversed(elements):  # children come after their parents
        if e.parent:
            inside[e.parent] += inside[e]
    for b in blocks:
        top = b.path
        while top.parent and top.name not in BLOCK:
            top = top.parent
        b.parent = top.parent if top.parent and inside[top] == 1 else top


def features(blocks: list[Block], elements: list[Element]) -> np.ndarray:
    """A row of FEATURES for each block."""
    wrappers = _wrappers(blocks, elements) if any(e.marked or e.section for e in elements) else set()
    known: dict[Element, tuple[bool, bool, bool]] = {}
    for e in elements:
        section, marked, good = known[e.parent] if e.parent else (False, False, False)
        evident = e not in wrappers
        known[e] = (section or (e.section and evident), marked or (bool(e.marked) and evident), good or e.good)
    out = np.zeros((len(blocks), len(FEATURES)))
    for row, b in zip(out, blocks, strict=True):
        tag = next((e.name for e in _around(b.path) if e.name in BLOCK or e.name == "math"), "")
        row[:] = (1, min(1.0, b.words / LONG), b.links, tag in PARAGRAPH, tag in HEADING, b.text[-1] in ".!?。！？…:;\"”»'’)", *known[b.path])
    return out


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the greatest posterior: Newton's steps on the logistic loss and the Gaussian prior."""
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        gradient = x.T @ (p - y) + PRECISION * (w - PRIOR)
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(PRECISION), gradient)
        w -= step * min(1.0, 5.0 / np.abs(step).max(initial=1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def examples(page: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a page's blocks, at most MOST_BLOCKS of them at even steps; none if the page has not both
    labels. The features are those of the page with its article and main elements read as div."""
    blocks, _ = blocks_of(page)
    hidden, elements = blocks_of(_OPENS_ARTICLE.sub(r"<\1div", page))
    labels = np.array([b.path.article for b in blocks], dtype=float)
    if [b.text for b in blocks] != [b.text for b in hidden] or labels.all() or not labels.any():
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    some = slice(None, None, -(-len(blocks) // MOST_BLOCKS))
    return features(hidden, elements)[some], labels[some]


def train(pages: DataFrame, html_col: str = "html", most_pages: int = MOST_PAGES) -> np.ndarray:
    """Weights learnt on the most_pages marked pages of least hash (copies count once)."""
    text = F.col(f"`{html_col}`")
    marked = pages.where(text.rlike(r"(?i)<(article|main)[\s/>]")).select(F.xxhash64(text).alias("hash"), text.alias("html"))
    least = marked.select("hash").distinct().orderBy("hash").limit(most_pages).agg(F.max("hash").alias("most")).first()["most"]
    if least is None:
        return PRIOR.copy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for h, page in zip(batch.column("hash").to_pylist(), batch.column("html").to_pylist(), strict=True):
                if h not in seen:
                    seen.add(h)
                    x, y = examples(page)
                    yield pa.RecordBatch.from_arrays([pa.array([h]), pa.array([x.ravel().tolist()], pa.list_(pa.float64())), pa.array([y.tolist()], pa.list_(pa.float64()))], names=["hash", "x", "y"])

    rows = marked.where(F.col("hash") <= least).mapInArrow(run, "hash long, x array<double>, y array<double>").dropDuplicates(["hash"]).orderBy("hash").collect()
    x = np.concatenate([np.zeros((0, len(FEATURES))), *(np.reshape(r["x"], (-1, len(FEATURES))) for r in rows)])
    return fit(x, np.concatenate([np.zeros(0), *(np.array(r["y"]) for r in rows)]))


def _steps(a: Element, b: Element) -> int:
    """Edges of the tree between two elements."""
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


class Cut:
    """Maximum flow by levels (Dinic) between a source and a sink; then the source's side of the minimum cut."""

    def __init__(self, n: int):
        self.source, self.sink = n, n + 1
        self.edges: list[list[int]] = [[] for _ in range(n + 2)]
        self.to: list[int] = []
        self.room: list[float] = []

    def join(self, a: int, b: int, there: float, back: float) -> None:
        self.edges[a].append(len(self.to))
        self.edges[b].append(len(self.to) + 1)
        self.to += (b, a)
        self.room += (there, back)

    def _levels(self) -> list[int]:
        level = [-1] * len(self.edges)
        level[self.source] = 0
        queue = deque([self.source])
        to, room = self.to, self.room
        while queue:
            a = queue.popleft()
            for e in self.edges[a]:
                b = to[e]
                if level[b] < 0 and room[e] > 1e-9:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    def source_side(self) -> list[bool]:
        to, room, edges, sink = self.to, self.room, self.edges, self.sink
        while True:
            level = self._levels()
            if level[sink] < 0:
                return [x >= 0 for x in level[:-2]]
            after = [0] * len(edges)
            path: list[int] = []
            a = self.source
            while True:
                if a == sink:
                    flow = min(room[e] for e in path)
                    cut = 0
                    for k in range(len(path) - 1, -1, -1):
                        room[path[k]] -= flow
                        room[path[k] ^ 1] += flow
                        if room[path[k]] <= 1e-9:
                            cut = k
                    a = to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                while after[a] < len(edges[a]):
                    e = edges[a][after[a]]
                    if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                        break
                    after[a] += 1
                else:
                    if not path:
                        break
                    a = to[path.pop() ^ 1]
                    after[a] += 1
                    continue
                path.append(e)
                a = to[e]


def labels(blocks: list[Block], odds: list[float]) -> list[bool]:
    """Which blocks are content, by the minimum cut."""
    cut = Cut(len(blocks))
    before: dict[int, int] = {}
    for i, (block, score) in enumerate(zip(blocks, odds, strict=True)):
        if score > 0:
            cut.join(cut.source, i, score, 0.0)
        else:
            cut.join(i, cut.sink, -score, 0.0)
        if i:
            room = ADJACENT / (1 + _steps(blocks[i - 1].parent, block.parent))
            cut.join(i - 1, i, room, room)
        j = before.get(id(block.parent))
        if j is not None and j < i - 1:
            cut.join(j, i, PROXIMATE, PROXIMATE)
        before[id(block.parent)] = i
    return cut.source_side()


def content(page: str, weights: np.ndarray = PRIOR) -> str:
    """The main text of a page."""
    blocks, elements = blocks_of(page)
    if not blocks:
        return ""
    odds = (features(blocks, elements) @ weights).tolist()
    return "\n".join(b.text for b, kept in zip(blocks, labels(blocks, odds), strict=True) if kept)


def extract(pages: DataFrame, html_col: str = "html", carry: list[str] | None = None, weights: np.ndarray | None = None) -> DataFrame:
    """``row`` (a struct of the carried columns, all by default), text and n_chars. weights: those of train; by default
    they are learnt on pages."""
    weights = train(pages, html_col) if weights is None else weights
    row = whole_row(pages.select(*[F.col(f"`{c}`") for c in carry])) if carry else whole_row(pages)
    rows = pages.select(row.alias("row"), F.col(f"`{html_col}`").alias("html"))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [content(p, weights) if p else "" for p in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["row", "text", "n_chars"])

    return map_texts(rows, kernel, StructType([rows.schema["row"], StructField("text", StringType()), StructField("n_chars", LongType())]), "html")
