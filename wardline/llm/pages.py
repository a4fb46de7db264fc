"""Main text of web pages by boosted trees over DOM nodes.

A page is read into its element tree.  Every element gets features: how much text
its subtree holds per tag and how much of that stands in links, what its and its
ancestors' attributes say, its depth, its place among its siblings.  Gradient
boosted trees turn them into a score for belonging to the article.  Pages that
mark their article teach the trees; half of the teaching rows have the marks
hidden, so that unmarked pages are told by the rest.  Tags that never hold the
article (nav, form and the like) set aside for good; words of attributes are a
prior, high for names made of certain words only and outside a marked article,
that the trees can overrule.  The choice over a page is
made for the whole tree at once: an element can only be kept in a kept parent,
and the choice with the highest total is taken.

The trees are fitted on a sample of about ``SAMPLE_PAGES`` pages and at most
``SAMPLE_NODES`` elements, chosen by hash; every page is extracted whole.

Defined results: null and empty pages, and pages without an article, give an
empty text; broken markup is read as far as it goes, without an error; equal
pages give equal texts; without marked pages the scores come from tags and
attribute words alone; other columns pass through.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.text import slices

#: Bounds of the sample that the trees are fitted on.
SAMPLE_PAGES, SAMPLE_NODES = 1500, 60_000

#: Trees, their depth, shrinkage, penalty, and bins per feature.
TREES, DEPTH, RATE, PENALTY, BINS = 40, 4, 0.2, 1.0, 32

#: Share of a page's text that attribute words alone cannot set aside; highest score of what tags mark as aside;
#: log odds that a certain word takes off besides what any word does.
WRAPPER, SET_ASIDE, CERTAIN = 0.6, -3.0, 9.0

# Elements by what HTML makes of them ...
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template svg iframe canvas title textarea".split())
TO_THE_END = set("script style".split())  # without an end tag these run to the end of the page
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr object".split())
INLINE |= set(
    "math mrow mi mo mn ms mtext mspace msub msup msubsup mfrac msqrt mroot mover munder munderover mmultiscripts mprescripts "
    "mtable mtr mtd mstyle mpadded mphantom menclose merror maction semantics annotation annotation-xml".split()
)
CLOSES = {
    "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"},
    "dd": {"dt", "dd"}, "option": {"option"}, "body": {"head"},
}
SCOPES = set("table ul ol dl div section article main body html nav header footer aside form select".split())
# ... what elements mean for the main text, and words of attributes that tell the same.
MAIN = set("article main".split())
ASIDE = set("nav header footer aside form head menu button select dialog fieldset".split())
MAIN_WORDS = set("article content main post entry story body text maintext articlebody".split())
ASIDE_WORDS = set(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments reply replies consent cookie cookies "
    "disclaimer footer form header login masthead menu modal nav navbar navigation newsletter notice notices pagination "
    "popup privacy promo promoted recommended related respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe tags toolbar topbar widget complementary contentinfo alert".split()
)
#: Words of these that an article's own parts are named by too: a prior only.  And words that turn the next one around.
DOUBTFUL = set(
    "alert banner consent disclaimer form header login notice notices privacy recommended related replies reply respond "
    "search share sharing social tags widget".split()
)
CERTAIN_WORDS = ASIDE_WORDS - DOUBTFUL
#: Words that say where or how something stands, not what it is: a certain word beside these and its like stays certain.
PLACING = set(
    "area block body bottom box center col column container content group inner item items left line link links list "
    "main outer panel primary right row secondary section side site slot text thread top unit wrap wrapper".split()
)
TURNING = set("no non without has with".split())

_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>?", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")

#: What is known of each element while a page is read.
FIELDS = "parent end depth kind inside sibling own links marks tags heading".split()
FEATURES = [
    "depth", "own", "text", "tags", "density", "link_share", "marks_share", "page_share", "start", "end",
    "sibling", "siblings", "sibling_share", "children", "text_per_child", "heading", "paragraph", "list", "inline",
    "kind", "inside", "parent_kind", "parent_density",
]
#: Features that semantic marks show in.
MARKED = [FEATURES.index(n) for n in ("kind", "inside", "parent_kind")]


class Page:
    """Elements of a page in document order, and its runs of text with element and block."""

    def __init__(self, source: str):
        self.parent, self.end, self.depth, self.names = [-1], [0], [0], ["#"]
        self.kind, self.inside, self.sibling, self.children = [0], [0], [0], [0]
        self.own, self.links, self.marks = [0], [0], [0]
        self.runs: list[tuple[int, int, str]] = []
        self._block = 0
        #: Whether words set an element aside and no tag does (1 doubtful, 2 certain ones, or any outside a marked article),
        #: whether it is inside an article's tag, whether a tag sets it aside; and whether its own words are certain.
        self.by_words, self.in_main, self.barred, self.certain = [0], [False], [False], [False]
        self._read(source)
        self._settle()

    def _open(self, name: str, attributes: str, stack: list[int]) -> int:
        above, node = stack[-1], len(self.parent)
        words, certain = set(), False
        for m in _ATTRIBUTE.finditer(attributes):
            for name_given in (m[2] or m[3] or m[4] or "").split():
                found = [w.lower() for w in _WORD.findall(name_given)]
                told = {w for before, w in zip(["", *found], found, strict=False) if before not in TURNING}
                words |= told
                certain |= not CERTAIN_WORDS.isdisjoint(told) and told <= ASIDE_WORDS | PLACING
        kind = (name in MAIN) - (name in ASIDE) * 2
        if words and not kind:
            kind = -1 if not ASIDE_WORDS.isdisjoint(words) else (1 if not MAIN_WORDS.isdisjoint(words) else 0)
        self.parent.append(above)
        self.end.append(node + 1)
        self.depth.append(len(stack))
        self.names.append(name)
        self.kind.append(kind)
        self.certain.append(certain)
        self.inside.append(0)
        self.sibling.append(self.children[above])
        self.children[above] += 1
        self.children.append(0)
        for values in (self.own, self.links, self.marks):
            values.append(0)
        return node

    def _text(self, text: str, stack: list[int]) -> None:
        if text.isspace():
            if self.runs and self.runs[-1][1] == self._block:
                self.runs.append((stack[-1], self._block, " "))
            return
        text, node = html.unescape(text), stack[-1]
        self.own[node] += len(text)
        if any(self.names[i] == "a" for i in stack[-4:]):
            self.links[node] += len(text)
        self.marks[node] += text.count(".") + text.count(",")
        self.runs.append((node, self._block, text))

    def _close(self, stack: list[int], to: int) -> None:
        while len(stack) > to:
            self.end[stack.pop()] = len(self.parent)

    def _read(self, source: str) -> None:
        stack, at, unclosed = [0], 0, set()
        size = len(source)
        while at < size:
            tag = _TAG.search(source, at)
            if tag is None:
                self._text(source[at:], stack)
                break
            if tag.start() > at:
                self._text(source[at : tag.start()], stack)
            at, name = tag.end(), (tag[2] or "").lower()
            if not name:
                continue
            if name not in INLINE and name not in RAW:
                self._block += 1
            if tag[1]:
                place = next((i for i in range(len(stack) - 1, 0, -1) if self.names[stack[i]] == name), 0)
                if place:
                    self._close(stack, place)
                continue
            if name in RAW:
                if not tag[3].endswith("/") and name not in unclosed:
                    over = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                    if over:
                        at = over.end()
                    elif name in TO_THE_END:
                        at = size
                    else:
                        unclosed.add(name)  # what it holds is read as part of the page
                continue
            if name == "br":
                self._text(" ", stack)
            if name in VOID:
                continue
            closed = CLOSES.get(name, set())
            if name not in INLINE:
                closed = closed | {"p"}  # a block ends an open paragraph
            for i in range(len(stack) - 1, 0, -1):
                if self.names[stack[i]] in closed:
                    self._close(stack, i)
                    break
                if self.names[stack[i]] in SCOPES:
                    break
            stack.append(self._open(name, tag[3], stack))
        self._close(stack, 0)

    def _settle(self) -> None:
        """What stands inside which marks; a word that would set most of the page aside is not believed."""
        total = np.concatenate([[0], np.cumsum(self.own)])
        for node in range(1, len(self.parent)):
            above = self.inside[self.parent[node]]
            if self.kind[node] == -1 and total[self.end[node]] - total[node] > WRAPPER * total[-1]:
                self.kind[node] = 0
            if self.names[node] == "header" and above > 0:
                self.kind[node] = 0  # an article's own heading
            kind = self.kind[node]
            self.inside[node] = -1 if kind < 0 or above < 0 else max(above, kind)
            up = self.parent[node]
            self.barred.append(kind == -2 or self.barred[up])
            told = (1 + self.certain[node]) * (kind == -1)
            self.by_words.append(0 if self.barred[node] else max(told, self.by_words[up]))
            self.in_main.append(self.names[node] in MAIN or self.in_main[up])
        if any(self.in_main):
            self.by_words = [b if m or not b else 2 for b, m in zip(self.by_words, self.in_main, strict=True)]

    def text(self, kept: np.ndarray) -> str:
        """The kept elements' text: white space as one space, blocks as lines."""
        blocks: dict[int, list[str]] = {}
        for node, block, text in self.runs:
            if kept[node]:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n".join(line for line in lines if line)


_PARAGRAPHS, _LISTS = set("p blockquote pre".split()), set("ul ol li dl dt dd table tr td th tbody thead".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())


def features(page: Page) -> np.ndarray:
    """A row of features per element."""
    n = len(page.parent)
    parent, end, kind = (np.array(v) for v in (page.parent, page.end, page.kind))
    above = np.maximum(parent, 0)
    whole = lambda values: (c := np.concatenate([[0.0], np.cumsum(values)]))[end] - c[np.arange(n)]
    text, links, marks = whole(page.own), whole(page.links), whole(page.marks)
    tags = (end - np.arange(n)).astype(float)
    children = np.array(page.children, dtype=float)
    place = np.cumsum(page.own) / max(1, sum(page.own))
    density = text / tags
    names = page.names
    columns = [
        np.array(page.depth), np.log1p(page.own), np.log1p(text), np.log1p(tags), np.log1p(density),
        links / np.maximum(text, 1), marks / np.maximum(text, 1), text / max(1.0, text[0]), place, place[end - 1],
        np.array(page.sibling), children[above], text / np.maximum(text[above], 1), children, np.log1p(text / np.maximum(children, 1)),
        [x in _HEADINGS for x in names], [x in _PARAGRAPHS for x in names], [x in _LISTS for x in names], [x in INLINE for x in names],
        kind, np.array(page.inside), kind[above], np.log1p(density[above]),
    ]
    return np.column_stack(columns).astype(np.float32)


def prior(x: np.ndarray) -> np.ndarray:
    """What tags and attribute words say by themselves, as log odds."""
    kind, inside = x[:, MARKED[0]], x[:, MARKED[1]]
    return np.where(inside < 0, -3.0, np.where(inside > 0, 2.0, np.where(kind < 0, -3.0, -0.5)))


class Trees:
    """Gradient boosted trees for a yes or no, on binned features, each of full depth."""

    def __init__(self, edges: np.ndarray):
        self.edges, self.features, self.cuts, self.leaves = edges, [], [], []

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]).astype(np.uint8)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, base: np.ndarray) -> Trees:
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        model = cls(np.quantile(x, quantiles, axis=0).T if len(x) else np.zeros((x.shape[1], BINS - 1)))
        binned, margin = model._binned(x), base.copy()
        for _ in range(TREES if len(x) else 0):
            chance = 1 / (1 + np.exp(-margin))
            slope, bend = y - chance, np.maximum(chance * (1 - chance), 1e-6)
            node, feature, cut = np.zeros(len(x), dtype=np.int64), [], []
            for depth in range(DEPTH):
                width = 1 << depth
                gains, cuts = [], []
                for j in range(x.shape[1]):
                    at = node * BINS + binned[:, j]
                    g, h = (np.bincount(at, w, width * BINS).reshape(width, BINS).cumsum(axis=1) for w in (slope, bend))
                    left = g[:, :-1] ** 2 / (h[:, :-1] + PENALTY)
                    right = (g[:, -1:] - g[:, :-1]) ** 2 / (h[:, -1:] - h[:, :-1] + PENALTY)
                    gain = left + right - g[:, -1:] ** 2 / (h[:, -1:] + PENALTY)
                    gains.append(gain.max(axis=1))
                    cuts.append(gain.argmax(axis=1))
                best = np.argmax(gains, axis=0)
                feature.append(best)
                cut.append(np.array(cuts)[best, np.arange(width)])
                node = node * 2 + (binned[np.arange(len(x)), best[node]] > cut[-1][node])
            g, h = (np.bincount(node, w, 1 << DEPTH) for w in (slope, bend))
            leaf = RATE * g / (h + PENALTY)
            margin += leaf[node]
            model.features.append(feature)
            model.cuts.append(cut)
            model.leaves.append(leaf)
        return model

    def margin(self, x: np.ndarray, base: np.ndarray) -> np.ndarray:
        binned, rows, out = self._binned(x), np.arange(len(x)), base.astype(float)
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for f, c in zip(feature, cut, strict=True):
                node = node * 2 + (binned[rows, f[node]] > c[node])
            out += leaf[node]
        return out


def choose(page: Page, margin: np.ndarray) -> np.ndarray:
    """The best choice over the tree in which every kept element has a kept parent.

    What tags mark as standing aside is not scored above ``SET_ASIDE``.
    """
    n = len(page.parent)
    margin = np.where(np.array(page.barred), np.minimum(margin, SET_ASIDE), margin)
    gain = margin * np.log1p(page.own)
    drop = np.concatenate([[0.0], np.cumsum(gain)])
    keep = gain.copy()
    for node in range(n - 1, 0, -1):  # children stand after their parents
        lost = -(drop[page.end[node]] - drop[node])
        keep[page.parent[node]] += max(keep[node], lost)
    kept = np.zeros(n, dtype=bool)
    kept[0] = True
    for node in range(1, n):
        kept[node] = kept[page.parent[node]] and keep[node] > -(drop[page.end[node]] - drop[node])
    return kept


def scores(model: Trees, x: np.ndarray, by_words: np.ndarray) -> np.ndarray:
    """Log odds of elements; where words set aside they are a prior, and the trees judge by the rest."""
    seen = x.copy()
    seen[np.ix_(by_words > 0, MARKED)] = 0
    return model.margin(seen, prior(x) - CERTAIN * (by_words == 2))


def _taught(page: Page) -> tuple[np.ndarray, np.ndarray] | None:
    """Labels of a page that marks its article: inside it and not aside, or around it; and which of them are sure.

    What doubtful words set aside within an article may be part of it or not, and teaches nothing.
    """
    inside = np.array(page.inside) > 0
    marked = [i for i, name in enumerate(page.names) if name in MAIN and page.inside[i] > 0]
    if not marked:
        return None
    for node in marked:
        while node >= 0 and not inside[node]:
            inside[node], node = True, page.parent[node]
        up = page.parent[marked[0]]
        while up >= 0:
            inside[up], up = True, page.parent[up]
    return inside, ~((np.array(page.by_words) == 1) & np.array(page.in_main))


def train(pages: DataFrame, column: str = "html") -> Trees:
    """Fit the trees on a bounded, hash-chosen sample of pages and their elements."""
    # One different page in so many, by hash: copies do not thin out the sample.
    share = max(1, (pages.agg(F.approx_count_distinct(F.xxhash64(column))).first()[0] or 0) // SAMPLE_PAGES)
    sample = (
        pages.select(F.col(column).alias("html"))
        .where("html IS NOT NULL")
        .where(F.pmod(F.xxhash64("html"), F.lit(share)) == 0)
        .dropDuplicates()
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            for source in batch.column("html").to_pylist():
                page = Page(source)
                taught = _taught(page)
                if taught is None:
                    continue
                labels, sure = taught
                x, labels = features(page)[sure], labels[sure]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.tobytes() for r in x], pa.binary()), pa.array(labels)], names=["x", "y"]
                )

    nodes = sample.mapInArrow(rows, "x binary, y boolean").orderBy(F.xxhash64("x")).limit(SAMPLE_NODES).toArrow()
    wide = len(FEATURES)
    x = np.frombuffer(b"".join(nodes["x"].to_pylist()), dtype=np.float32).reshape(-1, wide)
    y = nodes["y"].to_numpy(zero_copy_only=False).astype(float)
    hidden = x.copy()
    hidden[:, MARKED] = 0
    both = np.concatenate([x, hidden])
    return Trees.fit(both, np.concatenate([y, y]), prior(both))


def extract(pages: DataFrame, model: Trees, column: str = "html") -> DataFrame:
    """``pages`` with the main ``text`` in place of their source."""
    others = [c for c in pages.columns if c not in (column, "text")]
    schema = pages.select(*others).schema.add("text", "string")
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            read = [Page(source or "") for source in batch.column(column).to_pylist()]
            tables = [features(page) for page in read]
            x = np.concatenate(tables)
            by_words = np.concatenate([page.by_words for page in read])
            margins = np.split(scores(shared.value, x, by_words), np.cumsum([len(t) for t in tables])[:-1])
            texts = [page.text(choose(page, margin)) for page, margin in zip(read, margins, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(texts, pa.string())], names=[*others, "text"]
            )

    return pages.select(*others, column).mapInArrow(run, schema)


def op6_main_text(spark, sf_dir: str) -> DataFrame:
    """The article text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = extract(pages, train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
