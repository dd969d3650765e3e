"""Main text of web pages: flat text blocks, judged by a decision tree on word counts and link densities of a block and its neighbours."""

import bisect
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import text_of
from lawloom.llm.page_layouts import LAYOUTS, fill

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Elements that begin and end a block; of their open ones a stack is kept.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Their content is no markup: it ends at their own end tag.
RAW = {n: re.compile(rf"</{n}(?=[\s/>]|\Z)", re.I) for n in "script style title textarea iframe noembed noframes xmp".split()}
#: What they hold is never shown as text of the page.
UNSEEN = frozenset("noscript template svg select button object audio video canvas datalist".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An element's start closes an open one of these, unless one of the others was opened since.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
#: Names of classes, ids and roles whose elements are no part of an article.
ASIDE_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising alert alertdialog banner breadcrumb breadcrumbs byline comment comments commentlist complementary consent "
    "contentinfo cookie cookies copyright dialog disqus foot footer gdpr header legal login masthead menu menubar meta modal nav navbar navigation newsletter "
    "notice pager pagination paywall popup promo promotion recommended related respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "tags teaser toolbar topbar trending widget".split()
)
MAIN_WORDS = frozenset("article content entry main post story".split())
_WEAK, _STRONG, _MAIN, _UNSEEN = 1, 2, 4, 8


def _own_flags(tag: str, attributes: str, inherited: int) -> int:
    """What an element adds: weakly aside (form, header), aside, main text, unseen."""
    flags = inherited
    if tag in ("article", "main"):
        flags = (flags | _MAIN) & ~_WEAK
    elif tag in ("nav", "aside", "footer", "dialog", "menu", "search"):
        flags |= _STRONG
    elif tag == "form" or tag == "header" and not flags & _MAIN:
        flags |= _WEAK
    if tag in UNSEEN:
        flags |= _UNSEEN
    if not attributes or attributes.isspace() or tag in ("body", "html"):
        return flags
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), entities.unescape((m[2] or "").strip("\"'"))
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            flags |= _UNSEEN
        elif name in ("class", "id", "role"):
            for part in value.split():
                words = [w.lower() for w in _NAME_WORD.findall(part)]
                if not words or words[0] in ("has", "no", "with", "without", "is"):
                    continue
                main = not MAIN_WORDS.isdisjoint(words)
                aside = ASIDE_WORDS.intersection(words) - ({"header", "foot", "footer"} if main and words[-1] == "header" else set())
                if aside and not (tag in ("article", "main") and words[0] != "comment"):
                    flags |= _STRONG
                elif main and tag not in ("a", "li"):
                    flags = (flags | _MAIN) & ~_WEAK
    return flags


@dataclass
class Block:
    text: str
    start: int
    link_words: int
    flags: int
    heading: bool
    item: bool
    words: int = field(init=False)

    def __post_init__(self):
        self.words = len(self.text.split(" "))


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page, in order: runs of text between the edges of block elements, white space made one space, references decoded."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []
    open_: Counter = Counter()
    parts: list[str] = []
    links: list[str] = []
    start, in_link = -1, False

    def flags() -> int:
        return stack[-1][1] if stack else 0

    def end_block() -> None:
        nonlocal start
        if parts:
            text = " ".join("".join(parts).split())
            if text and not flags() & _UNSEEN:
                out.append(Block(
                    text, start, len(" ".join(links).split()), flags(), any(t in HEADINGS for t, _ in stack[-2:]), bool(stack) and stack[-1][0] in ("li", "td", "th", "dt", "dd", "option"),
                ))
            parts.clear()
            links.clear()
        start = -1

    def pop_to(at: int) -> None:
        while len(stack) > at:
            open_[stack.pop()[0]] -= 1

    def add(piece: str, at: int) -> None:
        nonlocal start
        if not piece:
            return
        if "&" in piece:
            piece = entities.unescape(piece)
        if start < 0 and not piece.isspace():
            start = at
        parts.append(piece)
        if in_link:
            links.append(piece)

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        add(page[at : m.start() if m else len(page)], at)
        if not m:
            break
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW and not closing:
            ended = RAW[tag].search(page, at)
            at = ended.start() if ended else len(page)
        elif tag == "br":
            add(" ", m.start())
        elif tag == "a":
            in_link = not closing
            if in_link and not re.search(r"(?i)\bhref\b", attributes):
                in_link = False
        elif tag in BLOCKS or tag in UNSEEN:
            end_block()
            in_link = in_link and tag not in ("p", "li", "td", "th", "tr", "table", "ul", "ol")
            if closing:
                if open_[tag]:
                    k = len(stack) - 1
                    while stack[k][0] != tag and not (stack[k][0] in ("td", "th", "caption") and tag not in ("tr", "table", "tbody", "thead", "tfoot")):
                        k -= 1
                    if stack[k][0] == tag:
                        pop_to(k)
                continue
            if stack and stack[-1][0] == "p":
                pop_to(len(stack) - 1)
            if tag in CLOSES:
                closed, bounds = CLOSES[tag]
                if any(open_[c] for c in closed):
                    k = len(stack) - 1
                    while k >= 0 and stack[k][0] not in bounds:
                        if stack[k][0] in closed:
                            pop_to(k)
                        k -= 1
            if tag != "hr" and not attributes.endswith("/"):
                stack.append((tag, _own_flags(tag, attributes, flags())))
                open_[tag] += 1
    end_block()
    return out


_RIGHTS = re.compile(r"©|\(c\) ?[12][0-9]{3}|\bcopyright\b|all rights reserved", re.I)

#: aside: 0, 1 for forms and headers, 2 for what is never part of an article. marked: the page has a main element that holds text.
FEATURES = ["words", "density", "words_before", "density_before", "words_after", "density_after", "aside", "main", "marked", "heading", "item", "sentence", "rights"]


def features(blocks: list[Block]) -> np.ndarray:
    if not blocks:
        return np.empty((0, len(FEATURES)))
    words = np.array([b.words for b in blocks], float)
    density = np.array([min(1.0, b.link_words / b.words) for b in blocks])
    flags = np.array([b.flags for b in blocks])
    before, after = (lambda x: np.concatenate([[0.0], x[:-1]])), (lambda x: np.concatenate([x[1:], [0.0]]))
    strong, main = (flags & _STRONG) != 0, (flags & _MAIN) != 0
    weak, marked = ((flags & _WEAK) != 0) & ~strong, (main & ~strong).any()
    if not marked and words[weak].sum() > words[~strong].sum() / 2:  # a form around the page is no form of the page
        weak[:] = False
    aside = np.where(strong, 2, weak)
    return np.stack([
        words, density, before(words), before(density), after(words), after(density), aside, main, np.full(len(blocks), marked),
        [b.heading for b in blocks], [b.item for b in blocks], [b.text[-1] in ".!?。\"”»…" for b in blocks],
        [b.words < 40 and bool(_RIGHTS.search(b.text)) for b in blocks],
    ], 1).astype(float)


@dataclass
class Tree:
    """A binary decision tree as arrays: at a node go left when the feature is at most the threshold; a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    share: list[float] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        """Splits by the greatest fall of Gini impurity, down to `depth` levels and leaves of `least` rows; the number of the node made."""
        node = len(self.feature)
        for part, value in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.share, float(y.mean()))):
            part.append(value)
        best = (1e-9, -1, 0.0)
        if depth and 0 < y.mean() < 1:
            for f in range(x.shape[1]):
                order = np.argsort(x[:, f], kind="stable")
                values, own = x[order, f], y[order]
                n, ones = np.arange(1, len(y)), own.cumsum()[:-1]
                rest, more = len(y) - n, own.sum() - ones
                gain = y.mean() * (1 - y.mean()) - (ones * (n - ones) / n + more * (rest - more) / rest) / len(y)
                gain[(values[1:] == values[:-1]) | (n < least) | (rest < least)] = 0
                k = int(gain.argmax()) if len(gain) else 0
                if len(gain) and gain[k] > best[0]:
                    best = (float(gain[k]), f, float((values[k] + values[k + 1]) / 2))
        if best[1] >= 0:
            _, self.feature[node], self.threshold[node] = best
            low = x[:, best[1]] <= best[2]
            self.left[node] = self.fit(x[low], y[low], depth - 1, least)
            self.right[node] = self.fit(x[~low], y[~low], depth - 1, least)
        return node

    def holds(self, x: np.ndarray) -> np.ndarray:
        feature, threshold, left, right = (np.array(a) for a in (self.feature, self.threshold, self.left, self.right))
        node = np.zeros(len(x), int)
        while (inner := feature[node] >= 0).any():
            at = node[inner]
            low = x[inner, feature[at]] <= threshold[at]
            node[inner] = np.where(low, left[at], right[at])
        return np.array(self.share)[node] >= 0.5


def labelled_blocks(layouts: list[str], fills: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of each layout, filled `fills` times with seeded words."""
    xs, ys = [], []
    for n, layout in enumerate(layouts):
        for k in range(fills):
            page, lines = fill(layout, [seed, n, k])
            blocks = blocks_of(page)
            marks = [lines[bisect.bisect_right([a for a, _ in lines], b.start) - 1][1] for b in blocks]
            known = [m is not None for m in marks]
            xs.append(features(blocks)[known])
            ys += [m for m in marks if m is not None]
    return np.concatenate(xs), np.array(ys)


def learnt_tree(layouts: list[str] = LAYOUTS, fills: int = 24, depth: int = 9, least: int = 4, seed: int = 5) -> Tree:
    tree = Tree()
    tree.fit(*labelled_blocks(layouts, fills, seed), depth, least)
    return tree


def extracted(pages: list[str], tree: Tree) -> list[tuple[str, int, int]]:
    """Per page its main text, and the number of its blocks and of those kept."""
    blocks = [blocks_of(p) for p in pages]
    kept = tree.holds(np.concatenate([features(b) for b in blocks])) if blocks else np.empty(0, bool)
    out, at = [], 0
    for own in blocks:
        said = [b.text for b, k in zip(own, kept[at : at + len(own)]) if k]
        at += len(own)
        out.append(("\n\n".join(said), len(own), len(said)))
    return out


def main_texts(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", tree: Tree | None = None,
) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_kept): one row per row of pages; text is the kept blocks in order with an empty line between.

    The tree is learnt on the driver from the layouts, some 6,000 blocks, unless one is given; whole pages are read, block by block and each on
    its own, so the work needs no shuffle. NULL html is empty and, like a page without main text, gives an empty text. Repeated rows are
    read each; an empty table gives no rows; other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(tree or learnt_tree())  # a few hundred nodes
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_column, url_column)]

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.iloc[at : at + 64]
                found = pd.DataFrame(extracted(part["html"].tolist(), shared.value), columns=["text", "n_blocks", "n_kept"], index=part.index)
                found.insert(1, "n_chars", found["text"].map(len).astype("int64"))
                yield pd.concat([part[["page_id", "url"]], found], axis=1)

    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), text_of(html_column).alias("html"))
    return rows.mapInPandas(extract, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long, n_blocks long, n_kept long")
