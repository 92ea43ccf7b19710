"""Main text of web pages (11): maximum-scoring subsequence.

A page is read as a sequence of words and tags. A word scores the log odds of
main text given the elements that are open around it (their tags, and the
words of their class, id and role) and whether its block is mostly links; tags
score below zero, the less the surer the place is main text. One linear scan
finds the contiguous run of tokens with the greatest sum; its blocks are the
main text, without the words inside it whose own odds are against (an advert
between two paragraphs). All weights come from labelled pages
(``labelled_pages``) by logistic regression and counting.

Words whose odds are against are left out wherever they stand, so they and the
tags between them take nearly nothing from the sum: an article that a long
sidebar cuts in two stays one region.

Reading follows HTML's rules as far as text needs: comments, raw text of
scripts, styles and titles, character references, void elements, a paragraph that
ends where the next block begins, end tags that close what is open inside. Line
breaks and block elements end a block; a table row is a block, its cells are
apart by a space.

Defined cases: null html is empty; a page without main text has an empty text
of 0 characters; long pages are read whole, in one pass; repeated rows give
repeated results; of runs with equal sums the first counts; an empty table gives
an empty result; other columns than the three are ignored.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seqrisk.llm.common import by_value

by_value(__name__)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody
textarea tfoot thead title tr ul""".split())
APART = frozenset(["td", "th"])
NO_TEXT = frozenset(["script", "style"])
# Elements that only format say nothing about their text.
NEUTRAL = frozenset("""a abbr address b big blockquote body br caption center cite code col colgroup dd del details div dl dt em figcaption figure
font h1 h2 h3 h4 h5 h6 hgroup hr html i img ins kbd li mark ol p picture pre q s samp section small span strong sub summary sup table tbody td
tfoot th thead time tr tt u ul var""".split())
_SCOPE = frozenset("article aside body button dialog div fieldset footer form header li main nav object section table td th".split())
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_UNSEEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile("[a-z]+")
_JOINT = re.compile("([a-z])([A-Z])")
LINKS, IN_LINK = "block of links", "in a link"
LINK_SHARE = 0.6
LETTERS = 12                # a run of characters without a space counts one word for so many
LEAST, MOST, AGAINST = 0.05, 4.0, -0.001


@lru_cache(maxsize=1 << 14)
def element_features(tag: str, attributes: str, in_article: bool) -> tuple[str, ...]:
    """What an element says about the text in it."""
    named = [] if tag in NEUTRAL else [f"<{tag}> in an article" if in_article and tag in ("header", "footer") else f"<{tag}>"]
    if tag == "a":
        named.append(IN_LINK)
    if attributes and tag not in ("html", "body"):
        for m in _NAMED.finditer(attributes):
            value = _JOINT.sub(r"\1 \2", m[2] or m[3] or m[4] or "").lower()
            named += [w if len(w) < 4 or not w.endswith("s") else w[:-1] for w in _WORD.findall(value) if len(w) > 1]
        if _UNSEEN.search(attributes):
            named.append("hidden")
    return tuple(dict.fromkeys(named))


@dataclass
class Page:
    """Text pieces (text, place, block) and tags (place) of a page in order; a place is a set of features."""
    pieces: list[tuple[str, frozenset[str], int]] = field(default_factory=list)
    tokens: list[tuple[int, str, frozenset[str]]] = field(default_factory=list)     # (piece or -1, tag, place)


def parse(source: str) -> Page:
    page = Page()
    stack: list[tuple[str, frozenset[str]]] = [("", frozenset())]
    opened: Counter[str] = Counter()
    block = 0

    def text(raw: str) -> None:
        if raw:
            page.tokens.append((len(page.pieces), "", stack[-1][1]))
            page.pieces.append((references.unescape(raw), stack[-1][1], block))

    def close(tag: str) -> None:
        while stack[-1][0] != tag:
            opened[stack.pop()[0]] -= 1
        opened[stack.pop()[0]] -= 1

    at, n = 0, len(source)
    while at < n:
        m = _TAG.search(source, at)
        if not m:
            text(source[at:])
            break
        text(source[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, ending, attributes = tag.lower(), bool(m[1] or m[4]), (m[3] or m[6] or "").strip()
        if tag in BLOCK:
            block += 1
        if ending:
            if opened[tag]:
                close(tag)
            page.tokens.append((-1, "/" + tag, stack[-1][1]))
        else:
            if tag == "body" and opened["head"]:
                close("head")
            elif tag in BLOCK and tag != "br" and opened["p"]:
                for k in range(len(stack) - 1, 0, -1):          # a block ends the paragraph that is open in the same container
                    if stack[k][0] == "p":
                        while len(stack) > k:
                            opened[stack.pop()[0]] -= 1
                        break
                    if stack[k][0] in _SCOPE:
                        break
            if tag == "li" and stack[-1][0] == "li":
                close("li")
            place = stack[-1][1]
            page.tokens.append((-1, tag, place))
            if tag not in VOID and not attributes.endswith("/"):
                own = element_features(tag, attributes[:4096], opened["article"] > 0)
                stack.append((tag, place.union(own) if not place.issuperset(own) else place))
                opened[tag] += 1
                if tag in RAW:
                    end = _raw_end(tag).search(source, at)
                    stop = end.start() if end else n
                    if tag not in NO_TEXT:
                        text(source[at:stop])
                    at = stop
        if tag in APART:
            page.pieces.append((" ", stack[-1][1], block))
            page.tokens.append((len(page.pieces) - 1, "", stack[-1][1]))
    return page


@lru_cache(maxsize=None)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(f"</{tag}(?=[\\s/>])", re.I)


def _size(text: str) -> int:
    """Words of a piece; long runs of characters without a space count as several."""
    words = text.split()
    return len(words) if len(text) <= LETTERS * len(words) else sum(-(-len(w) // LETTERS) for w in words)


def link_blocks(page: Page, sizes: list[int]) -> set[int]:
    """Blocks most words of which are in links."""
    all_, linked = Counter(), Counter()
    for (_, place, block), size in zip(page.pieces, sizes):
        all_[block] += size
        if IN_LINK in place:
            linked[block] += size
    return {b for b, n in linked.items() if n and n >= LINK_SHARE * all_[b]}


@dataclass
class Model:
    """Log odds of main text (``bias`` and by feature) and what each tag costs."""
    bias: float
    weights: dict[str, float]
    costs: dict[str, float]

    def __post_init__(self) -> None:
        self._odds: dict[frozenset[str], float] = {}

    def burden(self, place: frozenset[str]) -> float:
        """What a block of links adds to the odds of its place."""
        return self.weights.get(_links(place), 0.0)

    def odds(self, place: frozenset[str]) -> float:
        z = self._odds.get(place)
        if z is None:
            if len(self._odds) > 1 << 16:
                self._odds.clear()
            z = self._odds[place] = self.bias + sum(self.weights.get(f, 0.0) for f in place)
        return z


def _links(place: frozenset[str]) -> str:
    """The feature of a block of links: within an article it may be a paragraph of the text."""
    return LINKS + " in an article" if "<article>" in place else LINKS


def _labelled_words(marked: str) -> tuple[Counter, Counter]:
    """Words by (their features, main text or not), and tags by (name, main text or not), of a labelled page."""
    words, tags = Counter(), Counter()
    page = parse(marked)
    sizes = [_size(t.replace("{+", "").replace("+}", "")) for t, _, _ in page.pieces]
    linked, inside = link_blocks(page, sizes), False
    for piece, tag, place in page.tokens:
        if piece < 0:
            tags[tag, inside] += 1
            continue
        text, _, block = page.pieces[piece]
        given = place | {_links(place)} if block in linked else place
        for part in re.split(r"(\{\+|\+\})", text):
            if part in ("{+", "+}"):
                inside = part == "{+"
            elif part.strip():
                words[given, inside] += _size(part)
    return words, tags


def fit(pages: Iterable[str], penalty: float = 0.1, steps: int = 60) -> Model:
    """Weights from labelled pages (a bounded number of small ones): logistic regression by Newton steps."""
    words, tags = Counter(), Counter()
    for marked in pages:
        w, t = _labelled_words(marked)
        words.update(w)
        tags.update(t)
    names = sorted({f for place, _ in words for f in place})
    column = {f: i + 1 for i, f in enumerate(names)}
    rows = sorted(words.items(), key=lambda r: (sorted(r[0][0]), r[0][1]))
    x = np.zeros((len(rows), len(names) + 1))
    x[:, 0] = 1
    for i, ((place, _), _) in enumerate(rows):
        for f in place:
            x[i, column[f]] = 1
    y, n = np.array([float(r[0][1]) for r in rows]), np.array([float(r[1]) for r in rows])
    w = np.zeros(len(names) + 1)
    ridge = np.full(len(w), penalty)
    for _ in range(steps if len(rows) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (n * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    costs = {t: float(np.clip(np.log((tags[t, False] + 1) / (tags[t, True] + 1)), 0.2, 3.0)) for t in {t for t, _ in tags}}
    return Model(float(w[0]), {f: float(w[column[f]]) for f in names}, costs)


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and last + 1 of the contiguous elements with the greatest sum above zero; (0, 0) if none is."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, found = total, (start, i + 1)
    return found


def main_text(source: str | None, model: Model) -> str:
    """The main text of a page, one block a line."""
    page = parse(source or "")
    sizes = [_size(t) for t, _, _ in page.pieces]
    linked = link_blocks(page, sizes)
    odds = [model.odds(place) + (model.burden(place) if block in linked else 0.0) for _, place, block in page.pieces]
    scores = []
    for piece, tag, place in page.tokens:
        if piece >= 0:
            scores.append(sizes[piece] * (min(max(odds[piece], LEAST), MOST) if odds[piece] > 0 else AGAINST))
        else:
            z = model.odds(place)
            scores.append(-model.costs.get(tag, 1.0) / (1 + math.exp(min(z - model.bias, 30.0))) - 1e-6 if z > 0 else AGAINST)
    first, last = best_region(scores)
    inside = {page.pieces[piece][2] for piece, _, _ in page.tokens[first:last] if piece >= 0 and odds[piece] > 0}
    lines: list[list[str]] = []
    now = -1
    for (text, _, block), z in zip(page.pieces, odds):
        if z > 0 and block in inside:
            if block != now:
                lines.append([])
                now = block
            lines[-1].append(text)
    joined = (" ".join("".join(parts).split()) for parts in lines)
    return "\n".join(line for line in joined if line)


def extract(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars of every page."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source.as_py(), model) for source in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                  names=[id_col, url_col, "text", "n_chars"])

    rows = pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`"), F.col(f"`{html_col}`").cast("string").alias("html"))
    kinds = [rows.schema[i].dataType.simpleString() for i in (0, 1)]
    return rows.mapInArrow(work, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars long")
