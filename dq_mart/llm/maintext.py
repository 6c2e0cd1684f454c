"""Main text of web pages by a conditional random field over DOM leaf blocks.

Method
------
A page is cut into its leaf blocks: the text between two boundaries of block
elements, with the elements that are open around it.  A block's features are
the tags of its ancestors and the words of their class, id and role names, its
own element, and its text's length, share of link text, punctuation and so on.
A two-label chain (main, not) over the blocks in page order is trained by
gradient ascent on the conditional likelihood of labelled pages; Viterbi picks
the labels of a page, and the main blocks, in page order, are its text.

Labelled pages are of two kinds: pages drawn from the templates of
``layouts`` and a sample of the table's own pages that mark their article up
themselves (``article`` or ``main``), which teach the field how blocks of that
table look.  In half of the latter the telling tags are hidden, so that it
learns to do without.  What must not be shown at all (scripts, styles, head,
comments of the markup, templates) is never a block.

Scale: fitting uses at most ``SAMPLE`` pages, turned into feature names in the
tasks; extraction is one pass over whole pages where they lie, with no shuffle.
A page's elements are read once; the features and score of a path of open
elements are kept, so deep nesting does not make its blocks dearer.

Defined results
---------------
* null or empty html, or a page without a main block: empty text;
* a very long page is read whole; markup that is never closed is closed by its
  parent's end or the page's;
* character references are decoded, white space inside a block (``br`` too) is
  one space, blocks are joined by one line feed; nothing else changes;
* null ids and repeated rows are pages like any other; of an id in the sample
  one page is learnt from;
* an empty table gives no rows, and the templates alone train the field; other
  columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_texts
from .layouts import training_pages
from .quality import Chains

#: Pages of the table that are learnt from, at most.
SAMPLE = 400
#: Pages drawn from the templates.
TEMPLATES = 1200
STEPS = 200
#: Training pages that must hold a feature.
LEAST_PAGES = 3
#: Paths of open elements that a worker remembers.
_MEMORY = 20_000

# Kinds of HTML elements.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol optgroup option p pre search section select summary table tbody td textarea "
    "tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template iframe noembed noframes title head svg math object".split())
RAW = frozenset("script style iframe noembed noframes title textarea xmp".split())
SCOPE = frozenset("table td th caption template html".split())
#: A start tag ends these open elements, up to the elements after the bar.
ENDS = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"),
    "option": ("option", "select"), "optgroup": ("option optgroup", "select"),
    "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tbody": ("tr td th thead tbody tfoot caption", "table"),
    "thead": ("tr td th thead tbody tfoot caption", "table"),
    "tfoot": ("tr td th thead tbody tfoot caption", "table"),
}
_ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
_ARTICLE = ("tag:article", "tag:main")
#: Tags that say themselves what they hold.
_TELLING = frozenset(f"tag:{t}" for t in "article main nav aside footer header form".split()) \
    | {"inner:header", "inner:footer"}

_MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))"""
    r"""|<[!?][^>]*(?:>|\Z)"""
    r"""|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"""
    r"""|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
    r"""|<(?P<start2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(
    r"""(?<![^\s"'/])(class|id|role|hidden|data-main)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?(?![\w-])""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORDS_OF_NAMES = re.compile(r"class|id|role|hidden|data-main", re.I)


@dataclass
class Path:
    """The open elements around a text, as the set of their features."""

    features: frozenset = frozenset()
    score: float = 0.0
    main: bool = False                  # marked so in a labelled page
    hidden: bool = False
    steps: dict = field(default_factory=dict)


def _own_features(tag: str, attrs: str, outer: frozenset) -> tuple[list[str], bool]:
    """What an element adds to the features of a path, and whether a labelled
    page marks it as main."""
    inner = tag in ("header", "footer") and any(a in outer for a in _ARTICLE)
    out, main = [f"inner:{tag}" if inner else f"tag:{tag}"], False
    if attrs and tag != "a" and _WORDS_OF_NAMES.search(attrs):
        for name, *values in _ATTRIBUTE.findall(attrs):
            name = name.lower()
            if name == "data-main":
                main = True
            elif name == "hidden":
                out.append("hidden")
            else:
                out += [f"name:{w.lower()}" for w in _NAME.findall("".join(values))]
    return out, main


def _bucket(x: float, bounds: tuple) -> int:
    return sum(x >= b for b in bounds)


def _text_features(text: str, linked: int, tag: str) -> list[str]:
    words = text.count(" ") + 1
    size = len(text)
    last = text[-1]
    out = [f"in:{tag}", f"words:{_bucket(words, (2, 3, 5, 8, 14, 25, 50))}",
           f"link:{_bucket(linked / size, (0.01, 0.3, 0.7, 0.95))}",
           "ends:stop" if last in ".!?:;…。" else "ends:word" if last.isalnum() else "ends:other",
           f"commas:{_bucket(text.count(','), (1, 3))}"]
    if text[0] == "©":
        out.append("copyright")
    if words <= 12:
        out.append(f"digits:{_bucket(sum(c.isdigit() for c in text) / size, (0.01, 0.2, 0.5))}")
    return out


class Reader:
    """Cuts pages into blocks; ``weights`` (feature -> weight) scores their paths."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights
        self.root, self.held = Path(), 0

    def _open(self, outer: Path, tag: str, attrs: str) -> Path:
        own, main = _own_features(tag, attrs, outer.features)
        if self.weights is not None:    # what the field has not learnt says nothing
            own = [f for f in own if f in self.weights or f in _ARTICLE]
        key = (tag in HIDDEN, main, *own)
        got = outer.steps.get(key)
        if got is None:
            if self.held >= _MEMORY:
                self.root.steps.clear()
                self.held = 0
            new = frozenset(own) - outer.features
            got = Path(outer.features | new if new else outer.features,
                       outer.score + sum(self.weights.get(f, 0.0) for f in new) if self.weights else 0.0,
                       outer.main or main, outer.hidden or tag in HIDDEN)
            outer.steps[key] = got
            self.held += 1
        return got

    def blocks(self, html: str) -> list[tuple[str, int, str, Path]]:
        """(text, characters of it in links, element, path) of each block."""
        out: list[tuple[str, int, str, Path]] = []
        tags, paths = [""], [self.root]
        open_: Counter = Counter()          # of each tag
        parts: list[str] = []
        linked = links = 0

        def end_block() -> None:
            nonlocal linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    block = next((t for t in reversed(tags) if t in BLOCK), "body")
                    out.append((text, min(linked, len(text)), block, paths[-1]))
                parts.clear()
            linked = 0

        def pop_to(size: int) -> None:
            nonlocal links
            if any(t in BLOCK for t in tags[size:]):
                end_block()
            links -= tags[size:].count("a")
            open_.subtract(tags[size:])
            del tags[size:], paths[size:]

        def text_of(piece: str) -> None:
            nonlocal linked
            if piece and not paths[-1].hidden:
                piece = unescape(piece) if "&" in piece else piece
                parts.append(piece)
                if links:
                    linked += len(piece.strip())

        at, size = 0, len(html)
        while at < size:
            m = _MARKUP.search(html, at)
            if m is None:
                text_of(html[at:])
                break
            text_of(html[at:m.start()])
            at = m.end()
            tag = m["end"]
            if tag is not None:
                tag = tag.lower()
                if tag in VOID:
                    if tag == "br":
                        parts.append(" ")
                    continue
                block = tag in BLOCK
                for k in range(len(tags) - 1, 0, -1) if open_[tag] else ():
                    if tags[k] == tag:
                        pop_to(k)
                        break
                    if tags[k] in SCOPE and tag not in SCOPE and tag not in ("tr", "tbody", "thead", "tfoot", "body") \
                            or not block and tags[k] in BLOCK:
                        break
                if block:
                    end_block()
                continue
            tag = m["start"] or m["start2"]
            if tag is None:
                continue
            tag, attrs = tag.lower(), m["attrs"] or m["attrs2"] or ""
            if tag in VOID:
                if tag == "br":
                    parts.append(" ")
                elif tag == "hr":
                    end_block()
                continue
            if tag in BLOCK:
                end_block()
                for k in range(len(tags) - 1, 0, -1) if open_["p"] else ():     # it ends
                    if tags[k] == "p":
                        pop_to(k)
                        break
                    if tags[k] in SCOPE or tags[k] == "button":
                        break
                if tag in _ENDS:
                    closed, stop = _ENDS[tag]
                    to = None
                    for k in range(len(tags) - 1, 0, -1) if any(open_[t] for t in closed) else ():
                        if tags[k] in stop:
                            break
                        if tags[k] in closed:
                            to = k
                    if to:
                        pop_to(to)
                elif tag == "body" and "head" in tags:
                    pop_to(tags.index("head"))
            elif tag == "a" and links:
                pop_to(len(tags) - 1 - tags[::-1].index("a"))
            if attrs.endswith("/") and tag in ("svg", "math"):
                continue
            tags.append(tag)
            open_[tag] += 1
            paths.append(self._open(paths[-1], tag, attrs))
            links += tag == "a"
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
                stop = close.start() if close else size
                text_of(html[at:stop])
                at = stop
        end_block()
        return out


@dataclass
class MainTextModel:
    weights: dict[str, float]
    bias: float
    move: np.ndarray                    # by label before and label, 1 is main
    reader: Reader | None = None

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "move": self.move, "reader": None}

    def labels(self, blocks: list[tuple[str, int, str, Path]]) -> list[bool]:
        """Viterbi: the likeliest labels of a page's blocks together."""
        if not blocks:
            return []
        get = self.weights.get
        (m00, m01), (m10, m11) = self.move.tolist()
        back: list[tuple[bool, bool]] = []
        s0 = s1 = 0.0
        for i, (text, linked, tag, path) in enumerate(blocks):
            e = self.bias + path.score
            for f in _text_features(text, linked, tag):
                e += get(f, 0.0)
            if i == 0:
                s0, s1 = 0.0, e
                continue
            back.append((s1 + m10 > s0 + m00, s1 + m11 >= s0 + m01))
            s0, s1 = max(s0 + m00, s1 + m10), max(s0 + m01, s1 + m11) + e
        now = s1 > s0
        out = [now]
        for from0, from1 in reversed(back):
            now = from1 if now else from0
            out.append(now)
        return out[::-1]

    def text(self, html: str) -> str:
        if self.reader is None:
            self.reader = Reader(self.weights)
        blocks = self.reader.blocks(html)
        return "\n".join(b[0] for b, main in zip(blocks, self.labels(blocks)) if main)


def labelled(html: str, hide: bool = False) -> tuple[list[list[str]], list[int]]:
    """Feature names and label of each block of a page that marks its main
    elements by ``data-main``, or, where ``hide`` is given, by its own article;
    then the telling tags are no features if ``hide`` is true."""
    names, labels = [], []
    for text, linked, tag, path in Reader().blocks(html):
        names.append([*path.features, *_text_features(text, linked, tag)])
        labels.append(int(path.main))
    return names, labels


def by_own_markup(html: str, hide: bool) -> tuple[list[list[str]], list[int]]:
    """The same of a page with an ``article`` or ``main`` element, which is its
    main text but for the elements in it that say that they are none; nothing
    of other pages.  ``hide`` leaves the telling tags out of the features."""
    names, labels = [], []
    none = _TELLING - set(_ARTICLE) - {"inner:header"}
    for text, linked, tag, path in Reader().blocks(html):
        main = any(a in path.features for a in _ARTICLE) and not (none & path.features)
        labels.append(int(main))
        of = path.features - _TELLING if hide else path.features
        names.append([*of, *_text_features(text, linked, "div" if f"tag:{tag}" in _TELLING else tag)])
    return (names, labels) if 0 < sum(labels) < len(labels) else ([], [])


def train(pages: list[tuple[list[list[str]], list[int]]], steps: int = STEPS) -> MainTextModel:
    """Adam on the conditional likelihood with a Gaussian prior."""
    pages = [(n, y) for n, y in pages if y]
    held: dict[str, int] = {}
    for names, _ in pages:
        for f in {f for block in names for f in block}:
            held[f] = held.get(f, 0) + 1
    vocabulary = {f: i for i, f in enumerate(sorted(f for f, n in held.items() if n >= LEAST_PAGES))}
    size = len(vocabulary)
    flat = [[vocabulary[f] for f in block if f in vocabulary] for names, _ in pages for block in names]
    at = np.concatenate([np.array(b, np.int64) for b in flat])
    of = np.repeat(np.arange(len(flat)), [len(b) for b in flat])
    y = np.concatenate([np.array(v, float) for _, v in pages])
    lines = np.array([len(v) for _, v in pages], np.int64)
    chains = Chains(lines)
    inner = np.ones(len(y), bool)
    inner[np.cumsum(lines) - lines] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[np.flatnonzero(inner) - 1].astype(int), y[inner].astype(int)), 1)
    theta = np.zeros(size + 5)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        emission = np.bincount(of, theta[at], len(y)) + theta[size]
        good, count = chains.marginals(emission, theta[size + 1:].reshape(2, 2), pairs=True)
        r = y - good
        grad = np.concatenate([np.bincount(at, r[of], size), [r.sum()], (seen - count).ravel()]) / len(pages)
        grad -= 2e-4 * theta
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.99 * m2 + 0.01 * grad * grad
        theta = theta + 0.1 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    return MainTextModel({f: float(theta[i]) for f, i in vocabulary.items()}, float(theta[size]),
                         theta[size + 1:].reshape(2, 2))


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE,
        templates: int = TEMPLATES) -> MainTextModel:
    """The model of ``templates`` template pages and the pages of the ``sample``
    least id hashes that mark up their article."""
    src = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{html_col}`").alias("text"))
    ids = src.where("id is not null").select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    # at most ``sample`` ids: bounded, so they may be broadcast; one page of each
    chosen = src.where("text is not null").join(F.broadcast(ids), "id", "left_semi").groupBy("id") \
        .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("page")) \
        .select("id", (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)) == 0).alias("hide"), "page.text")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        got = [by_own_markup(t, h) for h, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([n for n, _ in got], pa.list_(pa.list_(pa.string()))),
             pa.array([y for _, y in got], pa.list_(pa.int32()))], names=["id", "names", "labels"])
    kind = dict(src.dtypes)["id"]
    rows = map_texts(chosen, run, f"id {kind}, names array<array<string>>, labels array<int>")
    own = [(r["names"], r["labels"]) for r in sorted(rows.collect(), key=lambda r: r["id"])]
    return train([labelled(html) for html in training_pages(templates)] + own)


def extract(pages: DataFrame, model: MainTextModel, html_col: str = "html") -> DataFrame:
    """The rows with ``text`` (in place of a column of that name) instead of
    the html."""
    kept = [c for c in pages.columns if c not in (html_col, "text")]
    src = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_col}`").alias("text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        text = pa.array([model.text(t) if t else "" for t in b.column(len(kept)).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([*b.columns[:-1], text], schema=b.schema)
    return map_texts(src, run, src.schema)
