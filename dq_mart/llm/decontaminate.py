"""Benchmark decontamination by the CGK embedding and bit-sampling LSH.

Method
------
Texts are sequences of lower-cased words.  An item is found in a document
when some passage is within ``ceil(RATE * words of the item)`` word edits.
Items of similar length form a class; every window of a document that could
hold an item of the class is embedded by the CGK random walk: at step j the
symbol under the walk is written, and the walk moves on by one random bit of
(j, symbol), so that windows a few edits apart fall back in step and differ
in few places (edit distance becomes Hamming distance).  Bit-sampling LSH
then hashes ``SAMPLES`` sampled places of the embedding, ``TABLES`` times for
each of ``WALKS`` walks; windows that share a key with an item are verified
by exact edit distance against the text around them, which also gives the
passage's place.  ``recall`` of the defaults is measured in the tests.

Embedding a window costs time in proportion to its length, so items longer than
``PART`` words are cut into parts of even length, only to find candidates: of a
passage within the whole item's edits at least one part is within its share of
them.  What is verified, and returned, is always the whole item.

Which windows could hold an item follows from counts alone, losslessly: at
most k of its words occur in no item of the class, and at least as many
rarely used words as the least of any item, less k.  Equal windows of a batch
are embedded once.

Scale: one pass over the documents for each block of ``BLOCK`` items, one after
the other: driver and tasks hold one block at a time, however long the benchmark
is, and what a block gave is cut in the shared folder before the next.  No
shuffle; a task holds one slice of texts.

Defined results
---------------
* null or empty text, and null or wordless items: no rows;
* null document id: its hits are returned with a null id;
* repeated documents or items: each row is searched, each item found;
* ties: of an item's passages in a document the one with the least distance
  is returned, the first of them, with the number of passages found;
* items of any length are found as wholes: half of a long item is no hit;
* very long texts are searched whole;
* an empty table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import BATCH_BYTES, cut, map_texts, python_tasks
from .hashing import PUNCTUATION, mix, word_hashes

RATE = 0.1
WALKS, TABLES, SAMPLES = 6, 8, 6
BLOCK = 4000
#: Words of an item that are embedded as one.
PART = 400
#: Lengths of one class differ by this factor at most.
SPREAD = 1.25
#: A word of more items than this share of the class is not rarely used.
COMMON = 0.03
#: The same words as ``word_hashes`` with ``PUNCTUATION``: runs of letters,
#: digits and whatever is not ASCII.
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
SCHEMA = ("doc_id bigint, item_id bigint, start bigint, end bigint, distance bigint, "
          "item_words bigint, n_passages bigint")
_U = np.uint64


def lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    return low


def edits(n: int, rate: float) -> int:
    return min(n - 1, math.ceil(rate * n - 1e-9))


def _last_row(item: np.ndarray, region: np.ndarray) -> np.ndarray:
    """Least edits between the item and any passage that ends at each place."""
    at = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for i, x in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (region != x), row[1:] + 1)
        row = np.minimum.accumulate(new - at) + at
    return row


def best_passage(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the passage of least edit distance."""
    row = _last_row(item, region)
    end = int(row.argmin())
    back = _last_row(item[::-1], region[:end][::-1])
    return int(row[end]), end - int(np.flatnonzero(back == row[end])[0]), end


class LengthClass:
    """The LSH tables of the items whose lengths are close."""

    def __init__(self, items: list[tuple[int, int]], words: list[np.ndarray],
                 symbols: np.ndarray, rate: float, walks: int, tables: int, samples: int,
                 rng: np.random.Generator):
        self.items = items                         # (item id, index into words)
        sizes = [len(words[i]) for _, i in items]
        self.low, high = min(sizes), max(sizes)
        self.most = edits(high, rate)
        self.known = np.zeros(len(symbols), bool)
        spread = Counter(x for _, i in items for x in set(words[i].tolist()))
        for x in spread:
            self.known[x] = True
        self.rare = np.zeros(len(symbols), bool)
        for x, n in spread.items():
            self.rare[x] = n <= max(2, COMMON * len(items))
        self.need = min(int(self.rare[words[i][:self.low]].sum()) for _, i in items) - self.most
        self.symbols = symbols
        # a walk advances by half a word a step: so many steps see the window
        self.steps = max(2, 2 * self.low - 2)
        odd = lambda *shape: rng.integers(0, 2**63, shape, dtype=np.uint64) * _U(2) + _U(1)
        self.move = odd(walks, self.steps)
        self.sampled = [[np.sort(rng.choice(self.steps, min(samples, self.steps), replace=False))
                         for _ in range(tables)] for _ in range(walks)]
        self.scale = odd(walks, tables, self.steps)
        stream = np.concatenate([np.concatenate([words[i], np.zeros(self.steps, np.int32)])
                                 for _, i in items])
        starts = np.cumsum([0] + [len(words[i]) + self.steps for _, i in items][:-1])
        self.tables = []
        for w in range(walks):
            for keys in self._keys(stream, starts, w):
                order = np.argsort(keys)
                quick = np.zeros(1 << 16, bool)
                quick[keys >> _U(48)] = True
                self.tables.append((keys[order], order, quick))

    def _keys(self, stream: np.ndarray, starts: np.ndarray, walk: int) -> list[np.ndarray]:
        """The keys of each table of a walk, for windows that begin at starts."""
        pos = starts.copy()
        keys = [np.zeros(len(starts), np.uint64) for _ in self.sampled[walk]]
        use: dict[int, list[int]] = {}
        for t, places in enumerate(self.sampled[walk]):
            for j in places.tolist():
                use.setdefault(j, []).append(t)
        for j in range(self.steps):
            seen = self.symbols[stream[pos]]
            for t in use.get(j, ()):
                keys[t] += seen * self.scale[walk, t, j]
            pos += ((seen * self.move[walk, j]) >> _U(63)).astype(np.int64)
        return [mix(k) for k in keys]

    def candidates(self, stream: np.ndarray, counts) -> list[tuple[int, int]]:
        """(start, index into items) of windows that share a key with an item."""
        foreign, rare, power, inverse = counts(self)
        n = self.low
        start = np.flatnonzero((foreign[n:] - foreign[:-n] <= self.most)
                               & (rare[n:] - rare[:-n] >= self.need))
        start = start[start + self.steps < len(stream)]
        if not len(start):
            return []
        # windows of equal words (as far as a walk can see) are embedded once
        far = start + min(2 * n, self.steps)
        content = (power[far] - power[start]) * inverse[start]
        _, first, same = np.unique(content, return_index=True, return_inverse=True)
        alone = start[first]
        hits: set[tuple[int, int]] = set()
        step = 1 << 15
        for at in range(0, len(alone), step):
            part = alone[at:at + step]
            k = 0
            for w in range(len(self.move)):
                for keys in self._keys(stream, part, w):
                    known, order, quick = self.tables[k]
                    k += 1
                    maybe = np.flatnonzero(quick[keys >> _U(48)])
                    if not len(maybe):
                        continue
                    lo = np.searchsorted(known, keys[maybe], "left")
                    hi = np.searchsorted(known, keys[maybe], "right")
                    for x, a, b in zip(maybe[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                        hits.update((at + x, int(i)) for i in order[a:b])
        if not hits:
            return []
        by_window: dict[int, list[int]] = {}
        for x, i in hits:
            by_window.setdefault(x, []).append(i)
        wanted = np.flatnonzero(np.isin(same, np.fromiter(by_window, np.int64)))
        return [(int(start[j]), i) for j in wanted.tolist() for i in by_window[int(same[j])]]


class ItemIndex:
    """The classes of one block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE, walks: int = WALKS,
                 tables: int = TABLES, samples: int = SAMPLES, seed: int = 5):
        self.vocabulary: dict[int, int] = {}    # from the hash of a word
        self.words: list[np.ndarray] = []       # of each part
        self.whole: list[tuple[int, np.ndarray]] = []       # item id and all its words
        self.place: list[tuple[int, int]] = []  # of each part: its item and its first word there
        self.rate = rate
        parts: list[tuple[int, int]] = []
        for item, text in items:
            found = word_hashes([lowered(text).encode()], PUNCTUATION)[0].tolist()
            if not found:
                continue
            ids = np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in found], np.int32)
            cuts = math.ceil(len(ids) / PART)
            for k in range(cuts):
                at = k * len(ids) // cuts
                parts.append((len(self.whole), len(self.words)))
                self.place.append((len(self.whole), at))
                self.words.append(ids[at:(k + 1) * len(ids) // cuts])
            self.whole.append((item, ids))
        known = np.array(sorted(self.vocabulary), np.uint64)
        self.known = (known, np.array([self.vocabulary[h] for h in known.tolist()], np.int32))
        self.quick = np.zeros(1 << 16, bool)
        self.quick[known >> _U(48)] = True
        symbols = mix(np.arange(len(self.vocabulary) + 1, dtype=np.uint64), 3)
        rng = np.random.default_rng(seed)
        self.classes: list[LengthClass] = []
        parts.sort(key=lambda x: len(self.words[x[1]]))
        while parts:
            low = len(self.words[parts[0][1]])
            here = [x for x in parts if len(self.words[x[1]]) <= max(low, SPREAD * low)]
            parts = parts[len(here):]
            self.classes.append(LengthClass(here, self.words, symbols, rate, walks, tables,
                                            samples, rng))
        self.gap = max([c.steps + c.low for c in self.classes], default=0) + 1

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts as numbers (0: in no item), and their count."""
        h, number = word_hashes([lowered(t).encode() for t in texts], PUNCTUATION)
        known, value = self.known
        ids = np.zeros(len(h), np.int32)
        if len(known):
            maybe = np.flatnonzero(self.quick[h >> _U(48)])
            at = np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)
            same = known[at] == h[maybe]
            ids[maybe[same]] = value[at[same]]
        return ids, number

    def search(self, texts: list[str]) -> list[tuple]:
        """(row, item, start, end, distance, words, passages) of all texts."""
        ids, number = self.numbers(texts)
        begin = np.concatenate([[0], np.cumsum(number + self.gap)])
        stream = np.zeros(begin[-1], np.int32)
        stream[np.arange(len(ids)) + np.repeat(self.gap * np.arange(len(texts)), number)] = ids
        odd = _U(0x9E3779B97F4A7C15)
        inverse_odd = _U(pow(int(odd), -1, 2**64))
        ramp = np.full(len(stream) + 1, odd, np.uint64)
        ramp[0] = 1
        ramp = np.multiply.accumulate(ramp)
        back = np.full(len(stream) + 1, inverse_odd, np.uint64)
        back[0] = 1
        back = np.multiply.accumulate(back)
        total = lambda x: np.concatenate([np.zeros(1, x.dtype), np.cumsum(x)])
        power = total(mix(stream.astype(np.uint64), 4) * ramp[:-1])

        def counts(c: LengthClass):
            return (total((~c.known[stream]).astype(np.int32)),
                    total(c.rare[stream].astype(np.int32)), power, back)

        # where an item would begin, from each of its parts that was met
        cand: dict[tuple[int, int], set[int]] = {}
        for c in self.classes:
            for p, i in c.candidates(stream, counts):
                row = int(np.searchsorted(begin, p, "right")) - 1
                whole, first = self.place[c.items[i][1]]
                cand.setdefault((row, whole), set()).add(p - int(begin[row]) - first)
        best: dict[tuple[int, int], list] = {}
        for (row, whole), places in cand.items():
            item, words = self.whole[whole]
            k, done = edits(len(words), self.rate), -1
            at_row = stream[begin[row]:begin[row + 1] - self.gap]
            for p in sorted(places):
                if p < done:
                    continue
                a = max(0, p - 2 * k - 4)       # a window may lie beside the passage
                d, s, e = best_passage(words, at_row[a:max(0, p + len(words) + 2 * k + 4)])
                if d > k or e <= s:
                    continue
                done = a + e
                held = best.setdefault((row, item), [k + 1, 0, 0, 0, 0])
                held[4] += 1
                if d < held[0]:
                    held[:4] = [d, a + s, a + e, len(words)]
        spans: dict[int, list] = {}
        out = []
        for (row, item), (d, s, e, n, times) in sorted(best.items(), key=lambda x: x[0]):
            if row not in spans:
                spans = {row: [m.span() for m in _WORD.finditer(lowered(texts[row]))]}
            out.append((row, item, spans[row][s][0], spans[row][e - 1][1], d, n, times))
        return out


def _blocks(items: DataFrame, size: int):
    block = []
    for r in items.toLocalIterator():
        block.append((r[0], r[1]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def _indexes(benchmark: DataFrame, item_col: str, item_text: str, rate: float, block: int):
    items = benchmark.select(F.col(item_col).cast("bigint"), F.col(item_text)) \
        .where(F.col(item_col).isNotNull() & F.col(item_text).isNotNull())
    for part in _blocks(items, block):
        index = ItemIndex(part, rate)
        if index.classes:
            yield index


def detectors(benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text",
              rate: float = RATE, block: int = BLOCK) -> Iterator:
    """For each block of items in turn, whether a text column holds any of them,
    for rows kept in place; null texts hold none."""
    python_tasks(benchmark.sparkSession)

    def detector(index: ItemIndex):
        @F.pandas_udf("boolean")
        def holds_item(texts: pd.Series) -> pd.Series:
            out = np.zeros(len(texts), bool)
            held, size, first = [], 0, 0
            for n, t in enumerate(texts, 1):
                held.append(t or "")
                size += len(held[-1])
                if size >= BATCH_BYTES or n == len(texts):     # bounded slices
                    for row, *_ in index.search(held):
                        out[first + row] = True
                    held, size, first = [], 0, n
            return pd.Series(out)
        return holds_item
    for index in _indexes(benchmark, item_col, item_text, rate, block):
        yield detector(index)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                         item_col: str = "item_id", item_text: str = "text", rate: float = RATE,
                         block: int = BLOCK) -> DataFrame:
    """The rows whose text holds no item."""
    for n, found in enumerate(detectors(benchmark, item_col, item_text, rate, block)):
        if n:
            docs = cut(docs)            # what the blocks before it left
        docs = docs.where(~found(F.col(text_col)))
    return docs


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                 rate: float = RATE, block: int = BLOCK) -> DataFrame:
    """A row for each pair of a document row and an item found in it."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                      F.col(text_col).alias("text"))
    kinds = [pa.int64()] * 7
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def search(index: ItemIndex) -> DataFrame:
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            doc = b.column(0).to_pylist()
            found = index.search([t or "" for t in b.column(1).to_pylist()])
            cols = list(zip(*[(doc[r], *rest) for r, *rest in found])) or [[]] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
        return map_texts(src, run, SCHEMA)

    out = None
    for index in _indexes(benchmark, item_col, item_text, rate, block):
        found = search(index)
        # of several blocks each is searched before the next is drawn
        out = found if out is None else cut(out).unionByName(found)
    return docs.sparkSession.createDataFrame([], SCHEMA) if out is None else out
