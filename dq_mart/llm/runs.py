"""Periodic runs of words: stretches that repeat themselves.

Method
------
A run of period q over the words i .. j is the maximal pair (i, i + q): the
words from i and from i + q agree over j + 1 - i - q words, the words before
both differ and those after both differ.  So runs are listed as maximal pairs,
with no extension of found repeats: the LCP-interval tree of a text's suffixes
is walked bottom up, every node keeps its suffixes by the word left of them,
and when a child is merged into a node of depth d, each of the smaller side's
suffixes meets those of the larger side with another left word at a distance q
of d at most (a run is at least two periods long).  Such a pair is a stretch
of d + q words; several periods of one stretch are multiples of the least,
which is kept.

A run of ``least`` words or more needs a node of depth ``least / 2``, so only the
parts of the tree at that depth are built, and of those only the ones with two
suffixes no farther apart than their greatest depth.  A batch's texts are sorted
together (prefix doubling on (text, word) ranks; suffixes that are alone in
their class are not sorted again); texts in which no ``least / 2`` words repeat
are left out before.  The lengths of common prefixes come from the same ranks.

Scale: texts are read where they lie, with no shuffle; a task holds the arrays of
one slice of texts.  A text of n words costs O(n log n) sorting, its merges move
each suffix to a larger list each time, and runs of all texts together have at
most some four pairs a word.

Defined results
---------------
* null or empty text, or white space alone: no words, no runs, empty text;
* a text of any length is one text, searched whole;
* words are equal if their bytes are; null ids and repeated rows are texts
  like any other;
* runs are listed by start, then period; runs may overlap, and of two that do
  each drops its own words;
* an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_texts
from .hashing import mix

#: Words of the shortest run.
LEAST = 12


def repeats_within(ids: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """The texts in which some ``size`` words occur twice (or seem to, by
    hash); ids and text numbers of all words, end to end."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = mix(text[:n].astype(np.uint64), 99)
    for j in range(size):
        h = mix(h ^ ids[j:n + j].astype(np.uint64), j + 1)
    whole = text[:n] == text[size - 1:]
    h, of = h[whole], text[:n][whole]
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    return np.unique(of[order][1:][same])


def suffix_order(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of all texts in order (by text, then words), and how many
    words each shares with the one before it (0 between texts)."""
    n = len(ids)
    end = np.searchsorted(text, text, side="right")
    key = text.astype(np.int64) * (int(ids.max()) + 1) + ids
    rank, active = np.empty(n, np.int64), np.arange(n)
    base = np.zeros(n, np.int64)
    levels, width = [], 1
    while True:
        order = np.argsort(key, kind="stable")
        sorted_key, sorted_base = key[order], base[order]
        new = np.flatnonzero(np.diff(sorted_key, prepend=sorted_key[0] - 1))
        group = np.flatnonzero(np.diff(sorted_base, prepend=-1)) if width > 1 else np.zeros(1, np.int64)
        size = np.diff(new, append=len(key))
        # a class's rank: that of the class it was in, and those before it there
        first = group[np.searchsorted(group, new, side="right") - 1]
        value = sorted_base[new] + new - first
        rank[active[order]] = np.repeat(value, size)
        levels.append(rank.copy())
        active = active[order][np.repeat(size > 1, size)]
        if not len(active):
            break
        base = rank[active]
        after = active + width
        inside = after < end[active]
        second = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        key = base * (n + 1) + second
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n, np.int64)
    for level in reversed(range(len(levels))):
        r = levels[level]
        live = (a < end[order[:-1]]) & (b < end[order[1:]])
        same = live & (r[np.minimum(a, n - 1)] == r[np.minimum(b, n - 1)])
        step = same.astype(np.int64) << level
        a, b = a + step, b + step
        shared[1:] += step
    return order, shared


class _Node:
    """The suffixes under a node, in order, and by the word left of them."""

    __slots__ = ("at", "by")

    def __init__(self, at: int, left: int):
        self.at, self.by = [at], {left: [at]}


def _merge(a: _Node, b: _Node, depth: int, left: list[int], found: dict, least: int) -> _Node:
    """Report the maximal pairs of the two sides; the larger takes in the smaller."""
    if len(a.at) < len(b.at):
        a, b = b, a
    at, by = a.at, a.by
    for p in b.at:
        lo, hi = bisect_left(at, p - depth), bisect_right(at, p + depth)
        if lo == hi:
            continue
        w = left[p]
        if hi - lo <= len(by):
            met = [r for r in at[lo:hi] if left[r] != w]
        else:
            met = [r for c, own in by.items() if c != w
                   for r in own[bisect_left(own, p - depth):bisect_right(own, p + depth)]]
        for r in met:
            q = abs(p - r)
            if depth + q >= least:
                key = (min(p, r), depth + q)
                if q < found.get(key, q + 1):
                    found[key] = q
    few = len(b.at) * 8 < len(at)
    for into, more in [(at, b.at), *((by.setdefault(c, []), own) for c, own in b.by.items())]:
        if few:
            for p in more:
                insort(into, p)
        else:
            into += more
            into.sort()
    return a


def maximal_pairs(suffixes: list[int], shared: list[int], left: list[int], found: dict,
                  least: int = LEAST) -> None:
    """Walk the LCP intervals of neighbouring suffixes bottom up; ``found`` gets
    (start, length) -> period.  ``shared[k]`` is of suffixes k - 1 and k."""
    stack: list[list] = []               # open intervals: depth, node
    for k, p in enumerate(suffixes):
        node = _Node(p, left[p])
        depth = shared[k + 1] if k + 1 < len(suffixes) else 0
        while stack and stack[-1][0] > depth:
            d, held = stack.pop()
            node = _merge(held, node, d, left, found, least)
        if stack and stack[-1][0] == depth:
            stack[-1][1] = _merge(stack[-1][1], node, depth, left, found, least)
        elif depth:
            stack.append([depth, node])


def find_runs(ids: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> dict[int, list[tuple]]:
    """text number -> its runs (start, length, period), of texts that have any;
    ids of the words of all texts, end to end, and the words of each."""
    deep = (least + 1) // 2
    text = np.repeat(np.arange(len(sizes)), sizes)
    some = repeats_within(ids, text, deep)
    if not len(some):
        return {}
    kept = np.isin(text, some)
    ids, text = ids[kept], text[kept]
    begin = np.searchsorted(text, some)
    order, shared = suffix_order(ids, text)
    # stretches of suffixes that share ``deep`` words or more with their neighbours
    joined = shared >= deep
    inside = joined.copy()
    inside[:-1] |= joined[1:]
    order, shared, joined = order[inside], shared[inside], joined[inside]
    if not len(order):
        return {}
    stretch = np.cumsum(~joined) - 1
    cuts = np.flatnonzero(~joined)
    deepest = np.maximum.reduceat(np.where(joined, shared, 0), cuts)
    by_place = np.lexsort((order, stretch))
    gap = np.diff(order[by_place], prepend=0)
    gap[cuts] = len(ids)
    nearest = np.minimum.reduceat(gap, cuts)
    left = np.empty(len(ids), np.int64)
    left[1:] = ids[:-1]
    left[begin] = -1
    left = left.tolist()
    runs: dict[int, dict] = defaultdict(dict)
    bounds = np.append(cuts, len(order))
    for s in np.flatnonzero(nearest <= deepest).tolist():
        lo, hi = int(bounds[s]), int(bounds[s + 1])
        t = int(text[order[lo]])
        maximal_pairs(order[lo:hi].tolist(), shared[lo:hi].tolist(), left, runs[t], least)
    start = dict(zip(some.tolist(), begin.tolist()))
    return {t: sorted((p - start[t], size, q) for (p, size), q in got.items())
            for t, got in runs.items() if got}


def collapsed(words: list[bytes], runs: list[tuple]) -> bytes:
    """The words but for those in a run after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, size, q in runs:
        gone[start + q] += 1
        gone[start + size] -= 1
    keep = np.cumsum(gone)[:-1] == 0
    return b" ".join([w for w, k in zip(words, keep.tolist()) if k])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least: int = LEAST) -> DataFrame:
    """(id_col, n_words, runs, collapsed) of every text: ``runs`` are structs
    start, length, period (in words), ``collapsed`` the text, with single
    spaces, without the repeated words."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        words = [(t or "").encode().split() for t in b.column(1).to_pylist()]
        number: dict[bytes, int] = defaultdict(count().__next__)
        ids = np.array([number[w] for own in words for w in own], np.int64)
        sizes = np.array([len(own) for own in words], np.int64)
        runs = find_runs(ids, sizes, least)
        each = [runs.get(i, []) for i in range(len(words))]
        flat = [np.array([r[j] for own in each for r in own], np.int64) for j in range(3)]
        items = pa.StructArray.from_arrays([pa.array(x) for x in flat], ["start", "length", "period"])
        offsets = np.concatenate([[0], np.cumsum([len(own) for own in each])]).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), items)
        text = [(collapsed(w, r) if r else b" ".join(w)).decode() for w, r in zip(words, each)]
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(sizes), listed, pa.array(text, pa.string())],
            names=["id", "n_words", "runs", "collapsed"])
    kind = dict(src.dtypes)["id"]
    return map_texts(src, run, f"id {kind}, n_words bigint, "
                     "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string") \
        .withColumnRenamed("id", id_col)
