"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Method
------
A bounded sample of labelled texts becomes an index; a text's score is the
distance-weighted vote of its ``NEIGHBOURS`` nearest examples, calibrated on
the examples themselves (each left out of its own vote).  All terms of the
examples that ``LEAST_TEXTS`` of them hold take part; a text's vector holds
(1 + log tf) * log(N / df) * r * r of its terms, where r is the log-odds of the
label given the term against the prior, smoothed by ``SMOOTHING`` examples of
the prior.  So a word that says nothing of the label weighs next to nothing,
however many examples there are, and no term is cut by a test that grows with
their number.

Search is exact.  The inverted index keeps each term's postings in blocks of
``BLOCK`` examples with the greatest weight in the block.  A query's terms are
taken by what they can add at most; the postings of the first, until the others
together can add a ``REST`` of the whole, give every example a part of its
cosine.  For the other terms the greatest weights of a block bound what they
add to any example in it.  The examples with the greatest parts are completed
first; then all whose part and bound do not fall below the k-th best cosine, so
no example that belongs to the nearest is missed.  Most terms of a text weigh
next to nothing, and their postings are never read.
The neighbours are returned as evidence.

Near copies among the examples would make any of their rare words look
telling, so in order of ids an example is left out whose word shingles have a
similarity of ``COPY`` or more to those of a kept one with the same label.
MinHash sketches only name the pairs whose whole shingle sets are compared.

Scale: the index is bounded by ``EXAMPLES``, whatever the corpus, and goes to
the tasks as one broadcast of flat arrays, which a worker drops when its next
task does not use it; texts are scored where they are read, with no shuffle.
The terms of the examples are collected and counted as Arrow columns.

Defined results
---------------
* null or empty text, or one without any term: no neighbours; the score is
  that of an empty vote (the prior);
* no labelled rows, or one class only: every score is the share of label 1
  (0 without any);
* null labels or ids take no part in fitting; an id labelled both ways counts
  as 1; null ids and repeated rows are scored like any row;
* of different texts with one labelled id, that of the least hash is learnt
  from, however many rows there are;
* a very long text is scored whole;
* ties of the cosine: the lesser example id is nearer;
* an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import BATCH_BYTES, cut, map_texts, pieces, python_tasks
from .hashing import mix, shingle_sets, word_hashes

#: The greatest number of labelled texts that are fitted on.
EXAMPLES = 8192
#: Examples that hold a term, at least.
LEAST_TEXTS = 2
#: Examples of the prior that smooth a term's log-odds.
SMOOTHING = 2.0
NEIGHBOURS = 15
BLOCK = 128
#: What the terms whose postings are not read can add at most, of the whole.
REST = 0.003
#: Examples that are completed first.
FIRST = 24
#: Least similarity of a near copy, and number of shingle words.
COPY, SHINGLE = 0.8, 5
#: MinHash values of an example, and how many two must share to be compared: of
#: a pair at ``COPY`` fewer agree once in a million times.
SKETCH, AGREE = 64, 35
#: Bytes that part terms, once other alphabets' marks and digits are spaces.
_PARTS = np.zeros(256, dtype=bool)
_PARTS[[c for c in range(128) if not chr(c).isalpha()]] = True
#: Parts and bounds are sums of single-precision weights, at most so far off;
#: whole cosines are exact.
_ROUNDING = 1e-5
#: Scores that a task remembers, of texts with the same terms.
_MEMORY = 5000


_APART = bytes(32 if p else c for c, p in enumerate(_PARTS))


def lettered(text: str) -> bytes:
    """The text in lower case, as UTF-8, with spaces for the marks and digits
    that ASCII lacks: terms are its runs outside ``_PARTS``."""
    text = text.lower()
    if not text.isascii():
        odd = [c for c in set(text) if c > "\x7f" and (not c.isalnum() or c.isdecimal())]
        if odd:
            text = text.translate(dict.fromkeys(map(ord, odd), " "))
    return text.encode()


def terms_of(text: str) -> Counter:
    """Terms of a text and how often each occurs."""
    return Counter(lettered(text).translate(_APART).split())


@dataclass
class BlockMaxIndex:
    """Unit vectors of examples in an inverted index with block maxima."""

    words: pa.Array                  # the terms, by number
    hashes: np.ndarray               # of the terms, ascending, and their numbers
    numbers: np.ndarray
    idf: np.ndarray
    ids: np.ndarray                  # of the examples, in index order
    labels: np.ndarray
    first: np.ndarray                # by term: its first entry; one more at the end
    block: np.ndarray                # of each entry, a term in a block
    greatest: np.ndarray             # weight in each entry
    start: np.ndarray                # of each entry's postings; one more at the end
    places: np.ndarray               # of the postings
    values: np.ndarray
    top: np.ndarray                  # of each term: its greatest weight
    own_first: np.ndarray            # of each example: its first term; one more at the end
    own_terms: np.ndarray
    own_values: np.ndarray
    prior: float
    slope: float = 1.0
    level: float = 0.0
    query: np.ndarray | None = None

    @property
    def vocabulary(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self.words.to_pylist())}

    @staticmethod
    def weights(terms: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
        w = (1 + np.log(tf)) * idf[terms]
        return w / np.sqrt((w * w).sum()) if len(w) else w

    @staticmethod
    def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """start[0], start[0] + 1, ... of all ranges, end to end."""
        return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())

    @classmethod
    def build(cls, vocabulary, idf, rows, prior):
        """vocabulary: number of each term; rows: (id, label, term numbers,
        counts) of each example."""
        rows = [r for r in rows if len(r[2])]
        none = [np.zeros(0, np.int32)]
        index, _ = cls.of_arrays(
            pa.array(sorted(vocabulary, key=vocabulary.get), pa.string()), idf,
            np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64),
            np.array([len(r[2]) for r in rows], np.int64),
            np.concatenate([r[2] for r in rows] or none).astype(np.int32),
            np.concatenate([r[3] for r in rows] or none).astype(np.float32), prior)
        return index

    @classmethod
    def of_arrays(cls, words, idf, ids, labels, sizes, terms, tf, prior):
        """The index, and the counts in its order; sizes: the terms of each
        example (one at least), terms and counts end to end."""
        weight = (1 + np.log(tf, dtype=np.float64)) * idf[terms]
        starts = np.cumsum(sizes) - sizes
        if len(sizes):
            weight /= np.repeat(np.sqrt(np.add.reduceat(weight * weight, starts)), sizes)
            most = np.maximum.reduceat(weight, starts)
            at = np.flatnonzero(weight == np.repeat(most, sizes))
            leading = terms[at[np.searchsorted(at, starts)]]
            # examples that lean on the same term share blocks, for tight bounds
            order = np.lexsort((ids, -most, leading))
        else:
            order = np.zeros(0, np.int64)
        move = cls._ranges(starts[order], sizes[order])
        ids, labels, sizes = ids[order], labels[order], sizes[order]
        own_terms, own_values, tf = terms[move], weight[move], tf[move]
        del weight, move
        order = np.argsort(own_terms, kind="stable")
        term, values = own_terms[order], own_values[order].astype(np.float32)
        places = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
        del order
        entry = np.flatnonzero((np.diff(term, prepend=-1) != 0)
                               | (np.diff(places // BLOCK, prepend=-1) != 0)).astype(np.int32)
        greatest = np.maximum.reduceat(values, entry) if len(entry) else values
        first = np.searchsorted(term[entry], np.arange(len(words) + 1)).astype(np.int32)
        top = np.maximum.reduceat(greatest, first[:-1]) if len(entry) else np.zeros(len(words), np.float32)
        hashes = word_hashes([w.encode() for w in words.to_pylist()], _PARTS)[0]
        numbers = np.argsort(hashes).astype(np.int32)
        return cls(words, hashes[numbers], numbers, idf, ids, labels, first, places[entry] // BLOCK, greatest,
                   np.append(entry, len(term)).astype(np.int32), places, values, top,
                   np.concatenate([[0], np.cumsum(sizes)]), own_terms, own_values, prior), tf

    def vectors(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(term numbers, counts) of each text, terms ascending."""
        h, sizes = word_hashes([lettered(t) for t in texts], _PARTS)
        if not len(self.hashes):
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(texts)
        # looking up sorted words keeps to one end of the table at a time
        key, back = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, key), len(self.hashes) - 1)
        number = np.where(self.hashes[at] == key, self.numbers[at], -1)[back]
        known = number >= 0
        of = np.repeat(np.arange(len(texts)), sizes)[known]
        both, counts = np.unique(of * len(self.hashes) + number[known], return_counts=True)
        cuts = np.searchsorted(both, np.arange(1, len(texts)) * len(self.hashes))
        return list(zip(np.split(both % len(self.hashes), cuts), np.split(counts.astype(np.float64), cuts)))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS,
                without: int | None = None) -> list[tuple[float, int]]:
        """(cosine, place in the index) of the k nearest, exactly."""
        if not len(terms) or not len(self.ids):
            return []
        most = weights * self.top[terms]
        # first those that add much for few postings
        start = self.start[self.first[terms]]
        order = np.argsort(-most / (self.start[self.first[terms + 1]] - start), kind="stable")
        terms, weights, most = terms[order], weights[order], most[order]
        rest = most[::-1].cumsum()[::-1]              # what a term and those after it can add
        head = int(np.searchsorted(-rest, -REST * rest[0]))
        # the parts of the cosines that the first terms make
        t, w = terms[:head], weights[:head]
        start = self.start[self.first[t]].astype(np.int64)
        size = self.start[self.first[t + 1]] - start
        post = self._ranges(start, size)
        part = np.bincount(self.places[post], np.repeat(w, size) * self.values[post], len(self.ids))
        # what the others can add in each block
        t, w = terms[head:], weights[head:]
        size = self.first[t + 1] - self.first[t]
        at = self._ranges(self.first[t], size)
        bound = np.bincount(self.block[at], np.repeat(w, size) * self.greatest[at],
                            -(-len(self.ids) // BLOCK))
        most = part + np.repeat(bound, BLOCK)[:len(part)]
        if without is not None:
            most[without] = 0
        if self.query is None:
            self.query = np.zeros(len(self.hashes))
        query = self.query               # all zero but for the terms asked for
        query[terms] = weights
        first = np.argpartition(-most, FIRST)[:FIRST] if len(most) > FIRST else np.arange(len(most))
        first = first[most[first] > 0]
        score = self._cosines(query, first)
        if (score > 0).sum() >= k:
            least = np.partition(score, -k)[-k] - _ROUNDING
            most[first] = -1
            more = np.flatnonzero(most >= least)
        else:
            most[first] = -1
            more = np.flatnonzero(most > 0)
        hit = np.concatenate([first, more])
        score = np.concatenate([score, self._cosines(query, more)])
        query[terms] = 0
        best = np.lexsort((self.ids[hit], -score))[:k]
        return [(c, p) for c, p in zip(score[best].tolist(), hit[best].tolist()) if c > 0]

    def _cosines(self, query: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The whole cosines of some examples; ``query`` by term."""
        start = self.own_first[places]
        size = self.own_first[places + 1] - start
        at = self._ranges(start, size)
        return np.bincount(np.repeat(np.arange(len(places)), size),
                           query[self.own_terms[at]] * self.own_values[at], len(places)).round(12)

    def vote(self, near: list[tuple[float, int]]) -> float:
        """The share of label 1 among the neighbours, weighted by nearness,
        with one far vote of the prior."""
        top = total = 0.0
        for cosine, at in near:
            w = 1 / (0.1 + max(0.0, 1 - cosine))
            top += w * self.labels[at]
            total += w
        return (top + self.prior) / (total + 1)

    def calibrate(self, tf: np.ndarray, df: np.ndarray, top: np.ndarray, n: int, empty: list[int]) -> None:
        """Platt scaling of left-out votes: each example asks with weights that
        do not know its own label.  ``tf`` are the counts of its terms, ``df``
        and ``top`` those of ``term_weights``, ``empty`` the labels of the
        examples that no term is in."""
        none = self.vote([])
        x, y = [none] * len(empty), list(empty)
        for at, label in enumerate(self.labels.tolist()):
            own = slice(self.own_first[at], self.own_first[at + 1])
            t = self.own_terms[own].astype(np.int64)
            w = (1 + np.log(tf[own], dtype=np.float64)) * (
                term_weights(df[t] - 1, top[t] - label, n - 1, self.prior) + 1e-12)
            x.append(self.vote(self.nearest(t, w / np.sqrt((w * w).sum()), without=at)))
            y.append(label)
        x, y = np.array(x), np.array(y, float)
        x = np.log(x / (1 - x))
        a, b = 1.0, 0.0
        for _ in range(50):                     # damped Newton steps
            p = 1 / (1 + np.exp(-(a * x + b)))
            g = np.array([((p - y) * x).sum() + 1e-2 * (a - 1), (p - y).sum()])
            v = p * (1 - p) + 1e-9
            h = np.array([[(v * x * x).sum() + 1e-2, (v * x).sum()], [(v * x).sum(), v.sum()]])
            step = np.linalg.solve(h, g)
            a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
        self.slope, self.level = (a, b) if a > 0 else (1.0, 0.0)

    def scores(self, texts: list[str], memory: dict,
               evidence: bool = True) -> list[tuple[float, list[tuple[int, float]]]]:
        """The calibrated score and, as ``evidence``, the neighbours (id, cosine)
        of each text; ``memory`` holds those of texts with the same terms."""
        out = []
        for terms, tf in self.vectors(texts):
            key = blake2b(terms.tobytes() + tf.tobytes(), digest_size=16).digest()
            got = memory.get(key)
            if got is None:
                near = self.nearest(terms, self.weights(terms, tf, self.idf))
                v = self.vote(near)
                if 0 < v < 1:
                    v = 1 / (1 + np.exp(-(self.slope * np.log(v / (1 - v)) + self.level)))
                got = float(v), [(int(self.ids[at]), c) for c, at in near] if evidence else []
                if len(memory) < _MEMORY:
                    memory[key] = got
            out.append(got)
        return out

    def score(self, text: str) -> tuple[float, list[tuple[int, float]]]:
        return self.scores([text], {})[0]


def _term_counts(b: pa.RecordBatch) -> pa.RecordBatch:
    terms, tf, sketch, shingles = [], [], [], []
    for t in b.column(2).to_pylist():
        found = terms_of(t or "")
        terms.append(list(found))
        tf.append(list(found.values()))
        s = np.unique(shingle_sets(word_hashes([(t or "").encode()])[0], SHINGLE))
        sketch.append(np.array([mix(s, 50 + j).min() if len(s) else 0 for j in range(SKETCH)],
                               np.uint64).astype(np.uint32).tobytes())
        shingles.append(s.tobytes())
    return pa.RecordBatch.from_arrays(
        [b.column(0), b.column(1), pa.array(terms, pa.list_(pa.binary())),
         pa.array(tf, pa.list_(pa.int32())), pa.array(sketch, pa.binary()),
         pa.array(shingles, pa.binary())],
        names=["id", "label", "terms", "tf", "sketch", "shingles"])


def without_copies(rows: DataFrame) -> dict[int, int]:
    """id -> label of the examples that are no near copy of a kept one with
    the same label."""
    first: dict[int, tuple] = {}
    for i, y, sketch in sorted(tuple(r) for r in rows.select("id", "label", "sketch").collect()):
        first.setdefault(i, (y, bytes(sketch)))
    ids = np.array(list(first), np.int64)
    labels = np.array([y for y, _ in first.values()], np.int64)
    sketches = np.frombuffer(b"".join(k for _, k in first.values()), np.uint32).reshape(-1, SKETCH)
    near: dict[int, list[int]] = {}         # place -> earlier places to compare with
    for y in (0, 1):
        of = np.flatnonzero(labels == y)
        own = sketches[of]
        for j in range(1, len(of)):
            hit = np.flatnonzero((own[:j] == own[j]).sum(axis=1) >= AGREE)
            if len(hit):
                near[int(of[j])] = of[hit]
    asked = sorted({*near, *(int(p) for hit in near.values() for p in hit)})
    if not asked:
        return dict(zip(ids.tolist(), labels.tolist()))
    side = rows.sparkSession.createDataFrame([(int(ids[p]),) for p in asked], "id bigint")
    whole = rows.join(F.broadcast(side), "id", "left_semi") \
        .select("id", "sketch", "shingles").orderBy("id", "sketch")
    place = {int(ids[p]): p for p in asked}
    held: dict[int, np.ndarray] = {}        # the whole sets of kept examples
    gone, seen = set(), set()
    for r in whole.toLocalIterator():
        p = place[r["id"]]
        if p in seen:
            continue
        seen.add(p)
        mine = np.frombuffer(bytes(r["shingles"]), np.uint64)
        for q in near.get(p, ()):
            other = held.get(int(q))
            if other is not None:
                both = len(np.intersect1d(mine, other, assume_unique=True))
                if both >= COPY * (len(mine) + len(other) - both):
                    gone.add(p)
                    break
        else:
            held[p] = mine
    return {int(i): int(y) for p, (i, y) in enumerate(zip(ids, labels)) if p not in gone}


def term_weights(df: np.ndarray, top: np.ndarray, n: int, prior: float) -> np.ndarray:
    """What a term weighs that ``df`` of n examples hold, ``top`` of them with
    label 1."""
    share = (top + SMOOTHING * prior) / (df + SMOOTHING)
    odds = np.log(share / (1 - share)) - np.log(prior / (1 - prior))
    return np.log(n / np.maximum(df, 1)) * odds * odds


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", examples: int = EXAMPLES) -> BlockMaxIndex:
    """The index of a sample of labelled texts (those of the least id hashes)."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()) \
        .groupBy(F.col(id_col).cast("bigint").alias("id")) \
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(examples)
    # at most ``examples`` pairs of numbers: bounded, so they may be broadcast
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(sample), "id").groupBy("id").agg(
            F.first("label").alias("label"),
            F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("row")) \
        .select("id", "label", "row.text")
    rows = cut(map_texts(texts, _term_counts, "id bigint, label int, terms array<binary>, "
                         "tf array<int>, sketch binary, shingles binary"))
    kept = without_copies(rows)
    total = Counter(kept.values())
    n = sum(total.values())
    prior = total[1] / n if n else 0.0
    if not total[0] or not total[1]:
        return BlockMaxIndex.build({}, np.zeros(0), [], prior)
    spark = docs.sparkSession
    of = spark.createDataFrame([(i,) for i in kept], "id bigint")
    rows = rows.join(F.broadcast(of), "id", "left_semi")
    got = rows.select("id", "label", "terms", "tf").orderBy("id").toArrow()
    ids, labels = got["id"].to_numpy(), got["label"].to_numpy().astype(np.int64)
    words = pa.concat_arrays([c.flatten() for c in got["terms"].chunks]).dictionary_encode()
    tf = pa.concat_arrays([c.flatten() for c in got["tf"].chunks]).to_numpy().astype(np.float32)
    term = words.indices.to_numpy()
    sizes = pc.list_value_length(got["terms"]).to_numpy().astype(np.int64)
    words = words.dictionary
    del got
    of = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
    df = np.bincount(term, minlength=len(words)).astype(float)
    top = np.bincount(term[labels[of] == 1], minlength=len(df)).astype(float)
    idf = term_weights(df, top, n, prior)
    stays = np.flatnonzero((df >= LEAST_TEXTS) & (df < n) & (idf > 0))
    number = np.full(len(df), -1, np.int32)
    number[stays] = np.arange(len(stays))
    words, df, top, idf = words.take(pa.array(stays)).cast(pa.string()), df[stays], top[stays], idf[stays]
    term = number[term]
    known = term >= 0
    of, tf, term = of[known], tf[known], term[known]
    order = np.lexsort((term, of))
    sizes = np.bincount(of, minlength=len(ids))
    some = sizes > 0
    index, tf = BlockMaxIndex.of_arrays(words, idf, ids[some], labels[some], sizes[some],
                                        term[order], tf[order], prior)
    index.calibrate(tf, df, top, n, labels[~some].tolist())
    pa.default_memory_pool().release_unused()
    return index


def slices(texts: list) -> Iterator[list]:
    """Texts in order, some megabytes at a time (one text at least)."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= BATCH_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def score_of(spark: SparkSession, index: BlockMaxIndex):
    """The score as a function of a text column, for rows kept in place."""
    python_tasks(spark)
    held = spark.sparkContext.broadcast(index)

    @F.pandas_udf("double")
    def toxicity_score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory: dict = {}                # of this task
        for texts in batches:
            got = [held.value.scores([t or "" for t in part], memory, evidence=False) for part in slices(texts.tolist())]
            yield pd.Series([s for part in got for s, _ in part], dtype="float64")
    return toxicity_score


def score(docs: DataFrame, index: BlockMaxIndex, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id_col, score, evidence): evidence lists the nearest examples and
    their cosines, nearest first."""
    near = pa.struct([("id", pa.int64()), ("cosine", pa.float64())])
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    python_tasks(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        memory: dict = {}                # of this task
        for batch in batches:
            for b in pieces(batch):
                got = held.value.scores([t or "" for t in b.column(1).to_pylist()], memory)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([s for s, _ in got], pa.float64()),
                     pa.array([[{"id": i, "cosine": c} for i, c in e] for _, e in got], pa.list_(near))],
                    names=["id", "score", "evidence"])
    kind = dict(src.dtypes)["id"]
    return src.mapInArrow(run, f"id {kind}, score double, evidence array<struct<id:bigint,cosine:double>>") \
        .withColumnRenamed("id", id_col)
