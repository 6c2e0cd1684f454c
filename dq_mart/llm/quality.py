"""Document quality from a linear-chain conditional random field over lines.

Method
------
Every line gets binary features: which bucket its length, its shares of
letter, capital, digit and symbol characters, its mean word length, its share of words equal
to the word before and so on fall into, and whether the same line occurs
earlier in the document; the features of the line before and the line after are features too.  A
two-label chain (bad, good) is trained by gradient ascent on the conditional
likelihood, each line carrying its document's label.  Forward-backward gives
each line's marginal of being good; a document's quality is their mean
weighted by line length, calibrated by Platt scaling.

Scale: fitting uses at most ``DOCUMENTS`` labelled documents, whole texts of
them (some ten bytes a line reach the driver); scoring is one pass over whole
texts, no shuffle, vectorised over all lines of a slice.

Defined results
---------------
* null or empty text: one empty line, scored like any other line;
* no labelled rows, or one class only: every score is the share of label 1
  (0 without any);
* null labels or ids take no part in fitting; an id labelled both ways counts
  as its greatest label; null ids and repeated rows are scored like any row;
* of different texts with one labelled id, that of the least hash is learnt
  from, however many rows there are; a very long text is scored whole;
* an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_texts
from .hashing import mix, word_hashes

DOCUMENTS = 4000
STEPS = 120
#: Bounds of the buckets of each feature of a line.
_BUCKETS = {
    "bytes": (1, 12, 40, 120, 400, 1500),
    "letters": (0.4, 0.6, 0.7, 0.8, 0.9),
    "capitals": (0.02, 0.1, 0.3, 0.6, 0.9),
    "digits": (0.001, 0.05, 0.2, 0.5),
    "symbols": (0.001, 0.02, 0.08, 0.2, 0.4),
    "stops": (0.001, 0.02, 0.08, 0.2),
    "bars": (0.001, 0.02, 0.08),
    "word": (2.5, 4, 5.5, 7, 10, 16),
    "repeated": (0.5,),
    "doubled": (0.02, 0.1, 0.3, 0.6),
}
_SIZES = [len(b) + 1 for b in _BUCKETS.values()]
#: Codes of one line, then of its neighbours (with one code for none).
_OFFSETS = np.cumsum([0, *_SIZES])
_OWN = int(_OFFSETS[-1])
FEATURES = 3 * (_OWN + 1)
# classes of bytes
_SPACE, _LOWER, _UPPER, _DIGIT, _STOP, _BAR, _SYMBOL, _OTHER = range(8)
_CLASS = np.full(256, _SYMBOL, np.uint8)
_CLASS[128:] = _OTHER
_CLASS[[*range(9, 14), 32]] = _SPACE
_CLASS[[*range(97, 123)]] = _LOWER
_CLASS[[*range(65, 91)]] = _UPPER
_CLASS[[*range(48, 58)]] = _DIGIT
_CLASS[[*b".,;:?'\"-()"]] = _STOP
_CLASS[[*b"|"]] = _BAR


def line_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, lines, bytes): a bucket number for each feature of each line of
    all texts, the number of lines of each text, and the bytes of each line."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    size = np.diff(ends, prepend=-1)                   # with the line's end
    lines = np.diff(np.searchsorted(ends, np.cumsum([len(t) + 1 for t in texts])), prepend=0)
    line = np.repeat(np.arange(len(ends), dtype=np.int64), size)
    kind = _CLASS[data]
    n = np.bincount((line << 3) + kind, minlength=8 * len(ends)).reshape(-1, 8).astype(float)
    n[:, _SPACE] -= 1                                  # the line's end itself
    total = np.maximum(size - 1, 1)
    inside = kind != _SPACE
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    words = np.bincount(line[first], minlength=len(ends))
    letters = n[:, _LOWER] + n[:, _UPPER] + n[:, _OTHER]
    # a line that occurs earlier in its document: equal hash, same document
    place = np.arange(len(data)) - (ends - size + 1)[line]
    h = np.add.reduceat(mix(data.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8))),
                        ends - size + 1)
    h = mix(h ^ mix(np.repeat(np.arange(len(texts), dtype=np.uint64), lines), 9))
    _, at = np.unique(h, return_index=True)
    again = np.ones(len(ends))
    again[at] = 0
    again[size <= 1] = 0
    word, _ = word_hashes(texts)
    word_line = line[first]
    twice = np.flatnonzero((word[1:] == word[:-1]) & (word_line[1:] == word_line[:-1]))
    doubled = np.bincount(word_line[twice], minlength=len(ends))
    values = {
        "bytes": size - 1, "letters": letters / total,
        "capitals": n[:, _UPPER] / np.maximum(letters, 1), "digits": n[:, _DIGIT] / total,
        "symbols": n[:, _SYMBOL] / total, "stops": n[:, _STOP] / total,
        "bars": n[:, _BAR] / total, "word": (total - n[:, _SPACE]) / np.maximum(words, 1),
        "repeated": again, "doubled": doubled / np.maximum(words, 1)}
    codes = np.empty((len(ends), len(_BUCKETS)), np.uint8)
    for j, (name, bounds) in enumerate(_BUCKETS.items()):
        codes[:, j] = np.searchsorted(bounds, values[name], "right")
    return codes, lines, size - 1


def _scores(codes: np.ndarray, lines: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """What each line, with its neighbours, says for the label good."""
    table = weights.reshape(3, _OWN + 1)
    at = codes + _OFFSETS[:-1]
    own, before, after = (table[i][at].sum(axis=1) for i in range(3))
    out = own.copy()
    out[1:] += before[:-1]
    out[:-1] += after[1:]
    starts = np.cumsum(lines) - lines
    ends = np.cumsum(lines) - 1
    inner = starts[starts > 0]
    out[inner] -= before[inner - 1]                    # not across documents
    last = ends[ends < len(out) - 1]
    out[last] -= after[last + 1]
    out[starts] += table[1][_OWN]
    out[ends] += table[2][_OWN]
    return out


class Chains:
    """Documents' lines laid out for steps over all chains at once."""

    def __init__(self, lines: np.ndarray):
        order = np.argsort(-lines, kind="stable")
        self.start = (np.cumsum(lines) - lines)[order]
        self.length = lines[order]
        self.alive = [int(np.searchsorted(-self.length, -t, "left"))
                      for t in range(int(self.length[0]) if len(lines) else 0)]

    def marginals(self, emission: np.ndarray, move: np.ndarray, pairs: bool = False):
        """P(good) of each line and, if asked, the expected counts of label pairs."""
        n = len(emission)
        e = np.empty((n, 2))
        top = np.maximum(emission, 0)
        e[:, 0], e[:, 1] = np.exp(-top), np.exp(emission - top)
        m = np.exp(move - move.max())
        fwd = np.empty((n, 2))
        for t, k in enumerate(self.alive):
            at = self.start[:k] + t
            a = e[at] if t == 0 else (fwd[at - 1] @ m) * e[at]
            fwd[at] = a / a.sum(axis=1, keepdims=True)
        back = np.ones((n, 2))
        count = np.zeros((2, 2))
        for t in range(len(self.alive) - 1, 0, -1):
            at = self.start[:self.alive[t]] + t
            b = e[at] * back[at]
            if pairs:
                p = fwd[at - 1][:, :, None] * m * b[:, None, :]
                count += (p / p.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = b @ m.T
            back[at - 1] = b / b.sum(axis=1, keepdims=True)
        g = fwd * back
        good = g[:, 1] / g.sum(axis=1)
        return (good, count) if pairs else good


@dataclass
class LineModel:
    weights: np.ndarray
    move: np.ndarray
    prior: float
    slope: float = 1.0
    level: float = 0.0
    flat: bool = False             # nothing could be learnt

    def judge(self, codes, lines, size) -> tuple[np.ndarray, np.ndarray]:
        """Each line's marginal of being good, and each document's
        length-weighted mean of them."""
        good = Chains(lines).marginals(_scores(codes, lines, self.weights), self.move)
        w = size + 1.0
        starts = np.cumsum(lines) - lines
        return good, np.add.reduceat(good * w, starts) / np.add.reduceat(w, starts)

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        x = np.clip(x, 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(x / (1 - x)) + self.level)))

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, lines, lines more likely bad than good) of each text."""
        codes, lines, size = line_codes(texts)
        if self.flat:
            return np.full(len(texts), self.prior), lines, np.zeros(len(texts), np.int64)
        good, x = self.judge(codes, lines, size)
        bad = np.add.reduceat((good < 0.5).astype(np.int64), np.cumsum(lines) - lines)
        return self.calibrated(x), lines, bad


def train(codes: np.ndarray, lines: np.ndarray, size: np.ndarray, labels: np.ndarray,
          steps: int = STEPS) -> LineModel:
    """Adam on the conditional likelihood with a Gaussian prior."""
    prior = float(labels.mean()) if len(labels) else 0.0
    if prior in (0.0, 1.0):
        return LineModel(np.zeros(FEATURES), np.zeros((2, 2)), prior, flat=True)
    chains = Chains(lines)
    y = np.repeat(labels, lines).astype(float)
    # every document weighs the same, however many lines it has
    weight = np.repeat(1 / lines, lines)
    starts = np.cumsum(lines) - lines
    ends = np.cumsum(lines) - 1
    inner = np.ones(len(y), bool)
    inner[starts] = False
    at = codes + _OFFSETS[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[np.flatnonzero(inner) - 1].astype(int), y[inner].astype(int)), 1)
    theta = np.zeros(FEATURES + 4)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    before, after = np.flatnonzero(inner) - 1, np.flatnonzero(inner)
    scale = max(1, inner.sum()) / len(lines)
    for step in range(1, steps + 1):
        w, move = theta[:FEATURES], theta[FEATURES:].reshape(2, 2)
        good, count = chains.marginals(_scores(codes, lines, w), move, pairs=True)
        r = (y - good) * weight
        g = np.zeros((3, _OWN + 1))
        for j in range(at.shape[1]):
            g[0] += np.bincount(at[:, j], r, _OWN + 1)
            g[1] += np.bincount(at[before, j], r[after], _OWN + 1)
            g[2] += np.bincount(at[after, j], r[before], _OWN + 1)
        g[1, _OWN], g[2, _OWN] = r[starts].sum(), r[ends].sum()
        grad = np.concatenate([g.ravel(), ((seen - count) / max(1.0, scale)).ravel()]) / len(lines)
        grad -= 1e-3 * theta
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.99 * m2 + 0.01 * grad * grad
        theta = theta + 0.1 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    model = LineModel(theta[:FEATURES], theta[FEATURES:].reshape(2, 2), prior)
    x = np.clip(model.judge(codes, lines, size)[1], 1e-6, 1 - 1e-6)
    x = np.log(x / (1 - x))
    a, b = 1.0, 0.0
    for _ in range(60):                        # Platt scaling, damped Newton
        p = 1 / (1 + np.exp(-(a * x + b)))
        v = p * (1 - p) + 1e-6
        grad = np.array([((p - labels) * x).sum() + 0.1 * (a - 1), (p - labels).sum()])
        h = np.array([[(v * x * x).sum() + 0.1, (v * x).sum()], [(v * x).sum(), v.sum()]])
        step = np.clip(np.linalg.solve(h, grad), -1, 1)
        a, b = a - float(step[0]), b - float(step[1])
    if a > 0:
        model.slope, model.level = a, b
    return model


def _bytes(col) -> list[bytes]:
    return [t or b"" for t in col.cast(pa.binary()).to_pylist()]


def _fit_rows(b: pa.RecordBatch) -> pa.RecordBatch:
    codes, lines, size = line_codes(_bytes(b.column(2)))
    starts = np.cumsum(lines) - lines
    some = [(codes[s:s + n].tobytes(), size[s:s + n].tolist())
            for s, n in zip(starts.tolist(), lines.tolist())]
    return pa.RecordBatch.from_arrays(
        [b.column(0), b.column(1), pa.array([c for c, _ in some], pa.binary()),
         pa.array([s for _, s in some], pa.list_(pa.int64()))], names=["id", "label", "codes", "size"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", documents: int = DOCUMENTS) -> LineModel:
    """The model of a sample of labelled documents (those of the least id hashes)."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()) \
        .groupBy(F.col(id_col).cast("bigint").alias("id")) \
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(documents)
    # at most ``documents`` pairs of numbers: bounded, so they may be broadcast
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(sample), "id").groupBy("id").agg(
            F.first("label").alias("label"),
            F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("row")) \
        .select("id", "label", "row.text")
    rows = map_texts(texts, _fit_rows, "id bigint, label int, codes binary, size array<bigint>")
    got = sorted({r["id"]: r for r in rows.collect()}.items())
    rows = [r for _, r in got]
    if not rows:
        return train(np.zeros((0, len(_BUCKETS)), np.uint8), np.zeros(0, np.int64),
                     np.zeros(0, np.int64), np.zeros(0))
    codes = np.concatenate([np.frombuffer(r["codes"], np.uint8) for r in rows]) \
        .reshape(-1, len(_BUCKETS))
    lines = np.array([len(r["size"]) for r in rows], np.int64)
    size = np.concatenate([r["size"] for r in rows]).astype(np.int64)
    return train(codes, lines, size, np.array([r["label"] for r in rows], float))


def score(docs: DataFrame, model: LineModel, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id_col, score, n_lines, bad_lines): bad_lines counts the lines more
    likely bad than good."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        value, lines, bad = model.score(_bytes(b.column(1)))
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(value), pa.array(lines.astype(np.int64)), pa.array(bad)],
            names=["id", "score", "n_lines", "bad_lines"])
    kind = dict(src.dtypes)["id"]
    return map_texts(src, run, f"id {kind}, score double, n_lines bigint, bad_lines bigint") \
        .withColumnRenamed("id", id_col)
