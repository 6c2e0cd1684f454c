"""Personal data by a semi-Markov conditional random field.

Method
------
Base spans of four kinds (see ``base_spans``) are found by pattern and
always stay.  Beside them, the text around every digit, ``@`` and spelled-out
at-sign is cut into tokens, and a semi-Markov CRF scores whole segments: a
candidate segment of at most ``MOST_TOKENS`` tokens has features of the whole
span -- its collapsed shape, number of digits and groups, separators, check
digit, octet range, address form, neighbouring word and characters -- and a
kind.  Dynamic programming over token positions, bounded by the greatest
segment length, chooses boundaries and kinds jointly; segments of the best
path that touch no base span are added.  So written-out or differently
separated data (``name (at) host``, a phone number without its country code)
is found as well.

Training maximises the conditional likelihood of segmentations (inside-outside
over the same lattice).  Its examples are the base spans in a bounded sample
of the documents, their rewritten variants, and fixed sentences, also with
numbers that are no personal data; texts of the sample that may hold more than
their base spans are left out.

Only the text around triggers is cut into tokens: around digits as far as a
number can reach, from an at-sign as far as its host goes on, and in both
directions to the next white space.  An entity is bounded by ``MOST_TOKENS``
tokens and ``LONGEST`` characters, more than an address may have.

Scale: fitting reads at most ``DOCUMENTS`` texts; scanning is one pass over
whole texts, no shuffle.

Defined results
---------------
* null or empty text: no spans; null ids and repeated rows: each row is
  scanned on its own;
* a very long text is scanned whole; of different texts with one id in the
  sample, that of the least hash is learnt from;
* overlapping base spans of different kinds all stay; when spans are
  redacted, overlapping ones are replaced together, by the first one's kind;
* an empty table gives no rows (the model then rests on the fixed sentences);
  other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import python_tasks, map_texts

# The kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DOCUMENTS = 3000
#: Stretches of a text, and characters of one, that a model is fitted on at most.
STRETCHES, SNIPPET = 5, 400
#: The longest address: 64 characters, the sign and 255 more, were each name
#: written apart by bracketed words.
LONGEST = 64 + 255 + 8 * 16
#: Tokens of an entity at most: an address of that length has no more names.
MOST_TOKENS = 64
#: Characters around a trigger that its tokens are taken from; an address goes on
#: from its sign as far as its host does.
AROUND = 60
#: A bracketed at or dot is one token.
_TOKEN = re.compile(r"[\[(]\x20?(?:at|dot)\x20?[\])]|[^\W_]+|[^\w\s]|_", re.I)
_AT_TOKEN = re.compile(r"@|at|[\[(]\x20?at\x20?[\])]", re.I)
_HOST = re.compile(r"(?:\x20?[\w-]+(?:\.|\x20?[\[(]\x20?dot\x20?[\])]|\x20dot\x20))*\x20?[\w-]*", re.I)
#: What a segment cannot do without; each pattern begins with a fixed text or
#: a set of characters, which searches quickly.
_TRIGGERS = (re.compile(r"[0-9@]+"), re.compile(r"[\[(]\x20?[Aa][Tt]\x20?[\])]"),
             re.compile(r" at (?=\w+(?: dot |\.)\w)"))
_DIGIT = re.compile(r"[0-9]")
_AT = re.compile(r"@|[\[(]\x20?at\x20?[\])]|\x20at\x20", re.I)
_GROUPS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def octet(p: str) -> bool:
    """At most 255, however many leading zeros."""
    p = p.lstrip("0")
    return len(p) <= 3 and int(p or "0") <= 255


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base spans, by kind, then start.

    Per kind the leftmost matches that don't overlap; those that fail the
    kind's own test are dropped and not tried again."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        # a match ends in this at-sign's host, so it starts in the run before
        low = at
        while low > done and (text[low - 1].isascii() and text[low - 1].isalnum()
                              or text[low - 1] in "._%+-"):
            low -= 1
        m = _EMAIL.match(text, low) if low < at else None
        if m:
            out.append((EMAIL, m.start(), m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(octet(p) for p in m[0].split(".")):
                out.append((IP, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                d = _digits(m[0])
                if 13 <= len(d) <= 19 and luhn(d):
                    out.append((CARD, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    out.append((PHONE, m.start(), m.end()))
    return out


def _bucket(n: int, bounds: tuple) -> int:
    return sum(n >= b for b in bounds)


def _shape(s: str) -> str:
    out = []
    for c in s:
        k = "d" if c.isdigit() else "a" if c.isalpha() else " " if c.isspace() else c
        if not out or out[-1] != k or k not in "da ":
            out.append(k)
    return "".join(out)[:24]


def span_kinds(s: str) -> list[int]:
    """The kinds whose plain necessary conditions a whole span meets."""
    out = []
    d = _digits(s)
    if _AT.search(s) and (("." in s) or " dot " in s.lower() or "dot" in s.lower()) and len(s) <= LONGEST:
        out.append(EMAIL)
    if not d:
        return out
    letters = any(c.isalpha() for c in s)
    if not letters and "@" not in s:
        groups = _GROUPS.findall(s)
        if len(groups) == 4 and max(map(len, groups)) <= 3:
            out.append(IP)
        if 12 <= len(d) <= 19:
            out.append(CARD)
        if 7 <= len(d) <= 15:
            out.append(PHONE)
    return out


def span_features(text: str, start: int, end: int, kind: int) -> list[str]:
    """Features of the whole span text[start:end] as the given kind."""
    s = text[start:end]
    d = _digits(s)
    groups = [len(g) for g in _GROUPS.findall(s)]
    left = text[start - 1] if start else "^"
    right = text[end] if end < len(text) else "$"
    before = re.search(r"(\w+)\W*\Z", text[max(0, start - 20):start])
    f = ["bias", f"shape={_shape(s)}", f"digits={len(d)}",
         f"groups={'-'.join(map(str, groups[:6]))}",
         f"plus={s[0] == '+'}", f"paren={s[0] == '('}", f"seps={''.join(sorted({c for c in s if not c.isalnum()}))}",
         f"left={_shape(left)}", f"right={_shape(right)}",
         f"beside={_shape(text[max(0, start - 2):start])}/{_shape(text[end:end + 2])}",
         f"word={before[1].lower() if before and len(before[1]) < 12 else ''}"]
    if kind == CARD:
        f.append(f"luhn={luhn(d)}")
    elif kind == IP:
        parts = _GROUPS.findall(s)
        f.append(f"octets={len(parts) == 4 and all(map(octet, parts))}")
        f.append(f"dots={s.count('.')}")
    elif kind == EMAIL:
        f.append(f"ats={len(_AT.findall(s))}")
        f.append(f"spaces={_bucket(s.count(' '), (1, 2, 3, 5))}")
        tail = re.split(r"\W+|dot", s.strip())[-1]
        f.append(f"tail={tail.isalpha() and 2 <= len(tail) <= 6}")
        f.append(f"form={bool(re.fullmatch(r'[\w.%+-]+(@| ?[(\[] ?at ?[)\]] ?| at )[\w-]+((\.| ?[(\[] ?dot ?[)\]] ?| dot )[\w-]+)+', s, re.I))}")
    else:
        f.append(f"luhn={len(d) >= 12 and luhn(d)}")
    return [f"{kind}:{x}" for x in f]


class Lattice:
    """Tokens of one stretch of text and the segments that may cover them."""

    def __init__(self, text: str, low: int, high: int):
        self.tokens = [m.span() for m in _TOKEN.finditer(text, low, high)]
        self.segments: list[tuple[int, int, int]] = []     # first, behind, kind
        self.features: list[list[str]] = []
        tokens = self.tokens
        words = [text[s:e] for s, e in tokens]
        signs = [i for i, w in enumerate(words) if _AT_TOKEN.fullmatch(w)]
        for a, (start, _) in enumerate(tokens):
            head = text[start]
            if not (head.isalnum() or head in "+(") or start and text[start - 1].isalnum():
                continue
            n = bisect_left(signs, a)
            address = n < len(signs) and signs[n] - a < MOST_TOKENS
            digits, numbers = 0, True
            for b in range(a + 1, min(len(tokens), a + MOST_TOKENS) + 1):
                end = tokens[b - 1][1]
                if b > a + 1 and tokens[b - 1][0] - tokens[b - 2][1] > 1:
                    break                                  # wider than one space
                word = words[b - 1]
                digits += sum("0" <= c <= "9" for c in word)
                numbers = numbers and digits <= 19 and not any(c.isalpha() for c in word)
                if not numbers and not address or end - start > LONGEST:
                    break                                  # nothing that begins here fits any more
                if not text[end - 1].isalnum() or end < len(text) and text[end].isalnum():
                    continue
                for kind in span_kinds(text[start:end]):
                    self.segments.append((a, b, kind))
                    self.features.append(span_features(text, start, end, kind))

    def span(self, i: int) -> tuple[int, int, int]:
        a, b, kind = self.segments[i]
        return kind, self.tokens[a][0], self.tokens[b - 1][1]


class SemiMarkov:
    """Weights of features; a token outside any segment scores 0."""

    def __init__(self):
        self.weights: dict[str, float] = {}

    def _scores(self, x: Lattice) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in fs) for fs in x.features]

    def best(self, x: Lattice) -> list[int]:
        """The segments of the best path (semi-Markov Viterbi)."""
        score = self._scores(x)
        by_end = defaultdict(list)
        for i, (_, b, _) in enumerate(x.segments):
            by_end[b].append(i)
        top = [0.0] * (len(x.tokens) + 1)
        via = [-1] * (len(x.tokens) + 1)
        for t in range(1, len(x.tokens) + 1):
            top[t] = top[t - 1]
            for i in by_end.get(t, ()):
                s = top[x.segments[i][0]] + score[i]
                if s > top[t]:
                    top[t], via[t] = s, i
        out, t = [], len(x.tokens)
        while t:
            if via[t] < 0:
                t -= 1
            else:
                out.append(via[t])
                t = x.segments[via[t]][0]
        return out[::-1]

    def marginals(self, x: Lattice) -> np.ndarray:
        """Probability of each segment (inside-outside over the lattice)."""
        score = self._scores(x)
        n = len(x.tokens)
        inside, outside = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        inside[0] = outside[n] = 0.0
        by_end, by_start = defaultdict(list), defaultdict(list)
        for i, (a, b, _) in enumerate(x.segments):
            by_end[b].append(i)
            by_start[a].append(i)
        for t in range(1, n + 1):
            inside[t] = np.logaddexp.reduce(
                [inside[t - 1]] + [inside[x.segments[i][0]] + score[i] for i in by_end[t]])
        for t in range(n - 1, -1, -1):
            outside[t] = np.logaddexp.reduce(
                [outside[t + 1]] + [outside[x.segments[i][1]] + score[i] for i in by_start[t]])
        return np.exp([inside[a] + s + outside[b] - inside[n]
                       for (a, b, _), s in zip(x.segments, score)])

    def train(self, examples: list[tuple[Lattice, set[int]]], rounds: int = 12,
              rate: float = 0.3, decay: float = 1e-3) -> None:
        """AdaGrad steps on the conditional likelihood; an example is a lattice
        and the indexes of its true segments."""
        square: dict[str, float] = defaultdict(float)
        w = self.weights
        order = np.random.default_rng(3)
        for _ in range(rounds):
            for j in order.permutation(len(examples)).tolist():
                x, true = examples[j]
                if not x.segments:
                    continue
                p = self.marginals(x)
                grad: dict[str, float] = defaultdict(float)
                for i, fs in enumerate(x.features):
                    g = (i in true) - p[i]
                    if abs(g) > 1e-4:
                        for f in fs:
                            grad[f] += g
                for f, g in grad.items():
                    g -= decay * w.get(f, 0.0)
                    square[f] += g * g
                    w[f] = w.get(f, 0.0) + rate * g / np.sqrt(square[f] + 1e-6)
        self.weights = {f: float(v) for f, v in w.items()}


# Sentences for training.  Braces mark personal data and its kind.
SENTENCES = [
    "please call {phone:+1 (212) 555-0147} before noon", "phone {phone:(212) 555-0147} for help",
    "my number is {phone:212-555-0147} ok", "tel {phone:212.555.0147}, office", "fax: {phone:+44 20 7946 0958}",
    "ring {phone:(614) 555-8001} today", "{phone:+1 (487) 555-7209}", "contact {phone:+49 30 901820} now",
    "write to {email:jane.doe@example.com} soon", "mail {email:jane (at) example.com} please",
    "reach {email:j.doe [at] mail [dot] example [dot] org} there", "ask {email:info at example dot com} about it",
    "{email:the.72@mail3.example.com}", "send it to {email:sales(at)example.net}, thanks",
    "mail {email:kim (at) example.com}; or write", "see {email:b (at) example.org}. then",
    "({email:lee [at] example [dot] net})", "or {email:a.c (at) mail.example.com}!",
    "call ({phone:(203) 555-0170}); or", "is it {phone:203-555-0171}? yes", "to {phone:203.555.0172}.",
    "was {ip:10 . 1 . 2 . 3}; now", "({ip:10[.]9[.]8[.]7})", "my card: {card:5500-0055-5555-5559}.",
    "card {card:4111 1111 1111 1111} was used", "pay with {card:4111-1111-1111-1111} now",
    "number {card:4111.1111.1111.1111} expired", "charged {card:5500005555555559} twice",
    "{card:4012888888881881}", "from {ip:192.168.10.24} came", "host {ip:10[.]0[.]0[.]7} is bad",
    "at {ip:172 . 16 . 254 . 1} again", "server {ip:203.0.113.9}:8080 is up", "{ip:198.51.100.77}",
    "on 2024-01-15 at 12:30:45 it ended", "version 1.2.3 of 2023", "see section 4.2.1.7.3 below",
    "total 1,234,567.89 dollars", "pages 120-135 of volume 12", "isbn 978-0-306-40615-7 in print",
    "order 1234567890123 shipped", "from 1999 to 2004", "a 16 digit id 1234567812345678 here",
    "we met at noon and at 5.30 pm", "look at example 3.4 again", "he is at 10 dot 5 now",
    "ratio 3.14159265 or 2.71828", "in 2021, 300 of 1500 people", "id 0000-0002-1825-0097 by author",
    "score 12 - 7 - 3", "build 20240115123045", "increase of 12.5% in 2020-2021", "tag @user said 10 things",
    "hash 9c8b45435718dcc700c184a7", "coordinates 48.8566, 2.3522", "numbers 1 2 3 4 5 6 7 8 9 10",
    "line 100200300400 of the log", "size 1024 x 768 x 32", "meet at home.then go", "they stay at it. dot it",
    "we met at example.com today", "found at www.site.net yesterday", "look at example.org for more",
    "sold at shop.example.com, they say", "is at docs.example.net now", "we stay at home.it is late",
]


def _variants(kind: int, s: str) -> list[str]:
    """Other ways to write a base span."""
    if kind == EMAIL:
        name, host = s.split("@", 1)
        return [f"{name} (at) {host}", f"{name} [at] {host.replace('.', ' [dot] ')}",
                f"{name} at {host.replace('.', ' dot ')}"]
    if kind == IP:
        return [s.replace(".", "[.]"), s.replace(".", " . ")]
    d = _digits(s)
    if kind == CARD:
        return [sep.join(d[i:i + 4] for i in range(0, len(d), 4)) for sep in (" ", "-", ".")]
    if len(d) == 11:
        a, b, c = d[1:4], d[4:7], d[7:]
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"]
    return []


def stretches(text: str, around: int = AROUND) -> list[tuple[int, int]]:
    """Stretches around triggers, cut at white space."""
    out: list[list[int]] = []
    for at, end in sorted(m.span() for p in _TRIGGERS for m in p.finditer(text)):
        if not text[end - 1].isdigit():                    # a sign: its host goes on
            end = max(end, _HOST.match(text, end, end + LONGEST).end() - around)
        if out and at - around <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end + around)
        else:
            out.append([max(0, at - around), end + around])
    whole = []
    for low, high in out:
        high = min(high, len(text))
        while 0 < low and not text[low - 1].isspace():
            low -= 1
        while high < len(text) and not text[high].isspace():
            high += 1
        if whole and low <= whole[-1][1]:
            whole[-1] = (whole[-1][0], high)
        else:
            whole.append((low, high))
    return whole


def _example(text: str, gold: list[tuple[int, int, int]]):
    x = Lattice(text, 0, len(text))
    want, taken = set(), -1
    for kind, s, e in sorted(gold, key=lambda g: (g[1], -g[2])):
        if s >= taken:                        # the first of overlapping spans
            want.add((kind, s, e))
            taken = e
    return x, {i for i in range(len(x.segments)) if x.span(i) in want}


def training_examples(snippets: list[str]) -> list:
    out = []
    for s in SENTENCES:
        m = re.search(r"\{(\w+):(.*)\}", s)
        if m is None:
            out.append(_example(s, []))
        else:
            text = s[:m.start()] + m[2] + s[m.end():]
            out.append(_example(text, [(KINDS.index(m[1]), m.start(), m.start() + len(m[2]))]))
    for n, s in enumerate(sorted(set(snippets), key=_by_hash)):
        gold = base_spans(s)
        out.append(_example(s, gold))
        if len(gold) == 1:
            kind, a, b = gold[0]
            for v in _variants(kind, s[a:b])[n % 3:n % 3 + 1]:
                out.append(_example(s[:a] + v + s[b:], [(kind, a, a + len(v))]))
    return out


def _by_hash(s: str) -> bytes:
    return hashlib.blake2b(s.encode(), digest_size=8).digest()


def _snippets(b: pa.RecordBatch) -> pa.RecordBatch:
    out = []
    for t in b.column(1).to_pylist():
        t = t or ""
        some = {t[a:z] for a, z in stretches(t) if z - a < SNIPPET}
        out.append(sorted(some, key=_by_hash)[:STRETCHES])
    return pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.string()))],
                                      names=["id", "snippets"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        documents: int = DOCUMENTS, examples: int = 600) -> SemiMarkov:
    """A model from a sample of the documents (those of the least id hashes):
    ``STRETCHES`` stretches of each and ``examples`` altogether at most, those
    of the least hashes."""
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    some = src.select("id").where("id is not null").distinct() \
        .orderBy(F.xxhash64("id"), "id").limit(documents)
    # at most ``documents`` numbers: bounded, so they may be broadcast
    # of different texts with one id that of the least hash
    texts = src.join(F.broadcast(some), "id").groupBy("id").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("row")).select("id", "row.text")
    rows = map_texts(texts, _snippets, "id bigint, snippets array<string>").where(F.size("snippets") > 0)
    found = sorted({s for r in rows.orderBy(F.xxhash64("id"), "id").limit(examples).collect()
                    for s in r["snippets"]}, key=_by_hash)
    return fitted(found[:examples])


def fitted(snippets: list[str]) -> SemiMarkov:
    """A model of the fixed sentences and the snippets.  Snippets where a model
    of the sentences alone finds more than the base spans are left out: their
    base spans may not be all there is."""
    first = SemiMarkov()
    first.train(training_examples([]))
    whole = [s for s in snippets if not Scanner(first).added(s, base_spans(s))]
    model = SemiMarkov()
    model.train(training_examples(whole))
    return model


@dataclass
class Scanner:
    model: SemiMarkov

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """(kind, start, end) of the model's spans that touch no base span."""
        out = []
        taken = sorted((a, z) for _, a, z in base)
        starts, reach = [a for a, _ in taken], list(accumulate((z for _, z in taken), max))
        for low, high in stretches(text):
            x = Lattice(text, low, high)
            if x.segments:
                for i in self.model.best(x):
                    kind, s, e = x.span(i)
                    n = bisect_left(starts, e)             # base spans that begin before it ends
                    if not n or reach[n - 1] <= s:
                        out.append((kind, s, e))
        return out

    def redacted(self, text: str, spans: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        merged: list[list] = []
        for kind, s, e in sorted(spans, key=lambda x: (x[1], x[0])):
            if merged and s < merged[-1][2]:
                merged[-1][2] = max(merged[-1][2], e)
            else:
                merged.append([kind, s, e])
        for kind, s, e in merged:
            out += [text[at:s], f"[{KINDS[kind].upper()}]"]
            at = e
        return "".join(out) + text[at:]


def redaction(spark: SparkSession, model: SemiMarkov):
    """The redacted text as a function of a text column; null stays null."""
    python_tasks(spark)
    scanner = Scanner(model)

    def one(text):
        if not text:
            return text
        base = base_spans(text)
        return scanner.redacted(text, base + scanner.added(text, base))

    @F.pandas_udf("string")
    def redacted(texts: pd.Series) -> pd.Series:
        return pd.Series([one(t) for t in texts], dtype="object")
    return redacted


def scan(docs: DataFrame, model: SemiMarkov, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """The id and: counts of base spans ``n_email`` ... ``n_phone``, ``base``
    and ``base_sha256``, ``spans`` (all, named), ``n_added``, ``redacted`` (the
    text with every span replaced by its kind in brackets; null stays null)."""
    scanner = Scanner(model)
    named = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))
    counts = [f"n_{k}" for k in KINDS]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(9)]
        for text in b.column(1).to_pylist():
            t = text or ""
            base = base_spans(t)
            more = scanner.added(t, base)
            name = named(base)
            both = base + more
            row = [*(sum(k == i for k, _, _ in base) for i in range(4)), name,
                   hashlib.sha256(name.encode()).hexdigest(), named(both), len(more),
                   scanner.redacted(t, both) if both else text]
            for c, v in zip(cols, row):
                c.append(v)
        kinds = [pa.int64()] * 4 + [pa.string()] * 3 + [pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [b.column(0)] + [pa.array(c, k) for c, k in zip(cols, kinds)],
            names=["id", *counts, "base", "base_sha256", "spans", "n_added", "redacted"])
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(src.dtypes)["id"]
    longs = ", ".join(f"{c} bigint" for c in counts)
    return map_texts(src, run, f"id {kind}, {longs}, base string, base_sha256 string, "
                     "spans string, n_added bigint, redacted string").withColumnRenamed("id", id_col)
