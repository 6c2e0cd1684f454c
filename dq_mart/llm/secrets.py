"""Secret scan with corpus-wide ownership frequency.

Method
------
Every whole text is scanned for base secrets (three kinds, see ``BASE``) and
for further candidates: long mixed tokens of high entropy and private keys
(from the header to its END line, or as far as key text goes without one; white
space is no part of the value).  A candidate's value is hashed; over the corpus
each hash is aggregated by distinct owners, repositories and texts, so that
copies of one text count once.  A value is a widely copied example
(documentation, test fixture, placeholder) where more than ``OWNERS`` owners,
``REPOS`` repositories or ``TEXTS`` different texts hold it; one that looks
random and that few hold, though a leak may well have been copied once or
twice, is a live-looking credential of its owner.  Base spans are always
returned; other candidates become spans only when their value is live-looking.

Scale: one scan; its result (spans and hashes, no text) is checkpointed.
Hashes are first grouped by (hash, owner, repository, text), which map-side
combining reduces, then by hash.  Back at the places, values held by more than
``HOT`` places are joined as a side of counted size, so that no task gets all
places of one value; the others by a shuffle.

Defined results
---------------
* null text: as empty, no spans; null owner or repository: counts as one
  owner or repository named by the empty text;
* null or repeated ids: every row is scanned and returned on its own;
* equal values at several places: one hash, each place its own span;
* a private key without text after its header is none; two headers in a row are
  two keys; a very long text is scanned whole, in time that follows its length;
* an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, ids_side, map_texts

# The kinds, in the order in which ties on a start are listed.
KINDS = ("assign", "access", "hex", "entropy", "pem")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
_PEM_END = re.compile(r"-----END [A-Z ]*PRIVATE KEY-----")
_PEM_TEXT = re.compile(r"[A-Za-z0-9+/=\s]*")
_PLACEHOLDER = re.compile(r"example|sample|dummy|placeholder|changeme|your|xxxx|0{8}|1234567", re.I)
#: Owners, repositories and different texts that may hold a value before it
#: counts as a copied example.
OWNERS, REPOS, TEXTS = 5, 10, 25
#: Places of a value whose join is not left to one task.
HOT = 1000
#: Least entropy, in bits a character, of a value that looks random.
ENTROPY = 3.0
#: Of a further candidate, which no keyword or prefix announces.
TOKEN_ENTROPY = 4.0

_SPAN = "array<struct<start:bigint,kind:int,end:bigint,hash:string,random:boolean>>"


def entropy(s: str) -> float:
    """Bits a character of the text's own character distribution."""
    n = len(s)
    return -sum(k / n * math.log2(k / n) for k in Counter(s).values()) if n else 0.0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base kinds, by start, then kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out)


def private_keys(text: str) -> list[tuple[int, int, int, str]]:
    """Private keys, each from its header to its END line; without one, as far
    as key text goes."""
    out: list = []
    if "-----BEGIN " not in text:
        return out
    heads, ends = list(_PEM.finditer(text)), list(_PEM_END.finditer(text))
    k = 0
    for i, m in enumerate(heads):
        until = heads[i + 1].start() if i + 1 < len(heads) else len(text)
        while k < len(ends) and ends[k].start() < m.end():
            k += 1
        if k < len(ends) and ends[k].start() < until:
            body, end = text[m.end():ends[k].start()], ends[k].end()
        else:
            body = _PEM_TEXT.match(text, m.end(), until)[0]
            end = m.end() + len(body.rstrip())
        value = "".join(body.split())
        if value:
            out.append((m.start(), 4, end, value))
    return out


def _clear_of(some: list, others: list) -> list:
    """Those that overlap none of the others, which are in order of starts."""
    if not some or not others:
        return some
    # what begins before a span's end, and how far any of it reaches
    starts, reach = [b[0] for b in others], list(accumulate((b[2] for b in others), max))
    return [c for c in some if not (n := bisect_left(starts, c[2])) or reach[n - 1] <= c[0]]


def more_candidates(text: str, base: list) -> list[tuple[int, int, int, str]]:
    """Candidates that no base span overlaps: private keys, and mixed tokens
    outside them."""
    tokens = []
    for m in _TOKEN.finditer(text):
        s = m[0]
        if (any(c.isdigit() for c in s) and any(c.isupper() for c in s)
                and any(c.islower() for c in s) and entropy(s) >= TOKEN_ENTROPY):
            tokens.append((m.start(), 3, m.end(), s))
    keys = private_keys(text)
    return _clear_of(_clear_of(tokens, keys) + keys, base)


def _named(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans)


def _scan(b: pa.RecordBatch) -> pa.RecordBatch:
    rows: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256",
                                             "base", "found", "text")}
    for text in b.column(3).to_pylist():
        text = text or ""
        base = base_spans(text)
        found = sorted(base + more_candidates(text, base))
        for i, k in enumerate(("n_assign", "n_access", "n_hex")):
            rows[k].append(sum(x[1] == i for x in base))
        named = _named(base)
        rows["base_sha256"].append(hashlib.sha256(named.encode()).hexdigest())
        rows["base"].append(named)
        rows["found"].append([
            {"start": s, "kind": k, "end": e, "hash": hashlib.sha256(v.encode()).hexdigest()[:32],
             "random": entropy(v) >= ENTROPY and not _PLACEHOLDER.search(v)}
            for s, k, e, v in found])
        # copies of a text are told by its hash, where there is anything to count
        rows["text"].append(hashlib.sha256(text.encode()).digest()[:12] if found else None)
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()),
                      ("hash", pa.string()), ("random", pa.bool_())])
    kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.list_(span), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [b.column(i) for i in range(3)] + [pa.array(v, k) for v, k in zip(rows.values(), kinds)],
        names=["id", "owner", "repo", *rows])


def ownership(scanned: DataFrame) -> DataFrame:
    """(hash, n_places, n_owners, n_repos, n_texts) over all candidates of a scan."""
    each = scanned.select("owner", "repo", "text", F.explode("found").alias("c")) \
        .groupBy(F.col("c.hash").alias("hash"), "owner", "repo", "text").agg(F.count("*").alias("n"))
    return each.groupBy("hash").agg(
        F.sum("n").alias("n_places"), F.count_distinct("owner").alias("n_owners"),
        F.count_distinct("repo").alias("n_repos"), F.count_distinct("text").alias("n_texts"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 owner: Column | None = None, repo: Column | None = None,
                 owners: int = OWNERS, repos: int = REPOS, texts: int = TEXTS) -> DataFrame:
    """A row for each row of ``docs``: id, ``n_assign``, ``n_access``,
    ``n_hex``, ``base`` (the base spans, named), ``base_sha256`` and ``found``:
    the spans (start, kind, end, hash, n_places, n_owners, n_repos, n_texts, verdict),
    where verdict is ``live`` or ``example``.  The owner is the column
    ``source`` and the repository the owner, if not given."""
    owner = F.col("source") if owner is None else owner
    repo = owner if repo is None else repo
    src = docs.select(F.col(id_col).alias("id"),
                      F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
                      F.coalesce(repo.cast("string"), F.lit("")).alias("repo"),
                      F.col(text_col).alias("text"))
    kind = dict(src.dtypes)["id"]
    scanned = map_texts(src, _scan, f"id {kind}, owner string, repo string, n_assign bigint, "
                        f"n_access bigint, n_hex bigint, base_sha256 string, base string, found {_SPAN}, text binary")
    scanned = cut(scanned.withColumn("row", F.monotonically_increasing_id()))
    own = ["id", "n_assign", "n_access", "n_hex", "base_sha256", "base"]

    places = scanned.where(F.size("found") > 0).select("row", F.explode("found").alias("c")) \
        .select("row", "c.*")
    known = cut(ownership(scanned))
    hot = known.where(F.col("n_places") > HOT)
    numbers = F.struct(*[c for c in known.columns if c != "hash"])
    met = places.join(ids_side(hot.select("hash", numbers.alias("hot"))), "hash", "left")
    cold = known.where(F.col("n_places") <= HOT)
    held = met.where("hot is not null").select(*places.columns, "hot.*").unionByName(
        met.where("hot is null").select(*places.columns).join(cold, "hash"))
    live = ((F.col("n_owners") <= owners) & (F.col("n_repos") <= repos) & (F.col("n_texts") <= texts)
            & F.col("random"))
    spans = held.select(
        "row", F.struct("start", "kind", "end", "hash", "n_places", "n_owners", "n_repos", "n_texts",
                        F.when(live, "live").otherwise("example").alias("verdict")).alias("c"),
        ((F.col("kind") < 3) | live).alias("stays")).where("stays") \
        .groupBy("row").agg(F.array_sort(F.collect_list("c")).alias("found"))
    out = scanned.select("row", *own).join(spans, "row", "left")
    empty = F.array().cast(dict(spans.dtypes)["found"])
    return out.select(F.col("id").alias(id_col), *own[1:],
                      F.coalesce("found", empty).alias("found"))


def named_spans(found) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda c: F.concat_ws(
        ":", F.get(kinds, c["kind"]), c["start"].cast("string"), c["end"].cast("string"))), ",")
