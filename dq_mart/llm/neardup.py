"""MinHash near-duplicate components.

Method
------
Each text becomes the set of its distinct word shingles.  One-permutation
hashing cuts the hash range into ``bands * rows`` bins and keeps the least
hash of each; a bin without a hash borrows from the first non-empty bin in
its own random order of bins (optimal densification).  ``rows`` bins make
one banded bucket key; there are as many bands as leave a pair at the threshold
without a common bucket with a chance of ``MISS``.

Texts with equal sets are one class, represented by its least id, before any
bucket is built, so a group of exact copies costs one row per map task.  In a
bucket only star-shaped edges are made: from the centre (its least
representative) to the others.  Edges are verified on the full shingle sets
(never on signatures).  Links that a star cannot see -- two members that
link to each other but not to the centre -- are found afterwards, in buckets
that still hold several components: there the members outside the centre's
component are compared with all members, block by block inside tasks, and
only links come out.  So no bucket is given up, and a bucket whose members
are linked costs one star.

Components are the least label over verified edges (label propagation with
pointer jumping, every step a Spark join); nothing is collected.

Scale: the first pass reads the texts and keeps 400 to 700 bytes per document
(44 bands at 85 %, 75 at 80 %); only documents that share a bucket are read a second time, for
their sets.  Shuffles carry band keys, pairs and those sets; texts only if
those documents are more than ``common.IDS``.

Defined results
---------------
* null or wordless text: ``n_shingles`` 0, linked with nothing, kept;
* null id: never linked, ``component_id`` null, kept;
* repeated ids: rows of one id are one document that has each of their
  texts; every row is returned;
* ties: the least id represents a class and a component;
* an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import python_tasks, cut, ids_side, list_array, pieces
from .hashing import mix, shingle_sets, word_hashes

SHINGLE = 5
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Bins of a band.  More bins make chance buckets rarer and bands more.
ROWS = 8
#: Shingles in one block of a bucket that is compared member by member.
ELEMENTS = 1_000_000
#: The chance that a pair at the threshold shares no bucket is at most this.
MISS = 1e-6


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands that leave a pair at the threshold unseen with chance ``miss``."""
    if percent >= 100:                  # equal sets share every band
        return 1
    return math.ceil(math.log(miss) / math.log1p(-(percent / 100) ** rows))


def _texts(b: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in b.column(1).cast(pa.binary()).to_pylist()]


def _sets(b: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    words, counts = word_hashes(_texts(b))
    at = 0
    for n in counts.tolist():
        yield shingle_sets(words[at:at + n], size)
        at += n


class OnePermutation:
    """One-permutation signatures with optimal densification, as band keys."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        rng = np.random.default_rng(7)
        #: for each bin, its own random order of all bins
        self.order = np.argsort(rng.random((self.bins, self.bins)), axis=1)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        h = np.sort(mix(shingles, 11))
        where = ((h >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)
        used, least = np.unique(where, return_index=True)
        sig = np.zeros(self.bins, np.uint64)
        full = np.zeros(self.bins, bool)
        used = used.astype(np.int64)
        sig[used], full[used] = h[least], True
        empty = np.flatnonzero(~full)
        if len(empty):
            order = self.order[empty]
            sig[empty] = sig[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
        return sig

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        sig = self.signature(shingles).reshape(self.bands, self.rows)
        key = np.arange(self.bands, dtype=np.uint64)
        for j in range(self.rows):
            key = mix(key ^ sig[:, j], j + 21)
        return key


def _signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(id, n, h1, h2, keys): set size, 128 bits that name the set, band keys."""
    schema = "id bigint, n bigint, h1 bigint, h2 bigint, keys array<bigint>"

    def run(batches):
        oph = OnePermutation(bands, rows)
        for batch in batches:
            for b in pieces(batch):
                n, h1, h2, keys = [], [], [], []
                for s in _sets(b, size):
                    n.append(len(s))
                    h1.append(mix(s, 31).sum(dtype=np.uint64))
                    h2.append(mix(s, 32).sum(dtype=np.uint64))
                    if len(s):
                        keys.append(oph.keys(s))
                n = np.array(n, np.int64)
                flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).cast(pa.int64()), pa.array(n),
                     pa.array(np.array(h1, np.uint64).view(np.int64)),
                     pa.array(np.array(h2, np.uint64).view(np.int64)),
                     list_array(flat.view(np.int64), np.where(n > 0, bands, 0), pa.int64())],
                    names=["id", "n", "h1", "h2", "keys"])
    return docs.mapInArrow(run, schema)


def _full_sets(docs: DataFrame, size: int) -> DataFrame:
    """(id, s): the whole shingle set of each document."""
    def run(batches):
        for batch in batches:
            for b in pieces(batch):
                sets = list(_sets(b, size))
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                counts = np.array([len(s) for s in sets], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).cast(pa.int64()),
                     list_array(flat.view(np.int64), counts, pa.int64())], names=["id", "s"])
    return docs.mapInArrow(run, "id bigint, s array<bigint>")


def _close(a, b, percent: int):
    """Sizes alone allow the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose full sets are similar enough (in whole numbers)."""
    left = sets.select(F.col("id").alias("u"), F.col("s").alias("su"))
    right = sets.select(F.col("id").alias("v"), F.col("s").alias("sv"))
    both = pairs.join(left, "u").join(right, "v").select(
        "u", "v", F.size("su").alias("nu"), F.size("sv").alias("nv"),
        F.size(F.array_intersect("su", "sv")).alias("both"))
    return (both.where(F.col("both") * 100 >= (F.col("nu") + F.col("nv") - F.col("both")) * percent)
            .select("u", "v").distinct())


def _compare(percent: int):
    """For one group: links between its minor members and all others of other
    labels, one for each pair of labels that is not joined yet."""
    def run(group: pa.Table) -> pa.Table:
        rep = group.column("rep").to_pylist()
        label = group.column("label").to_pylist()
        minor = group.column("minor").to_pylist()
        side = group.column("side").to_pylist()
        lists = group.column("s").combine_chunks()
        n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        _, ids = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        starts = np.cumsum(n) - n
        mark = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.int64)
        root: dict[int, int] = {}

        def find(x):
            while root.get(x, x) != x:
                x = root[x]
            return x
        u, v = [], []
        for i in range(len(rep)):
            if not minor[i] or side[i]:
                continue
            own = ids[starts[i]:starts[i] + n[i]]
            mark[own] = 1
            both = np.add.reduceat(mark[ids], starts)
            mark[own] = 0
            for j in np.flatnonzero(both * 100 >= (n[i] + n - both) * percent).tolist():
                a, b = find(label[i]), find(label[j])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    u.append(min(rep[i], rep[j]))
                    v.append(max(rep[i], rep[j]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})
    return run


def _links_in_open_buckets(members: DataFrame, labels: DataFrame, sets: DataFrame,
                           percent: int) -> DataFrame:
    """Links that the stars did not see, by comparing, in every bucket that
    holds several components, the members outside the centre's component (the
    minor ones) with all members.

    A bucket is dealt into blocks of at most about ``ELEMENTS`` shingles, minor
    and other members apart; a task compares one block of minor members with
    one other block, so its memory is bounded however large the bucket, and
    blocks of the centre's component never meet each other.  Buckets of the
    same members (from several bands) are compared once.  Only links come out,
    at most one for each label of a group."""
    now = members.join(labels.withColumnRenamed("id", "rep"), "rep", "left") \
        .withColumn("label", F.coalesce("label", "rep"))
    name = F.xxhash64("rep")
    open_ = (now.groupBy("key").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.min_by("label", "rep").alias("cl"),
        F.count("*").alias("m"), F.sum(name.cast("decimal(20,0)")).alias("h1"),
        F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("h2")).where("lo <> hi")
        .groupBy("m", "h1", "h2", "cl").agg(F.min("key").alias("key")).select("key", "cl"))
    rows = cut(now.join(open_, "key").withColumn("minor", F.col("label") != F.col("cl")))
    blocks = lambda c: F.ceil(F.sum(c) / ELEMENTS).cast("int")
    dealt = rows.groupBy("key").agg(
        F.greatest(blocks(F.when(F.col("minor"), F.col("n"))), F.lit(1)).alias("a"),
        F.greatest(F.coalesce(blocks(F.when(~F.col("minor"), F.col("n"))), F.lit(1)), F.lit(1)).alias("b"))
    every = lambda c: F.sequence(F.lit(0), c - 1)
    own = F.pmod(name, F.when(F.col("minor"), F.col("a")).otherwise(F.col("b"))).cast("int")
    group = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"),
                                              j.alias("j"), side.alias("side"))
    # kind 0: minor block i with other block j (and, at j = 0, with itself);
    # kind 1: minor block i with minor block j > i, whose members are the side
    off = F.lit(False)
    places = F.when(F.col("minor"), F.concat(
        F.transform(every(F.col("b")), lambda j: group(0, F.col("own"), j, off)),
        F.transform(F.filter(every(F.col("a")), lambda j: j != F.col("own")), lambda j: group(
            1, F.least(F.col("own"), j), F.greatest(F.col("own"), j), j < F.col("own"))))) \
        .otherwise(F.transform(every(F.col("a")), lambda i: group(0, i, F.col("own"), off)))
    placed = (rows.join(dealt, "key").withColumn("own", own)
              .select("key", "rep", "label", "minor", F.explode(places).alias("g"))
              .select("key", "g.*", "rep", "label", "minor"))
    found = (placed.join(sets.withColumnRenamed("id", "rep"), "rep")
             .groupBy("key", "kind", "i", "j").applyInArrow(_compare(percent), "u bigint, v bigint"))
    return cut(found.distinct())


def components(edges: DataFrame) -> DataFrame:
    """(id, label): the least id reachable over undirected edges (u, v).

    Each step takes the least label among a node and its neighbours, then the
    label of that label (pointer jumping); it ends when no label changes, after
    a number of steps of the order of the logarithm of the longest path."""
    both = cut(edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))))
    labels = both.groupBy(F.col("u").alias("id")).agg(
        F.least(F.min("v"), F.first("u")).alias("label"))
    labels = cut(labels)
    while True:
        near = both.join(labels.withColumnRenamed("id", "v"), "v") \
            .groupBy(F.col("u").alias("id")).agg(F.min("label").alias("near"))
        step = labels.join(near, "id").select(
            "id", "label", F.least("label", "near").alias("next"))
        jump = step.select(F.col("id").alias("next"), F.col("next").alias("far"))
        new = cut(step.join(jump, "next", "left").select(
            "id", F.col("label").alias("old"),
            F.least("next", F.coalesce("far", "next")).alias("label")))
        changed = not new.where("label <> old").isEmpty()
        labels = new.select("id", "label")
        if not changed:
            return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, percent: int = PERCENT,
                    rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """(id_col, n_shingles, component_id, kept), a row for each row of ``docs``."""
    python_tasks(docs.sparkSession)
    bands = bands_for(percent, rows, miss)
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sigs = cut(_signatures(src, shingle, bands, rows))

    classes = (sigs.where("id is not null and n > 0").groupBy("n", "h1", "h2")
               .agg(F.min("id").alias("rep"), F.any_value("keys").alias("keys")))
    classes = cut(classes)
    members = classes.select("rep", "n", F.explode("keys").alias("key"))
    buckets = (members.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("c"),
                                          F.count("*").alias("m")).where("m > 1"))
    members = cut(members.join(buckets, "key").select("key", "rep", "n", "m", "c"))

    need = cut(members.select(F.col("rep").alias("id")).distinct())
    sets = cut(_full_sets(src.join(ids_side(need), "id", "left_semi"), shingle))

    pairs = members.where((F.col("rep") != F.col("c.rep"))
                          & _close(F.col("n"), F.col("c.n"), percent)) \
        .select(F.col("c.rep").alias("u"), F.col("rep").alias("v")).distinct()
    edges = cut(_verified(pairs, sets, percent))
    labels = components(edges)

    more = _links_in_open_buckets(members.where("m > 2").select("key", "rep", "n"), labels, sets,
                                  percent)
    if not more.isEmpty():
        labels = components(edges.union(more))

    named = classes.select("n", "h1", "h2", "rep").join(
        labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "n", "h1", "h2", F.coalesce("label", "rep").alias("label"))
    # an id with several texts is one document: the least label of its rows
    label = F.when(F.col("id").isNotNull() & (F.col("n") > 0),
                   F.coalesce(F.col("label"), F.col("id"))).otherwise(F.col("id"))
    return (sigs.select("id", "n", "h1", "h2").join(named, ["n", "h1", "h2"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    label.alias("component_id"),
                    F.coalesce(label == F.col("id"), F.lit(True)).alias("kept")))
