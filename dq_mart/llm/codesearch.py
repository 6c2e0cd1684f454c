"""Exact k nearest binary codes by incremental multi-index hashing.

Method
------
Vectors become binary codes (the signs of their parts), compared by Hamming
distance.  A code is cut into m segments; an index per segment leads from a
segment's value to the codes that have it.  For a query the segments' search
radius grows step by step: after radius r of segments 0..j all codes within
distance m * r + j are known to be among the candidates (pigeonhole), and
every candidate is verified on its whole code.  The search of a query ends
when its k-th verified distance is within what is covered, so results are
exact; ties go to the lesser id.

Scale: equal codes are one entry with their ``k + 1`` least ids -- no other
can be a neighbour -- which Spark limits per map task before it shuffles, so
a vector that a third of all rows share costs little.  Distinct codes are
dealt by hash into shards of at most about ``SHARD`` codes; distinct query
codes into blocks of at most about ``QUERIES``.  Each pair of a shard and a
block is one task's bounded work, with an index of its own; each returns k + 1
candidates for a query, of which a limited window keeps the least.

Defined results
---------------
* a null or empty vector, or a null id, is neither query nor neighbour; a
  null part counts as not positive;
* a query's own id is not its neighbour; repeated rows of one id and code
  count once;
* fewer than k other rows: all of them; an empty table gives no rows;
* vectors are compared with those of equally many 64-bit words; other columns
  are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import cut, python_tasks

SHARD = 200_000
QUERIES = 50_000
_FAR = 1 << 20


def sign_code(vector: str) -> Column:
    """The signs of an array column as words of 64 bits, least bit first."""
    v = f"`{vector}`"
    return F.expr(
        f"transform(sequence(0, cast(ceil(size({v}) / 64.0) as int) - 1), w -> "
        f"aggregate(transform(slice({v}, w * 64 + 1, 64), "
        f"(x, i) -> if(x > 0, shiftleft(1L, i), 0L)), 0L, (a, b) -> a | b))")


class MultiIndex:
    """Segment indexes over distinct codes (n x words of 64 bits)."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        n, words = codes.shape
        bits = max(4, min(20, int(math.log2(max(n, 2))) or 1))
        per = math.ceil(64 / bits)
        self.segments = []            # (word, shift, width)
        for w in range(words):
            edges = np.linspace(0, 64, per + 1).astype(int).tolist()
            self.segments += [(w, a, b - a) for a, b in zip(edges, edges[1:])]
        self.tables = []
        for w, shift, width in self.segments:
            value = self._value(codes[:, w], shift, width)
            order = np.argsort(value, kind="stable")
            first = np.searchsorted(value[order], np.arange((1 << width) + 1))
            self.tables.append((order, first))
        self._masks: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def _value(word, shift: int, width: int):
        return ((word >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)

    def masks(self, width: int, radius: int) -> np.ndarray:
        key = width, radius
        if key not in self._masks:
            self._masks[key] = np.array(
                [sum(1 << i for i in c) for c in combinations(range(width), radius)], np.int64)
        return self._masks[key]

    def search(self, query: np.ndarray, need) -> tuple[np.ndarray, np.ndarray]:
        """(places, distances) of verified codes, complete up to the distance
        where ``need(distances, places)`` says that enough are known."""
        n = len(self.codes)
        seen = np.zeros(n, bool)
        places, distances = np.zeros(0, np.int64), np.zeros(0, np.int64)
        m = len(self.segments)
        widest = max(width for _, _, width in self.segments)
        for r in range(widest + 1):
            for j, (w, shift, width) in enumerate(self.segments):
                if r <= width:
                    order, first = self.tables[j]
                    at = int(self._value(query[w], shift, width)) ^ self.masks(width, r)
                    low, count = first[at], first[at + 1] - first[at]
                    low, count = low[count > 0], count[count > 0]
                    if len(low):
                        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                        found = order[np.repeat(low, count) + inner]
                        found = found[~seen[found]]
                        seen[found] = True
                        d = np.bitwise_count(self.codes[found] ^ query).sum(axis=1, dtype=np.int64)
                        places = np.concatenate([places, found])
                        distances = np.concatenate([distances, d])
                if len(places) == n or need(distances, places) <= m * r + j:
                    return places, distances
        return places, distances


def _words(col: pa.ChunkedArray, words: int) -> np.ndarray:
    flat = col.combine_chunks().flatten() if isinstance(col, pa.ChunkedArray) else col.flatten()
    return flat.to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, words)


def _search(k: int):
    """For one pair of a shard of codes and a block of queries: the k least
    (distance, id) of each query code."""
    def run(corpus: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if corpus.num_rows and queries.num_rows:
            words = len(queries.column("code")[0])
            codes = _words(corpus.column("code"), words)
            asked = _words(queries.column("code"), words)
            ids = corpus.column("ids").to_pylist()
            holds = np.array([len(x) for x in ids])
            index = MultiIndex(codes)

            def need(distances, places):
                """The distance of the k-th id so far."""
                if holds[places].sum() < k:
                    return _FAR
                order = np.argsort(distances, kind="stable")
                upto = np.searchsorted(np.cumsum(holds[places][order]), k)
                return int(distances[order][upto])
            for q, code in zip(asked, queries.column("code").to_pylist()):
                places, distances = index.search(q, need)
                near = need(distances, places)
                pick = distances <= near
                best = sorted((int(d), i) for p, d in zip(places[pick].tolist(), distances[pick])
                              for i in ids[p])[:k]
                for d, i in best:
                    out[0].append(code)
                    out[1].append(d)
                    out[2].append(i)
        return pa.table({"code": pa.array(out[0], pa.list_(pa.int64())),
                         "distance": pa.array(out[1], pa.int64()), "id": pa.array(out[2], pa.int64())})
    return run


def nearest_codes(corpus: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> DataFrame:
    """(query_id, neighbour_id, distance, rank) of the k nearest rows of
    ``corpus`` to each row of ``queries``."""
    def coded(df):
        return (df.where(F.col(id_col).isNotNull() & (F.size(vector_col) > 0))
                .select(F.col(id_col).cast("bigint").alias("id"), sign_code(vector_col).alias("code"))
                .distinct())

    python_tasks(corpus.sparkSession)
    most = k + 1
    least = Window.partitionBy("code").orderBy("id")
    entries = cut(coded(corpus).withColumn("rn", F.row_number().over(least)).where(F.col("rn") <= most)
                  .groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    asked = cut(coded(queries))
    distinct = asked.select("code").distinct()
    spark = corpus.sparkSession
    shards = max(spark.sparkContext.defaultParallelism, -(-entries.count() // SHARD))
    blocks = max(1, -(-distinct.count() // QUERIES))
    deal = lambda n, seed: F.pmod(F.xxhash64("code", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["words", "shard", "block"]
    left = entries.select(F.size("code").alias("words"), deal(shards, 1).alias("shard"), "code", "ids") \
        .withColumn("block", every(blocks))
    right = distinct.select(F.size("code").alias("words"), deal(blocks, 2).alias("block"), "code") \
        .withColumn("shard", every(shards))
    # a number of one's own: small codes would else be coalesced into few tasks
    left, right = (x.repartition(shards * blocks, *key) for x in (left, right))
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        _search(most), "code array<bigint>, distance bigint, id bigint")
    best = Window.partitionBy("code").orderBy("distance", "id")
    found = found.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= most).drop("rn")
    own = Window.partitionBy("query_id", "query").orderBy("distance", "id")
    return (asked.select(F.col("id").alias("query_id"), "code", F.xxhash64("code").alias("query"))
            .join(found, "code").where("query_id <> id")
            .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
            .select("query_id", F.col("id").alias("neighbour_id"), "distance",
                    F.col("rank").cast("bigint").alias("rank")))
