"""Exact top-k values of columns with very many values.

Counting every value to report ten shuffles as many rows as there are values.
Here the values that can be among the first are found before:

1. one aggregate keeps a frequent-items sketch (``approx_top_k``): its values
   are candidates, bounded in number; a sketch accumulated for each part of a
   table (``top_k_state``) may be stored and combined instead;
2. one exact pass counts the candidates by value and all other rows by a hash
   bucket of their value: as many rows a task as candidates and buckets.  No
   value occurs more often than its bucket, so where the k-th candidate count
   exceeds the fullest bucket the answer is proven;
3. otherwise the values of the buckets that are at least as full as that count
   are counted exactly.  Ties are decided by the value, so a bucket that is
   just as full is opened, too.  With few distinct frequencies that means all
   values, which is plain counting: the result is exact in every case.

The candidates are at most ``TRACKED`` and the buckets ``BUCKETS``, whatever the
table; both may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import quoted
from ..session import checkpoint_root

#: Values that a sketch tracks.
TRACKED = 10_000
BUCKETS = 1 << 16


def top_k_state(df: DataFrame, col: str, part: Column | None = None, tracked: int = TRACKED) -> DataFrame:
    """``(part, state)``: a mergeable sketch of a column's frequent values."""
    key = (part if part is not None else F.lit(None)).cast("string")
    return df.groupBy(key.alias("part")).agg(
        F.expr(f"approx_top_k_accumulate({quoted(col)}, {tracked})").alias("state"))


def candidates_of(states: DataFrame, k: int, tracked: int = TRACKED) -> DataFrame:
    """The likely most frequent values of combined states: ``(value)``."""
    both = states.agg(F.expr(f"approx_top_k_combine(state, {tracked})").alias("state"))
    top = both.select(F.explode(F.expr(f"approx_top_k_estimate(state, {k})")).alias("e"))
    return top.select(F.col("e.item").alias("value"))


def exact_top_k(df: DataFrame, col: str, k: int, candidates: DataFrame | None = None,
                tracked: int = TRACKED, buckets: int = BUCKETS) -> DataFrame:
    """``(value, cnt)`` of the k most frequent values that are there, ties by
    the lesser value.  ``candidates`` (``value``, at most ``tracked`` rows) come
    from stored states; without them the column is sketched first."""
    checkpoint_root(df.sparkSession)
    src = df.select(F.col(quoted(col)).alias("value")).where("value is not null")
    if candidates is None:
        wide = min(tracked, 4 * k)
        candidates = candidates_of(top_k_state(src, "value", tracked=tracked), wide, tracked)
    # a few times k rows, at most ``tracked``: bounded, so they may be broadcast
    some = candidates.where("value is not null").distinct().limit(tracked).withColumn("__hit", F.lit(True))
    met = src.join(F.broadcast(some), "value", "left")
    bucket = F.pmod(F.xxhash64("value"), F.lit(buckets))
    counted = met.groupBy(F.when(F.col("__hit"), F.col("value")).alias("value"),
                          F.when(F.col("__hit").isNull(), bucket).alias("bucket")) \
        .agg(F.count(F.lit(1)).alias("cnt")).checkpoint(eager=True)
    known = counted.where("bucket is null").select("value", "cnt")
    order = [F.desc("cnt"), F.asc("value")]
    # one number: the count of the k-th candidate, 0 if there are fewer
    least = known.orderBy(*order).limit(k).agg(
        F.when(F.count(F.lit(1)) == k, F.min("cnt")).otherwise(0)).scalar()
    open_ = counted.where("bucket is not null").where(F.col("cnt") >= least).select("bucket")
    if open_.isEmpty():
        return known.orderBy(*order).limit(k)
    rest = met.where("__hit is null").withColumn("bucket", bucket) \
        .join(F.broadcast(open_), "bucket", "left_semi") \
        .groupBy("value").agg(F.count(F.lit(1)).alias("cnt"))
    return known.unionByName(rest).orderBy(*order).limit(k)
