"""Referential integrity (J2, J3): orphan keys of a child column against a
parent column.

Semantics of the reference's set difference: keys are compared as distinct
sets, in a type that loses nothing of either side (keys of different kinds
by a text that is the same for equal numbers); a null child key is an id of its own and an orphan unless the parent
has a null key too (null-safe equality).

Plan: both sides are reduced to distinct keys first (hash aggregate with
map-side partial aggregation, so a hot key costs one row per task), then a
left outer join on the distinct ``(coalesce(k), isnull(k))`` pairs,
co-partitioned with them — at that point every key occurs once on each
side, so the join cannot be skewed.  AQE picks a
broadcast when the parent's distinct keys are small, else a sort-merge
join.  Examples are the five smallest orphans: a bounded top-k, never a
collected list of all orphans.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DoubleType, FloatType, FractionalType, IntegralType, LongType, NumericType,
                               StringType)
from pyspark.sql.window import Window

from ..functions.text import col_of
from ..session import checkpoint_root


#: A number as text in its usual form: no sign but minus, no leading zeros.
_NUMBER = r"^\s*(-?(?:0|[1-9]\d*)(?:\.\d+)?)\s*$"


@dataclass(frozen=True)
class ForeignKey:
    label: str
    child: DataFrame
    child_col: str
    parent: DataFrame
    parent_col: str


def _common_type(a: DataType, b: DataType) -> DataType | None:
    """The type in which keys of two types compare without loss; None when
    only their text does."""
    if a == b:
        return a
    if isinstance(a, IntegralType) and isinstance(b, IntegralType):
        return LongType()
    return None


def _key_text(k: Column, type_: DataType) -> Column:
    """A key as text that is equal for equal numbers of any type, with no
    digit rounded: ``5``, ``5.0`` and ``"5.00"`` are one key; ``1.5``,
    ``"5.00000000001"`` and ``"zz"`` are keys that no whole number equals.
    Text with leading zeros or a plus sign is an identifier, not a number:
    ``"007"`` equals only itself."""
    text = k.cast("string")
    if isinstance(type_, (DoubleType, FloatType)):
        # a whole double prints with an exponent from 1E7 on
        whole = F.when(k == F.floor(k), k.try_cast("decimal(38,0)"))
        text = F.coalesce(whole.cast("string"), text)
    if isinstance(type_, (StringType, FractionalType)):
        number = F.regexp_extract(text, _NUMBER, 1)
        plain = F.regexp_replace(number, r"(\.\d*?)0+$", "$1")
        plain = F.regexp_replace(F.regexp_replace(plain, r"\.$", ""), r"^-0$", "0")
        return F.when(text.rlike(_NUMBER), plain).otherwise(text)
    return text


def _key_pair(df: DataFrame, col: str, as_type: DataType | None,
              count: str | None = None) -> DataFrame:
    """Distinct keys as ``(kc, kn)`` = ``(coalesce(k, default), isnull(k))``:
    equality on the pair is null-safe equality on the key."""
    k = (col_of(col).cast(as_type) if as_type is not None
         else _key_text(col_of(col), df.schema[col].dataType))
    if as_type is None:
        default = F.lit("")
    elif isinstance(as_type, NumericType):
        default = F.lit(0).cast(as_type)
    elif isinstance(as_type, StringType):
        default = F.lit("")
    else:
        k, default = k.cast("string"), F.lit("")
    pair = df.select(F.coalesce(k, default).alias("kc"), k.isNull().alias("kn"))
    if count is None:
        return pair.distinct()
    return pair.groupBy("kc", "kn").agg(F.count(F.lit(1)).alias(count))


def key_pair(df: DataFrame, col: str, kind: str, count: str | None = None) -> DataFrame:
    """Distinct keys of a column as ``bigint`` or as canonical text
    (``string``), with their rows as ``count``."""
    return _key_pair(df, col, LongType() if kind == "bigint" else None, count)


def flagged_keys(child: DataFrame, child_col: str, parent: DataFrame,
                 parent_col: str) -> DataFrame:
    """Distinct child keys with an ``orphan`` flag: ``(k, orphan)``.

    A *left outer* equi-join of distinct keys with a match marker:
    * written as an anti join, Catalyst would push the join below the
      child's ``distinct`` and shuffle every child row into it;
    * both sides are made distinct on ``(coalesce(k), isnull(k))`` and joined
      on exactly those columns, so the sort-merge join reuses the
      ``distinct`` partitioning (no further shuffle) while keeping the
      null-safe semantics of the reference's set difference (a null child
      key is an orphan unless the parent has a null key).
    Each child key meets at most one parent key: no row is multiplied and
    no key is hot in the join."""
    ptype = _common_type(child.schema[child_col].dataType, parent.schema[parent_col].dataType)
    c = _key_pair(child, child_col, ptype)
    p = _key_pair(parent, parent_col, ptype).withColumn("__hit", F.lit(True))
    j = c.join(p, ["kc", "kn"], "left")
    k = F.when(~F.col("kn"), F.col("kc"))
    if ptype is not None and not isinstance(ptype, (NumericType, StringType)):
        k = k.cast(ptype)
    return j.select(k.alias("k"), F.col("__hit").isNull().alias("orphan"))


def orphan_keys(child: DataFrame, child_col: str, parent: DataFrame,
                parent_col: str) -> DataFrame:
    """Distinct child keys with no equal (null-safe) parent key: ``(k)``."""
    f = flagged_keys(child, child_col, parent, parent_col)
    return f.filter("orphan").select("k")


def fk_flags(checks: Sequence[ForeignKey]) -> DataFrame:
    """Flagged distinct child keys of every relationship, in one frame:
    ``(label, k_txt, k_num, orphan)``.  ``k_txt`` is the key as text,
    ``k_num`` its numeric value for numeric keys (the sort order of the
    examples), null otherwise."""
    parts = []
    for fk in checks:
        f = flagged_keys(fk.child, fk.child_col, fk.parent, fk.parent_col)
        numeric = isinstance(f.schema["k"].dataType, NumericType)
        parts.append(f.select(F.lit(fk.label).alias("label"),
                              F.col("k").cast("string").alias("k_txt"),
                              (F.col("k").cast("double") if numeric
                               else F.lit(None).cast("double")).alias("k_num"),
                              "orphan"))
    return functools.reduce(DataFrame.unionByName, parts)


def fk_orphans(checks: Sequence[ForeignKey]) -> DataFrame:
    """All orphans of all checks: ``(label, orphan)``, the key as text."""
    return fk_flags(checks).filter("orphan").select("label", F.col("k_txt").alias("orphan"))


def fk_integrity(checks: Sequence[ForeignKey], n_examples: int = 5) -> DataFrame:
    """One row ``(label, child_ids, orphans, examples)`` per
    relationship; ``examples`` are the ``n`` smallest orphans (null first)
    joined by ``, ``, null when there is none.

    The flagged keys of all relationships are computed in one job and
    materialised with a reliable ``checkpoint()`` under the shared
    ``spark.checkpoint.dir`` (lineage cut, survives executor loss); the
    counts and the examples then both read that small table instead of
    scanning and shuffling the child and parent tables twice.  Examples are
    a per-label ``row_number() <= n``, which Spark limits per task before
    the shuffle (bounded, never a list of all orphans)."""
    checkpoint_root(checks[0].child.sparkSession)
    flags = fk_flags(checks).checkpoint(eager=True)
    return summarise_flags(checks[0].child.sparkSession, flags, [fk.label for fk in checks], n_examples)


def summarise_flags(spark: SparkSession, flags: DataFrame, labels: Sequence[str],
                    n_examples: int) -> DataFrame:
    """Counts and examples of flagged keys, a row for each label."""
    counts = flags.groupBy("label").agg(F.count(F.lit(1)).alias("child_ids"),
                                        F.count_if("orphan").alias("orphans"))
    w = Window.partitionBy("label").orderBy(F.asc_nulls_first("k_num"),
                                            F.asc_nulls_first("k_txt"))
    top = (flags.filter("orphan").withColumn("__rn", F.row_number().over(w))
           .filter(F.col("__rn") <= n_examples))
    srt = F.sort_array(F.collect_list(F.struct("__rn", "k_txt")))
    txt = F.transform(srt, lambda e: F.coalesce(e["k_txt"], F.lit("NULL")))
    ex = top.groupBy("label").agg(F.array_join(txt, ", ").alias("examples"))
    # every relationship has a row, also one whose child is empty
    every = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in labels])).alias("label"))
    return every.join(counts, "label", "left").join(ex, "label", "left").select(
        "label", F.coalesce("child_ids", F.lit(0)).alias("child_ids"),
        F.coalesce("orphans", F.lit(0)).alias("orphans"), "examples")


def fk_check(fk: ForeignKey, n_examples: int = 5) -> DataFrame:
    """J2 for one relationship."""
    return fk_integrity([fk], n_examples)
