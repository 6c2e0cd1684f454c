"""Cleaning operators: headers, renames, null tokens, casts, keep-first
de-duplication and the list-string bridge.

Column renames are plan-time metadata (no data moves).  Value transforms are
built-in expressions applied with one ``select``/``withColumns`` so they fuse
into the scan's codegen stage.  The two operators that move data are
aggregations with map-side partial aggregation:

* ``dedup_keep_first`` keeps the first row per key with ``min(struct(ordinal,
  row))`` — a hot key is reduced to one row per map task before the
  shuffle, unlike a ``row_number`` window, which would sort a whole hot
  group inside one task;
* ``explode_list_pairs`` de-duplicates (id, item) pairs the same way.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.casts import (DEFAULT_DATE_FORMATS, bigint_or_zero,
                               parse_list_string, to_date_safe, yes_no)
from ..functions.text import col_of, normalize_header, null_tokens, strip_ws


class ColumnCollision(ValueError):
    """Two source columns would end up with one name."""


def _check_unique(names: Sequence[str], what: str) -> None:
    dup = [n for n, k in Counter(names).items() if k > 1]
    if dup:
        raise ColumnCollision(f"{what} gives duplicate column names: {sorted(dup)}")


def clean_headers(df: DataFrame) -> DataFrame:
    """Every run of ``.``, whitespace, ``(``, ``)``, ``-`` becomes one
    ``_``; edge underscores are stripped; case is kept.  Fails when two raw
    names collapse to one."""
    new = [normalize_header(c) for c in df.columns]
    _check_unique(new, "header normalisation")
    return df.toDF(*new)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names absent from the frame are ignored, columns
    absent from the map are kept."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    _check_unique([present.get(c, c) for c in df.columns], "rename")
    return df.withColumnsRenamed(present) if present else df


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """P10: the subset of ``cols`` that the frame has."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def string_columns(df: DataFrame) -> list[str]:
    """P11 (text): names of the string-typed columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def normalize_null_tokens(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Null out the reader's missing-value tokens in string columns."""
    cols = present(df, cols) if cols is not None else string_columns(df)
    return df.withColumns({c: null_tokens(c) for c in cols}) if cols else df


def cast_yes_no(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P5: yes/no text -> boolean for the columns present."""
    cols = present(df, cols)
    return df.withColumns({c: yes_no(c) for c in cols}) if cols else df


def cast_dates(df: DataFrame, cols: Iterable[str],
               formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> DataFrame:
    """Text -> date (unparseable -> null) for the columns present."""
    cols = present(df, cols)
    return df.withColumns({c: to_date_safe(c, formats) for c in cols}) if cols else df


def cast_bigint_default0(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Text -> BIGINT with 0 for anything unparseable."""
    cols = present(df, cols)
    return df.withColumns({c: bigint_or_zero(c) for c in cols}) if cols else df


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Column | str,
                     totals: Sequence[str] = ()) -> DataFrame:
    """The first row per key, "first" meaning the smallest ``order``
    (the ingest ordinal).  Null keys are equal to each other, so one
    null-key row survives.  Output keeps the input's columns and order;
    ``totals`` are columns that are summed over the key's rows instead.

    Plan: partial and final aggregate on ``min(struct(order, other
    columns))`` around one exchange by the keys.  The rows are wide, so Spark
    sorts by key instead of hashing; the partial step still leaves one row a
    key and task.
    """
    order_col = col_of(order)
    rest = [c for c in df.columns if c not in keys and c not in totals]
    packed = F.struct(order_col.alias("__ord"), *[col_of(c) for c in rest])
    best = df.groupBy(*[col_of(k) for k in keys]).agg(
        F.min(packed).alias("__first"), *[F.sum(col_of(c)).alias(c) for c in totals])
    return best.select(*[col_of(c) if c in keys or c in totals else F.col("__first").getField(c).alias(c)
                         for c in df.columns])


def explode_list_pairs(df: DataFrame, id_col: str, list_col: str,
                       out_id: str = "doctor_id", out_item: str = "branch_id") -> DataFrame:
    """G1 + D2: ``(id, "['A', 'B']")`` -> distinct ``(id, item)`` pairs with
    trimmed items.  Null or unparseable text yields no row; ``[]`` yields no
    row."""
    pairs = (df.select(col_of(id_col).alias(out_id),
                       F.explode(parse_list_string(list_col)).alias("__item"))
             .select(out_id, strip_ws("__item").alias(out_item)))
    return pairs.dropDuplicates([out_id, out_item])


def explode_list_ordered(df: DataFrame, id_col: str, list_col: str, order: str,
                         out_id: str = "doctor_id", out_item: str = "branch_id") -> DataFrame:
    """G1 before de-duplication, keeping the source order ``(order, pos)``
    for previews."""
    return (df.select(col_of(order).alias("__ord"), col_of(id_col).alias(out_id),
                      F.posexplode(parse_list_string(list_col)).alias("__pos", "__item"))
            .select("__ord", "__pos", out_id, strip_ws("__item").alias(out_item)))
