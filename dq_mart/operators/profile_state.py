"""Mergeable profiles (C1-C9, C13): a stored state for each part of a table.

A state has one row for each column of a part (a file, a day, a partition):
rows, missing values, the class bits and digits of its type (``inference``),
its least and greatest value, its first one, the longest one, valid dates and
their range, yes/no spellings, and an HLL sketch of its distinct values.  Each
field has a merge that is associative and commutative (sum, max, min, bit_or,
min by ingest order, sketch union), so

    state(A and B) = merge(state(A), state(B))

however the rows are split.  A new day's file is profiled alone and merged with
what is stored; nothing that was profiled is read again, and the merged
profile equals that of the whole table.

Scale: one aggregate per part with map-side partial states, whatever the number
of columns; a state is a few kilobytes a column (the sketch), so merging a
thousand days moves megabytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from ..functions.casts import DEFAULT_DATE_FORMATS, YES_NO_DOMAIN, to_date_safe
from ..functions.numeric import pct_half_up
from ..functions.text import quoted, strip_ws
from .inference import BIT, digits_of, joined_type, value_class
from .profiling import missing_predicate

#: log2 of the buckets of a distinct-count sketch: relative error about
#: 1.04 / sqrt(2^12) = 1.6 % (one standard deviation).
SKETCH_BITS = 12
_NUMBERS = ("int", "bigint", "decimal", "double")
_WIDE = "decimal(38,6)"
#: Number of a text whose class is exact; others (doubles) keep their range apart.
_EXACT = BIT["int"] | BIT["bigint"] | BIT["decimal"]


def _column_aggregates(df: DataFrame, c: str, order: str) -> dict[str, Column]:
    """The fields of one column's state, as aggregates over raw rows."""
    v, dt = F.col(quoted(c)), df.schema[c].dataType
    text = v.cast("string")
    is_text = isinstance(dt, StringType)
    t = strip_ws(text)
    if is_text:
        bit, (whole, scale) = value_class(v), digits_of(v)
    else:
        # a declared type is the class of all its values
        bit, whole, scale = F.lit(0), F.lit(None).cast("int"), F.lit(None).cast("int")
    number = F.when(bit.bitwiseAND(F.lit(_EXACT)) != 0, t.try_cast(_WIDE)) if is_text \
        else v.try_cast(_WIDE) if dt.simpleString().startswith(("tiny", "small", "int", "bigint", "dec", "dou", "fl")) \
        else F.lit(None).cast(_WIDE)
    far = F.when(bit == BIT["double"], t.try_cast("double")) if is_text else F.lit(None).cast("double")
    if isinstance(dt, (DateType, TimestampType, TimestampNTZType)):
        day = v.cast("date")
    else:
        day = to_date_safe(text, DEFAULT_DATE_FORMATS) if is_text else F.lit(None).cast("date")
    norm = F.lower(strip_ws(text))
    return {
        "rows": F.count(F.lit(1)),
        "missing": F.count_if(missing_predicate(df, c)),
        "nulls": F.count_if(v.isNull()),
        "classes": F.coalesce(F.bit_or(bit), F.lit(0)),
        "whole": F.max(whole), "scale": F.max(scale),
        "max_number": F.max(number), "min_number": F.min(number), "max_double": F.max(far),
        "first": F.min(F.struct(F.col(quoted(order)).alias("at"), text.alias("value"))),
        "widest": F.min(F.when(text.isNotNull(), F.struct((-F.length(text)).alias("l"), text.alias("v")))),
        "bad_dates": F.count_if(day.isNull()), "min_date": F.min(day), "max_date": F.max(day),
        "yes": F.count_if(F.lower(text) == YES_NO_DOMAIN[0]), "no": F.count_if(F.lower(text) == YES_NO_DOMAIN[1]),
        "unexpected": F.count_if(norm.isNull() | ~norm.isin(*YES_NO_DOMAIN)),
        "distinct": F.hll_sketch_agg(text, F.lit(SKETCH_BITS)),
    }


def profile_state(df: DataFrame, table: str, order: str, cols: Sequence[str] | None = None,
                  part: Column | None = None) -> DataFrame:
    """A row for each part and column: ``(table_name, part, column_name,
    dtype, <fields>)``; ``dtype`` is null for text, whose type is inferred.
    Without ``part`` the table is one part.  All columns of a part come out of
    one aggregate."""
    cols = list(cols or [c for c in df.columns if c != order])
    fields = {c: _column_aggregates(df, c, order) for c in cols}
    aggs = [F.struct(*[a.alias(n) for n, a in fields[c].items()]).alias(f"__s{i}") for i, c in enumerate(cols)]
    key = (part if part is not None else F.lit(None)).cast("string")
    grouped = df.groupBy(key.alias("part")).agg(*aggs)
    dtypes = {c: None if isinstance(df.schema[c].dataType, StringType) else df.schema[c].dataType.simpleString()
              for c in cols}
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(dtypes[c]).cast("string").alias("dtype"),
                               F.col(f"__s{i}").alias("state")) for i, c in enumerate(cols)])
    return grouped.select("part", F.explode(items).alias("__m")).select(
        F.lit(table).alias("table_name"), "part", "__m.column_name", "__m.dtype", "__m.state.*")


#: How each field of two states becomes that of both.
_MERGES = {
    **{n: F.sum for n in ("rows", "missing", "nulls", "bad_dates", "yes", "no", "unexpected")},
    **{n: F.max for n in ("whole", "scale", "max_number", "max_double", "max_date")},
    **{n: F.min for n in ("min_number", "min_date", "first", "widest")},
    "classes": F.bit_or, "distinct": F.hll_union_agg,
}


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One state for each table and column (and ``by``) from those of its
    parts; again a state, with the part null unless it is in ``by``."""
    keys = ["table_name", "column_name", *by]
    merged = states.groupBy(*keys).agg(F.max("dtype").alias("dtype"),
                                       *[fn(n).alias(n) for n, fn in _MERGES.items()])
    part = F.col("part") if "part" in by else F.lit(None).cast("string")
    return merged.select("table_name", part.alias("part"), "column_name", "dtype",
                         *[n for n in states.columns if n in _MERGES])


def finish(states: DataFrame) -> DataFrame:
    """The checks read off merged states: a row for each column with the types,
    nulls, range, dates and spellings as the single checks give them, and
    ``distinct_estimate`` (of the values that are there)."""
    number = F.col("classes").bitwiseAND(F.lit(sum(BIT[n] for n in _NUMBERS)))
    only_numbers = (F.col("classes") != 0) & (F.col("classes").bitwiseAND(
        F.lit(sum(b for n, b in BIT.items() if n not in _NUMBERS))) == 0)
    declared = F.col("dtype").isNotNull()
    beyond = F.coalesce(F.col("max_double") > F.coalesce(F.col("max_number").cast("double"), F.lit(0.0)),
                        F.lit(False))
    plain = F.regexp_replace(F.col("max_number").cast("string"), r"\.0+$", "")
    largest = F.when(declared | only_numbers, F.when(beyond, F.col("max_double").cast("string")).otherwise(plain))
    clean = F.col("bad_dates") == 0
    return states.select(
        "table_name", "column_name",
        F.coalesce("dtype", joined_type(F.col("classes"), F.col("whole"), F.col("scale"))).alias("dtype"),
        F.col("first.value").alias("sample"), F.col("widest.v").alias("widest"),
        "rows", "missing", pct_half_up("missing", "rows", 1).alias("missing_pct"),
        largest.alias("max_value"),
        F.when(largest.isNotNull(), F.coalesce(beyond | (F.col("max_number") > 2147483647), F.lit(False)))
        .alias("needs_bigint"),
        "bad_dates", F.when(clean, F.col("min_date")).alias("min_date"),
        F.when(clean, F.col("max_date")).alias("max_date"),
        "unexpected", F.when(F.col("unexpected") == 0, F.col("yes")).alias("yes_count"),
        F.when(F.col("unexpected") == 0, F.col("no")).alias("no_count"),
        F.hll_sketch_estimate("distinct").alias("distinct_estimate"),
        (number != 0).alias("has_numbers"))


def merged_profile(stored: DataFrame | None, new: DataFrame) -> DataFrame:
    """The state of everything: what is stored and the new parts.  A part that
    is profiled again replaces its stored state."""
    if stored is None:
        return new
    fresh = new.select("table_name", "part").distinct()
    kept = stored.alias("s").join(
        fresh.alias("f"), (F.col("s.table_name") == F.col("f.table_name"))
        & F.col("s.part").eqNullSafe(F.col("f.part")), "left_anti")
    return kept.unionByName(new)
