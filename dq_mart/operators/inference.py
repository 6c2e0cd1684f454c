"""Inferred column types of raw text (C2, A19, P11), in one aggregate.

Every value belongs to one class: boolean, int, bigint, decimal, double, date
or text.  The classes seen in a column are kept as the bits of one number, with
the most digits before and after the point; the column's type is the join of
its classes in the lattice

    void < boolean < string,   void < date < string,
    void < int < bigint < decimal(p, s) < double < string

so 1 and 2.5 are decimal(2,1), true and 1 are text.  Bits, digits and rows are
joined by ``bit_or``, ``max`` and ``sum``, which is why states of parts of a
table merge into that of the whole (``profile_state``).

A value's class does not depend on the others': ``1e3`` is a double, a number
of more than 38 digits as well, ``2024-02-30`` is text, ``007`` an int (what a
reader makes of it).  White space around numbers is no part of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import quoted, strip_ws

#: Classes in the order of their bits.
CLASSES = ("boolean", "int", "bigint", "decimal", "double", "date", "string")
BIT = {c: 1 << i for i, c in enumerate(CLASSES)}
_DIGITS = 38
_INT = r"^[+-]?\d+$"
_DECIMAL = r"^[+-]?(\d+\.\d*|\.\d+)$"
_DOUBLE = r"^[+-]?(\d+\.?\d*|\.\d+)[eE][+-]?\d+$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
#: Significant digits before the point, digits after it.
_PARTS = r"^[+-]?0*(\d*)\.?(\d*)$"


def value_class(c: Column) -> Column:
    """The class bit of a text value; null for a missing one."""
    v = strip_ws(c)
    whole, scale = digits_of(c)
    exact = F.coalesce(whole + scale <= _DIGITS, F.lit(False))
    bit = {k: F.lit(b) for k, b in BIT.items()}
    number = (F.when(v.try_cast("int").isNotNull(), bit["int"])
              .when(v.try_cast("bigint").isNotNull(), bit["bigint"])
              .when(exact, bit["decimal"]).otherwise(bit["double"]))
    return (F.when(c.isNull(), F.lit(None).cast("int"))
            .when(F.lower(v).isin("true", "false"), bit["boolean"])
            .when(v.rlike(_INT), number)
            .when(v.rlike(_DECIMAL), F.when(exact, bit["decimal"]).otherwise(bit["double"]))
            .when(v.rlike(_DOUBLE), bit["double"])
            .when(v.rlike(_DATE) & v.try_cast("date").isNotNull(), bit["date"])
            .otherwise(bit["string"]))


def digits_of(c: Column) -> tuple[Column, Column]:
    """Digits before (without leading zeros) and after the point of a plain
    number; null for any other text."""
    v = strip_ws(c)
    plain = v.rlike(_INT) | v.rlike(_DECIMAL)
    return (F.when(plain, F.length(F.regexp_extract(v, _PARTS, 1))),
            F.when(plain, F.length(F.regexp_extract(v, _PARTS, 2))))


def type_aggregates(c: Column) -> dict[str, Column]:
    """The state of a text column's type: ``classes``, ``whole``, ``scale``."""
    whole, scale = digits_of(c)
    return {"classes": F.coalesce(F.bit_or(value_class(c)), F.lit(0)),
            "whole": F.max(whole), "scale": F.max(scale)}


def joined_type(classes: Column, whole: Column, scale: Column) -> Column:
    """The join of the classes as a type name."""
    def has(*names: str) -> Column:
        return classes.bitwiseAND(F.lit(sum(BIT[n] for n in names))) != 0
    numbers = ("int", "bigint", "decimal", "double")
    kinds = sum(F.when(has(*k), 1).otherwise(0) for k in (("boolean",), numbers, ("date",)))
    size = F.greatest(whole + scale, F.lit(1))
    exact = F.when(size <= _DIGITS, F.concat(
        F.lit("decimal("), size.cast("string"), F.lit(","), scale.cast("string"), F.lit(")"))).otherwise("double")
    return (F.when(classes == 0, "void").when(has("string") | (kinds > 1), "string")
            .when(has("boolean"), "boolean").when(has("date"), "date").when(has("double"), "double")
            .when(has("decimal"), exact).when(has("bigint"), "bigint").otherwise("int"))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def infer_types(df: DataFrame, table: str, order: str,
                cols: Sequence[str] | None = None) -> DataFrame:
    """C2 over raw text: ``(table_name, column_name, dtype, sample, widest,
    max_length, non_null)`` in one pass.  ``dtype`` is the inferred type of a
    text column (the declared one of any other), ``sample`` the value of the
    first row by ``order``, ``widest`` the longest value (the least of several)."""
    cols = list(cols or [c for c in df.columns if c != order])
    texts = set(text_columns(df))
    first = F.min_by(F.struct(*[F.col(quoted(c)).cast("string").alias(f"s{i}")
                                for i, c in enumerate(cols)]), F.col(quoted(order)))
    aggs, items = [first.alias("__first")], []
    for i, c in enumerate(cols):
        v = F.col(quoted(c)).cast("string")
        # the least of (-length, value) is the longest, the least of several
        widest = F.min(F.when(v.isNotNull(), F.struct((-F.length(v)).alias("l"), v.alias("v"))))
        aggs += [F.count(v).alias(f"__n{i}"), widest.alias(f"__w{i}")]
        dtype = F.lit(df.schema[c].dataType.simpleString())
        if c in texts:
            state = type_aggregates(F.col(quoted(c)))
            aggs += [a.alias(f"__{k}{i}") for k, a in state.items()]
            dtype = joined_type(*[F.col(f"__{k}{i}") for k in state])
        items.append(F.struct(F.lit(c).alias("column_name"), dtype.alias("dtype"),
                              F.col(f"__first.s{i}").alias("sample"), F.col(f"__w{i}.v").alias("widest"),
                              (-F.col(f"__w{i}.l")).alias("max_length"), F.col(f"__n{i}").alias("non_null")))
    return (df.agg(*aggs).select(F.explode(F.array(*items)).alias("__m")).select("__m.*")
            .select(F.lit(table).alias("table_name"), "*"))
