"""Data-quality profiling (checks C1-C9), each returning a metrics DataFrame.

Scale rules:
* one scan per table and check: every column's metric goes into a single
  ``agg`` (a global aggregate = partial per task + one tiny final merge),
  and the one-row result is turned long with ``explode(array(struct))``;
* value-level checks (categorical counts, yes/no domains) first group by
  ``(column, value)`` with map-side partial aggregation, so the shuffle
  carries distinct values, not rows;
* examples are a top-k by first appearance (``TakeOrderedAndProject``),
  never a collected list;
* nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, DoubleType, FloatType, IntegralType, NumericType,
                               StringType, TimestampNTZType, TimestampType)

from ..functions.casts import (DEFAULT_DATE_FORMATS, YES_NO_DOMAIN,
                               parse_list_string, to_date_safe)
from ..functions.numeric import pct_half_up
from .inference import infer_types
from ..functions.text import is_blank, quoted, strip_ws

INT_MAX = 2147483647


def _count_all() -> Column:
    return F.count(F.lit(1))


def _long(one_row: DataFrame, items: list[Column], keep: Sequence[str] = ()) -> DataFrame:
    """One-row metrics -> one row per struct in ``items``."""
    return (one_row.select(*keep, F.explode(F.array(*items)).alias("__m"))
            .select(*keep, "__m.*"))


# --- C1: nulls and blanks ----------------------------------------------------------

def missing_predicate(df: DataFrame, c: str) -> Column:
    """Missing as the reference counts it: null, NaN for floats, and
    whitespace-only text."""
    dt = df.schema[c].dataType
    col = F.col(quoted(c))
    if isinstance(dt, StringType):
        return is_blank(col)
    if isinstance(dt, (DoubleType, FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def profile_nulls(df: DataFrame, table: str) -> DataFrame:
    """``(table_name, column_name, null_count, pct)`` for columns with
    at least one missing value; pct of all rows, 1 digit."""
    cols = df.columns
    one = df.agg(_count_all().alias("__n"),
                 *[F.count_if(missing_predicate(df, c)).alias(f"__c{i}")
                   for i, c in enumerate(cols)])
    items = [F.struct(F.lit(i).alias("column_pos"), F.lit(c).alias("column_name"),
                      F.col(f"__c{i}").alias("null_count"))
             for i, c in enumerate(cols)]
    out = _long(one, items, keep=["__n"]).filter(F.col("null_count") > 0)
    return out.select(F.lit(table).alias("table_name"), "column_name", "null_count",
                      pct_half_up("null_count", "__n", 1).alias("pct"))


# --- C2: types and first-row sample ---------------------------------------------------

def profile_types(df: DataFrame, table: str, order: str) -> DataFrame:
    """``(table_name, column_name, dtype, sample)`` — the type (of a text
    column the one that its values have, see ``inference``) and the value of
    the first row (smallest ``order``) as text."""
    return infer_types(df, table, order, df.columns).select(
        "table_name", "column_name", "dtype", "sample")


# --- C3: integer range -------------------------------------------------------------------

def numeric_columns(df: DataFrame) -> list[str]:
    """P11 (numeric): names of numeric columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def exact_number(c: Column, type_: DataType) -> Column:
    """A number as text with every digit: integers as they are (also above
    2^53), others with six decimals, a double too large for those as it is."""
    if isinstance(type_, IntegralType):
        return c.cast("string")
    return F.coalesce(c.try_cast("decimal(38,6)").cast("string"), c.cast("string"))


def profile_int_range(df: DataFrame, table: str,
                      cols: Sequence[str] | None = None) -> DataFrame:
    """``(table_name, column_name, max_value, needs_bigint)`` for the
    numeric columns; a column needs BIGINT when its max exceeds INT.  The
    maximum is exact text (``exact_number``)."""
    cols = [c for c in (cols or numeric_columns(df)) if c in numeric_columns(df)]
    one = df.agg(*[F.max(F.col(quoted(c))).alias(f"__m{i}") for i, c in enumerate(cols)])
    items = [F.struct(F.lit(c).alias("column_name"),
                      exact_number(F.col(f"__m{i}"), df.schema[c].dataType).alias("max_value"),
                      F.coalesce(F.col(f"__m{i}") > F.lit(INT_MAX), F.lit(False))
                      .alias("needs_bigint"))
             for i, c in enumerate(cols)]
    return _long(one, items).select(F.lit(table).alias("table_name"), "column_name",
                                    "max_value", "needs_bigint")


# --- C4: categorical values --------------------------------------------------------------

def profile_categorical(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """C4: ``(table_name, column_name, value, cnt, pct, status)`` — value
    counts without nulls, pct of *all* rows (1 digit); an absent column gives
    one row with status ``missing``."""
    have = [c for c in cols if c in df.columns]
    missing = [c for c in cols if c not in df.columns]
    parts = []
    if have:
        total = df.select(_count_all()).scalar()
        stacked = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(quoted(c)).cast("string").alias("value"))
            for c in have])).alias("__v")).select("__v.*")
        counts = (stacked.filter(F.col("value").isNotNull())
                  .groupBy("column_name", "value").agg(_count_all().alias("cnt")))
        parts.append(counts.select(F.lit(table).alias("table_name"), "column_name", "value",
                                   "cnt", pct_half_up("cnt", total, 1).alias("pct"),
                                   F.lit("ok").alias("status")))
    if missing:
        spark = df.sparkSession
        parts.append(spark.createDataFrame(
            [(table, c, None, None, None, "missing") for c in missing],
            "table_name string, column_name string, value string, cnt bigint, "
            "pct double, status string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- C5: dates ------------------------------------------------------------------------------

def parsed_date(df: DataFrame, c: str,
                formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, DateType):
        return F.col(quoted(c))
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return F.col(quoted(c)).cast("date")
    return to_date_safe(c, formats)


def profile_dates(df: DataFrame, table: str, cols: Sequence[str],
                  formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> DataFrame:
    """``(table_name, column_name, bad_count, min_date, max_date)``;
    bad = unparseable or null; the range only when nothing is bad.  Absent
    columns are skipped."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, bad_count bigint, "
            "min_date date, max_date date")
    aggs = []
    for i, c in enumerate(cols):
        p = parsed_date(df, c, formats)
        aggs += [F.count_if(p.isNull()).alias(f"__b{i}"),
                 F.min(p).alias(f"__lo{i}"), F.max(p).alias(f"__hi{i}")]
    one = df.agg(*aggs)
    items = [F.struct(F.lit(c).alias("column_name"),
                      F.col(f"__b{i}").alias("bad_count"),
                      F.when(F.col(f"__b{i}") == 0, F.col(f"__lo{i}")).alias("min_date"),
                      F.when(F.col(f"__b{i}") == 0, F.col(f"__hi{i}")).alias("max_date"))
             for i, c in enumerate(cols)]
    return _long(one, items).select(F.lit(table).alias("table_name"), "column_name",
                                    "bad_count", "min_date", "max_date")


def profile_dates_bad_values(df: DataFrame, table: str, col: str, order: str,
                             n: int = 5,
                             formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> DataFrame:
    """C5 examples: up to ``n`` distinct bad raw values (null included), in
    order of first appearance."""
    bad = df.filter(parsed_date(df, col, formats).isNull())
    firsts = bad.groupBy(F.col(quoted(col)).cast("string").alias("bad_value")) \
        .agg(F.min(F.col(quoted(order))).alias("__first"))
    return (firsts.orderBy("__first").limit(n)
            .select(F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
                    "bad_value"))


# --- C7: yes/no columns ------------------------------------------------------------------

def _distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, raw, cnt)``: distinct raw values per column with
    their counts (one shuffle of distinct values)."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(quoted(c)).cast("string").alias("raw"))
        for c in cols])).alias("__v")).select("__v.*")
    return stacked.groupBy("column_name", "raw").agg(_count_all().alias("cnt"))


def _unexpected(raw: Column) -> tuple[Column, Column]:
    norm = F.lower(strip_ws(raw))
    return norm, ~F.coalesce(norm.isin(*YES_NO_DOMAIN), F.lit(False))


def profile_yes_no(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """``(table_name, column_name, yes_count, no_count,
    unexpected_count)``.  The domain test trims and lower-cases distinct
    values (a null is unexpected); the counts lower-case without trimming
    and are given only when nothing is unexpected.  Absent columns are
    skipped."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, yes_count bigint, no_count bigint, "
            "unexpected_count bigint")
    d = _distinct_values(df, cols)
    norm, unexp = _unexpected(F.col("raw"))
    lower = F.lower(F.col("raw"))
    per = d.groupBy("column_name").agg(
        (F.count_distinct(F.when(unexp, norm))
         + F.max(F.when(F.col("raw").isNull(), 1).otherwise(0))).cast("bigint")
        .alias("unexpected_count"),
        F.sum(F.when(lower == "yes", F.col("cnt")).otherwise(0)).cast("bigint").alias("__y"),
        F.sum(F.when(lower == "no", F.col("cnt")).otherwise(0)).cast("bigint").alias("__n"))
    ok = F.col("unexpected_count") == 0
    return per.select(F.lit(table).alias("table_name"), "column_name",
                      F.when(ok, F.col("__y")).alias("yes_count"),
                      F.when(ok, F.col("__n")).alias("no_count"),
                      "unexpected_count")


def profile_yes_no_unexpected(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """C7 detail: the distinct unexpected (trimmed, lower-cased) values per
    column; a null value appears as a null.  Absent columns are skipped."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, unexpected_value string")
    d = _distinct_values(df, cols)
    norm, unexp = _unexpected(F.col("raw"))
    return (d.filter(unexp).select("column_name", norm.alias("unexpected_value"))
            .distinct()
            .select(F.lit(table).alias("table_name"), "column_name", "unexpected_value"))


# --- C6: list-string column ----------------------------------------------------------------

def profile_list_column(df: DataFrame, col: str) -> DataFrame:
    """``(total_rows, parse_errors, pairs, distinct_items)`` — a null
    counts as a parse error; pairs are counted before de-duplication."""
    parsed = df.select(parse_list_string(col).alias("__p"))
    ex = parsed.select(F.col("__p").isNull().alias("__err"),
                       F.posexplode_outer("__p").alias("__pos", "__item"))
    return ex.agg(
        F.count_if(F.col("__pos").isNull() | (F.col("__pos") == 0)).cast("bigint")
        .alias("total_rows"),
        F.count_if(F.col("__err")).cast("bigint").alias("parse_errors"),
        F.count_if(F.col("__pos").isNotNull()).cast("bigint").alias("pairs"),
        F.count_distinct(strip_ws("__item")).cast("bigint").alias("distinct_items"))


def list_column_preview(df: DataFrame, id_col: str, list_col: str, order: str,
                        n: int = 8, out_id: str = "doctor_id",
                        out_item: str = "branch_id") -> DataFrame:
    """C6 preview: the first ``n`` unpacked pairs in source order."""
    from .cleaning import explode_list_ordered
    ex = explode_list_ordered(df, id_col, list_col, order, out_id, out_item)
    top = ex.orderBy("__ord", "__pos").limit(n)
    from pyspark.sql.window import Window
    w = Window.orderBy("__ord", "__pos")  # over at most n rows
    return top.select(F.row_number().over(w).cast("int").alias("pair_no"), out_id, out_item)


# --- C9: requested vs consulted --------------------------------------------------------------

def profile_mismatch(df: DataFrame, a: str, b: str) -> DataFrame:
    """``(mismatches, total, pct, all_mismatch)``.  Inequality with the
    profiler's null rule: a null on either side counts as a mismatch
    (unlike SQL ``<>``)."""
    differ = ~F.coalesce(F.col(quoted(a)) == F.col(quoted(b)), F.lit(False))
    one = df.agg(F.count_if(differ).cast("bigint").alias("mismatches"),
                 _count_all().alias("total"))
    return one.select("mismatches", "total",
                      pct_half_up("mismatches", "total", 1).alias("pct"),
                      (F.col("mismatches") == F.col("total")).alias("all_mismatch"))


# --- C13: one long metrics table ---------------------------------------------------------

def metric_text(df: DataFrame, name: str) -> Column:
    """A metric value as text: floating values through DECIMAL(38,6) so the
    text does not depend on float printing."""
    dt = df.schema[name].dataType
    c = F.col(quoted(name))
    if isinstance(dt, (DoubleType, FloatType)):
        return c.cast("decimal(38,6)").cast("string")
    return c.cast("string")


def long_metrics(df: DataFrame, step: int, check: str, metrics: Sequence[str],
                 table_col: str | None = "table_name",
                 column_col: str | None = "column_name",
                 item_col: str | None = None) -> DataFrame:
    """A check's rows -> ``(step, check_name, table_name, column_name, item,
    metric, value)``, one row per metric."""
    def pick(c):
        return (F.col(quoted(c)).cast("string") if c else F.lit(None).cast("string"))
    kv = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"),
                                      metric_text(df, m).alias("value")) for m in metrics]))
    return (df.select(F.lit(step).alias("step"), F.lit(check).alias("check_name"),
                      pick(table_col).alias("table_name"), pick(column_col).alias("column_name"),
                      pick(item_col).alias("item"), kv.alias("__kv"))
            .select("step", "check_name", "table_name", "column_name", "item", "__kv.*"))
