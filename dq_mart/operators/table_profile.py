"""One table, two passes: the profiling checks folded together (C13 at scale).

Every column-level metric that is a global aggregate (C1 nulls, C2 types
and first-row sample, C3 integer range, C5 date validity, C9 mismatch) is
one expression in a *single* ``agg`` over the table; every value-level
check (C4 categorical counts, C7 yes/no domain) reads *one* grouping of the
table by ``(column, value)``.  Both passes emit the long metrics form
``(step, check_name, table_name, column_name, item, metric, value)``
directly, through one ``explode`` each, so a table is scanned twice however
many checks and columns are profiled.

The per-check functions in ``profiling.py`` keep the same semantics for
single checks; ``tests`` and the ``profile_report`` oracle hold both to the
same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.casts import (DEFAULT_DATE_FORMATS, YES_NO_DOMAIN, number_or_null,
                               parse_list_string)
from ..functions.numeric import pct_half_up
from ..functions.text import quoted, strip_ws
from ..session import checkpoint_root
from .inference import joined_type, type_aggregates
from .profiling import (INT_MAX, exact_number, missing_predicate, numeric_columns,
                        parsed_date)

#: Text numbers whose maximum is exact: 32 digits before the point.
_WIDE = "decimal(38,6)"

#: Stands for the items of the list column among the column names.
_ITEMS = "[items]"
LONG_COLUMNS = ["step", "check_name", "table_name", "column_name", "item", "metric",
                "value"]


def _num_text(c: Column) -> Column:
    """A floating metric as text via DECIMAL(38,6) (engine-independent)."""
    return c.cast("double").cast("decimal(38,6)").cast("string")


def _s(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("string")


def _item(step: int, check: str, table, column, item, metric: str, value: Column,
          keep: Column | None = None) -> Column:
    return F.struct(F.lit(step).alias("step"), F.lit(check).alias("check_name"),
                    _s(table).alias("table_name"), _s(column).alias("column_name"),
                    _s(item).alias("item"), F.lit(metric).alias("metric"),
                    value.cast("string").alias("value"),
                    (keep if keep is not None else F.lit(True)).alias("__keep"))


class TableProfile:
    """Collect checks for one table, then ``long()`` runs both passes."""

    def __init__(self, df: DataFrame, table: str):
        self.df = df
        self.table = table
        self._aggs: list[Column] = []
        self._items: list[Column] = []
        self._cat: tuple[int, list[str], list[str]] | None = None
        self._yn: tuple[int, list[str]] | None = None
        self._yn_values = False
        self._list: tuple | None = None

    def _agg(self, expr: Column) -> Column:
        alias = f"__a{len(self._aggs)}"
        self._aggs.append(expr.alias(alias))
        return F.col(alias)

    def _rows(self) -> Column:
        if not hasattr(self, "_n"):
            self._n = self._agg(F.count(F.lit(1)))
        return self._n

    # --- aggregate pass -----------------------------------------------------------

    def nulls(self, step: int = 2, cols: Sequence[str] | None = None) -> "TableProfile":
        n = self._rows()
        for c in cols or self.df.columns:
            k = self._agg(F.count_if(missing_predicate(self.df, c)))
            keep = k > 0
            self._items += [
                _item(step, "nulls", self.table, c, None, "null_count", k, keep),
                _item(step, "nulls", self.table, c, None, "pct",
                      _num_text(pct_half_up(k, n, 1)), keep)]
        return self

    def types(self, order: str, step: int = 3,
              cols: Sequence[str] | None = None) -> "TableProfile":
        """Types (of text columns: inferred from all values) and first-row sample."""
        cols = list(cols or [c for c in self.df.columns if c != order])
        # one comparison of the order a row, whatever the number of columns
        first = self._agg(F.min_by(F.struct(*[F.col(quoted(c)).cast("string").alias(f"s{i}")
                                              for i, c in enumerate(cols)]), F.col(quoted(order))))
        for i, c in enumerate(cols):
            sample = first.getField(f"s{i}")
            dtype = F.lit(self.df.schema[c].dataType.simpleString())
            if isinstance(self.df.schema[c].dataType, StringType):
                dtype = joined_type(*[self._agg(a) for a in type_aggregates(F.col(quoted(c))).values()])
            self._items += [
                _item(step, "types", self.table, c, None, "dtype", dtype),
                _item(step, "types", self.table, c, None, "sample", sample)]
        return self

    def int_range(self, step: int = 4, cols: Sequence[str] | None = None) -> "TableProfile":
        """Numeric columns: max and the BIGINT verdict.  Text columns count
        as numeric when every non-null value reads as a number."""
        numeric = set(numeric_columns(self.df))
        for c in cols or self.df.columns:
            v = F.col(quoted(c))
            if c in numeric:
                mx = self._agg(F.max(v))
                text, large = exact_number(mx, self.df.schema[c].dataType), mx > F.lit(INT_MAX)
                keep = None
            elif isinstance(self.df.schema[c].dataType, StringType):
                # exact while a number fits 38 digits; beyond, as a double
                num = number_or_null(strip_ws(v))
                dec = F.when(num.isNotNull(), strip_ws(v).try_cast(_WIDE))
                mx = self._agg(F.max(dec))
                far = self._agg(F.max(F.when(dec.isNull(), num)))
                t, p = self._agg(F.count(v)), self._agg(F.count(num))
                keep = (t == p) & (t > 0)
                beyond = F.coalesce(far > F.coalesce(mx.cast("double"), F.lit(0.0)), F.lit(False))
                plain = F.regexp_replace(mx.cast("string"), r"\.0+$", "")
                text = F.when(beyond | mx.isNull(), far.cast("string")).otherwise(plain)
                large = beyond | (mx > F.lit(INT_MAX))
            else:
                continue
            self._items += [
                _item(step, "int_range", self.table, c, None, "max_value", text, keep),
                _item(step, "int_range", self.table, c, None, "needs_bigint",
                      F.coalesce(large, F.lit(False)), keep)]
        return self

    def dates(self, cols: Sequence[str], step: int = 6,
              formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> "TableProfile":
        for c in [c for c in cols if c in self.df.columns]:
            p = parsed_date(self.df, c, formats)
            bad = self._agg(F.count_if(p.isNull()))
            lo, hi = self._agg(F.min(p)), self._agg(F.max(p))
            self._items += [
                _item(step, "dates", self.table, c, None, "bad_count", bad),
                _item(step, "dates", self.table, c, None, "min_date", F.when(bad == 0, lo)),
                _item(step, "dates", self.table, c, None, "max_date", F.when(bad == 0, hi))]
        return self

    def mismatch(self, a: str, b: str, step: int = 10, table=None,
                 column=None) -> "TableProfile":
        n = self._rows()
        differ = ~F.coalesce(F.col(quoted(a)) == F.col(quoted(b)), F.lit(False))
        m = self._agg(F.count_if(differ))
        check = "requested_vs_consulted"
        self._items += [
            _item(step, check, table, column, None, "mismatches", m),
            _item(step, check, table, column, None, "total", n),
            _item(step, check, table, column, None, "pct", _num_text(pct_half_up(m, n, 1))),
            _item(step, check, table, column, None, "all_mismatch", m == n)]
        return self

    def list_column(self, col: str, step: int = 8, table=None, column=None) -> "TableProfile":
        """Rows, parse errors and pairs here; the distinct items in the
        value pass."""
        n = self._rows()
        items = parse_list_string(F.col(quoted(col)))
        errors = self._agg(F.count_if(items.isNull()))
        pairs = self._agg(F.coalesce(F.sum(F.size(F.coalesce(items, F.array().cast("array<string>")))),
                                     F.lit(0)))
        for metric, value in (("total_rows", n), ("parse_errors", errors), ("pairs", pairs)):
            self._items.append(_item(step, "list_column", table, column, None, metric, value))
        self._list = (step, col, table, column)
        return self

    # --- value pass ------------------------------------------------------------------

    def categorical(self, cols: Sequence[str], step: int = 5) -> "TableProfile":
        have = [c for c in cols if c in self.df.columns]
        self._cat = (step, have, [c for c in cols if c not in self.df.columns])
        return self

    def yes_no(self, cols: Sequence[str], step: int = 7,
               values: bool = False) -> "TableProfile":
        """Yes/no audit; ``values`` also lists the distinct unexpected values
        (normalised; a null as ``NULL``)."""
        self._yn = (step, [c for c in cols if c in self.df.columns])
        self._yn_values = values
        return self

    def _value_pass(self) -> DataFrame | None:
        cat = self._cat[1] if self._cat else []
        yn = self._yn[1] if self._yn else []
        cols = list(dict.fromkeys(cat + yn))
        if not cols and not self._list:
            return self._missing()
        value = lambda c, v: F.struct(F.lit(c).alias("column_name"), v.alias("raw"))
        values = F.array(*[value(c, F.col(quoted(c)).cast("string")) for c in cols])
        if self._list:
            items = F.transform(F.coalesce(parse_list_string(F.col(quoted(self._list[1]))),
                                           F.array().cast("array<string>")),
                                lambda x: value(_ITEMS, strip_ws(x)))
            values = F.concat(values, items) if cols else items
        stacked = self.df.select(F.explode(values).alias("__v")).select("__v.*")
        raw, cnt, col = F.col("raw"), F.col("cnt"), F.col("column_name")
        # several results read the distinct values; written once to the shared
        # folder, they cost one scan of the table
        checkpoint_root(self.df.sparkSession)
        g = stacked.groupBy("column_name", "raw").agg(F.count(F.lit(1)).alias("cnt")) \
            .checkpoint(eager=True)
        lower, norm = F.lower(raw), F.lower(strip_ws(raw))
        unexp = norm.isNotNull() & ~norm.isin(*YES_NO_DOMAIN)
        # the distinct values are the one large input; per column they are
        # aggregated with partial sums, by (column, normalised value) first so
        # that counting distinct unexpected values is a sum as well
        by_norm = g.groupBy("column_name", norm.alias("norm")).agg(
            F.sum("cnt").alias("cnt"),
            F.sum(F.when(lower == "yes", cnt).otherwise(0)).alias("y"),
            F.sum(F.when(lower == "no", cnt).otherwise(0)).alias("no"),
            F.max(F.when(unexp, 1).otherwise(0)).alias("unexpected"),
            F.max(F.when(raw.isNull(), 1).otherwise(0)).alias("null"))
        per = by_norm.groupBy("column_name").agg(
            F.sum("cnt").alias("total"), F.sum("y").cast("bigint").alias("y"),
            F.sum("no").cast("bigint").alias("no"),
            (F.sum("unexpected") + F.max("null")).cast("bigint").alias("uc"))
        parts = []
        if cat:
            step = self._cat[0]
            # one row per audited column: as small as the list of columns
            totals = F.broadcast(per.select("column_name", "total"))
            items = [_item(step, "categorical", self.table, col, raw, "cnt", cnt),
                     _item(step, "categorical", self.table, col, raw, "pct",
                           _num_text(pct_half_up(cnt, F.col("total"), 1))),
                     _item(step, "categorical", self.table, col, raw, "status", F.lit("ok"))]
            parts.append(g.where(col.isin(*cat) & raw.isNotNull()).join(totals, "column_name")
                         .select(F.explode(F.array(*items)).alias("__m")))
        if yn:
            step, uc = self._yn[0], F.col("uc")
            items = [_item(step, "yes_no", self.table, col, None, "yes_count",
                           F.when(uc == 0, F.col("y"))),
                     _item(step, "yes_no", self.table, col, None, "no_count",
                           F.when(uc == 0, F.col("no"))),
                     _item(step, "yes_no", self.table, col, None, "unexpected_count", uc)]
            parts.append(per.where(col.isin(*yn)).select(F.explode(F.array(*items)).alias("__m")))
            if self._yn_values:
                bad = by_norm.where(col.isin(*yn) & ((F.col("unexpected") == 1) | (F.col("null") == 1)))
                parts.append(bad.select(_item(step, "yes_no_unexpected", self.table, col, F.col("norm"),
                                              "value", F.coalesce("norm", F.lit("NULL"))).alias("__m")))
        if self._list:
            step, _, table, column = self._list
            found = g.where((col == _ITEMS) & raw.isNotNull()).agg(F.count(F.lit(1)).alias("d"))
            parts.append(found.select(_item(step, "list_column", table, column, None,
                                            "distinct_items", F.col("d")).alias("__m")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.select("__m.*").select(*LONG_COLUMNS)
        missing = self._missing()
        return out if missing is None else out.unionByName(missing)

    def _missing(self) -> DataFrame | None:
        """Rows for audited columns that the table lacks."""
        if not (self._cat and self._cat[2]):
            return None
        return self.df.sparkSession.createDataFrame(
            [(self._cat[0], "categorical", self.table, c, None, m, v)
             for c in self._cat[2]
             for m, v in (("cnt", None), ("pct", None), ("status", "missing"))],
            "step int, check_name string, table_name string, column_name string, "
            "item string, metric string, value string")

    # --- both ----------------------------------------------------------------------------

    def long(self) -> DataFrame:
        parts = []
        if self._items:
            one = self.df.agg(*self._aggs)
            parts.append(one.select(F.explode(F.array(*self._items)).alias("__m"))
                         .select("__m.*").filter("__keep").select(*LONG_COLUMNS))
        vp = self._value_pass()
        if vp is not None:
            parts.append(vp)
        if not parts:     # no check applies to this table
            return self.df.sparkSession.createDataFrame(
                [], "step int, check_name string, table_name string, column_name string, "
                "item string, metric string, value string")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
