"""Declared table schemas and the generic transform / conform operators.

A ``TableSpec`` holds everything the reference spreads over one transform
function per table (rename map, yes/no, date and id columns, primary key,
dropped columns) plus the declared column types of its DDL.  The per-table
transforms are then data, and two generic operators do the work:

* ``transform(raw, spec)`` — the reference's cleaning steps (P1, P3, P4, P5,
  P6, P7, D1), in its order;
* ``conform(df, spec)`` — the implicit cast of an INSERT into the declared
  types (P8), made explicit: a cast per column (numbers are rounded into
  integer columns) plus a length check for VARCHAR(n); a row whose non-null input does not fit is *rejected*
  with its reasons instead of failing the load.

``conform`` is one projection: reasons, typed values and (for rejected rows
only) the raw text are computed in the same pass, so a sink can write good
and rejected rows with one scan (the ETL job partitions its output by load
status, see ``plans/jobs.etl_job``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.casts import DEFAULT_DATE_FORMATS, declared_cast
from .cleaning import (cast_bigint_default0, cast_dates, cast_yes_no,
                       clean_headers, dedup_keep_first, rename_columns, string_columns)
from .date_layout import cast_guessed_dates, guessed_formats

REJECT_REASONS = "reject_reasons"
RAW = "raw"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str                      # Spark SQL type: int, bigint, decimal(10,2), ...
    max_len: int | None = None     # VARCHAR(n) -> n


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    rename: Mapping[str, str] = field(default_factory=dict)
    # When set, a clean header whose lower-case form is a declared column
    # is renamed to it (the rule behind the reference's rename maps).
    match_lower: bool = False
    yes_no: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    bigint_default0: tuple[str, ...] = ()
    primary_key: str | None = None
    drop: tuple[str, ...] = ()
    # Layouts of the date columns; none: each column's is found from its values.
    date_formats: tuple[str, ...] = DEFAULT_DATE_FORMATS

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def rename_for(self, columns: Sequence[str]) -> dict[str, str]:
        """The rename map for a frame with these (clean) column names."""
        mapping = dict(self.rename)
        if self.match_lower:
            declared = set(self.column_names)
            for c in columns:
                if c not in mapping and c != c.lower() and c.lower() in declared:
                    mapping[c] = c.lower()
        return mapping

    def ddl(self) -> str:
        """The declared schema as a DDL string (VARCHAR(n) kept as a comment
        in ``max_len``; the stored type is STRING)."""
        return ", ".join(f"{c.name} {c.type}" for c in self.columns)


def transform(raw: DataFrame, spec: TableSpec, order: str | None = None,
              totals: Sequence[str] = ()) -> DataFrame:
    """The reference's per-table cleaning, in its order: headers, renames,
    drops, yes/no, dates, zero-defaulted ids, keep-first on the primary key.

    ``order`` names the ingest-ordinal column that defines "first" (its name
    must be unchanged by header cleaning, e.g. ``ingest_ord``); it is
    required when the spec has a primary key and is kept in the output.
    ``totals`` are counters that the rows dropped by keep-first add to.
    """
    df = clean_headers(raw)
    df = rename_columns(df, spec.rename_for(df.columns))
    if spec.drop:
        df = df.drop(*spec.drop)
    df = cast_yes_no(df, spec.yes_no)
    if spec.date_formats:
        df = cast_dates(df, spec.dates, spec.date_formats)
    else:                       # the layout that each column's values vote for
        df = cast_guessed_dates(df, guessed_formats(df, spec.dates))
        df = cast_dates(df, [c for c in spec.dates if c in string_columns(df)])
    df = cast_bigint_default0(df, spec.bigint_default0)
    if spec.primary_key:
        if not order:
            raise ValueError(f"{spec.name}: keep-first on {spec.primary_key} needs an ordinal")
        df = dedup_keep_first(df, [spec.primary_key], order, totals)
    return df


def _fits(value: Column, typed: Column, spec: ColumnSpec,
          source_is_string: bool) -> list[Column]:
    """Reason texts (null when fine) for a value against its declared type."""
    problems = []
    if spec.type != "string":
        what = "not a valid" if source_is_string else "out of range for"
        problems.append(F.when(value.isNotNull() & typed.isNull(),
                               F.lit(f"{spec.name}: {what} {spec.type}")))
    if spec.max_len is not None:
        problems.append(F.when(F.length(typed) > spec.max_len,
                               F.lit(f"{spec.name}: longer than {spec.max_len}")))
    return problems


def conform(df: DataFrame, spec: TableSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Cast to the declared types in one projection.

    Output: the declared columns (typed; absent ones are null), the ``keep``
    columns, ``reject_reasons`` (the reasons joined by ``; ``, null when the
    row fits) and ``raw`` (the source text of the declared columns, only on
    rejected rows, else null).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    typed: dict[str, Column] = {}
    reasons: list[Column] = []
    for c in spec.columns:
        if c.name not in have:
            typed[c.name] = F.lit(None).cast(c.type)
            continue
        v = F.col(c.name)
        src_str = isinstance(have[c.name], StringType)
        t = declared_cast(v, c.type, src_str) if c.type != "string" else v.cast("string")
        typed[c.name] = t
        reasons.extend(_fits(v, t, c, src_str))
    # concat_ws skips nulls: the reasons of a row, or null when it fits.
    why = (F.nullif(F.concat_ws("; ", *reasons), F.lit("")) if reasons
           else F.lit(None).cast("string"))
    row = F.struct(*[typed[c].alias(c) for c in spec.column_names],
                   *[F.col(k) for k in keep], why.alias(REJECT_REASONS))
    # one row out of a generator: a filter on the reasons stays above it, so
    # the cleaning of a row is evaluated once, not again inside the filter; the
    # source text goes along beside it and is put together for rejects only
    source = [F.col(c.name).alias(f"__raw_{c.name}") for c in spec.columns if c.name in have]
    out = df.select(*source, F.explode(F.array(row)).alias("__row"))
    raw = F.struct(*[F.col(f"__raw_{c.name}").cast("string").alias(c.name)
                     for c in spec.columns if c.name in have])
    return out.select("__row.*", F.when(F.col(f"__row.{REJECT_REASONS}").isNotNull(), raw).alias(RAW))


def good_rows(conformed: DataFrame) -> DataFrame:
    """Rows that fit, without the bookkeeping columns."""
    return conformed.filter(F.col(REJECT_REASONS).isNull()).drop(REJECT_REASONS, RAW)


def rejected_rows(conformed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rejected rows: kept columns, reasons and raw text."""
    return (conformed.filter(F.col(REJECT_REASONS).isNotNull())
            .select(*keep, F.col(REJECT_REASONS).alias("reasons"), F.col(f"{RAW}.*")))
