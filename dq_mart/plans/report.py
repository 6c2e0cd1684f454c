"""The daily multi-section report.

Each section is one of the version-b queries.  A section renders as a blank
line, ``### NAME ###``, the CSV header and one CSV line per result row, in
the query's order.  A union keeps no order, so every line carries
``(section_ord, line_ord)`` and the sink sorts by them.

Numbers never go through DOUBLE text: 2-decimal values are printed from
DECIMAL the way the reference's float printing shows them (``12.5``,
``12.0``, ``0.05``); counts print as integers.

Scale: all sections' rows are sorted together by one range-partitioned sort
and numbered from the row counts of the sorted partitions (a few numbers), so
no window gathers a section in one task.  Only the final text file is written
by a single task, because it is one file by contract.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, NumericType

from ..functions.numeric import report_number
from ..session import checkpoint_root
from ..sources.csv import csv_text


@dataclass(frozen=True)
class Section:
    """A section's rows and their order: pairs of a column and ``asc`` (nulls
    last) or ``desc`` (nulls first)."""

    name: str
    df: DataFrame
    order: tuple[tuple[str, str], ...]


def _render_col(df: DataFrame, name: str) -> Column:
    """A number as the reference prints it; anything else as text."""
    dt = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dt, (DoubleType, FloatType, DecimalType)):
        return report_number(c)
    return c.cast("string")


#: Sort columns of a section at most.
_KEYS = 3


def _sort_keys(sec: Section) -> list[Column]:
    """The section's order as uniform ascending keys: for each of its columns
    whether it is null, a number (negated for descending) and a text."""
    out = []
    for i in range(_KEYS):
        null, num, txt = F.lit(False), F.lit(None).cast("decimal(38,2)"), F.lit(None).cast("string")
        if i < len(sec.order):
            name, way = sec.order[i]
            c = F.col(f"`{name}`")
            null = c.isNull() if way == "asc" else c.isNotNull()
            if isinstance(sec.df.schema[name].dataType, NumericType):
                num = c.cast("decimal(38,2)") if way == "asc" else -c.cast("decimal(38,2)")
            elif way == "asc":
                txt = c.cast("string")
            else:
                raise ValueError(f"{sec.name}: a descending text order is not supported")
        out += [null.alias(f"__null{i}"), num.alias(f"__num{i}"), txt.alias(f"__txt{i}")]
    return out


def _section_rows(ord_: int, sec: Section) -> DataFrame:
    data = sec.df.columns
    keyed = sec.df.select(*[_render_col(sec.df, c).alias(c) for c in data],
                          F.struct(*_sort_keys(sec)).alias("__keys"))
    return keyed.select(F.lit(ord_).alias("section_ord"), F.lit(sec.name).alias("section"),
                        csv_text(data).alias("line"), "__keys.*")


def report_lines(sections: Sequence[Section]) -> DataFrame:
    """All sections, in the given order: ``(section_ord, section, line_ord,
    line)``."""
    spark = sections[0].df.sparkSession
    rows = functools.reduce(DataFrame.unionByName,
                            [_section_rows(i, s) for i, s in enumerate(sections)])
    keys = [f"__{k}{i}" for i in range(_KEYS) for k in ("null", "num", "txt")]
    checkpoint_root(spark)
    # the place of a row: its sorted partition and its position there; fixed
    # by the checkpoint before the partitions are counted
    placed = (rows.orderBy("section_ord", *keys)
              .select("section_ord", "section", "line", F.spark_partition_id().alias("__part"),
                      F.monotonically_increasing_id().alias("__at")).checkpoint(eager=True))
    # one row for each partition and section, whatever the rows
    counts = sorted(placed.groupBy("section_ord", "__part")
                    .agg(F.count(F.lit(1)), F.min("__at")).collect())
    first, base = [], {}
    for section, part, n, at in counts:
        first.append((section, part, base.get(section, 3) - at))
        base[section] = base.get(section, 3) + n
    shift = spark.createDataFrame(first, "section_ord int, __part int, __shift bigint")
    body = placed.join(F.broadcast(shift), ["section_ord", "__part"]).select(
        "section_ord", "section", (F.col("__at") + F.col("__shift")).cast("int").alias("line_ord"),
        "line")
    head = spark.createDataFrame(
        [(i, s.name, n, line) for i, s in enumerate(sections) for n, line in
         enumerate(("", f"### {s.name.upper()} ###", ",".join(s.df.columns)))],
        "section_ord int, section string, line_ord int, line string")
    return head.unionByName(body)


def write_report(lines: DataFrame, path: str) -> None:
    """One text file at ``path`` (a folder with one part file): lines in
    ``(section_ord, line_ord)`` order.  ``coalesce(1)`` after the sort keeps
    the order; the report is small by construction."""
    (lines.orderBy("section_ord", "line_ord").select("line").coalesce(1)
     .write.mode("overwrite").text(path))
