"""Date layouts by vote (P6, X10, C5): which layout a text column is in.

Each candidate layout has a shape (a regex) and a pattern.  For every value the
layouts that read it are the bits of one number; one aggregate counts, for each
layout of each column, the values that parse, those that no other layout
explains, and those that another layout reads as *another* day.  The layout
that reads most values wins; of several, the one that alone explains most, then
the first of the list.

``03/04/2024`` is the 3rd of April or the 4th of March.  Where day-first and
month-first read equally many values and no value speaks for either, the layout
is only a guess: ``ambiguous`` is true, and ``disputed`` counts the values at
stake.  A single ``25/04/2024`` in the column decides it for all.

Shapes are checked before parsing, so junk never takes the parser's exception
path; one scan decides for all date columns of a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import ISO_DATE, to_date_safe
from ..functions.text import quoted, strip_ws

# --- fixed values -----------------------------------------------------------
# Layouts in the order of preference, with their shapes.
LAYOUTS = {
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}$",
    "yyyyMMdd": r"^\d{8}$",
    "dd/MM/yyyy": r"^\d{2}/\d{2}/\d{4}$",
    "MM/dd/yyyy": r"^\d{2}/\d{2}/\d{4}$",
    "dd-MM-yyyy": r"^\d{2}-\d{2}-\d{4}$",
    "MM-dd-yyyy": r"^\d{2}-\d{2}-\d{4}$",
    "dd.MM.yyyy": r"^\d{2}\.\d{2}\.\d{4}$",
    "dd-MMM-yyyy": r"^\d{2}-[A-Z][a-z]{2}-\d{4}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
}
# ---------------------------------------------------------------------------


def parse_layout(c: Column, layout: str) -> Column:
    """A text value as a date of this layout; null for any other text."""
    v = strip_ws(c)
    if layout == ISO_DATE:
        parsed = v.try_cast("date")
    elif layout.startswith(ISO_DATE):
        parsed = v.try_cast("timestamp_ntz").cast("date")
    else:
        parsed = F.try_to_date(v, layout)
    return F.when(v.rlike(LAYOUTS[layout]), parsed)


def layout_votes(df: DataFrame, cols: Sequence[str], layouts: Sequence[str] = tuple(LAYOUTS)) -> DataFrame:
    """A row for each column and layout: ``(column_name, layout, parsed, only,
    disputed, present)``, in one pass: values that the layout reads, that no
    other layout reads, that another layout reads as another day, and values
    that are there."""
    aggs, items = [], []
    for i, c in enumerate(cols):
        text = F.col(quoted(c)).cast("string")
        days = {lay: parse_layout(text, lay) for lay in layouts}
        aggs.append(F.count(text).alias(f"__n{i}"))
        for j, lay in enumerate(layouts):
            mine = days[lay]
            # only layouts of one shape can read the same text
            rivals = [days[o] for o in layouts if o != lay and LAYOUTS[o] == LAYOUTS[lay]]
            others = F.coalesce(*rivals) if rivals else F.lit(None).cast("date")
            aggs += [F.count(mine).alias(f"__p{i}_{j}"),
                     F.count_if(mine.isNotNull() & others.isNull()).alias(f"__o{i}_{j}"),
                     F.count_if(mine != others).alias(f"__d{i}_{j}")]
            items.append(F.struct(F.lit(c).alias("column_name"), F.lit(j).alias("rank"), F.lit(lay).alias("layout"),
                                  F.col(f"__p{i}_{j}").alias("parsed"), F.col(f"__o{i}_{j}").alias("only"),
                                  F.col(f"__d{i}_{j}").alias("disputed"), F.col(f"__n{i}").alias("present")))
    return df.agg(*aggs).select(F.explode(F.array(*items)).alias("__m")).select("__m.*")


def guess_layouts(df: DataFrame, cols: Sequence[str], layouts: Sequence[str] = tuple(LAYOUTS)) -> DataFrame:
    """The layout of each column: ``(column_name, layout, parsed, unparsed,
    ambiguous, disputed)``; ``layout`` is null where none reads any value.  The
    votes are a few rows for each column."""
    votes = layout_votes(df, cols, layouts)
    ballot = F.sort_array(F.collect_list(F.struct(
        (-F.col("parsed")).alias("p"), (-F.col("only")).alias("o"), "rank", "layout", "disputed")))
    won = votes.groupBy("column_name").agg(ballot.alias("b"), F.max("present").alias("present"))
    first, second = F.col("b")[0], F.get("b", F.lit(1))
    some = first["p"] < 0
    tied = F.coalesce((first["p"] == second["p"]) & (first["o"] == second["o"]), F.lit(False))
    disputed = F.when(some, first["disputed"]).otherwise(0)
    return won.select("column_name", F.when(some, first["layout"]).alias("layout"),
                      (-first["p"]).alias("parsed"), (F.col("present") + first["p"]).alias("unparsed"),
                      (some & tied & (disputed > 0)).alias("ambiguous"), disputed.alias("disputed"))


def guessed_formats(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """column -> layout, of the columns that some layout reads (one row for
    each column comes to the driver)."""
    have = [c for c in cols if c in df.columns]
    if not have:
        return {}
    return {r.column_name: r.layout for r in guess_layouts(df, have).collect() if r.layout}


def cast_guessed_dates(df: DataFrame, formats: dict[str, str]) -> DataFrame:
    """P6 with the layout of each column; a column without one as ISO."""
    return df.withColumns({c: parse_layout(F.col(quoted(c)).cast("string"), f) if f in LAYOUTS
                           else to_date_safe(c, [f]) for c, f in formats.items()}) if formats else df
