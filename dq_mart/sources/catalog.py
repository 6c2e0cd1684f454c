"""Named tables and the row-count audit over them."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tables of the driver's test data folders.
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b), list(parts))


def row_counts(tables: Mapping[str, DataFrame], with_total: bool = True) -> DataFrame:
    """One row per table ``(table_name, row_count)`` and, optionally, a
    final ``TOTAL`` row.

    Each table is one global count (no column is read, so a scan decodes
    nothing), which gives a row for an empty table too; ``rollup`` over these
    few counts adds the total in the same plan."""
    counts = union_all([df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("table_name"), "n") for name, df in tables.items()])
    grouped = counts.rollup("table_name") if with_total else counts.groupBy("table_name")
    counts = grouped.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
    return counts.select(F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"),
                         "row_count")
