"""Landing zone (S4, S5): raw CSV -> Parquet under ``raw/<table>``, and an
audit of the files in a folder.

The reference copies files byte for byte to an object store.  Here the
landing job reads each raw file once, attaches the ingest ordinal (file
order, see ``csv.py``) and writes Parquet, so every later job reads a
splittable, column-pruned format and "first row" stays well defined.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import union_all
from .csv import read_raw_csv
from .sinks import Written, path_exists, write_table

log = logging.getLogger(__name__)

RAW_PREFIX = "raw"


def land_raw(spark: SparkSession, sources: Mapping[str, str], root: str,
             multiline: bool = False) -> list[Written]:
    """Land each ``name -> csv path`` as Parquet at ``<root>/raw/<name>``.

    Text stays text (no null-token handling: landing keeps the raw fields);
    an absent source is logged and skipped, like the reference's upload
    loop.  ``multiline`` reads quoted newlines.  Returns what was written,
    with observed row counts."""
    out = []
    for name, path in sources.items():
        if not path_exists(spark, path):
            log.warning("landing: %s not found at %s; skipped", name, path)
            continue
        df = read_raw_csv(spark, path, with_ordinal=True, normalize_nulls=False,
                          multiline=multiline)
        out.append(write_table(spark, df, f"{root.rstrip('/')}/{RAW_PREFIX}", name))
    return out


def landing_audit(spark: SparkSession, paths: Mapping[str, str | None],
                  suffix: str = ".parquet") -> DataFrame:
    """One row per expected table ``(table_name, present, non_empty,
    files, size_bytes, size_kb, status)`` from the listing of its data files,
    and a ``TOTAL`` row whose status says whether anything landed at all.  A
    None path, an absent one and one without data files give status
    ``missing``; names and lengths are read, no content."""
    parts = []
    for name, path in paths.items():
        if path is not None and path_exists(spark, path):
            files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                     .select("path", "length").where(F.col("path").endswith(suffix)))
        else:
            files = spark.createDataFrame([], "path string, length bigint")
        parts.append(files.agg(F.count(F.lit(1)).alias("files"),
                               F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"))
                     .select(F.lit(name).alias("table_name"), "files", "size_bytes"))
    each = union_all(parts)
    both = each.rollup("table_name").agg(F.sum("files").alias("files"),
                                         F.sum("size_bytes").alias("size_bytes"))
    return both.select(
        F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"),
        (F.col("files") > 0).alias("present"), (F.col("size_bytes") > 0).alias("non_empty"),
        "files", "size_bytes", F.round(F.col("size_bytes") / F.lit(1024.0), 1).alias("size_kb"),
        F.when(F.col("files") > 0, "ok").otherwise("missing").alias("status"))


def verify_landing(spark: SparkSession, paths: Mapping[str, str | None]) -> DataFrame:
    """The landing audit; fails when nothing at all has landed, as the
    reference's verification does."""
    audit = landing_audit(spark, paths)
    if audit.where("table_name = 'TOTAL' and files = 0").count():
        raise FileNotFoundError(f"no landed files for {', '.join(paths)}")
    return audit
