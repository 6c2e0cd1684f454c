"""Landing only what changed.

A manifest has one row for each landed source file: path, length, modification
time, digest of its rows, rows, and the folder that they are in.  A run lists
the sources (names and lengths, no content) and joins the listing with the
manifest:

* ``unchanged``: same length and time; not read;
* ``touched``: same length, another time, and the digest of what is read is the
  stored one; nothing is written;
* ``changed``, ``new``: landed; the file's rows replace those it had;
* ``vanished``: reported; its rows are in the table no more.

All files of a table that have to be landed are read in one job, written to
folders of their own, and the new manifest is published in one step after
that: readers take the folders that a manifest names, so a run that fails half
way changes nothing.  The digest is a sum of row hashes, computed in parallel
whatever the size of the file.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .csv import ORDINAL, read_raw_csv
from .landing import RAW_PREFIX
from .sinks import path_exists, table_path, write_table

MANIFEST = "_manifest"
SCHEMA = ("table_name string, path string, length bigint, modified timestamp, digest string, "
          "rows bigint, folder string")


def _raw(root: str) -> str:
    return f"{root.rstrip('/')}/{RAW_PREFIX}"


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """What is landed: a row for each source file."""
    path = table_path(spark, _raw(root), MANIFEST)
    return spark.read.parquet(path) if path else spark.createDataFrame([], SCHEMA)


def list_sources(spark: SparkSession, sources: Mapping[str, str], suffix: str = ".csv") -> DataFrame:
    """``(table_name, path, length, modified)`` of the files of each source (a
    file or a folder; an absent one has none)."""
    parts = []
    for name, path in sources.items():
        if path_exists(spark, path):
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            parts.append(files.where(F.col("path").endswith(suffix)).select(
                F.lit(name).alias("table_name"), "path", "length", F.col("modificationTime").alias("modified")))
    none = spark.createDataFrame([], "table_name string, path string, length bigint, modified timestamp")
    return functools.reduce(DataFrame.unionByName, parts, none)


def compared(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Each file of either side with its ``status``; one of the same length
    and another time is ``to_check``."""
    key = ["table_name", "path"]
    old = manifest.select(*key, F.col("length").alias("old_length"), F.col("modified").alias("old_modified"),
                          "digest", "rows", "folder")
    both = listing.join(old, key, "full")
    same = F.col("length") == F.col("old_length")
    return both.withColumn("status", F.when(F.col("length").isNull(), "vanished")
                           .when(F.col("old_length").isNull(), "new")
                           .when(same & (F.col("modified") == F.col("old_modified")), "unchanged")
                           .when(same, "to_check").otherwise("changed"))


def _rows_of(spark: SparkSession, paths: list[str], multiline: bool) -> DataFrame:
    """The raw rows of some files with their path."""
    return read_raw_csv(spark, paths, normalize_nulls=False, multiline=multiline) \
        .withColumn("__path", F.regexp_replace(F.col(f"{ORDINAL}.file"), "^file:/+", "file:/"))


def _digests(rows: DataFrame) -> DataFrame:
    """``(__path, digest, rows)``: a sum of row hashes, the same in any order."""
    data = [F.col(f"`{c}`") for c in rows.columns if c not in (ORDINAL, "__path", "__file")]
    return rows.groupBy("__path").agg(
        F.sum(F.xxhash64(F.struct(*data)).cast("decimal(38,0)")).cast("string").alias("digest"),
        F.count(F.lit(1)).alias("rows"))


def land_changed(spark: SparkSession, sources: Mapping[str, str], root: str, suffix: str = ".csv",
                 multiline: bool = False) -> DataFrame:
    """Land what changed and publish the new manifest.  Returns a row for each
    file of either state: ``(table_name, path, status, rows)``."""
    raw = _raw(root)
    listing = list_sources(spark, sources, suffix)
    files = compared(listing, read_manifest(spark, root)).withColumn(
        "path_key", F.regexp_replace("path", "^file:/+", "file:/"))
    # a row for each source file: names and numbers
    found = files.collect()
    load = uuid.uuid4().hex[:12]
    landed, touched = {}, set()
    for name in sources:
        mine = [r for r in found if r["table_name"] == name]
        check = {r["path_key"]: r for r in mine if r["status"] == "to_check"}
        if check:
            for r in _digests(_rows_of(spark, [r["path"] for r in check.values()], multiline)).collect():
                if r["digest"] == check[r["__path"]]["digest"]:
                    touched.add((name, r["__path"]))
        todo = [r for r in mine if r["status"] in ("new", "changed")
                or r["status"] == "to_check" and (name, r["path_key"]) not in touched]
        if not todo:
            continue
        rows = _rows_of(spark, [r["path"] for r in todo], multiline)
        folder = f"{raw}/{name}/load_{load}"
        rows.withColumn("__file", F.sha1("__path")).write.mode("overwrite").partitionBy("__file").parquet(folder)
        written = spark.read.parquet(folder)
        if "__file" in written.columns:
            for r in _digests(written).collect():
                landed[name, r["__path"]] = (r["digest"], r["rows"])
    out, kept = [], []
    for r in found:
        key = (r["table_name"], r["path_key"])
        status = "touched" if key in touched else "changed" if r["status"] == "to_check" else r["status"]
        if status in ("new", "changed"):
            digest, rows = landed.get(key, (None, 0))          # a header alone: no rows
            folder = f"{r['table_name']}/load_{load}" if rows else None
        else:
            digest, rows, folder = r["digest"], r["rows"], r["folder"]
        out.append((r["table_name"], r["path"], status, rows))
        if status != "vanished":
            kept.append((r["table_name"], r["path"], r["length"], r["modified"], digest, rows, folder))
    write_table(spark, spark.createDataFrame(kept, SCHEMA).coalesce(1), raw, MANIFEST)
    return spark.createDataFrame(out, "table_name string, path string, status string, rows bigint")


def read_changed(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The rows of a table as the manifest names them; None without any."""
    raw = _raw(root)
    mine = read_manifest(spark, root).where(F.col("table_name") == table).where("folder is not null")
    folders = [f"{raw}/{r['folder']}/__file={r['file']}" for r in mine.select(
        "folder", F.sha1(F.regexp_replace("path", "^file:/+", "file:/")).alias("file")).distinct().collect()]
    return spark.read.parquet(*folders).drop("__path") if folders else None
