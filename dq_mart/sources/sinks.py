"""Table sinks (S6, S7, S12): write a version, publish it, audit counts.

A table is a folder of versions and one small pointer file that names the
current one.  A job writes a new version, counts the rows it wrote with an
``Observation`` (a metric collected on the write itself, so no second scan),
and only then switches the pointer.  At every moment the pointer names a
complete version, so a failed run leaves the previous one readable, and
publishing moves no data, also on an object store.  The version before the
current one is kept for readers that have already started; older ones go.
Everything goes through the Hadoop FileSystem API, so the same code works on
a local path, HDFS or an object store.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def write_counted(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Write and return the number of rows written (observed on the write).

    The observation sits directly under the write, in the job's result
    stage, whose metric updates Spark applies once per successful task: a
    retried task or a lost executor does not double-count."""
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["rows"])


POINTER = "_CURRENT"


@dataclass(frozen=True)
class Written:
    table: str
    path: str
    rows: int


def _write_pointer(spark: SparkSession, folder: str, version: str) -> None:
    """Replace the pointer file in one step: a new file renamed over it."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs, final = _fs(spark, f"{folder}/{POINTER}")
    _, new = _fs(spark, f"{folder}/{POINTER}.{version}")
    out = fs.create(new, True)
    try:
        out.write(bytearray(version, "utf-8"))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    flags = spark.sparkContext._gateway.new_array(rename, 1)
    flags[0] = rename.OVERWRITE
    context.rename(fs.makeQualified(new), fs.makeQualified(final), flags)


def _read_pointer(spark: SparkSession, folder: str) -> str | None:
    fs, p = _fs(spark, f"{folder}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def table_path(spark: SparkSession, root: str, table: str) -> str | None:
    """The folder of a published table's current version; None if there is
    no such table."""
    folder = f"{root.rstrip('/')}/{table}"
    version = _read_pointer(spark, folder)
    return f"{folder}/{version}" if version else None


def publish(spark: SparkSession, folder: str, version: str) -> None:
    """Make a finished version the table's current one."""
    previous = _read_pointer(spark, folder)
    _write_pointer(spark, folder, version)
    fs, p = _fs(spark, folder)
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("v_") and name not in (version, previous):
            fs.delete(status.getPath(), True)


def write_table(spark: SparkSession, df: DataFrame, root: str, table: str,
                partition_by: Sequence[str] = ()) -> Written:
    """Full refresh of ``<root>/<table>``: version write, count, pointer."""
    folder = f"{root.rstrip('/')}/{table}"
    version = f"v_{uuid.uuid4().hex[:12]}"
    path = f"{folder}/{version}"
    rows = write_counted(df, path, partition_by=partition_by)
    if not rows and partition_by:
        # no row, no partition folder: an empty file keeps the schema readable
        df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(path)
    publish(spark, folder, version)
    return Written(table, path, rows)


def load_count_audit(spark: SparkSession, written: Sequence[Written],
                     loaded: str | None = None) -> DataFrame:
    """``(table_name, rows_written, rows_read, rows_loaded,
    rows_rejected, ok)`` — the observed write count against a fresh count of
    the published table (from Parquet footers and partition values).
    ``loaded`` is the predicate of a loaded row (all rows without it); the
    others are rejected.  A table that cannot be read gives null counts and
    ``ok = false`` instead of stopping the audit."""
    parts = []
    for w in written:
        try:
            t = spark.read.parquet(w.path)
            n, good = F.count(F.lit(1)), F.count_if(F.expr(loaded or "true"))
            read = t.agg(n.alias("rows_read"), good.alias("rows_loaded"),
                         (n - good).alias("rows_rejected"))
        except AnalysisException:   # missing or unreadable: reported, not raised
            none = F.lit(None).cast("bigint")
            read = spark.range(1).select(none.alias("rows_read"), none.alias("rows_loaded"),
                                         none.alias("rows_rejected"))
        parts.append(read.select(F.lit(w.table).alias("table_name"),
                                 F.lit(w.rows).cast("bigint").alias("rows_written"),
                                 "rows_read", "rows_loaded", "rows_rejected"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("ok", F.coalesce(F.col("rows_written") == F.col("rows_read"),
                                           F.lit(False)))


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str],
               batch_size: int = 10000, max_connections: int = 16,
               mode: str = "append") -> None:
    """S6, JDBC variant: append rows to a database table with batched
    inserts.  ``max_connections`` caps the writing tasks (each task holds one
    connection), so a large cluster does not open thousands of sessions
    against one database; a shuffle hands the rows over, so that the scan and
    the cleaning before it keep their own number of tasks.
    (Not exercised by the tests: no database is started here.)"""
    out = df.repartition(max_connections) if max_connections else df
    props = dict(properties, batchsize=str(batch_size))
    out.write.mode(mode).jdbc(url, table, properties=props)
