"""Snapshots: one commit for several tables.

A refresh writes every table as a new version folder that nothing refers to
yet (``stage_table``).  When all are written and audited, one small manifest
naming the version of every table is put into ``<root>/_snapshots``.  Manifests
are numbered; number n + 1 can be created once, by a run that read snapshot n
(compare and set), so of two runs that started from the same snapshot the
second fails instead of undoing the first.  A run that is killed, or whose
audit is false, before that leaves the snapshot as it was, for all tables.

A manifest is written under a name of its own and renamed to its number
without overwriting, which fails where the number exists; readers only see
whole manifests.  (On an object store without such a rename, the store's own
put-if-absent takes its place.)  Readers name a snapshot, or take the latest
once and read all tables of it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .sinks import Written, _fs

FOLDER = "_snapshots"
_DIGITS = 12


class SnapshotConflict(RuntimeError):
    """Another run committed since this one read the snapshot."""


@dataclass(frozen=True)
class Snapshot:
    """Number 0, without tables, is the state before the first commit."""

    number: int = 0
    tables: Mapping[str, str] = field(default_factory=dict)     # name -> version folder
    rows: Mapping[str, int] = field(default_factory=dict)


def _manifest(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{number:0{_DIGITS}d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, p = _fs(spark, f"{root.rstrip('/')}/{FOLDER}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_snapshot(spark: SparkSession, root: str, number: int | None = None) -> Snapshot:
    """The snapshot of that number; the latest without one."""
    if number is None:
        number = max(_numbers(spark, root), default=0)
    if number == 0:
        return Snapshot()
    fs, p = _fs(spark, _manifest(root, number))
    stream = fs.open(p)
    try:
        data = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Snapshot(number, data["tables"], data["rows"])


def commit(spark: SparkSession, root: str, base: Snapshot, tables: Mapping[str, str],
           rows: Mapping[str, int], keep_others: bool = False) -> Snapshot:
    """Make these versions the next snapshot after ``base``; with
    ``keep_others`` its other tables stay as they were."""
    old = base if keep_others else Snapshot()
    new = Snapshot(base.number + 1, {**old.tables, **tables}, {**old.rows, **rows})
    final = _manifest(root, new.number)
    fs, target = _fs(spark, final)
    _, own = _fs(spark, f"{root.rstrip('/')}/{FOLDER}/.{uuid.uuid4().hex}")
    out = fs.create(own, False)
    try:
        out.write(bytearray(json.dumps({"tables": dict(new.tables), "rows": dict(new.rows)}), "utf-8"))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    flags = spark.sparkContext._gateway.new_array(kind, 1)
    flags[0] = kind.NONE
    try:
        context.rename(fs.makeQualified(own), fs.makeQualified(target), flags)
    except Py4JJavaError as e:
        fs.delete(own, False)
        if "FileAlreadyExists" in str(e.java_exception):
            raise SnapshotConflict(f"snapshot {new.number} of {root} was committed by another run") from e
        raise
    return new


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove version folders that none of the last ``keep`` snapshots names;
    the number removed.  Not while a refresh is being written: its versions
    are in no snapshot yet."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    used = {v for n in numbers[-keep:] for v in read_snapshot(spark, root, n).tables.values()}
    fs, p = _fs(spark, root)
    gone = 0
    for table in fs.listStatus(p) if numbers else []:
        name = table.getPath().getName()
        if not table.isDirectory() or name.startswith("_"):
            continue
        for version in fs.listStatus(table.getPath()):
            if version.getPath().getName().startswith("v_") and f"{name}/{version.getPath().getName()}" not in used:
                fs.delete(version.getPath(), True)
                gone += 1
    for n in numbers[:-keep]:
        fs.delete(_fs(spark, _manifest(root, n))[1], False)
    return gone


@dataclass(frozen=True)
class Staged(Written):
    """A version that was written but not published, and what was counted on
    the way."""

    version: str = ""
    metrics: Mapping[str, int | None] = field(default_factory=dict)


def stage_table(df: DataFrame, root: str, table: str, partition_by: Sequence[str] = (),
                metrics: Mapping[str, Column] | None = None, drop: Sequence[str] = ()) -> Staged:
    """Write a new version without publishing it.  ``metrics`` (aggregates over
    the written rows and the ``drop`` columns, which are not written) are
    observed on the write itself, in its result stage, where a retried task
    counts once: no second scan."""
    version = f"v_{uuid.uuid4().hex[:12]}"
    path = f"{root.rstrip('/')}/{table}/{version}"
    seen = Observation(f"write_{uuid.uuid4().hex[:8]}")
    exprs = {"rows": F.count(F.lit(1)), **(metrics or {})}
    out = df.observe(seen, *[c.alias(n) for n, c in exprs.items()]).drop(*drop)
    w = out.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    got = dict(seen.get)
    rows = int(got.pop("rows"))
    if not rows and partition_by:
        # no row, no partition folder: an empty file keeps the schema readable
        df.sparkSession.createDataFrame([], out.schema).coalesce(1).write.mode("append").parquet(path)
    return Staged(table, path, rows, f"{table}/{version}", got)


def snapshot_table(spark: SparkSession, root: str, table: str,
                   snapshot: Snapshot | None = None) -> DataFrame:
    """A table as of a snapshot (the latest without one)."""
    snapshot = snapshot or read_snapshot(spark, root)
    if table not in snapshot.tables:
        raise FileNotFoundError(f"no table {table} in snapshot {snapshot.number} of {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{snapshot.tables[table]}")
