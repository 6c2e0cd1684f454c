"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import checkpoint_root

#: Rows and bytes of one Arrow batch handed to a Python task; whole texts may
#: be long, so the default of 10,000 rows could hold gigabytes.  Vectorised
#: work takes some forty times the bytes of a slice for a moment.
BATCH_ROWS = 1000
BATCH_BYTES = 2 << 20
#: Python workers live on from stage to stage: what a slice took goes back to
#: the system at once instead of staying with the worker.
_ALLOCATION = {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_ARENA_MAX": "2",
               "ARROW_DEFAULT_MEMORY_POOL": "system"}
#: The folder that this package is in.
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_tasks(spark: SparkSession) -> None:
    """Settings of Python tasks.  What one Arrow batch holds is bounded (a
    smaller setting of the user stays), and workers find this package also when
    the driver found it by ``sys.path`` alone (on a cluster it is installed or
    sent along, and the path is no use but no harm)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    for key, value in _ALLOCATION.items():
        env.setdefault(key, value)
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        try:
            now = int(str(spark.conf.get(key)).rstrip("b"))
        except Exception as e:  # the second setting is newer than the first
            if "SQL_CONF_NOT_FOUND" not in str(e) and not isinstance(e, ValueError):
                raise
            continue
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


#: Ids that are sent to every task at most; more are joined by a shuffle.
IDS = 1_000_000


def ids_side(ids: DataFrame, most: int = IDS) -> DataFrame:
    """A checkpointed table of ids as the side of a join: broadcast if its
    counted size allows, so that the other side, with whole texts, stays where
    it is; else left to Spark's shuffle joins."""
    return F.broadcast(ids) if ids.count() <= most else ids


def fold_of(id_col) -> "F.Column":
    """The remainder by 5 of the CRC-32 of the id written as text."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def pieces(batch: pa.RecordBatch, most_bytes: int = BATCH_BYTES,
           text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts together stay near ``most_bytes``."""
    col = batch.column(batch.schema.get_field_index(text))
    if batch.num_rows == 0:
        return
    size = np.asarray(pc.binary_length(col).fill_null(0), dtype=np.int64)
    group = np.cumsum(size) // most_bytes
    cuts = np.flatnonzero(np.diff(group)) + 1
    at = 0
    for to in [*cuts.tolist(), batch.num_rows]:
        yield batch.slice(at, to - at)
        at = to


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from flat values and the count of each row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch],
              schema: str) -> DataFrame:
    """``mapInArrow`` with bounded slices: ``fn`` turns a slice into rows."""
    python_tasks(df.sparkSession)

    def run(batches):
        for b in batches:
            for p in pieces(b):
                yield fn(p)
    return df.mapInArrow(run, schema)
