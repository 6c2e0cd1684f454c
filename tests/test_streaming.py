"""Incremental landing: each availableNow run lands only new files."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from dq_mart.session import local_fs_path, shared_path
from dq_mart.sources.csv import ORDINAL
from dq_mart.sources.csv import text_schema
from dq_mart.streaming.landing import land_stream

HEADER = "Sl. No.,Branch ID,Location\n"


def _write(folder: str, name: str, rows: list[str]) -> None:
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(HEADER + "".join(r + "\n" for r in rows))


def test_land_stream_is_incremental(spark):
    base = shared_path(spark, "tests", "stream")
    src = local_fs_path(f"{base}/in")
    os.makedirs(src, exist_ok=True)
    out, ckpt = f"{base}/raw/branches", f"{base}/ckpt"
    _write(src, "day1.csv", ["1,BR01,Pune", "2,BR02,Mumbai"])
    schema = text_schema(spark, src)
    assert schema.names == ["Sl. No.", "Branch ID", "Location"]

    land_stream(spark, src, out, checkpoint=ckpt, schema=schema).awaitTermination()
    first = spark.read.parquet(out)
    assert first.count() == 2

    _write(src, "day2.csv", ["3,BR03,Delhi"])
    land_stream(spark, src, out, checkpoint=ckpt, schema=schema).awaitTermination()
    landed = spark.read.parquet(out)
    rows = sorted((r["Branch ID"], r.file) for r in
                  landed.select("`Branch ID`", F.col(f"{ORDINAL}.file").alias("file")).collect())
    assert [(b, f.rsplit("/", 1)[-1]) for b, f in rows] == [
        ("BR01", "day1.csv"), ("BR02", "day1.csv"), ("BR03", "day2.csv")]


def test_default_checkpoint_keeps_earlier_batches(spark):
    """Without a checkpoint of one's own a second run goes on after the first,
    also when the first day's file is gone by then."""
    base = shared_path(spark, "tests", "stream-default")
    src, out = local_fs_path(f"{base}/in"), f"{base}/raw/branches"
    os.makedirs(src, exist_ok=True)
    _write(src, "day1.csv", ["1,BR01,Pune", "2,BR02,Mumbai"])
    land_stream(spark, src, out).awaitTermination()
    _write(src, "day1.csv", [])
    _write(src, "day2.csv", ["3,BR03,Delhi"])
    land_stream(spark, src, out).awaitTermination()
    assert sorted(r["Branch ID"] for r in spark.read.parquet(out).collect()) == ["BR01", "BR02", "BR03"]
