"""Incremental landing: the landing job (S4) as a Structured Streaming file
source, so a daily run lands only the CSV files that arrived since the last
run, exactly once.

The file source tracks processed files in the query's checkpoint, which by
default belongs to the output (``<out>/_checkpoint``), so the next run goes
on where the last one stopped and its epochs are new ones;
``trigger(availableNow=True)`` processes everything new and stops, which
suits a scheduled batch.  Rows
carry the same ingest ordinal as the batch reader (file name, split start,
row position in the split), so "first in file order" is unchanged.  Each
micro-batch is written by ``foreachBatch`` to its own folder, overwritten
on replay, so a retried epoch never duplicates rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.csv import ORDINAL, READ_OPTIONS, SURPLUS, no_surplus, text_schema, with_surplus


def _batch_writer(out_path: str, data_cols: list[str]):
    """Write one micro-batch to ``<out>/batch=<epoch>``.

    The row position is taken here, on the micro-batch's own file scan
    (``monotonically_increasing_id`` is a batch expression), exactly as the
    batch reader does.  Overwriting the epoch's own folder makes a replayed
    epoch idempotent, so the landing is exactly-once."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        landed = batch.select(*[F.col(f"`{c}`") for c in data_cols], SURPLUS,
                              F.struct(F.col("__file").alias("file"),
                                       F.col("__block").alias("block"),
                                       F.monotonically_increasing_id().alias("row"))
                              .alias(ORDINAL))
        no_surplus(landed).write.mode("overwrite").parquet(
            f"{out_path.rstrip('/')}/batch={epoch_id}")
    return write


def land_stream(spark: SparkSession, csv_dir: str, out_path: str,
                checkpoint: str | None = None, schema: StructType | None = None,
                max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream from ``csv_dir`` to Parquet under
    ``out_path`` (one ``batch=<epoch>`` folder per micro-batch); the caller
    waits with ``awaitTermination()``.  A ``checkpoint`` of one's own must stay
    with the output: a fresh one starts at epoch 0 again and would overwrite
    the first batches, so the default lies in the output folder."""
    schema = schema or text_schema(spark, csv_dir)
    reader = spark.readStream.schema(with_surplus(schema)).options(
        **{k: v for k, v in READ_OPTIONS.items() if k != "inferSchema"})
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    src = reader.csv(csv_dir)
    with_meta = src.select(*[F.col(f"`{c}`") for c in schema.names], SURPLUS,
                           F.col("_metadata.file_path").alias("__file"),
                           F.col("_metadata.file_block_start").alias("__block"))
    return (with_meta.writeStream
            .foreachBatch(_batch_writer(out_path, schema.names))
            .option("checkpointLocation", checkpoint or f"{out_path.rstrip('/')}/_checkpoint")
            .trigger(availableNow=True)
            .start())
