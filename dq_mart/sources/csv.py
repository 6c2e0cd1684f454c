"""Raw CSV reader and writer.

The reader keeps every field as text (no ``inferSchema``: it would cost a
second scan and guess differently from the reference), applies the
reference reader's null tokens, and can attach the *ingest ordinal* — the
file order of each row — taken on the scan itself:

    ingest_ord = struct(file path, split start offset, monotonically_increasing_id())

Within one split, ``monotonically_increasing_id`` grows with file order;
splits of one file are ordered by their start offset; files by name.  So
sorting by the struct restores file order without any shuffle, and the
value is deterministic when a task is retried.  It is written out at
landing time and never recomputed after a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import null_tokens

ORDINAL = "ingest_ord"

# Reader options matching the reference's CSV dialect: header row, doubled
# quotes inside quoted fields, empty field = missing.  A row with fewer fields
# than the header is filled up with nulls; one with more fails the job (see
# ``no_surplus``).  Columns are never pruned in the parser, whose check of a
# row would otherwise depend on what a query selects.
READ_OPTIONS = {
    "header": "true",
    "inferSchema": "false",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnPruning": "false",
    "encoding": "UTF-8",
}

# Writer options matching the reference's ``to_csv``: header, doubled
# quotes, nulls as empty fields, no whitespace trimming.
WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


#: Takes the first field beyond the header's.
SURPLUS = "__surplus"


def text_schema(spark: SparkSession, path: str | list[str], options: Mapping[str, str] | None = None) -> StructType:
    """All-text schema from the header of the files (no data is read)."""
    names = spark.read.options(**dict(READ_OPTIONS, **(options or {}))).csv(path).columns
    return StructType([StructField(c, StringType(), True) for c in names])


def with_surplus(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(SURPLUS, StringType(), True)])


def no_surplus(df: DataFrame) -> DataFrame:
    """Fail on a row with more fields than the header, whatever is selected:
    a filter that every row passes or raises in."""
    surplus = F.col(SURPLUS).isNotNull()
    message = F.concat(F.lit("CSV row with more fields than the header; first one beyond: "), SURPLUS)
    return df.where(F.when(surplus, F.raise_error(message).cast("boolean")).otherwise(True)).drop(SURPLUS)


def read_raw_csv(spark: SparkSession, path: str | list[str], *, with_ordinal: bool = True,
                 normalize_nulls: bool = True, multiline: bool = False,
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """All-text scan of a CSV file or folder, or of several.

    ``multiline`` allows quoted newlines but stops file splitting, so it is
    off by default.
    """
    opts = dict(READ_OPTIONS, multiLine=str(multiline).lower(), **(options or {}))
    schema = text_schema(spark, path, opts)
    data_cols = schema.names
    df = spark.read.options(**opts).schema(with_surplus(schema)).csv(path)
    if with_ordinal:
        df = df.select(*[F.col(f"`{c}`") for c in data_cols], SURPLUS,
                       F.struct(F.col("_metadata.file_path").alias("file"),
                                F.col("_metadata.file_block_start").alias("block"),
                                F.monotonically_increasing_id().alias("row"))
                       .alias(ORDINAL))
    df = no_surplus(df)
    if normalize_nulls:
        df = df.select(*[null_tokens(F.col(f"`{c}`")).alias(c) for c in data_cols],
                       *([ORDINAL] if with_ordinal else []))
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              options: Mapping[str, str] | None = None) -> None:
    """CSV sink with the reference's dialect; one file per partition."""
    df.write.mode(mode).options(**dict(WRITE_OPTIONS, **(options or {}))).csv(path)


def csv_text(cols: list[str]) -> Column:
    """The named columns of a row as one CSV text line, same dialect as the
    writer (quotes doubled, nulls empty)."""
    opts = {k: v for k, v in WRITE_OPTIONS.items() if k != "header"}
    return F.to_csv(F.struct(*[F.col(f"`{c}`") for c in cols]), opts)
