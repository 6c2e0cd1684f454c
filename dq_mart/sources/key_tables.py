"""Key tables (J2, J3, C8, U1): referential checks without shuffling rows.

A fact that refers to three dimensions can be bucketed by one of its keys only.
So the load writes, for each key column, a narrow table of its distinct keys and
their rows, bucketed and sorted by key: one aggregate with map-side partial
counts, as many rows as there are keys.  Checks then join key tables of a child
and a parent bucket by bucket, with no exchange and no sort of either side, as
often as they are run, and tell how many child rows the orphans hold.

Keys are stored as ``(kc, kn)``, the key or a default and whether it is null,
so equality of the pair is null-safe equality; a key's kind is that of both
sides (whole numbers as BIGINT, anything else as the text of
``operators.integrity``).
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..operators.integrity import ForeignKey, key_pair, summarise_flags

#: Buckets of a key table; both sides of a check have the same number.
BUCKETS = 32


@dataclass(frozen=True)
class KeyTable:
    """A bucketed table in the session's catalog, its files at ``path``."""

    name: str
    path: str
    kind: str

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


def kind_of(*types) -> str:
    return "bigint" if all(isinstance(t, IntegralType) for t in types) else "string"


def write_key_table(df: DataFrame, col: str, kind: str, path: str, buckets: int = BUCKETS) -> KeyTable:
    """The distinct keys of a column with their rows, as an external table
    bucketed by key: ``(kc, kn, rows)``."""
    keys = key_pair(df, col, kind, count="rows")
    name = f"keys_{uuid.uuid4().hex}"
    # as many files as buckets: each task writes one
    keys.repartition(buckets, "kc", "kn").write.mode("overwrite").option("path", path) \
        .bucketBy(buckets, "kc", "kn").sortBy("kc", "kn").saveAsTable(name)
    return KeyTable(name, path, kind)


def open_key_table(spark: SparkSession, path: str, kind: str, buckets: int = BUCKETS) -> KeyTable:
    """A key table that another session wrote."""
    name = f"keys_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (kc {kind}, kn boolean, rows bigint) USING parquet "
              f"CLUSTERED BY (kc, kn) SORTED BY (kc, kn) INTO {buckets} BUCKETS LOCATION '{path}'")
    return KeyTable(name, path, kind)


def write_key_tables(checks: Sequence[ForeignKey], root: str, buckets: int = BUCKETS) -> dict[tuple, KeyTable]:
    """The key tables that these checks need, each column and kind once:
    ``(id of the frame, column, kind) -> table``."""
    out: dict[tuple, KeyTable] = {}
    for fk in checks:
        kind = kind_of(fk.child.schema[fk.child_col].dataType, fk.parent.schema[fk.parent_col].dataType)
        for df, col in ((fk.child, fk.child_col), (fk.parent, fk.parent_col)):
            key = (id(df), col, kind)
            if key not in out:
                out[key] = write_key_table(df, col, kind, f"{root.rstrip('/')}/{len(out):03d}", buckets)
    return out


def flagged_rows(spark: SparkSession, pairs: Mapping[str, tuple[KeyTable, KeyTable]]) -> DataFrame:
    """``(label, k_txt, k_num, orphan, rows)``: every child key of every check;
    joined bucket by bucket."""
    parts = []
    for label, (child, parent) in pairs.items():
        if child.kind != parent.kind:
            raise ValueError(f"{label}: keys of kind {child.kind} and {parent.kind}")
        p = parent.frame(spark).select("kc", "kn", F.lit(True).alias("__hit"))
        j = child.frame(spark).join(p, ["kc", "kn"], "left")
        k = F.when(~F.col("kn"), F.col("kc"))
        number = k.cast("double") if child.kind == "bigint" else F.lit(None).cast("double")
        parts.append(j.select(F.lit(label).alias("label"), k.cast("string").alias("k_txt"),
                              number.alias("k_num"), F.col("__hit").isNull().alias("orphan"), "rows"))
    return functools.reduce(DataFrame.unionByName, parts)


def key_integrity(spark: SparkSession, pairs: Mapping[str, tuple[KeyTable, KeyTable]],
                  n_examples: int = 5) -> DataFrame:
    """J3 from key tables: ``(label, child_ids, orphans, examples, child_rows,
    orphan_rows)``, one row for each check."""
    flags = flagged_rows(spark, pairs)
    rows = flags.groupBy("label").agg(
        F.sum("rows").alias("child_rows"),
        F.sum(F.when(F.col("orphan"), F.col("rows")).otherwise(0)).alias("orphan_rows"))
    return summarise_flags(spark, flags, list(pairs), n_examples).join(rows, "label", "left") \
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("child_rows", "orphan_rows")})


def drop_key_tables(spark: SparkSession, tables) -> None:
    """Forget the catalog's entries; the files stay where they are."""
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")
