"""The daily report from kept monthly aggregates.

A fact is stored by month, and beside it, by month as well, the partial
aggregates that the report's sections are made of: counts by branch and
diagnosis, outcomes by doctor, and so on.  Counts and sums of months add up, so
the report is a small aggregate over the partials.

A run compares each month's data files (names, lengths and times, no content)
with the fingerprint that was stored with the month's partials, recomputes the
months that differ, by partition-pruned reads, and replaces just those (dynamic
partition overwrite).  A month whose data is gone loses its partials.  A run
that is killed between months leaves fingerprints that do not fit, and the next
run computes those months again.

Scale: a day's run reads the months that changed, not the history; a month's
partials have a row for each group, not for each event.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analytics as A
from ..sources.sinks import delete_path, path_exists

MONTH = "month"
#: The month of a row without a date.
UNDATED = "undated"
#: Files that the rows of a month are spread over, at most.
FILES = 8


@dataclass(frozen=True)
class Fact:
    """How a fact is kept: its date column, and the groups and sums of its
    partial aggregates."""

    name: str
    date: str
    groups: tuple[str, ...]
    sums: Mapping[str, Column]


def appointments_fact() -> Fact:
    return Fact("appointments", "date_of_consultation", ("branch_id", "diagnosis"), {
        "n": A.count_all(),
        "substitutions": A._cnt_when(A._substituted("requested_doctor_id", "consulted_doctor_id"))})


def surgeries_fact() -> Fact:
    return Fact("surgeries", "surgery_date", ("doctor_id", "surgery_outcome"), {"n": A.count_all()})


def _data(root: str, fact: Fact) -> str:
    return f"{root.rstrip('/')}/facts/{fact.name}"


def _partials(root: str, fact: Fact) -> str:
    return f"{root.rstrip('/')}/partials/{fact.name}"


def replace_months(rows: DataFrame, root: str, fact: Fact) -> None:
    """Store rows by month; the months that occur in ``rows`` are replaced as a
    whole, the others stay."""
    # a month's rows are spread over a few files, so that no month is one task
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(FILES))
    rows.withColumn(MONTH, F.coalesce(A.month_of(fact.date), F.lit(UNDATED))).repartition(MONTH, spread) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(MONTH).parquet(_data(root, fact))


def drop_month(spark: SparkSession, root: str, fact: Fact, month: str) -> None:
    delete_path(spark, f"{_data(root, fact)}/{MONTH}={month}")


def fingerprints(spark: SparkSession, root: str, fact: Fact) -> dict[str, str]:
    """month -> a digest of the listing of its data files: a row for each month."""
    path = _data(root, fact)
    if not path_exists(spark, path):
        return {}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path) \
        .where(F.col("path").endswith(".parquet"))
    line = F.concat_ws("|", "path", F.col("length").cast("string"), F.col("modificationTime").cast("string"))
    by = files.groupBy(F.regexp_extract("path", f"/{MONTH}=([^/]+)/", 1).alias(MONTH)).agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n"), 256).alias("f"))
    return {r[MONTH]: r["f"] for r in by.collect()}


def _stored(spark: SparkSession, root: str, fact: Fact) -> dict[str, str]:
    path = _partials(root, fact)
    if not path_exists(spark, path):
        return {}
    kept = spark.read.parquet(path).select(MONTH, "fingerprint").distinct()
    return {r[MONTH]: r["fingerprint"] for r in kept.collect()}


def refresh(spark: SparkSession, root: str, fact: Fact) -> list[str]:
    """Bring the partials up to date; the months that were computed."""
    now, before = fingerprints(spark, root, fact), _stored(spark, root, fact)
    for month in before.keys() - now.keys():
        delete_path(spark, f"{_partials(root, fact)}/{MONTH}={month}")
    changed = sorted(m for m, f in now.items() if before.get(m) != f)
    if changed:
        rows = spark.read.option("basePath", _data(root, fact)).parquet(
            *[f"{_data(root, fact)}/{MONTH}={m}" for m in changed])
        prints = spark.createDataFrame([(m, now[m]) for m in changed], f"{MONTH} string, fingerprint string")
        rows = rows.withColumn(MONTH, F.col(MONTH).cast("string"))
        partials = rows.groupBy(MONTH, *fact.groups).agg(*[c.alias(n) for n, c in fact.sums.items()])
        # a row for each month that changed
        partials.join(F.broadcast(prints), MONTH).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(_partials(root, fact))
    return changed


def partials(spark: SparkSession, root: str, fact: Fact) -> DataFrame:
    """The stored partial aggregates with their month; null for rows without a date."""
    if not path_exists(spark, _partials(root, fact)):
        raise FileNotFoundError(f"no partial aggregates of {fact.name} under {root}")
    kept = spark.read.parquet(_partials(root, fact)).drop("fingerprint")
    month = F.col(MONTH).cast("string")
    return kept.withColumn(MONTH, F.when(month != UNDATED, month))


# --- sections -----------------------------------------------------------------------

def visits_by_branch(p: DataFrame) -> DataFrame:
    return p.groupBy("branch_id", MONTH).agg(F.sum("n").alias("visit_count"))


def top_diagnoses(p: DataFrame, k: int = 10) -> DataFrame:
    return (p.groupBy("diagnosis").agg(F.sum("n").alias("frequency"))
            .orderBy(F.desc_nulls_first("frequency"), F.asc_nulls_last("diagnosis")).limit(k))


def substitutions(p: DataFrame) -> DataFrame:
    return p.groupBy("branch_id").agg(F.sum("n").alias("total_appointments"),
                                      F.sum("substitutions").alias("substitutions"))


def surgery_outcomes(p: DataFrame, k: int = 20) -> DataFrame:
    n, o = F.col("n"), F.col("surgery_outcome")
    return (p.groupBy("doctor_id").agg(
        F.sum(n).alias("total_surgeries"), F.sum(F.when(o == A.SUCCESSFUL, n).otherwise(0)).alias("successful"),
        F.sum(F.when(o == A.FAILED, n).otherwise(0)).alias("failed"))
        .orderBy(F.desc_nulls_first("total_surgeries"), F.asc_nulls_last("doctor_id")).limit(k))
