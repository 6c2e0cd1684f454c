"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's rows as Parquet in the shared folder and reads them again as
the next one's ``docs``.  All stages but the last return the columns of
``documents``, whatever further columns there are.

* toxicity: documents with a score of 0.5 or more go; the index is fitted on
  the labelled documents outside the held-out fold;
* near_duplicates: one document of each component stays, the one of the least
  id (five-word shingles, similarity 0.8 or more); of rows that repeat an id
  one stays; rows without an id all stay;
* decontamination: documents that hold a passage of a benchmark item go;
* pii: every personal span is replaced by its kind in brackets, and
  ``n_chars`` (where there is one) counts the new text;
* packing: a row for each piece of a sequence.

Rows with a null text are kept (they hold nothing to reject) and packed as
empty texts; an empty table gives no rows at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from dq_mart.llm import decontaminate, neardup, packing, pii, toxicity
from dq_mart.llm.common import cut, fold_of, ids_side, table
from dq_mart.session import scratch_path, shared_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    index = toxicity.fit(docs, labels.where(fold_of("doc_id") != 0))
    return docs.where(toxicity.score_of(spark, index)(F.col("text")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = neardup.near_duplicates(docs)
    gone = cut(groups.where(~F.col("kept")).select("doc_id").distinct())
    names = [F.col(f"`{c}`") for c in docs.columns]
    out = docs.join(ids_side(gone), "doc_id", "left_anti").select(*names)
    repeats = docs.groupBy("doc_id").count().where("doc_id is not null and count > 1")
    if repeats.isEmpty():
        return out
    rank = "rank"
    while rank in docs.columns:
        rank += "_"
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64(*names))
    return (out.where("doc_id is not null").withColumn(rank, F.row_number().over(one))
            .where(F.col(rank) == 1).drop(rank).unionByName(out.where("doc_id is null")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = pii.redaction(spark, pii.fit(docs))
    out = docs.withColumn("text", redacted(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                       "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  A stage's rows go once the next one has used
    them, also when a stage fails; the last one's when the driver ends."""
    docs, written = table(spark, sf_dir, "documents"), []
    try:
        for name, stage in STAGES[:-1]:
            written.append(shared_path(spark, "pipeline", name))
            stage(spark, docs, sf_dir).write.parquet(written[-1])
            if len(written) > 1:
                _remove(spark, written.pop(0))
            docs = spark.read.parquet(written[-1])
        name, stage = STAGES[-1]
        last = scratch_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(last)
    finally:
        for path in written:
            _remove(spark, path)
    return spark.read.parquet(last)
