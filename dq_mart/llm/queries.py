"""The registered queries: each applies one operator, with its production
parameters, to the whole of its table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (codesearch, decontaminate, licenses, maintext, manifest, neardup, packing, pii,
               quality, runs, secrets, toxicity, urlfilter)
from .common import fold_of, table


def op1_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op2_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source is the owner, its language part the repository."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"),
                                 repo=F.concat_ws("/", "source", "lang"))
    live = F.filter("found", lambda c: c["verdict"] == "live")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
                        secrets.named_spans("found").alias("spans"),
                        F.size(live).cast("bigint").alias("n_live"),
                        (F.size("found") - F.size(live)).cast("bigint").alias("n_example"))


def op3_quality_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(fold_of("doc_id") != 0))
    return quality.score(docs, model).select(
        "doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_lines", "bad_lines")


def op4_url_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The rules of the query, as verdict, host, path.
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"),
             ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
    pages = table(spark, sf_dir, "pages")
    return urlfilter.judge(pages, urlfilter.fit(pages), rules).select(
        "page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"), "words")


def op5_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id", F.array_join("sentences", ",").alias("sentences"),
        F.array_join("licenses", ",").alias("licenses"),
        F.size("licenses").cast("bigint").alias("n_licenses"))


def op6_pii_semi_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.fit(docs)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")


def op7_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = toxicity.fit(docs, labels.where(fold_of("doc_id") != 0))
    return toxicity.score(docs, index).select(
        "doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op8_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                       "doc_tokens", "sequence_id", "offset")


def op10_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id is divisible by 100 asks for its ten nearest codes."""
    rows = table(spark, sf_dir, "embeddings")
    return codesearch.nearest_codes(rows, rows.where("vec_id % 100 = 0"), k=10)


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return maintext.extract(pages, maintext.fit(pages)).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """The rows with the words of every tenth text (by hash) made periodic."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.expr("h div 10")

    def planted(words):
        n = F.size(words).cast("bigint")
        a = F.pmod(g, n)
        p = 1 + F.call_function("div", n - a, 3 + g % 8)
        again = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")),
                                         (F.call_function("div", n - a, p) + 1).cast("int")))
        out = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(again, F.lit(1), (n - a).cast("int")))
        return F.when(n > 0, F.array_join(out, " ")).otherwise(F.lit(""))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # an array of one, so that the words are cut once
    return docs.select("doc_id", "text", h.alias("h")).select("doc_id", F.when(
        (F.col("h") % 10 == 0) & F.col("text").isNotNull(),
        F.transform(F.array(words), planted)[0]).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.get(F.sort_array(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words").select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-1000 * best.less div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256", "n_words")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-casing A-Z of every fifth row's text is the tampering to find."""
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return manifest.verify(docs, "source", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"],
                           {"text": lower}, fold_of("doc_id") == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_minhash_neardup, op2_secret_ownership, op3_quality_line_crf, op4_url_words,
        op5_license_sentences, op6_pii_semi_markov, op7_toxicity_neighbours,
        op8_cgk_decontamination, op9_sum_of_squares_packing, op10_multi_index_hashing,
        op11_main_text, op12_periodic_runs, op13_merkle_manifest)
}
