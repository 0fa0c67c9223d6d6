"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from levygrid.llm import (
    extraction, fingerprints, langid, lexical, licenses, mixing, packing, periodic, quality, quotes, simhash,
    tokencounts, warc,
)
from levygrid.llm.common import table

#: Folder of the public tokenizers' files, where it isn't the installed one.
TOKENIZERS = "LEVYGRID_TOKENIZERS"


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a tokenizer's file; it must be the same on all executors."""
    if folder := os.environ.get(TOKENIZERS):
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held))
    return docs.select(
        "doc_id", held.alias("held_out"), langid.predicted(docs, model).alias("p")
    ).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.main_texts(pages, extraction.fit_on(pages))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents, every tenth of which gets a repeated tail first."""
    docs = table(spark, sf_dir, "documents")
    found = periodic.detect(docs.select("doc_id", periodic.with_loops(docs).alias("text")))
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    stronger = lambda a, b: (
        a["start"].isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    )
    best = F.reduce("runs", none, lambda a, b: F.when(stronger(a, b), b).otherwise(a))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_document_fingerprints, op2_license_scan, op3_quality_rules, op4_simhash_near_dedup,
        op5_language_id, op6_warc, op7_packing, op8_html_extraction, op9_source_mixing,
        op10_quotation_linking, op11_token_counts, op12_lexical_search, op13_periodic_runs,
    ]
    return {f.__name__: f for f in own}
