"""A training corpus from ``documents``: five stages over everything the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from levygrid.llm import langid, mixing, packing, quality, simhash
from levygrid.llm.queries import vocabulary
from levygrid.operators.stages import discard, scratch_path


#: Rows of a batch that goes to a Python worker; Spark's default of 10,000 texts takes tens of MB on either side.
BATCH_ROWS = 1_000


def _small_batches(spark: SparkSession) -> None:
    """The caller executes a stage's result, so the setting has to stay."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a determined language; the model is fitted on labelled documents.

    Null, empty and letterless texts go, as they have no language. Repeated rows stay, each
    judged alike, whatever their id. An empty table, or one without labels, gives no rows.
    """
    _small_batches(spark)
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.confident(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor their source's verdict reject.

    Null and empty texts go (they have fewer than ten words); rows without a source share a
    host of their own. Repeated rows stay, each judged alike. An empty table gives no rows.
    """
    return quality.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of SimHash near duplicates: that with the least id.

    Null and empty texts are one class. Of repeated rows one stays, and a row without id
    only if its class has no row with one. An empty table gives no rows.
    """
    _small_batches(spark)
    return simhash.deduplicated(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights, documents as often as they are taken.

    Null and empty texts have no words, so they are not taken. Rows without a source are a
    source; repeated rows are documents each. An empty table gives no rows.
    """
    mixed = mixing.mixture(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else mixed


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of tokens.

    Null and empty texts are an end-of-document id; null ids stay null, repeated rows are
    packed each. An empty table gives no rows.
    """
    _small_batches(spark)
    return packing.pack(docs, vocabulary())


STAGES = [
    ("language", language),
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("mixture", mixture),
    ("pack", pack),
]

#: Classifier, fingerprints, components and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each is written to the shared folder and read again by the next.

    What a stage read is deleted once its own rows are written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    read = None
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if read:
            discard(spark, read)
        docs, read = spark.read.parquet(path), path
    return docs
