import os

import pytest

import corpus_pipeline
from levygrid.llm import quality, simhash
from tests.llm.frames import ROWS, documents

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_odd_rows(spark, tmp_path):
    docs = documents(spark)
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(docs.columns)


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0, name


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_against_a_plain_run(spark, tmp_path):
    """The same decisions, from the operators' narrow results and plain Python sets."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    first = steps["language"](spark, docs, FOLDER)
    first.write.parquet(str(tmp_path / "a"))
    first = spark.read.parquet(str(tmp_path / "a"))
    truth = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"])}
    assert {r["doc_id"] for r in first.collect()} == truth
    kept = {r["doc_id"] for r in quality.assess(first).where("kept").collect()}
    second = steps["quality"](spark, first, FOLDER)
    assert {r["doc_id"] for r in second.collect()} == kept
    classes = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(second).collect()}
    third = steps["near_dedup"](spark, second, FOLDER)
    assert {r["doc_id"] for r in third.collect()} == {i for i, c in classes.items() if i == c}
    third.write.parquet(str(tmp_path / "c"))
    third = spark.read.parquet(str(tmp_path / "c"))
    mixed = steps["mixture"](spark, third, FOLDER)
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    sources = third.select("source").distinct().count()
    assert abs(words(mixed.collect()) - 1.5 * words(third.collect())) <= sources
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in mixed.collect()}
    fill = {}
    for r in pieces:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 1024 and sum(fill.values()) / (1024 * len(fill)) > 0.9
    assert len(ROWS) > 0


def test_stages_send_small_batches_to_python(spark):
    """Texts go to workers by the thousand, as batches of Spark's default size fill an executor."""
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    for stage in (corpus_pipeline.near_dedup, corpus_pipeline.pack):
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        stage(spark, docs, "")
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
