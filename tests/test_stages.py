"""Stages and outputs: what writing them leaves on the disk."""

import time

import pytest
from pyspark.sql import functions as F

from levygrid.operators.stages import durable, measured
from levygrid.sinks import files


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle")}


def written_csv(df, path):
    files.write_csv(df, path, [F.col("k")], one_header=True)


def written_errors(df, path):
    part = df.select(F.lit("a").alias("error_type"), F.lit("b").alias("file_name"), F.lit("c").alias("error_message"))
    files.write_errors([part.distinct()], df.select(F.col("k").cast("string").alias("research_id")), path)


@pytest.mark.parametrize("write", [
    lambda df, path: durable(df), lambda df, path: measured(df, n=F.count("*")), written_csv, written_errors,
])
def test_shuffle_files_go_with_the_write(spark, tmp_path, write):
    """Spark deletes them on its own time, so they are waited for."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name)
    before = shuffle_files(spark)
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))
    write(df, str(tmp_path / "out"))
    for _ in range(100):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(name) == setting
    assert df.count() == 10 and len(df.collect()) == len(df.collect()) == 10
