"""Dense row numbers without a window over whole groups."""

from pyspark.sql import Window as W, functions as F

from levygrid.operators.numbering import number_rows


def test_numbers_match_a_plain_window(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("g"),
        (F.xxhash64("id") % 5000).alias("x"), "id",
    )
    got = number_rows(rows, ["g"], [F.col("x"), F.col("id")], "n")
    want = rows.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy("x", "id")))
    assert got.exceptAll(want.select(got.columns)).count() == 0
    assert got.count() == 20_000


def test_equal_rows_of_one_group_spread_over_partitions(spark):
    rows = spark.range(40_000).select(F.lit("one").alias("g"), F.lit(1).alias("x"))
    got = number_rows(rows, ["g"], [F.col("x")], "n")
    assert got.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[:] == (1, 40_000, 40_000)

