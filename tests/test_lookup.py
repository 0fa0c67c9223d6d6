"""Look-up joins: how a dimension reaches the facts."""

import pytest
from pyspark.sql import functions as F

from levygrid.operators.lookup import Dimension, lookup_join
from levygrid.operators.stages import durable


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_large_dimension_is_never_broadcast(spark, how):
    """Its files and Spark's estimate may be small, but the salted copies are not."""
    facts = durable(spark.range(100).select("id", (F.col("id") % 20).alias("key")))
    codes = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("code"))
    joined = [
        lookup_join(facts, Dimension(codes, ["k"], size, salts=4), {"k": F.col("key")}, how, ["id"])
        for size in (-1, 1 << 20)
    ]
    large, small = [df._jdf.queryExecution().executedPlan().toString() for df in joined]
    assert "Broadcast" in small
    assert "SortMergeJoin" in large and "Broadcast" not in large
    rows = [sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr) for df in joined]
    assert rows[0] == rows[1]
