"""Counters of a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from levygrid.config import MatrixConfig
from levygrid.operators.rows import is_tagged


def counters(**tables: DataFrame) -> DataFrame:
    """One row with one column per one-value table, put together without a join."""
    rows = [
        df.select(F.lit(name).alias("name"), df[df.columns[0]].cast("bigint").alias("value"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows).agg(
        *[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in tables]
    )


def count_of(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("value"))


def total_of(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).alias("value"))


def rows_processed(rows: DataFrame, config: MatrixConfig) -> DataFrame:
    """Tagged rows per file."""
    return rows.groupBy("file_idx", "file_name").agg(
        F.count_if(is_tagged(config)).alias("rows_processed")
    )
