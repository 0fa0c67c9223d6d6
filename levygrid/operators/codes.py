"""Research ids to item codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from levygrid.functions.ids import normalize_research_id
from levygrid.operators.lookup import Dimension, lookup_join
from levygrid.operators.records import spread_of


def with_item_codes(df: DataFrame, codes: Dimension) -> DataFrame:
    """Replace ``item`` by its code; rows of unmapped ids drop out."""
    columns = df.columns
    keys = {"research_key": normalize_research_id(F.col("item"))}
    found = lookup_join(df, codes, keys, "inner", spread_of(df))
    return found.withColumn("item", F.col("item_code")).select(*columns)


def unmapped_ids(*sources: DataFrame, codes: Dimension) -> DataFrame:
    """Distinct ids, as written, that no code exists for."""
    items = None
    for df in sources:
        one = df.select("item")
        items = one if items is None else items.unionByName(one)
    keys = {"research_key": normalize_research_id(F.col("item"))}
    # Distinct first: few ids are left to look up and none of them is hot.
    return lookup_join(items.distinct(), codes, keys, "left_anti", ["item"]).select(
        F.col("item").alias("research_id")
    )
