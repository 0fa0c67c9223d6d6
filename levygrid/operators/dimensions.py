"""Look-up dimensions built from their raw tables.

Raw tables carry an ``ordinal`` column (any orderable type), the position of the row in
its file; "last wins" and "first wins" rules refer to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from levygrid import constants as C
from levygrid.config import MatrixConfig
from levygrid.functions.ids import is_state_geocode, normalize_research_id, pad_item_code
from levygrid.operators.lookup import Dimension


def state_geocodes(geo: DataFrame) -> DataFrame:
    """state -> state-level geocode; the last row of a state wins."""
    return (
        geo.where((F.col("geocode") != "") & (F.col("state") != ""))
        .where(is_state_geocode(F.col("geocode")))
        .groupBy("state")
        .agg(F.max_by("geocode", "ordinal").alias("geocode"))
    )


def city_geocodes(geo: DataFrame) -> DataFrame:
    """Upper-cased city -> its distinct geocodes, first position first, in any state."""
    return (
        geo.where((F.col("geocode") != "") & (F.col("state") != "") & (F.col("city") != ""))
        .groupBy(F.upper("city").alias("city"), "geocode")
        .agg(F.min("ordinal").alias("geo_idx"))
    )


def tax_categories(raw: DataFrame) -> DataFrame:
    """description -> code, exact case; the last row of a description wins."""
    return (
        raw.where((F.col("tax_cat") != "") & (F.col("tax_cat_desc") != ""))
        .groupBy("tax_cat_desc")
        .agg(F.max_by("tax_cat", "ordinal").alias("tax_cat"))
    )


def tax_types_by_key(raw: DataFrame) -> DataFrame:
    """(geocode, tax_cat) -> sorted distinct tax types, keys as written."""
    return (
        raw.where((F.col("geocode") != "") & (F.col("tax_cat") != "") & (F.col("tax_type") != ""))
        .groupBy("geocode", "tax_cat")
        .agg(
            F.array_sort(F.collect_set("tax_type")).alias("tax_types"),
            F.min("ordinal").alias("ordinal"),
        )
    )


def tax_types(raw: DataFrame) -> DataFrame:
    """Case-insensitive (geocode, tax_cat) -> tax types.

    If keys differ in case only, the upper-case one wins, else the first in the file.
    """
    up_geo, up_cat = F.upper("geocode"), F.upper("tax_cat")
    not_exact = (F.col("geocode") != up_geo) | (F.col("tax_cat") != up_cat)
    return (
        tax_types_by_key(raw)
        .groupBy(up_geo.alias("geo_key"), up_cat.alias("cat_key"))
        .agg(F.min_by("tax_types", F.struct(not_exact, "ordinal")).alias("tax_types"))
    )


def product_codes(raw: DataFrame) -> DataFrame:
    """Normalized research id -> padded item code; the last row of an id wins."""
    return (
        raw.where((F.col("research_id") != "") & (F.col("item") != ""))
        .select(
            normalize_research_id(F.col("research_id")).alias("research_key"),
            pad_item_code(F.col("item")).alias("item_code"),
            "ordinal",
        )
        .groupBy("research_key")
        .agg(F.max_by("item_code", "ordinal").alias("item_code"))
    )


def state_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(C.US_STATES.items()), "state_name string, state string")


def state_locations(names: DataFrame, states: DataFrame) -> DataFrame:
    """Jurisdiction name -> state geocode, without the city leg."""
    return names.join(states, "state").select(
        F.col("state_name").alias("jurisdiction"), "geocode"
    )


def locations(names: DataFrame, states: DataFrame, cities: DataFrame) -> DataFrame:
    """Jurisdiction name -> geocode(s): a state of that name, else the cities."""
    by_state = state_locations(names, states)
    by_city = cities.withColumnRenamed("city", "jurisdiction").join(
        by_state.select("jurisdiction"), "jurisdiction", "left_anti"
    )
    first = F.lit(None).cast(cities.schema["geo_idx"].dataType)
    return by_state.withColumn("geo_idx", first).unionByName(by_city)


@dataclass
class Dimensions:
    """The look-ups of one run; one that no join uses is never computed."""

    locations: Dimension
    tax_cats: Dimension
    tax_types: Dimension
    product_codes: Dimension

    @classmethod
    def build(
        cls,
        geo: DataFrame,
        names: DataFrame,
        tax_cat: DataFrame,
        tax_type: DataFrame,
        codes: DataFrame,
        config: MatrixConfig,
    ) -> "Dimensions":
        def dim(df: DataFrame, *keys: str) -> Dimension:
            return Dimension(df, list(keys), config.broadcast_bytes, config.salts)

        return cls(
            locations=dim(
                locations(names, state_geocodes(geo), city_geocodes(geo)), "jurisdiction"
            ),
            tax_cats=dim(tax_categories(tax_cat), "tax_cat_desc"),
            tax_types=dim(tax_types(tax_type), "geo_key", "cat_key"),
            product_codes=dim(product_codes(codes), "research_key"),
        )
