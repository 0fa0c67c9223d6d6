"""Sheet rows to matrix records: parse, collapse, fan out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from levygrid import constants as C
from levygrid.config import LOGICAL_COLUMNS, MatrixConfig
from levygrid.functions import percent
from levygrid.functions.treatment import (
    format_percent,
    is_unknown_status,
    parse_percent,
    parse_taxable,
)
from levygrid.operators.dimensions import Dimensions
from levygrid.operators.lookup import Dimension, lookup_join
from levygrid.operators.rows import tagged_any_case, with_jurisdiction

# Identifies a row among rows of equal look-up key, to spread hot keys.
SPREAD = ["file_idx", "ordinal"]
SIDES = ["business", "personal"]


def with_tax_cat(rows: DataFrame, desc: str, code: str, tax_cats: Dimension) -> DataFrame:
    """Add the category code of a description: '' is '00', an unknown text is itself."""
    joined = lookup_join(rows, tax_cats, {"tax_cat_desc": F.col(desc)}, "left", SPREAD)
    value = F.when(F.col(desc) == "", F.lit(C.DEFAULT_TAX_CAT)).otherwise(
        F.coalesce(F.col("tax_cat"), F.col(desc))
    )
    return joined.withColumn(code, value).drop("tax_cat")


def parsed_sides(rows: DataFrame, config: MatrixConfig, tax_cats: Dimension) -> DataFrame:
    """Tagged rows with an id, both sides parsed, and whether each side is valid."""
    rows = tagged_any_case(rows, config).where(F.col("current_id") != "")
    parsed = rows.select(
        *[c for c in rows.columns if c not in LOGICAL_COLUMNS and c != "description"],
        F.col("current_id").alias("item"),
        *[
            column
            for s in SIDES
            for column in (
                F.col(f"{s}_use"),
                F.col(f"{s}_tax_cat").alias(f"{s}_desc"),
                parse_taxable(F.col(f"{s}_use")).alias(f"{s}_taxable"),
                parse_percent(F.col(f"{s}_percent_tax")).alias(f"{s}_percent"),
            )
        ],
    )
    for s in SIDES:
        parsed = with_tax_cat(parsed, f"{s}_desc", f"{s}_code", tax_cats)
    return parsed.withColumns(
        {
            f"{s}_valid": F.col(f"{s}_taxable").isNotNull() & F.col(f"{s}_percent").isNotNull()
            for s in SIDES
        }
    )


def same_treatment() -> Column:
    """Both sides valid and equal in status, category and percent (as numbers)."""
    equal = percent.equal(F.col("business_percent"), F.col("personal_percent"))
    for part in ("taxable", "code"):
        equal = equal & (F.col(f"business_{part}") == F.col(f"personal_{part}"))
    return F.col("business_valid") & F.col("personal_valid") & equal


def treatments(parsed: DataFrame) -> DataFrame:
    """One row per record template: a row yields none, one or two of them."""

    def side(i: int, name: str, customer: str) -> Column:
        return F.struct(
            F.lit(i).alias("side_idx"),
            F.lit(customer).alias("customer"),
            F.col(f"{name}_taxable").alias("taxable"),
            F.col(f"{name}_code").alias("tax_cat"),
            format_percent(F.col(f"{name}_percent")).alias("percent_taxable"),
        )

    business = F.when(
        F.col("business_valid") & ~same_treatment(), side(0, "business", C.CUSTOMER_BUSINESS)
    )
    personal = F.when(F.col("personal_valid"), side(1, "personal", C.CUSTOMER_PERSONAL))
    kept = [c for c in parsed.columns if not c.startswith(tuple(SIDES))]
    return (
        parsed.where(F.col("business_valid") | F.col("personal_valid"))
        .select(*kept, business.alias("b"), personal.alias("p"))
        .select(*kept, F.explode(F.array("b", "p")).alias("side"))
        .where(F.col("side").isNotNull())
        .select(*kept, "side.*")
    )


def at_geocodes(rows: DataFrame, locations: Dimension) -> DataFrame:
    """Repeat rows for every geocode of their file; rows of unknown files drop out."""
    return lookup_join(
        with_jurisdiction(rows), locations, {"jurisdiction": F.col("jurisdiction")},
        "inner", SPREAD,
    ).drop("jurisdiction")


def templates(rows: DataFrame, dims: Dimensions, config: MatrixConfig) -> DataFrame:
    """Record templates at every geocode, before tax types are known."""
    return at_geocodes(treatments(parsed_sides(rows, config, dims.tax_cats)), dims.locations)


def type_keys() -> dict[str, Column]:
    return {
        "geo_key": F.upper("geocode"),
        "cat_key": F.upper("tax_cat"),
    }


def spread_of(df: DataFrame) -> list[str]:
    return [c for c in SPREAD if c in df.columns] or df.columns


def with_tax_types(records: DataFrame, tax_types: Dimension) -> DataFrame:
    """One record per tax type of its geocode and category; without types it drops out."""
    found = lookup_join(records, tax_types, type_keys(), "inner", spread_of(records))
    return found.withColumn("tax_type", F.explode("tax_types")).drop("tax_types")


def without_tax_types(records: DataFrame, tax_types: Dimension) -> DataFrame:
    """Templates that no tax type applies to."""
    return lookup_join(records, tax_types, type_keys(), "left_anti", spread_of(records))


def with_default_tax_types(records: DataFrame, tax_types: Dimension) -> DataFrame:
    """Like ``with_tax_types``, but a miss gets the default type."""
    found = lookup_join(records, tax_types, type_keys(), "left", spread_of(records))
    types = F.coalesce("tax_types", F.array(F.lit(C.DEFAULT_TAX_TYPE)))
    return found.withColumn("tax_type", F.explode(types)).drop("tax_types")


def as_matrix(records: DataFrame, config: MatrixConfig) -> DataFrame:
    """Fill in the constant columns, in output order; keeps the ordering columns."""
    order = [c for c in ("file_idx", "geo_idx", "ordinal", "side_idx") if c in records.columns]
    constants = {
        "tax_auth_id": C.TAX_AUTH_ID,
        "group": C.GROUP_CODE,
        "provider": C.PROVIDER_CODE,
        "transaction": C.TRANSACTION_CODE,
        "effective": config.effective_date,
        "per_taxable_type": C.PER_TAXABLE_TYPE,
    }
    records = records.withColumns({k: F.lit(v) for k, v in constants.items()})
    return records.select(*order, *C.MATRIX_COLUMNS)


def unknown_statuses(rows: DataFrame, dims: Dimensions, config: MatrixConfig) -> DataFrame:
    """Unknown status texts, once per geocode, row and side."""
    tagged = tagged_any_case(rows, config).where(F.col("current_id") != "")
    texts = F.array(
        *[F.when(is_unknown_status(F.col(f"{s}_use")), F.col(f"{s}_use")) for s in SIDES]
    )
    flagged = tagged.where(
        is_unknown_status(F.col("business_use")) | is_unknown_status(F.col("personal_use"))
    ).select("file_idx", "file_name", "ordinal", F.explode(texts).alias("status_text"))
    return at_geocodes(flagged.where(F.col("status_text").isNotNull()), dims.locations)
