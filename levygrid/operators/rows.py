"""From positional sheet rows to named columns, and the row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from levygrid.config import LOGICAL_COLUMNS, MatrixConfig
from levygrid.functions.text import (
    DESCRIPTION_CELLS,
    blank_if_null,
    cell,
    jurisdiction_name,
    row_description,
    ws,
)
from levygrid.functions.treatment import is_uncertain


def named_rows(sheet_rows: DataFrame, header: dict[str, int | None]) -> DataFrame:
    """Pick the logical columns out of ``cells`` by the header map.

    A column missing from the header reads as ''. ``description`` is the row's own text
    from cells C to J, which are fixed positions. ``ordinal`` orders rows of one file.
    """
    cells = F.col("cells")
    return sheet_rows.select(
        "file_idx",
        "file_name",
        "ordinal",
        *[cell(cells, header.get(name)).alias(name) for name in LOGICAL_COLUMNS],
        row_description(cells).alias("description"),
    )


def named_columns(wide: DataFrame, header: dict[str, int | None]) -> DataFrame:
    """Like ``named_rows`` for cells held in columns ``c0, c1, ...``.

    Columns that no later step uses are then not even read.
    """

    def at(index: int | None) -> Column:
        known = index is not None and f"c{index}" in wide.columns
        return ws(blank_if_null(F.col(f"c{index}"))) if known else F.lit("")

    return wide.select(
        "file_idx",
        "file_name",
        "ordinal",
        *[at(header.get(name)).alias(name) for name in LOGICAL_COLUMNS],
        F.concat(*[at(i) for i in DESCRIPTION_CELLS]).alias("description"),
    )


def tagged_any_case(rows: DataFrame, config: MatrixConfig) -> DataFrame:
    """Rows carrying the admin tag in any case (the matrix path)."""
    return rows.where(F.upper("admin") == F.upper(F.lit(config.admin_filter_value)))


def is_tagged(config: MatrixConfig) -> Column:
    return F.col("admin") == config.admin_filter_value


def tagged_same_case(rows: DataFrame, config: MatrixConfig) -> DataFrame:
    """Rows carrying the admin tag in exact case (the item path and row counts)."""
    return rows.where(is_tagged(config))


def certain_only(rows: DataFrame) -> DataFrame:
    """Drop rows of which either side is still being researched."""
    return rows.where(~is_uncertain(F.col("business_use")) & ~is_uncertain(F.col("personal_use")))


def with_jurisdiction(rows: DataFrame) -> DataFrame:
    return rows.withColumn("jurisdiction", jurisdiction_name(F.col("file_name")))
