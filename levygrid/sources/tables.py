"""Domain inputs derived from the star-schema tables.

Sheets, geocodes, categories, tax types and item codes are computed from ``lineitem``,
``supplier``, ``nation`` and ``part`` with integer arithmetic, so the whole engine can be
run, checked and timed at any scale of those tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from levygrid import constants as C
from levygrid.config import MatrixConfig
from levygrid.operators.dimensions import Dimensions
from levygrid.operators.numbering import number_rows
from levygrid.operators.rows import named_columns
from levygrid.operators.stages import freed, scratch_scope

# Columns of the derived sheets by logical name.
HEADER = {
    "admin": 10,
    "current_id": 1,
    "business_use": 11,
    "business_tax_cat": 12,
    "business_percent_tax": 13,
    "personal_use": 14,
    "personal_tax_cat": 15,
    "personal_percent_tax": 16,
}

# Statuses and percents the derived cells cycle through.
BUSINESS_STATUSES = [
    "Taxable", "TAXABLE", "taxable ", "Not Taxable", "Nontaxable", "Exempt",
    "Drill Down", "Bogus", "",
]
PERSONAL_STATUSES = [
    "Taxable", "TAXABLE", "taxable ", "Not Taxable", "Nontaxable", "Exempt",
    "To Research", "Bogus", "",
]
PERCENTS = ["100%", "0%", "8.75%", "1.0", "invalid"]

# Tax types and their positions in the derived bridge.
TAX_TYPES = ["01", "02", "03", "04", "47"]
CATEGORIES = 25

# Rows of one sheet are in this order; no two rows tie on it.
ROW_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def research_id(part: Column) -> Column:
    """Eight dotted segments from the decimal digits of a part key."""
    segments = [part % 10, div(part, 10) % 10, div(part, 100) % 10, div(part, 1000)]
    return F.concat(
        F.lit("1"),
        *[F.concat(F.lit("."), s.cast("string")) for s in segments],
        F.lit(".0.0.0"),
    )


def geo(spark: SparkSession, folder: str) -> DataFrame:
    """Geocodes: a state per nation, a city geocode per supplier, three per city name."""
    nation = table(spark, folder, "nation")

    def prefix(key: Column) -> Column:
        return F.concat(F.lit("US"), F.lpad((key + 1).cast("string"), 2, "0"))

    states = nation.select(
        F.col("n_nationkey").cast("bigint").alias("ordinal"),
        F.concat(prefix(F.col("n_nationkey")), F.lit("00000000")).alias("geocode"),
        F.col("n_name").alias("state"),
        F.lit("").alias("city"),
        F.lit("STATE").alias("jurisdiction"),
    )
    cities = (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            (F.col("s_suppkey") + 25).alias("ordinal"),
            F.concat(
                prefix(F.col("s_nationkey")), F.lit("1"),
                F.lpad(F.col("s_suppkey").cast("string"), 7, "0"),
            ).alias("geocode"),
            F.col("n_name").alias("state"),
            F.concat(F.lit("CITY "), div(F.col("s_suppkey"), 3).cast("string")).alias("city"),
            F.lit("CITY").alias("jurisdiction"),
        )
    )
    return states.unionByName(cities)


def state_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_name").alias("state_name"), F.col("n_name").alias("state")
    )


def files_of_states(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A file per supplier, named after a state or, one in 52, after none; and states' geocodes by code."""
    names = [*C.US_STATES, "Nowhere"]
    place = F.col("s_suppkey") % len(names)
    files = table(spark, folder, "supplier")
    return (
        files.select(F.concat(F.initcap(_pick(names, place)), F.lit(" Sales Tax Research")).alias("file_name")),
        files.where(place < len(C.US_STATES)).select(
            F.col("s_suppkey").alias("ordinal"),
            F.concat(F.lit("US"), F.lpad((place + 1).cast("string"), 2, "0"), F.lit("00000000")).alias("geocode"),
            _pick(list(C.US_STATES.values()), place).alias("state"),
        ),
    )


def tax_cats(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    return (
        table(spark, folder, "nation")
        .where(key != 7)
        .select(
            F.lpad(key.cast("string"), 2, "0").alias("tax_cat"),
            F.concat(F.lit("CAT "), key.cast("string")).alias("tax_cat_desc"),
            key.alias("ordinal"),
        )
    )


def tax_types(spark: SparkSession, folder: str) -> DataFrame:
    """About a third of all (geocode, category, type) combinations, by a residue rule."""
    types = F.array(*[F.struct(F.lit(i).alias("ti"), F.lit(t).alias("tax_type"))
                      for i, t in enumerate(TAX_TYPES)])
    g, k = F.col("ordinal"), F.col("k")
    return (
        geo(spark, folder)
        .select("ordinal", "geocode", F.explode(F.sequence(F.lit(0), F.lit(CATEGORIES - 1))).alias("k"))
        .where((g * 7 + k) % 10 != 0)
        .select("ordinal", "geocode", "k", F.inline(types))
        .where((g + k + F.col("ti")) % 3 == 0)
        .select(
            "geocode", F.lpad(k.cast("string"), 2, "0").alias("tax_cat"), "tax_type",
            ((g * CATEGORIES + k) * len(TAX_TYPES) + F.col("ti")).alias("ordinal"),
        )
    )


def product_codes(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return (
        table(spark, folder, "part")
        .where(key % 10 != 7)
        .select(
            F.regexp_replace(research_id(key), r"(\.0)+$", "").alias("research_id"),
            (key % 1500).cast("string").alias("item"),
            key.alias("ordinal"),
        )
    )


def _pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def sheet_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The line items with the sheet they belong to: ``file_idx, file_name`` and ``ROW_ORDER``."""
    lines = (
        table(spark, folder, "lineitem").select(*ROW_ORDER)
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    line, city = F.col("l_linenumber"), div(F.col("l_suppkey"), 3)
    in_state, in_city = line <= 4, line.isin(5, 6)
    file_idx = (
        F.when(in_state, F.col("s_nationkey").cast("bigint"))
        .when(in_city, city + 1000)
        .otherwise(F.lit(900000).cast("bigint"))
    )
    file_name = F.concat(
        F.when(in_state, F.col("n_name"))
        .when(in_city, F.concat(F.lit("City "), city.cast("string")))
        .otherwise(F.lit("Nowhere")),
        F.lit(" Sales Tax Research"),
    )
    return lines.select(file_idx.alias("file_idx"), file_name.alias("file_name"), *ROW_ORDER)


def line_cells() -> list[Column]:
    """The cells of a line item's row, from the columns of ``sheet_lines``."""
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    admin = (
        F.when(order % 5 == 2, "tag level")
        .when(order % 5 == 3, " Tag Level ")
        .when(order % 5 == 4, "Section")
        .otherwise("Tag Level")
    )
    q = F.col("l_quantity").cast("int") % 26
    category = (
        F.when(q == 25, "").when(q == 7, "07")
        .otherwise(F.concat(F.lit("CAT "), q.cast("string")))
    )
    even = order % 2 == 0
    discount = F.concat(
        F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%")
    )

    def percent(index: Column) -> Column:
        return F.coalesce(_pick(PERCENTS, index % 6), discount)

    first_text = F.concat(F.lit("N"), (part % 10).cast("string"))
    second_text = F.when(part % 3 == 0, "").otherwise(
        F.concat(F.lit(" part "), part.cast("string"))
    )
    return [
        F.lit(""),
        research_id(part),
        first_text,
        second_text,
        *[F.lit("")] * 6,
        admin,
        _pick(BUSINESS_STATUSES, order % 9),
        category,
        percent(part),
        _pick(PERSONAL_STATUSES, (order + F.when(even, 0).otherwise(3)) % 9),
        F.when(order % 4 == 3, "Mystery").otherwise(category),
        percent(part + F.when(even, 0).otherwise(1)),
    ]


def sheet_cells(spark: SparkSession, folder: str) -> DataFrame:
    """One sheet row per line item: ``file_idx, file_name, ordinal`` and cells ``c0, ...``."""
    return sheet_lines(spark, folder).select(
        "file_idx",
        "file_name",
        F.struct(*ROW_ORDER).alias("ordinal"),
        *[c.alias(f"c{i}") for i, c in enumerate(line_cells())],
    )


def sheet_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows with all cells in one array: ``file_idx, file_name, ordinal, cells``."""
    wide = sheet_cells(spark, folder)
    cells = [c for c in wide.columns if c not in ("file_idx", "file_name", "ordinal")]
    return wide.select("file_idx", "file_name", "ordinal", F.array(*cells).alias("cells"))


def header_cells() -> Column:
    """Header of a derived sheet. By file: a second Admin column, a missing one, blanks."""
    f = F.col("file_idx")
    return F.array(
        F.lit(""),
        F.when(f % 3 == 0, " Current ID ").otherwise("Current ID"),
        *[F.lit(f"L{i}") for i in range(1, 8)],
        F.when(f % 4 == 1, "Admin").otherwise("L8"),
        F.lit("Admin"),
        F.lit("Business Use"),
        F.lit("Business tax_cat"),
        F.lit("Business percent_taxable"),
        F.when(f % 5 == 2, "").otherwise("Personal Use"),
        F.lit("Personal tax_cat"),
        F.lit("Personal percent_taxable"),
    )


def header_sheets(spark: SparkSession, folder: str, config: MatrixConfig) -> DataFrame:
    """The rows above the data of every sheet: titles, then the header row."""
    files = sheet_rows(spark, folder).select("file_idx", "file_name").distinct()
    return files.select(
        "file_idx", "file_name",
        F.explode(F.expr(f"sequence(1L, {config.header_row}L)")).alias("row_idx"),
    ).withColumn(
        "cells",
        F.when(F.col("row_idx") == config.header_row, header_cells()).otherwise(
            F.array(F.concat(F.lit("Title "), F.col("row_idx").cast("string")))
        ),
    )


def numbered_sheets(spark: SparkSession, folder: str, config: MatrixConfig) -> DataFrame:
    """Whole sheets with dense row numbers: titles, the header row, the data rows."""
    rows = sheet_rows(spark, folder)
    data = number_rows(rows, ["file_idx"], [F.col("ordinal")], "row_idx").select(
        "file_idx", "file_name", (F.col("row_idx") + config.header_row).alias("row_idx"), "cells"
    )
    return header_sheets(spark, folder, config).unionByName(data)


def export_sheets(
    spark: SparkSession, folder: str, path: str, config: MatrixConfig, line_breaks: bool = False
) -> None:
    """Write the sheets as CSV, each a folder of part files, all under the first header.

    With ``line_breaks`` the description of every third data row goes over two lines, the
    second with quotes and a comma. Only then are the rows numbered. What is put in order are
    the line items; their cells, several times as wide, are made where they are written. Own
    tables and shuffle files are deleted at the end.
    """
    with scratch_scope(spark), freed(spark):
        _ordered_cells(spark, folder, config, line_breaks).write.partitionBy("sheet").options(
            quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)


def _ordered_cells(spark: SparkSession, folder: str, config: MatrixConfig, line_breaks: bool) -> DataFrame:
    """``sheet`` and cells ``c0, ...`` of all rows of the sheets, in order."""
    lines = sheet_lines(spark, folder)
    if line_breaks:
        lines = number_rows(lines, ["file_idx"], [F.col(c) for c in ROW_ORDER], "row_idx")
        lines = lines.withColumn("row_idx", F.col("row_idx") + config.header_row)
    else:
        lines = lines.withColumn("row_idx", F.lit(config.header_row + 1).cast("bigint"))
    plain = F.transform("cells", lambda c, i: F.when(i == 1, "Current ID").when(i == 9, "L8")
                        .when(i == 14, "Personal Use").otherwise(c))
    heads = header_sheets(spark, folder, config).withColumn(
        "cells", F.when(F.col("row_idx") == config.header_row, plain).otherwise(F.col("cells"))
    )
    order = ["sheet", "row_idx", *([] if line_breaks else [*ROW_ORDER, "tie"])]
    ordered = (
        heads.unionByName(lines.withColumn("tie", F.monotonically_increasing_id()), allowMissingColumns=True)
        .withColumn("sheet", F.concat("file_name", F.lit(".csv"))).drop("file_idx", "file_name")
        .repartitionByRange(*order).sortWithinPartitions(*order)
    )
    cells = line_cells()
    if line_breaks:
        third = F.col("row_idx") % 3 == 0
        cells[3] = F.when(third, F.concat(cells[3], F.lit('\n"'), cells[1], F.lit('",'))).otherwise(cells[3])
    head = F.col("cells")
    return ordered.select("sheet", *[
        F.when(head.isNotNull(), F.get(head, F.lit(i))).otherwise(c).alias(f"c{i}") for i, c in enumerate(cells)
    ])


def export_mappings(spark: SparkSession, folder: str, path: str, config: MatrixConfig) -> None:
    """Write the mapping tables as CSV, in their order."""
    blank = F.lit("")
    files = {
        config.geo_file: geo(spark, folder).select(
            "ordinal", "geocode", "state", blank.alias("county"), "city", blank.alias("tax_district"), "jurisdiction"),
        config.tax_cat_file: tax_cats(spark, folder).select("ordinal", "tax_cat", "tax_cat_desc"),
        config.tax_type_file: tax_types(spark, folder).select("ordinal", "geocode", "tax_cat", "tax_type"),
        config.product_code_file: product_codes(spark, folder).select(
            "ordinal", "research_id", blank.alias("taxonomy_id"), blank.alias("product_id"),
            F.lit("7777").alias("group"), "item", blank.alias("description")),
    }
    for name, df in files.items():
        df.orderBy("ordinal").drop("ordinal").write.csv(f"{path}/{name}", header=True, quoteAll=True)


def rows(spark: SparkSession, folder: str) -> DataFrame:
    return named_columns(sheet_cells(spark, folder), HEADER)


def dimensions(spark: SparkSession, folder: str, config: MatrixConfig) -> Dimensions:
    return Dimensions.build(
        geo=geo(spark, folder),
        names=state_names(spark, folder),
        tax_cat=tax_cats(spark, folder),
        tax_type=tax_types(spark, folder),
        codes=product_codes(spark, folder),
        config=config,
    )
