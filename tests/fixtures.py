"""Small hand-made inputs."""

from pyspark.sql import functions as F

from levygrid.config import LOGICAL_COLUMNS, MatrixConfig
from levygrid.operators.dimensions import Dimensions, state_names

CONFIG = MatrixConfig()

GEO = [
    ("US0000000000", "", ""),
    ("US1700000000", "IL", ""),
    ("US0800000000", "CO", ""),
    ("US08013A0025", "CO", "BOULDER"),
    ("US08031A0002", "CO", "DENVER"),
    ("US17031A0003", "IL", "CHICAGO"),
    ("US17031A0047", "IL", "CHICAGO"),
    ("US17043A0053", "IL", "Chicago"),
]
TAX_TYPES = [
    ("US1700000000", "01", "02"), ("US1700000000", "01", "01"), ("US1700000000", "01", "01"),
    ("US0800000000", "01", "01"), ("US0800000000", "01", "03"),
    ("us08013a0025", "01", "01"),
    ("US17031A0003", "01", "47"), ("US17031A0047", "01", "47"), ("US17043A0053", "01", "47"),
]
TAX_CATS = [("00", "General Sales Tax"), ("01", "General Sales Tax"), ("02", "Special Tax")]
CODES = [
    ("1.1.1.4.3", "21"), ("1.1.1.4.3.0", "22"), ("1.1.2.1.1", "5"), ("1.1.3.2.1", "123"),
    ("1.1.1", "7"), ("1.1.3", "1234"), ("", "9"), ("9.9", ""),
]


def table(spark, rows, columns):
    schema = ", ".join(f"{c} string" for c in columns) + ", ordinal int"
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)


def dimensions(spark, geo=GEO, tax_types=TAX_TYPES, codes=CODES, config=CONFIG):
    return Dimensions.build(
        geo=table(spark, geo, ["geocode", "state", "city"]),
        names=state_names(spark),
        tax_cat=table(spark, TAX_CATS, ["tax_cat", "tax_cat_desc"]),
        tax_type=table(spark, tax_types, ["geocode", "tax_cat", "tax_type"]),
        codes=table(spark, codes, ["research_id", "item"]),
        config=config,
    )


def row(
    item, business=("Taxable", "General Sales Tax", "8.75%"), personal=None,
    admin="Tag Level", description="", file="Chicago",
):
    return (item, business, business if personal is None else personal, admin, description, file)


def named(spark, rows):
    data = []
    for i, (item, b, p, admin, description, file) in enumerate(rows):
        name = f"{file} Sales Tax Research"
        values = {
            "admin": admin, "current_id": item,
            "business_use": b[0], "business_tax_cat": b[1], "business_percent_tax": b[2],
            "personal_use": p[0], "personal_tax_cat": p[1], "personal_percent_tax": p[2],
        }
        data.append((name, name, i, *[values[c] for c in LOGICAL_COLUMNS], description))
    columns = ", ".join(f"{c} string" for c in LOGICAL_COLUMNS)
    return spark.createDataFrame(
        data, f"file_idx string, file_name string, ordinal int, {columns}, description string"
    )


MATRIX_SCHEMA = ", ".join(
    f"`{c}` {'int' if c == 'taxable' else 'string'}"
    for c in [
        "geocode", "tax_auth_id", "group", "item", "customer", "provider", "transaction",
        "taxable", "tax_type", "tax_cat", "effective", "per_taxable_type", "percent_taxable",
    ]
)


def matrix(spark, rows):
    """Matrix records from (geocode, item, customer, tax_type, tax_cat)."""
    full = [
        (g, "", "7777", i, c, "99", "01", 1, t, k, "2024-01-01", "01", "1.000000")
        for g, i, c, t, k in rows
    ]
    return spark.createDataFrame(full, MATRIX_SCHEMA)


def counted(df, *columns):
    """Bag of tuples of a small result."""
    from collections import Counter

    return Counter(tuple(r) for r in df.select(*[F.col(c) for c in columns]).collect())
