"""Run configuration."""

from __future__ import annotations

from dataclasses import dataclass, field


def _default_columns() -> dict[str, str]:
    # Header texts of the research sheets, by logical name.
    return {
        "admin": "Admin",
        "current_id": "Current ID",
        "business_use": "Business Use",
        "personal_use": "Personal Use",
        "personal_tax_cat": "Personal tax_cat",
        "personal_percent_tax": "Personal percent_taxable",
        "business_tax_cat": "Business tax_cat",
        "business_percent_tax": "Business percent_taxable",
    }


@dataclass(frozen=True)
class MatrixConfig:
    """Settings of one run; the defaults are those of the published sheets."""

    header_row: int = 4
    admin_filter_value: str = "Tag Level"
    effective_date: str = "1999-01-01"
    columns: dict[str, str] = field(default_factory=_default_columns)
    # "first": the first file's header serves all files; "per_file": each its own.
    header_mode: str = "first"
    # Which of several equal header texts counts: "last" or "first".
    header_duplicates: str = "last"
    # Dimensions up to this many bytes of text are broadcast; larger ones shuffle.
    broadcast_bytes: int = 32 << 20
    # Copies of a dimension row in a salted shuffle join; None: by the shuffle partitions.
    salts: int | None = None
    geo_file: str = "geo_state.csv"
    tax_cat_file: str = "tax_cat.csv"
    tax_type_file: str = "unique_tax_type.csv"
    product_code_file: str = "product_code_mapping.csv"


LOGICAL_COLUMNS = list(_default_columns())
