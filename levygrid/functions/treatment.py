"""Column expressions for the tax treatment of one side of a row.

Texts are taken as stripped, which the cell access already does.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from levygrid import constants as C
from levygrid.functions import percent


def _codes(texts: dict[str, int]) -> Column:
    """A literal map; one look-up compiles to far less code than a chain of tests."""
    return F.create_map(*[F.lit(x) for pair in texts.items() for x in pair])


def parse_taxable(text: Column) -> Column:
    """1 taxable, 0 not taxable, null for blank, uncertain and unknown texts."""
    codes = {t: 1 for t in C.TAXABLE_TEXTS} | {t: 0 for t in C.NOT_TAXABLE_TEXTS}
    return F.try_element_at(_codes(codes), F.upper(text))


def is_uncertain(text: Column) -> Column:
    return F.upper(text).isin(C.UNCERTAIN_TEXTS)


def is_unknown_status(text: Column) -> Column:
    """True for a non-blank text that is no status at all (a data-quality error)."""
    known = C.TAXABLE_TEXTS + C.NOT_TAXABLE_TEXTS + C.UNCERTAIN_TEXTS + [""]
    return ~F.upper(text).isin(known)


def legacy_taxable_status(text: Column) -> Column:
    """Exact-case status; unknown texts count as taxable, 'Drill Down' as -1."""
    found = F.try_element_at(_codes(C.LEGACY_STATUS), text)
    return F.coalesce(found, F.lit(C.LEGACY_STATUS_DEFAULT))


def parse_percent(text: Column) -> Column:
    """The stated number, exactly; null when unreadable. See ``percent.parse``."""
    return percent.parse(text)


def format_percent(value: Column) -> Column:
    """Text of a parsed percent with six decimals, halves rounded to even."""
    return percent.formatted(value, 6)
