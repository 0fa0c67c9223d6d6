"""Column expressions over cell texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from levygrid import constants as C

# What str.strip() removes: white space in ASCII (with the four separators), and beyond.
_ASCII_SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21)]))
_OTHER_SPACES = "".join(
    map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


# A name, the suffix, and behind it nothing, or further suffixes with only space between
# the first two. The name may not hold the suffix itself.
_NAME_PATTERN = (
    r"(?s)^((?:(?!{s}).)++){s}(?:[{w}]*{s}(?:.*{s})?)?[{w}]*$".format(
        s=C.FILE_NAME_SUFFIX, w=_ASCII_SPACES + _OTHER_SPACES
    )
)


def ws(c: Column) -> Column:
    """Strip white space of any kind (Spark's plain trim removes spaces only).

    The cost of a trim grows with its character set, so pure ASCII texts get the short one.
    """
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.trim(c, F.lit(_ASCII_SPACES))).otherwise(
        F.trim(c, F.lit(_ASCII_SPACES + _OTHER_SPACES))
    )


def blank_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def cell(cells: Column, index: int | None) -> Column:
    """Stripped text of one cell; '' if the column is unknown, absent or null."""
    if index is None:
        return F.lit("")
    return ws(blank_if_null(F.get(cells, F.lit(index))))


# Positions of the description cells, C to J.
DESCRIPTION_CELLS = range(2, 10)


def row_description(cells: Column) -> Column:
    """The description cells, stripped and run together without a separator."""
    return F.concat(*[cell(cells, i) for i in DESCRIPTION_CELLS])


def jurisdiction_name(file_name: Column) -> Column:
    """Upper-cased jurisdiction of '<name> Sales Tax Research', null for other names."""
    found = F.regexp_extract(F.upper(file_name), _NAME_PATTERN, 1)
    return F.nullif(F.trim(found, F.lit(_ASCII_SPACES + _OTHER_SPACES)), F.lit(""))


def csv_line(*columns: Column) -> Column:
    """One all-quoted CSV line; quotes inside a field are doubled."""
    quoted = [
        F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))
        for c in columns
    ]
    return F.concat_ws(",", *quoted)


def output_folder_name(ts: Column) -> Column:
    """Run folder for a UTC timestamp, named after Pacific time."""
    local = F.from_utc_timestamp(ts, "America/Los_Angeles")
    return F.concat(F.lit("output-"), F.date_format(local, "yyyyMMdd-HHmm"))
