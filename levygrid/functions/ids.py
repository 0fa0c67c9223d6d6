"""Column expressions over geocodes, research ids and item codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from levygrid import constants as C
from levygrid.functions.text import ws

ID_DEPTH = 8


def is_state_geocode(geocode: Column) -> Column:
    return geocode.endswith(C.STATE_SUFFIX)


def parent_geocode(geocode: Column) -> Column:
    """State geocode above a geocode; short codes are filled up with zeros."""
    return F.concat(F.rpad(F.substring(geocode, 1, 4), 4, "0"), F.lit(C.STATE_SUFFIX))


def normalize_research_id(research_id: Column) -> Column:
    """Without trailing zero segments; an id of zeros only stays as it is."""
    rid = ws(research_id)
    all_zero = rid.rlike(r"^0(\.0)*$")
    return F.when(all_zero, rid).otherwise(F.regexp_replace(rid, r"(\.0)+$", ""))


def pad_item_code(code: Column) -> Column:
    """At least three characters, zeros on the left, never truncated."""
    c = ws(code)
    signed = F.concat(F.substring(c, 1, 1), F.lpad(F.substring(c, 2, 2), 2, "0"))
    return (
        F.when(code.isNull(), F.lit(C.BLANK_ITEM_CODE))
        .when(F.length(c) > 3, c)
        .when(c.rlike(r"^[+-]"), signed)
        .otherwise(F.lpad(c, 3, "0"))
    )


def _eight_segments(research_id: Column) -> Column:
    filled = F.concat(research_id, F.lit(".0" * (ID_DEPTH - 1)))
    return F.substring_index(filled, ".", ID_DEPTH)


def ancestor_ids(research_id: Column) -> Column:
    """Array of the zero-filled ids above an id, top level first (at most seven)."""
    full = _eight_segments(research_id)
    segments = F.split(full, r"\.")
    levels = [
        F.when(
            F.get(segments, F.lit(level)) != "0",
            F.concat(F.substring_index(full, ".", level), F.lit(".0" * (ID_DEPTH - level))),
        )
        for level in range(1, ID_DEPTH)
    ]
    return F.array_compact(F.array(*levels))


def has_ancestors(research_id: Column) -> Column:
    """True if any segment below the first differs from '0'."""
    rest = F.substring_index(_eight_segments(research_id), ".", -(ID_DEPTH - 1))
    return rest != ".".join(["0"] * (ID_DEPTH - 1))
