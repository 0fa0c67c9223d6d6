"""State treatments repeated at city geocodes, against the plain pairwise rule."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from levygrid.operators import errors, replicate
from tests.fixtures import counted, matrix

IL, CO = "US1700000000", "US0800000000"
CHICAGO, BOULDER = "US17031A0003", "US08013A0025"
COLUMNS = ["geocode", "item", "customer", "tax_type", "tax_cat"]


def pairwise(rows):
    """Copies and misses by comparing every city record with every record."""
    copies, misses = Counter(), Counter()
    for c in rows:
        if c[0].endswith("00000000"):
            continue
        found = [
            (c[0], *s[1:]) for s in rows
            if s[0] == c[0][:4] + "00000000" and s[1:3] == c[1:3] and s[3:] != c[3:]
        ]
        copies.update(found)
        if not found:
            misses[c] += 1
    return copies, misses


def check(spark, rows):
    records = matrix(spark, rows)
    copies, misses = pairwise(rows)
    written = replicate.expand_copies(replicate.replicated(records))
    assert counted(written, *COLUMNS) == copies
    found = replicate.cities_without_state(records).collect()
    assert Counter({tuple(r[c] for c in COLUMNS): r["n"] for r in found}) == misses
    total = replicate.enhanced(records).count()
    assert total == len(rows) + sum(copies.values())
    return total


@pytest.mark.parametrize(
    "rows, total",
    [
        # The agreeing state record is not copied: 4 -> 6.
        ([(IL, "1", "99", "01", "01"), (IL, "1", "99", "02", "02"), (IL, "1", "99", "47", "01"),
          (CHICAGO, "1", "99", "47", "01")], 6),
        # All three are copied: 4 -> 7.
        ([(IL, "1", "99", "01", "01"), (IL, "1", "99", "02", "01"), (IL, "1", "99", "03", "01"),
          (CHICAGO, "1", "99", "47", "01")], 7),
        # Every city type pulls its own copies: 5 -> 10.
        ([(IL, "1", "99", "01", "01"), (IL, "1", "99", "02", "01"), (IL, "1", "99", "03", "01"),
          (CHICAGO, "1", "99", "01", "01"), (CHICAGO, "1", "99", "04", "01")], 10),
        # Copies come from the own state only.
        ([(IL, "1", "99", "01", "01"), (CO, "1", "99", "03", "01"),
          (CHICAGO, "1", "99", "47", "01"), (BOULDER, "1", "99", "04", "01")], 6),
        # Other item or customer; other spelling of the id.
        ([(IL, "9", "0B", "01", "01"), (CHICAGO, "1", "99", "47", "01")], 2),
        ([(IL, "1.1", "99", "01", "01"), (CHICAGO, "1.1.0", "99", "47", "01")], 2),
        # Only an agreeing state record: nothing to copy, and a miss.
        ([(IL, "1", "99", "47", "01"), (CHICAGO, "1", "99", "47", "01")], 2),
        # States only.
        ([(IL, "1", "99", "01", "01"), (CO, "2", "99", "01", "01")], 2),
    ],
)
def test_counts(spark, rows, total):
    assert check(spark, rows) == total


record = st.tuples(
    st.sampled_from([IL, CO, CHICAGO, "US17031A0047", BOULDER]),
    st.sampled_from(["1", "2"]),
    st.sampled_from(["99", "0B"]),
    st.sampled_from(["01", "02"]),
    st.sampled_from(["01", "02"]),
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(record, min_size=1, max_size=40))
def test_any_bag_equals_the_pairwise_rule(spark, rows):
    check(spark, rows)


def test_hot_key_is_counted_not_compared(spark):
    """One item holds all records: copies are computed from counts and cut into chunks."""
    rows = [(CHICAGO, "1", "99", "47", "01")] * 25_000 + [(IL, "1", "99", "47", "01")] * 9_000
    records = matrix(spark, rows)
    assert replicate.replicated(records).count() == 0
    more = records.unionByName(matrix(spark, [(IL, "1", "99", "01", "01")]))
    copied = replicate.replicated(more)
    assert [(r["tax_type"], r["copies"]) for r in copied.collect()] == [("01", 25_000)]
    assert counted(replicate.expand_copies(copied), *COLUMNS) == {
        (CHICAGO, "1", "99", "01", "01"): 25_000
    }


def test_error_per_city(spark):
    rows = [
        (IL, "999", "99", "01", "01"),
        (CHICAGO, "001", "99", "47", "01"),
        (CHICAGO, "002", "99", "47", "01"),
        (CHICAGO, "003", "0B", "47", "01"),
    ] + [(BOULDER, f"{i:03d}", "99", "04", "01") for i in range(12)]
    misses = replicate.cities_without_state(matrix(spark, rows))
    got = {r["error_message"] for r in errors.replication_errors(misses).collect()}
    assert got == {
        "City geocode 'US17031A0003' has 3 records but no matching state-level tax treatments "
        "found for parent geocode 'US1700000000'. Affected records: groups=['7777'], "
        "items=[001, 002, 003], customers=['0B', '99']",
        "City geocode 'US08013A0025' has 12 records but no matching state-level tax treatments "
        "found for parent geocode 'US0800000000'. Affected records: groups=['7777'], "
        "items=[000, 001, 002, 003, 004, 005, 006, 007, 008, 009 ... and 2 more], "
        "customers=['99']",
    }
