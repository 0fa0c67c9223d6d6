import random

import pytest
import xxhash
from pyspark.sql import functions as F

from levygrid.llm import simhash
from levygrid.llm.common import Scratch
from tests.llm.frames import LONG, ROWS, documents, rows_of


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


@pytest.mark.parametrize("text", [None, "", "A", "A b", "A B c", "İ ß É x y z", LONG, "a a a a a"])
def test_fingerprint(text):
    got = simhash.fingerprint(None if text is None else text.encode())
    assert got & (1 << 64) - 1 == brute_fingerprint(text)


@pytest.mark.parametrize("bucket", [1, 64])
def test_links_and_components(spark, bucket):
    draw = random.Random(3)
    seeds = [draw.getrandbits(64) for _ in range(12)]
    values = {0}
    for s in seeds:
        for _ in range(12):
            s ^= sum(1 << draw.randrange(64) for _ in range(draw.randint(0, 3)))
            values.add(s)
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = rows_of(simhash.links(frame, bucket=bucket), "a", "b")
    near = {(a, b) for a in values for b in values if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert set(edges) <= near and len(set(edges)) == len(edges)
    if bucket == 64:
        assert set(edges) == near
    linked = spark.createDataFrame(edges, "a long, b long")
    roots = dict(rows_of(simhash.components(linked, Scratch(spark)), "node", "root"))
    expected = brute_components(values)
    assert {v: roots.get(v, v) for v in values} == expected


def test_probes_are_not_broadcast(spark):
    """A ball has 33 values; Spark takes the exploded rows for as few as the fingerprints."""
    prints = spark.range(1000).select(F.xxhash64("id").alias("fp"))
    plan = simhash.links(prints)._jdf.queryExecution().executedPlan().toString()
    inner = [line for line in plan.splitlines() if "Join" in line and " Inner" in line]
    assert inner and all("SortMergeJoin" in line for line in inner)


def test_odd_rows(spark):
    got = rows_of(simhash.near_duplicates(documents(spark)), "doc_id", "fingerprint", "component_id")
    assert len(got) == len(ROWS)
    by_id = {i: (f, c) for i, f, c in got}
    assert by_id[1] == by_id[2] and by_id[1][1] == 1
    assert by_id[4] == by_id[5] == by_id[6] == ("0" * 16, 4)
    assert by_id[None][1] is None


def test_one_of_each_class_stays(spark):
    frame = documents(spark)
    kept = simhash.deduplicated(frame)
    assert kept.columns == frame.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 4, 7, None, 9, 10} <= set(ids) and not {2, 5, 6} & set(ids)


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.deduplicated(documents(spark, [])).count() == 0
