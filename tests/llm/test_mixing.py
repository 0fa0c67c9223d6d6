import hashlib
import os
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from levygrid.llm import mixing, oracles, queries
from tests.compare import connect, difference
from tests.llm.frames import LONG, ROWS, documents, rows_of

FOLDER = "/root/testdata/sf0.001"


def targets(sizes, weights):
    total, capped = Fraction(3 * sum(sizes), 2), set()
    while True:
        rest = total - sum(2 * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        out = [Fraction(2 * s) if i in capped else rest * weights[i] / weight for i, s in enumerate(sizes)]
        above = {i for i, t in enumerate(out) if i not in capped and t > 2 * sizes[i]}
        if not above:
            return out
        capped |= above


def brute(rows):
    words = lambda t: len((t or "").split())
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(words(r[1]) for r in rows if r[3] == s) for s in sources]
    goal = targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(sources))])
    out = []
    for s, size, target in zip(sources, sizes, goal):
        whole = int(target // size) if size else 0
        left = int(target) - whole * size
        mine = sorted((r for r in rows if r[3] == s), key=lambda r: hashlib.md5(f"42/{'' if r[0] is None else r[0]}".encode()).hexdigest())
        for r in mine:
            part = min(words(r[1]), left)
            left -= part
            out.append((r[0], words(r[1]), size, float(target), whole * words(r[1]) + part))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows", [
    ROWS, [], [(i, "one two three", None, f"s{i % 7}") for i in range(400)],
    [(i, "a " * (i % 13), None, "abc"[i % 3]) for i in range(300)], [(1, None, None, None)],
])
def test_mix(spark, rows):
    got = rows_of(mixing.mix(documents(spark, rows)), "doc_id", "size", "source_size", "target", "taken")
    assert got == brute(rows)


def test_mixture(spark):
    frame = documents(spark)
    taken = {}
    for i, _, _, _, t in brute(ROWS):
        taken[i] = taken.get(i, 0) + t
    got = mixing.mixture(frame)
    assert got.columns == frame.columns
    words = {}
    for r in got.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == {i: t for i, t in taken.items() if t}
    assert all(LONG.startswith(r["text"]) for r in got.collect() if r["doc_id"] == 7)


def test_clashing_names(spark):
    names = ["__target", "__key", "__taken", "__copy", "c0", "size", "__row", "n", "weight", "bin", "__whole"]
    frame = documents(spark).select("doc_id", "text", "source", *[F.lit("x").alias(n) for n in names])
    got = mixing.mixture(frame)
    assert got.columns == frame.columns
    plain = rows_of(mixing.mixture(documents(spark)), "doc_id", "text", "source")
    assert rows_of(got, "doc_id", "text", "source") == plain
    assert {r["__target"] for r in got.collect()} == {"x"}
    assert mixing.mixture(frame.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_sql(spark):
    got = queries.op9_source_mixing(spark, FOLDER)
    assert difference(got, connect(FOLDER), oracles.oracle_sql()["op9_source_mixing"]) is None
