import os
import re
from collections import Counter

import pytest

from levygrid.llm import licenses, oracles, queries
from tests.compare import connect, difference
from tests.llm.frames import LONG, documents, rows_of

FOLDER = "/root/testdata/sf0.001"
APACHE = licenses.TEMPLATES[1][1]

TEXTS = [
    None, "", "some text\nReleased under the MIT License.\nmore", "released UNDER the mit   license",
    "Released under the BSD License.", APACHE, APACHE.replace(" ", "\n"), "intro\n\n" + APACHE.replace("; ", ";\n") + "\n\nend",
    APACHE.replace("compliance", "accordance"), APACHE[: len(APACHE) // 2], LONG + "\nLicensed under CC BY-NC 4.0.",
    "Licensed under CC BY 4.0.\nLicensed under CC BY-NC 4.0.\n Licensed under CC BY 4.0!", "mit mit mit mit mit",
    "Licensed under CC BY-SA-NC 4.0.",
]


def brute(rows):
    grams = lambda t: Counter(zip(w := re.sub("[^a-z0-9]+", " ", t.lower()).split(), w[1:]))
    out = {}
    for i, text, *_ in rows:
        text = text or ""
        parts = {text, *text.split("\n"), *re.split(r"\n[ \t\r]*\n", text)}
        for p in {" ".join(licenses._words(p)) for p in parts}:
            a = grams(p)
            best = {}
            for name, t in licenses.TEMPLATES:
                b = grams(t)
                dice = 2 * sum((a & b).values()) / ((sum(a.values()) + sum(b.values())) or 1)
                if 100 * dice >= 80:
                    best[name] = max(dice, best.get(name, 0))
            if best:
                name = min(best, key=lambda n: (-best[n], n))
                dice, n = out.get((i, name), (0, 0))
                out[i, name] = max(dice, best[name]), n + 1
    return sorted((*k, *v) for k, v in out.items())


def test_scan(spark):
    rows = [(i, t, None, None) for i, t in enumerate(TEXTS)]
    got = rows_of(licenses.scan(documents(spark, rows)), "doc_id", "license_id", "dice", "n_passages")
    assert sorted(got) == brute(rows) and len(got) > 7


def test_bounds_are_tight():
    for size in range(1, 90):
        low, high = licenses.size_bounds(size)
        reach = [n for n in range(1, 300) if 100 * 2 * min(n, size) >= 80 * (n + size)]
        assert (low, high) == (reach[0], reach[-1])


def test_repeated_rows_and_empty_table(spark):
    row = (None, "Released under the MIT License.", None, None)
    got = rows_of(licenses.scan(documents(spark, [row, row])), "doc_id", "license_id", "dice", "n_passages")
    assert got == [(None, "mit", 1.0, 1)]
    assert licenses.scan(documents(spark, [])).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_sql(spark):
    got = queries.op2_license_scan(spark, FOLDER)
    assert difference(got, connect(FOLDER), oracles.oracle_sql()["op2_license_scan"]) is None
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
