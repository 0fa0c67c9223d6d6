import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from levygrid.llm import oracles, quality, queries
from tests.compare import connect, difference
from tests.llm.frames import LONG, PROSE, ROWS, documents, rows_of

FOLDER = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [l for l in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", l)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )


TEXTS = [
    None, "", "\n\n", "a b c d e", "a b c d e a b c d e", "x " * 40, "a b c d e f a b c d e\ta b c d e f",
    PROSE + "\n" + PROSE + "\n\n" + PROSE, "###|<a> & *b* 100% $5\nä ö ü\r\nä ö ü\r\n", LONG, "é\x0bè\x0cê",
    "1 2 3 4 5 6 1 2 3 4 5 7 2 3 4 5 7",
]


def test_measures(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)]
    got = rows_of(quality.assess(documents(spark, rows)), "doc_id", *quality.MEASURES[:5])
    assert got == sorted(((i, *brute(t)) for i, t in enumerate(TEXTS)), key=repr)


def test_odd_rows(spark):
    frame = documents(spark)
    got = quality.assess(frame).collect()
    assert len(got) == len(ROWS)
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    kept = quality.accepted(frame)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["kept"]}
    assert quality.assess(documents(spark, [])).count() == quality.accepted(documents(spark, [])).count() == 0


def test_clashing_names(spark):
    names = ["__enforced", "__host", "__blocked", "__m", "c1", "base", "n_words", "kept", "__row"]
    frame = documents(spark).select("doc_id", "text", "source", *[F.lit("x").alias(n) for n in names])
    got = quality.accepted(frame)
    assert got.columns == frame.columns
    assert rows_of(got, "doc_id", "source") == rows_of(quality.accepted(documents(spark)), "doc_id", "source")
    assert {r["__enforced"] for r in got.collect()} == {"x"}


def test_hosts(spark):
    """A bad host is blocked, a rule is enforced where it fails often, chance is forgiven."""
    def text(i, junk=False):
        words = [f"{'#' if junk else ''}w{i}x{k}" for k in range(20)]
        return " ".join(words)

    rows = [(i, text(i), "en", f"good{i % 9}") for i in range(1800)]
    rows += [(2000 + i, text(i, junk=True), "en", "bad") for i in range(200)] + [(2999, text(7), "en", "bad")]
    rows += [(3000 + i, text(i, junk=i % 4 == 0), "en", "mixed") for i in range(200)]
    rows += [(4000, text(1, junk=True), "en", "good0")]
    kept = {r["doc_id"] for r in quality.assess(documents(spark, rows)).where("kept").collect()}
    assert kept == {*range(1800), *(3000 + i for i in range(200) if i % 4), 4000}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_sql(spark):
    got = queries.op3_quality_rules(spark, FOLDER)
    assert difference(got, connect(FOLDER), oracles.oracle_sql()["op3_quality_rules"]) is None
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
