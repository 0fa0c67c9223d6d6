import os

import pytest

from levygrid.llm import oracles, queries, quotes
from tests.compare import connect, difference
from tests.llm.frames import LONG, rows_of

FOLDER = "/root/testdata/sf0.001"

TALK = [
    (1, 0, "user", "Hello  there.\n\nHow is the weather?"),
    (1, 1, "assistant", "Fine."),
    (1, 2, "user", "> Fine.\nGood to know."),
    (1, 3, "assistant", "On Monday Ann wrote:\n>> how is THE   weather?\n> Good to know.\nBetter."),
    (1, 4, "user", ">hello there.\n> How is the weather?\nBack to that."),
    (1, 5, "user", "> never said\nOdd."),
    (1, 6, "user", None),
    (1, 7, "user", ""),
    (2, 0, "user", "> Fine.\nOther conversation."),
    (None, 0, "user", "lone"), (None, 1, "user", "> lone"),
    (3, None, "user", "first"), (3, 1, "user", "second"), (3, 1, "user", "second"),
    (4, 0, "user", LONG), (4, 1, "user", f"> {LONG}\nShort."),
]


def talk(spark, rows=TALK):
    extra = "n int, parent string, hash long, level int, position string, row int"
    return spark.createDataFrame(
        [(*r, 1, "x", 1, 1, "x", 1) for r in rows], f"conv_id long, turn long, role string, text string, {extra}"
    )


def test_conversations(spark):
    got = quotes.conversations(talk(spark))
    names = ["conv_id", "position", "text", "reply_to", "depth", "quote_levels", "quotes", "matched"]
    rows = {(r[0], r[1]): r[2:] for r in rows_of(got, *names)}
    assert len(rows) == len(TALK)
    assert rows[1, 1] == (TALK[0][3], None, 0, 0, 0, 0)
    assert rows[1, 2] == ("Fine.", 1, 1, 0, 0, 0)
    assert rows[1, 3] == ("Good to know.", 2, 2, 1, 1, 1)
    assert rows[1, 4] == ("Better.", 3, 3, 2, 2, 2)
    assert rows[1, 5] == ("Back to that.", 1, 1, 1, 3, 3)
    assert rows[1, 6] == ("Odd.", 5, 2, 1, 1, 0)
    assert rows[1, 7] == (None, 6, 3, 0, 0, 0) and rows[1, 8] == ("", 7, 4, 0, 0, 0)
    assert rows[2, 1] == ("Other conversation.", None, 0, 1, 1, 0)
    assert rows[None, 2] == ("", 1, 1, 1, 1, 1)
    assert [rows[3, i][1] for i in (1, 2, 3)] == [None, 1, 2]
    assert rows[4, 2] == ("Short.", 1, 1, 1, 1, 1)
    for (conv, position), r in rows.items():
        assert r[1] is None or r[1] < position


def test_long_chains(spark):
    rows = [(1, i, "user", f"line {i}" + (f"\n> line {i - 1}" if i % 2 else "")) for i in range(100)]
    got = rows_of(quotes.conversations(talk(spark, rows)), "position", "reply_to", "depth")
    assert got == sorted(((i + 1, i or None, i) for i in range(100)), key=repr)


def test_empty_table(spark):
    assert quotes.conversations(talk(spark, [])).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_sql(spark):
    got = queries.op10_quotation_linking(spark, FOLDER)
    assert difference(got, connect(FOLDER), oracles.oracle_sql()["op10_quotation_linking"]) is None
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
