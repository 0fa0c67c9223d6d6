import math
import random
import re
from collections import Counter

import duckdb
import pytest

from levygrid.llm import lexical, oracles, queries
from tests.llm.frames import ROWS, documents, rows_of


def terms(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def brute(docs, items, top=10):
    docs = [(i, Counter(terms(t))) for i, t in docs]
    number = sum(1 for _, c in docs if c)
    total = sum(sum(c.values()) for _, c in docs)
    holding = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        own = Counter(terms(text))
        found = []
        for i, c in docs:
            m = 25 + 75 * sum(c.values()) * number // max(1, total)
            score = sum(
                k * math.floor(1000 * math.log((2 * number + 2) / (2 * holding[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t, k in own.items() if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(found)[:top], 1):
            out.append((item, rank, None if none else i, -score))
    return sorted(out, key=repr)


ITEMS = [
    (1, "The QUICK brown fox; the lazy dog!"), (2, None), (3, "..."), (4, "eins zwei fünf zwei"), (None, "word1 word2"),
    (6, "absent terms only zzz"), (6, "band plays"), (7, "word word1 rd1 wor"),
]


def frame(spark, items=ITEMS):
    extra = [(*i, 7, "x") for i in items]
    return spark.createDataFrame(extra, "item_id long, text string, score long, terms string")


@pytest.mark.parametrize("size", [1, 30, 1 << 19])
def test_odd_rows(spark, size):
    got = lexical.search(documents(spark), frame(spark), size=size)
    want = brute([(i, t) for i, t, _, _ in ROWS], ITEMS)
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == want
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and want


def test_empty_tables(spark):
    assert lexical.search(documents(spark, []), frame(spark)).count() == 0
    assert lexical.search(documents(spark), frame(spark, [])).count() == 0


def test_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(lexical, "_CELLS", 64)
    draw = random.Random(2)
    words = [f"t{i}" for i in range(30)] + ["É", "é", "x9", "naïve"]
    texts = [", ".join(draw.choices(words, k=draw.randint(0, 60))) for _ in range(60)]
    docs = [(i, draw.choice(texts)) for i in range(400)] + [(i, "t1 t2") for i in range(900, 960)]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(1, 9)))) for i in range(12)]
    draw.shuffle(docs)
    made = documents(spark, [(*d, None, None) for d in docs]).repartition(3)
    got = lexical.search(made, frame(spark, items), size=60)
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == brute(docs, items)


def test_guards():
    machine = lexical.automaton(["a", "ab", "b", "é", "Ã"])
    text = lexical.guarded("A ab,a\x00b É é Ã a".encode())
    got = Counter(n for _, n in machine.iter(text.decode("latin-1")))
    assert got == {0: 3, 1: 1, 2: 1, 3: 1, 4: 1}
    assert lexical.term_number(text) == 8
    assert [lexical.term_number(lexical.guarded(t)) for t in (b"", b" ", b"a", b" .a. ")] == [0, 0, 1, 1]


def test_against_sql(spark, tmp_path):
    docs = documents(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    frame(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    got = rows_of(queries.op12_lexical_search(spark, str(tmp_path)), "item_id", "rank", "doc_id", "score")
    assert got == sorted(con.sql(oracles.oracle_sql()["op12_lexical_search"]).fetchall(), key=repr)
