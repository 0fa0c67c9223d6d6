"""Derived sheets written as CSV."""

import csv
import datetime as dt
from pathlib import Path

import pytest

from levygrid.config import MatrixConfig
from levygrid.operators.stages import ensure_checkpoint_dir
from levygrid.sources import tables


@pytest.fixture
def star(spark, tmp_path):
    """Three files: a state's, a city's and one of no place; equal rows come twice."""
    day = dt.datetime(2024, 1, 1)
    lines = [(k, n, k * 7, 3, float(k), 1.0, 0.05, 0.0, day) for k in (5, 1, 3, 3, 4) for n in (1, 5, 7)]
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, " \
        "l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp"
    made = {"lineitem": (lines, schema), "supplier": ([(3, 0)], "s_suppkey long, s_nationkey int"),
            "nation": ([(0, "ALGERIA")], "n_nationkey int, n_name string")}
    for name, (rows, columns) in made.items():
        spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def read(path: Path) -> list[list[str]]:
    text = "".join(p.read_text(encoding="utf-8") for p in sorted(path.glob("part-*.csv")))
    return list(csv.reader(text.splitlines(keepends=True)))


@pytest.mark.parametrize("line_breaks", [False, True])
def test_rows_in_order_below_the_header(spark, star, monkeypatch, line_breaks):
    """Only with line breaks are rows numbered, and then without their cells."""
    number = tables.number_rows

    def narrow(df, *rest):
        assert line_breaks and "cells" not in df.columns
        return number(df, *rest)

    monkeypatch.setattr(tables, "number_rows", narrow)
    tables.export_sheets(spark, star, f"{star}/out", MatrixConfig(), line_breaks)
    folders = sorted(Path(star, "out").glob("sheet=*"))
    assert [f.name for f in folders] == [f"sheet={n} Sales Tax Research.csv" for n in ("ALGERIA", "City 1", "Nowhere")]
    for folder in folders:
        rows = read(folder)
        assert [r[0] for r in rows[:3]] == ["Title 1", "Title 2", "Title 3"]
        assert (rows[3][1], rows[3][10], rows[3][14]) == ("Current ID", "Admin", "Personal Use")
        ids = [f"1.{p % 10}.{p // 10}.0.0.0.0.0" for p in (7, 21, 21, 28, 35)]
        assert [r[1] for r in rows[4:]] == ids
        broken = [i for i, r in enumerate(rows, 1) if "\n" in r[3]]
        assert broken == ([6, 9] if line_breaks else [])
        if line_breaks:
            assert rows[5][3] == '\n"' + ids[1] + '",'


def test_nothing_but_the_sheets_stays(spark, star):
    """The table that rows are numbered on goes with the export."""
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    tables.export_sheets(spark, star, f"{star}/out", MatrixConfig(), line_breaks=True)
    assert set(folder.iterdir()) == before
