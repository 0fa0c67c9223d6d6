"""Helpers that several training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from levygrid.operators.stages import discard, scratch_path

#: Words are runs of characters other than ASCII white space.
SPACE_CLASS = "[ \\t-\\r]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns named by place, and the places of ``names``, so that no name can clash.

    ``toDF(*df.columns)`` gives a result its names back.
    """
    columns = {c.lower(): f"c{i}" for i, c in reversed([*enumerate(df.columns)])}
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), [columns[n.lower()] for n in names]


def words_of(text: Column) -> Column:
    """The words of a text, in order; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}++")
    return F.array_remove(parts, "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas use it."""
    return F.transform(F.array(value), body)[0]


class Scratch:
    """Tables in the shared checkpoint folder that can be dropped when no longer read."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: list[tuple[DataFrame, str]] = []

    def write(self, df: DataFrame, name: str = "llm") -> DataFrame:
        """Write ``df`` and read it back: lineage ends here, and readers prune columns."""
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((out, path))
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete the files of a table that ``write`` returned."""
        discard(self.spark, *[path for table, path in self.tables if table is df])
        self.tables = [(table, path) for table, path in self.tables if table is not df]


def slices(batches: Iterable[pa.RecordBatch], text: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text column of a slice has about ``limit`` bytes.

    No row is divided: a longer text is a slice of its own.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(False)
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
