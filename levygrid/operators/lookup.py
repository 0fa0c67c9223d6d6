"""Look-up joins of a large, possibly skewed side against a dimension."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from levygrid.operators.stages import measured

_PER_VALUE_BYTES = 16  # allowance per value on top of its text


def text_bytes(df: DataFrame) -> Column:
    """Estimated in-memory bytes of a table, as an aggregate."""
    width = F.lit(_PER_VALUE_BYTES * len(df.columns)).cast("bigint")
    for name in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)).cast("bigint")
    return F.coalesce(F.sum(width), F.lit(0))


class Dimension:
    """A look-up table that several joins use.

    It is computed and written once, when the first join needs it, and measured by the
    same job.
    """

    def __init__(self, df: DataFrame, keys: list[str], broadcast_bytes: int, salts: int | None = None):
        self.plan = df
        self.keys = keys
        self.broadcast_bytes = broadcast_bytes
        self.salts = salts

    @cached_property
    def _written(self) -> tuple[DataFrame, dict]:
        return measured(self.plan, bytes=text_bytes(self.plan))

    @property
    def df(self) -> DataFrame:
        return self._written[0]

    @property
    def bytes(self) -> int:
        return self._written[1]["bytes"] or 0

    @property
    def small(self) -> bool:
        return self.bytes <= self.broadcast_bytes


def lookup_join(
    facts: DataFrame,
    dim: Dimension,
    keys: dict[str, Column],
    how: str,
    spread: list[str],
) -> DataFrame:
    """Join ``facts`` to ``dim`` on ``dim key == expression over facts``.

    A dimension of checked small size is broadcast, so the facts do not move. A larger
    one is joined by shuffle with both sides salted: ``spread`` names columns that
    differ between facts of equal key, so a key holding a large share of all facts is
    divided over ``dim.salts`` tasks: by default an eighth of the shuffle's partitions, which
    grow with the data, and 16 at least. The shuffle is asked for, as Spark only knows the size
    of the dimension's compressed files without their salted copies, and would broadcast those.
    """
    temp = {name: f"__k_{name}" for name in keys}
    left = facts.withColumns({temp[n]: e for n, e in keys.items()})
    right = dim.df.withColumnsRenamed(temp)
    on = list(temp.values())
    if dim.small:
        return left.join(F.broadcast(right), on, how).drop(*on)
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = dim.salts or max(16, partitions // 8)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(salts)).cast("int")
    left = left.withColumn("__salt", salt)
    right = right.withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return left.join(right.hint("merge"), [*on, "__salt"], how).drop(*on, "__salt")
