"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from levygrid.llm.common import fresh, numbered, Scratch, words_of
from levygrid.operators.lookup import Dimension, lookup_join
from levygrid.operators.numbering import number_rows

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
MAX_EPOCHS = 2
#: The mix takes this many halves of all words.
SHARE_HALVES = 3
SEED = 42
_BINS = 4096
_BROADCAST = 32 << 20
_SALTS = 64


def water_levels(sources: DataFrame) -> DataFrame:
    """Add ``target`` to a table (…, weight, source_size) with a row for each source.

    Every source gets words in proportion to its weight, at most ``MAX_EPOCHS`` times its
    size. While a source is above that, it is set to it and what it gives up is shared
    among the others by weight. Only three sums reach the driver in each round; at most as
    many rounds as there are sources, in practice a few. Sums are exact integers, and a
    target is one quotient, so every engine gives the same double.
    """
    cap = F.col("source_size") * MAX_EPOCHS
    total = Decimal(sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("t")).first()["t"])
    capped = F.lit(False)
    closed = -1
    while True:
        sums = sources.agg(
            F.coalesce(F.sum(F.when(capped, cap)), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weight"),
            F.count(F.when(capped, 1)).alias("n"),
        ).first()
        # Half words, so that one and a half times a sum is whole.
        rest = int(SHARE_HALVES * total - 2 * sums["words"])
        level = (F.col("weight").cast("decimal(38,0)") * F.lit(Decimal(rest))).cast("double") / F.lit(
            float(2 * sums["weight"] or 1)
        )
        if sums["n"] == closed or sums["weight"] == 0:
            return sources.withColumn("target", F.when(capped, cap.cast("double")).otherwise(level))
        closed = sums["n"]
        above = F.col("weight").cast("decimal(38,0)") * F.lit(Decimal(rest)) > (
            cap.cast("decimal(38,0)") * F.lit(Decimal(2 * sums["weight"]))
        )
        capped = above if closed == 0 else capped | above


def _draw(*parts: Column) -> Column:
    """The seeded order of documents: a hash in hexadecimal."""
    text = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("/", F.lit(str(SEED)), *text))


def _bin(draw: Column) -> Column:
    return F.conv(F.substring(draw, 1, 3), 16, 10).cast("int")


def _taken(df: DataFrame, id_col: str, text_col: str, source_col: str, keep: list[str]):
    """Rows of ``df`` (columns ``keep``) with size, source_size, target and taken words.

    A source's target is whole repetitions of all its documents plus a rest. The rest is
    filled by documents in seeded order, each taken whole; the one that would exceed it is
    taken in part, so the source's words are its target, rounded down. A document's place in
    that order comes from sums over ``_BINS`` bins of the hash; only the documents of
    the one bin in which the rest ends are put in order, so no source is sorted in one task.
    """
    scratch = Scratch(df.sparkSession)
    size, key, draw, row = fresh(df, "size", "__source", "__draw", "__row")
    wide = [*dict.fromkeys(keep)]
    source = F.col(source_col).cast("string")
    rows = scratch.write(df.select(
        *wide,
        F.size(words_of(F.col(text_col))).cast("long").alias(size),
        F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source)).alias(key),
        _draw(F.col(id_col)).alias(draw), F.monotonically_increasing_id().alias(row),
    ))
    bins = scratch.write(
        rows.groupBy(F.col(key).alias("__key"), _bin(F.col(draw)).alias("bin"))
        .agg(F.sum(size).alias("words"))
    )
    sources = bins.groupBy("__key").agg(F.sum("words").alias("source_size"))
    turn = F.pmod(F.col("n") - 1, F.lit(len(WEIGHTS))).cast("int")
    sources = scratch.write(
        number_rows(sources, [], [F.col("__key")], "n")
        .withColumn("weight", F.array(*[F.lit(w) for w in WEIGHTS])[turn].cast("long"))
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    levels = (
        water_levels(sources).withColumn("whole", F.coalesce(whole, F.lit(0)).cast("long"))
        .withColumn("rest", F.floor("target").cast("long") - F.col("whole") * F.col("source_size"))
    )
    upto = F.sum("words").over(W.partitionBy("__key").orderBy("bin"))
    ends = (
        bins.join(levels.select("__key", "rest"), "__key").withColumn("upto", upto)
        .where(F.col("upto") > F.col("rest"))
        .groupBy("__key").agg(
            F.min("bin").alias("cut"),
            F.min(F.col("upto")).alias("upto"),
            F.min_by("words", "bin").alias("words"),
        )
        .select("__key", "cut", (F.col("upto") - F.col("words")).alias("earlier"))
    )
    plan = levels.join(ends, "__key", "left").select(
        "__key", *[F.col(c).alias(f"__{c}") for c in ("source_size", "target", "whole", "rest", "cut", "earlier")]
    )
    dim = Dimension(plan, ["__key"], _BROADCAST, _SALTS)
    known = lookup_join(rows, dim, {"__key": F.col(key)}, "inner", [row])
    place = _bin(F.col(draw))
    at_end = F.coalesce(place == F.col("__cut"), F.lit(False))
    sure = known.where(~at_end).withColumn(
        "__part", F.when(place < F.col("__cut"), F.col(size)).otherwise(0).cast("long")
    )
    order = W.partitionBy(key).orderBy(draw, row).rowsBetween(W.unboundedPreceding, -1)
    before = F.col("__earlier") + F.coalesce(F.sum(size).over(order), F.lit(0))
    ordered = known.where(at_end).withColumn(
        "__part", F.least(F.col(size), F.greatest(F.lit(0), F.col("__rest") - before)).cast("long")
    )
    out = sure.unionByName(ordered)
    return out, size, F.col("__whole") * F.col(size) + F.col("__part")


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """(doc_id, size, source_size, target, taken), a row for each row of ``df``.

    Sizes are words of the whole text; a null text has none. Sources weigh 3, 1, 2,
    repeating, in code point order, null as the last; rows of the null source count as one
    source. Words taken are whole repetitions of the document and, for one document of a
    source at most, a part. The order is a seeded hash of the id (equal and null ids: by
    place in the input), so reruns agree. Other columns of ``df`` are not read.
    """
    df = df.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source")
    )
    out, size, taken = _taken(df, "doc_id", "text", "source", ["doc_id"])
    return out.select(
        "doc_id", F.col(size).alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), taken.alias("taken"),
    )


def mixture(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The mix itself: rows of ``df``, each as often as it is taken.

    A part of a document is a row whose text is its first words, joined by blanks. Documents
    without words aren't taken, and an empty table gives an empty one. Other columns of ``df`` stay as they are,
    whatever their names.
    """
    names = df.columns
    df, (id_col, text_col, source_col) = numbered(df, id_col, text_col, source_col)
    out, size, taken = _taken(df, id_col, text_col, source_col, df.columns)
    copies = F.ceil(F.col("__taken") / F.col(size)).cast("int")
    words = F.least(F.col(size), F.col("__taken") - (F.col("__copy") - 1) * F.col(size))
    cut = F.array_join(F.slice(words_of(F.col(text_col)), F.lit(1), F.col("__words").cast("int")), " ")
    text = F.when(F.col("__words") < F.col(size), cut).otherwise(F.col(text_col))
    return (
        out.withColumn("__taken", taken).where(F.col("__taken") > 0)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), copies)))
        .withColumn("__words", words).withColumn(text_col, text).select(*df.columns).toDF(*names)
    )
