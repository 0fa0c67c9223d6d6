"""Product items with hierarchical descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from levygrid import constants as C
from levygrid.config import MatrixConfig
from levygrid.functions.ids import ancestor_ids, has_ancestors
from levygrid.functions.text import ws
from levygrid.operators.codes import with_item_codes
from levygrid.operators.dimensions import Dimensions
from levygrid.operators.lookup import Dimension, lookup_join
from levygrid.operators.rows import certain_only, tagged_same_case, with_jurisdiction
from levygrid.operators.stages import durable

KEY = ["file_idx", "item"]


def descriptions(rows: DataFrame) -> DataFrame:
    """(file, id) -> own text; all rows count, tagged or not, and the last one wins."""
    return (
        rows.where(F.col("current_id") != "")
        .groupBy("file_idx", F.col("current_id").alias("item"))
        .agg(F.max_by("description", "ordinal").alias("own_text"))
    )


def resolved_files_only(rows: DataFrame, locations: Dimension) -> DataFrame:
    """Rows of files whose name resolves; a file that fails yields no items."""
    return lookup_join(
        with_jurisdiction(rows), locations, {"jurisdiction": F.col("jurisdiction")},
        "left_semi", ["file_idx", "ordinal"],
    ).drop("jurisdiction")


def candidates(rows: DataFrame, dims: Dimensions, config: MatrixConfig) -> DataFrame:
    """Rows that name a product item: tagged in exact case, identified, not uncertain."""
    wanted = certain_only(tagged_same_case(rows, config)).where(F.col("current_id") != "")
    return resolved_files_only(wanted, dims.locations).select(
        "file_idx", "ordinal", F.col("current_id").alias("item")
    )


def counted(candidate_rows: DataFrame) -> DataFrame:
    """Candidates per (file, id): how many, and the first position."""
    return candidate_rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("copies"), F.min("ordinal").alias("ordinal")
    )


def hierarchical(ids: DataFrame, texts: DataFrame, config: MatrixConfig) -> DataFrame:
    """Add ``description`` to distinct (file, id) keys: ancestors' texts, then the own one.

    A missing or blank text counts as one space. The own text is met one to one, by file
    and id. Ancestors' texts are put together once per file and list of ancestors, which all
    ids below the same one share: few rows, and only this small table is broadcast or salted.
    """
    carried = [c for c in ids.columns if c not in KEY]

    def shown(text: Column) -> Column:
        return F.when(F.coalesce(text, F.lit("")) == "", F.lit(" ")).otherwise(text)

    ids = ids.withColumn("chain", ancestor_ids(F.col("item")))
    chains = durable(ids.where(F.size("chain") > 0).select("file_idx", "chain").distinct())
    steps = chains.select("file_idx", "chain", F.posexplode("chain").alias("pos", "step"))
    needed = steps.select("file_idx", F.col("step").alias("item")).distinct()
    above = texts.join(needed, KEY, "left_semi").select(
        F.col("file_idx").alias("f"), F.col("item").alias("i"), F.col("own_text").alias("text")
    )
    lookup = Dimension(above, ["f", "i"], config.broadcast_bytes, config.salts)
    found = lookup_join(
        steps, lookup, {"f": F.col("file_idx"), "i": F.col("step")}, "left", ["chain"]
    )
    parts = F.array_sort(F.collect_list(F.struct("pos", shown(F.col("text")).alias("text"))))
    upper = found.groupBy(F.col("file_idx").alias("f"), F.col("chain").alias("c")).agg(parts["text"].alias("upper"))
    uppers = Dimension(upper, ["f", "c"], config.broadcast_bytes, config.salts)
    full = F.concat(
        F.coalesce(F.col("upper"), F.array().cast("array<string>")), F.array(shown(F.col("own_text")))
    )
    return (
        lookup_join(
            ids.join(texts, KEY, "left"), uppers, {"f": F.col("file_idx"), "c": F.col("chain")}, "left", ["item"]
        )
        .select(*KEY, *carried, ws(F.array_join(full, " | ")).alias("description"))
    )


def product_items(rows: DataFrame, dims: Dimensions, config: MatrixConfig) -> DataFrame:
    """Items before code conversion, one row per file and id with its ``copies``."""
    described = hierarchical(
        counted(candidates(rows, dims, config)), descriptions(rows), config
    )
    return described.where(F.col("description") != "").select(
        "file_idx", "ordinal", F.lit(C.GROUP_CODE).alias("group"), "item", "description", "copies"
    )


def valid_candidates(rows: DataFrame, dims: Dimensions, config: MatrixConfig) -> DataFrame:
    """Candidates that have a description, found without building it; with ``copies``.

    An id with ancestors always has one (the separators). Only ids without ancestors
    need their own text looked up, and they are counted first.
    """
    rows_in = candidates(rows, dims, config)
    nested = rows_in.where(has_ancestors(F.col("item")))
    top = counted(rows_in.where(~has_ancestors(F.col("item"))))
    top_rows = rows.where(~has_ancestors(F.col("current_id")))
    blank = descriptions(top_rows).where(F.col("own_text") == "")
    described = top.join(blank, KEY, "left_anti")
    one = F.lit(1).cast("bigint")
    return nested.withColumn("copies", one).unionByName(described)


def first_per_code(coded: DataFrame, *carried: str) -> DataFrame:
    """Keep the first item of every code, in file then row order."""
    return (
        coded.groupBy("item")
        .agg(
            F.min_by(F.struct(*carried), F.struct("file_idx", "ordinal")).alias("kept")
        )
        .select("item", "kept.*")
    )


def unique_items(rows: DataFrame, dims: Dimensions, config: MatrixConfig) -> DataFrame:
    """Output items: converted, the first per code, described.

    The winners are chosen before descriptions are built, so the ancestor look-ups run
    for one row per code instead of every row.
    """
    valid = valid_candidates(rows, dims, config).withColumn("research_id", F.col("item"))
    coded = with_item_codes(valid, dims.product_codes)
    winners = durable(first_per_code(coded, "file_idx", "research_id"))
    ids = winners.select("file_idx", F.col("research_id").alias("item")).distinct()
    path = F.concat(ancestor_ids(F.col("item")), F.array("item"))
    needed = ids.select("file_idx", F.explode(path).alias("item")).distinct()
    texts = descriptions(rows).join(needed, KEY, "left_semi")
    described = hierarchical(ids, texts, config)
    return winners.join(
        described.withColumnRenamed("item", "research_id"), ["file_idx", "research_id"]
    ).select(F.lit(C.GROUP_CODE).alias("group"), "item", "description")
