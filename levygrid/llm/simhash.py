"""SimHash fingerprints and near-duplicate classes by multi-index hashing.

A fingerprint has two 32-bit segments. Two fingerprints that differ in at most two bits
differ in at most one bit of one of the segments, so it is enough to enumerate, for each
distinct fingerprint and segment, the Hamming ball of radius one, to fetch the table
entries that have such a segment, and to verify the distance of the whole fingerprints.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from levygrid.llm.common import Scratch, fresh

SEED = 42
MAX_DISTANCE = 2
#: A segment value with more distinct fingerprints than this is not expanded into pairs.
BUCKET = 64
_SEGMENT_BITS = 32
_STEP = 1 << 16


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """Signed 64-bit SimHash of a text in UTF-8; 0 if it has no word.

    ASCII capitals are lowered, words are runs without ASCII white space, features are
    shingles of ``width`` words, repeats included (all words if there are fewer).
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(0, len(words) - width)
    ends = ends[min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for at in range(0, last + 1, _STEP):
        spans = zip(starts[at : min(at + _STEP, last + 1)].tolist(), ends[at : at + _STEP].tolist())
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > last + 1)
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprint_column(text: Column) -> Column:
    """SimHash of a text column as a long; null and wordless texts give 0."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py()) for t in texts.cast(pa.binary())], pa.int64())

    return simhash(text)


def hex_fingerprint(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _ball(value: Column, upward: bool) -> Column:
    """Segment values within one bit; ``upward`` only sets bits, so that a pair that
    differs in one bit is found from one side."""
    masks = F.array(*[F.lit(m).cast("long") for m in [0, *(1 << b for b in range(_SEGMENT_BITS))]])
    if upward:
        masks = F.filter(masks, lambda m: value.bitwiseAND(m) == 0)
    return F.transform(masks, lambda m: value.bitwiseXOR(m))


def _whole(segment: Column, part: Column, rest: Column) -> Column:
    high = F.when(segment == 0, part).otherwise(rest)
    low = F.when(segment == 0, rest).otherwise(part)
    return F.shiftleft(high, _SEGMENT_BITS).bitwiseOR(low)


def links(prints: DataFrame, fp: str = "fp", bucket: int = BUCKET) -> DataFrame:
    """Links ``a < b`` between distinct fingerprints at two or fewer differing bits.

    ``prints`` holds each fingerprint once. Table entries are (segment, value, other
    segment). Buckets of up to ``bucket`` entries are fetched whole and every pair with
    the probing fingerprint is verified. A larger bucket is never paired: its entries and
    its probes are spread over the balls of the other segment too, that is, over
    common neighbours at one bit. At most 65 fingerprints share such a neighbour, all
    of them within two bits of each other; each is linked to the least. Fingerprints that
    differ in two or fewer bits have a common neighbour, so no component is torn.

    Probes meet buckets in a sort-merge join, which is asked for: Spark sizes rows behind an
    explode like those before it, and would broadcast many times what it takes them for.
    """
    low = (1 << _SEGMENT_BITS) - 1
    high = F.shiftrightunsigned(F.col(fp), _SEGMENT_BITS)
    halves = [(0, high, F.col(fp).bitwiseAND(low)), (1, F.col(fp).bitwiseAND(low), high)]
    entry = F.explode(F.array(*[
        F.struct(F.lit(s).alias("segment"), part.alias("part"), rest.alias("rest"))
        for s, part, rest in halves
    ]))
    entries = prints.select(entry.alias("e")).select("e.*")
    key = ["segment", "part"]
    large = entries.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket)
    large = large.select(*key, F.lit(None).cast("array<long>").alias("members"))
    small = (
        entries.join(large.select(*key), key, "left_anti")
        .groupBy(*key).agg(F.collect_list("rest").alias("members"))
    )
    probes = entries.select(
        "segment", F.col("part").alias("own"), "rest",
        F.explode(_ball(F.col("part"), upward=True)).alias("part"),
    )
    hits = probes.hint("merge").join(small.unionByName(large), key)
    me = _whole(F.col("segment"), F.col("own"), F.col("rest"))

    fetched = hits.where(F.col("members").isNotNull()).select(
        me.alias("x"), "segment", "part", F.explode("members").alias("member")
    ).select("x", _whole(F.col("segment"), F.col("part"), F.col("member")).alias("y"))

    same = F.col("own") == F.col("part")
    centre = F.when(same, _ball(F.col("rest"), upward=False)).otherwise(F.array("rest"))
    around = (
        hits.where(F.col("members").isNull())
        .select(*key, F.explode(centre).alias("centre"), me.alias("x"))
        .groupBy(*key, "centre").agg(F.collect_set("x").alias("xs"))
        .where(F.size("xs") > 1)
        .select(F.array_min("xs").alias("x"), F.explode("xs").alias("y"))
    )
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= MAX_DISTANCE
    return (
        fetched.unionByName(around)
        .where((F.col("x") != F.col("y")) & near)
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): the least node reachable over ``edges`` (a, b), for linked nodes.

    Labels spread to neighbours and then jump to the label of their label, so that the
    number of rounds grows with the logarithm of the longest path. Every round is written
    to the shared folder; only the count of changed labels reaches the driver.
    """
    both = scratch.write(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    )
    labels = scratch.write(
        both.groupBy("node").agg(F.min("other").alias("other"))
        .select("node", F.least("node", "other").alias("root"))
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), "root"), "other")
            .groupBy("node").agg(F.min("root").alias("near"))
        )
        spread = scratch.write(
            labels.select("node", F.col("root").alias("old"))
            .join(near, "node").select("node", "old", F.least("old", "near").alias("root"))
        )
        up = spread.select(F.col("node").alias("root"), F.col("root").alias("upper"))
        scratch.drop(labels)
        labels = scratch.write(
            spread.join(up, "root").select("node", "old", F.least("root", "upper").alias("root"))
        )
        scratch.drop(spread)
        if not labels.where(F.col("old") != F.col("root")).limit(1).count():
            scratch.drop(both)
            return labels.select("node", "root")


def classes(prints: DataFrame, id_col: str, fp: str, scratch: Scratch) -> DataFrame:
    """(fp, component_id): for each fingerprint the least id of its near-duplicate class.

    ``prints`` has a row per document. Equal fingerprints collapse before anything is
    compared, whatever their number. Null ids don't count (a class of them only has null).
    """
    first = scratch.write(
        prints.groupBy(F.col(fp).alias("fp")).agg(F.min(id_col).alias("first"))
    )
    edges = scratch.write(links(first.select("fp")))
    roots = components(edges, scratch).withColumnRenamed("node", "fp")
    linked = roots.join(first, "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = roots.join(least, "root").select("fp", "component_id")
    return scratch.write(
        first.join(linked, "fp", "left")
        .select("fp", F.coalesce("component_id", "first").alias("component_id"))
    )


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each row of ``df``.

    Null and empty texts have fingerprint zero and form a class. Repeated rows stay, in
    one class. Other columns of ``df`` are not read.
    """
    scratch = Scratch(df.sparkSession)
    prints = scratch.write(
        df.select(F.col(id_col).alias("doc_id"), fingerprint_column(F.col(text_col)).alias("fp"))
    )
    found = classes(prints, "doc_id", "fp", scratch)
    return prints.join(found, "fp").select(
        "doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id"
    )


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df``, one of each near-duplicate class: that with the least id.

    Of repeated rows with the least id one stays; a null id stays only if no row of the
    class has an id. The rows are written once with their fingerprint and a row number, so
    that texts are hashed once and ties are broken alike in all readers.
    """
    scratch = Scratch(df.sparkSession)
    row, fp, member = fresh(df, "__row", "__fp", "__class")
    kept = scratch.write(df.withColumns({
        row: F.monotonically_increasing_id(), fp: fingerprint_column(F.col(text_col)),
    }))
    found = classes(kept.select(id_col, fp), id_col, fp, scratch)
    keepers = (
        kept.select(row, fp, id_col)
        .join(found.withColumnsRenamed({"fp": fp, "component_id": member}), fp)
        .where(F.col(id_col).eqNullSafe(F.col(member)))
        .groupBy(member).agg(F.min(row).alias(row))
    )
    return kept.join(keepers.select(row), row, "left_semi").select(*df.columns)
