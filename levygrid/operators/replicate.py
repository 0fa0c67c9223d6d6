"""State treatments repeated at the city geocodes below them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from levygrid import constants as C
from levygrid.functions.ids import is_state_geocode, parent_geocode

SHARED_KEY = ["group", "item", "customer", "provider"]
TYPE_KEY = ["tax_type", "tax_cat"]

# A bag entry with more copies than this is cut up before it is written out.
COPIES_PER_CHUNK = 10_000


def city_records(records: DataFrame) -> DataFrame:
    return records.where(~is_state_geocode(F.col("geocode")))


def _city_counts(records: DataFrame) -> DataFrame:
    """City records counted by geocode, shared key and tax type and category."""
    return (
        city_records(records)
        .groupBy("geocode", *SHARED_KEY, *TYPE_KEY)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def replicated(records: DataFrame) -> DataFrame:
    """New city records, one row per distinct record with its number of ``copies``.

    Every city record pulls in every record of its state with the same shared key,
    unless tax type and category both agree; nothing is de-duplicated. Joining records
    pairwise would compare all records of a hot key with each other. Counting does the
    same: of the N records a city has under a key, n agree with the state record in
    type and category, so the record appears N - n times per state copy. Both sides are
    aggregated before they meet, so what meets per key is at most the cities of one
    state times the distinct treatments of one item.

    ``exact`` holds one entry per tax type and category a city has for one item, which
    the tax-type dimension bounds.
    """
    cities = (
        _city_counts(records)
        .groupBy("geocode", *SHARED_KEY)
        .agg(
            F.sum("n").alias("total"),
            F.map_from_entries(
                F.collect_list(F.struct(F.struct(*TYPE_KEY), F.col("n")))
            ).alias("exact"),
        )
        .withColumn("parent", parent_geocode(F.col("geocode")))
        .withColumnRenamed("geocode", "city_geocode")
    )
    states = (
        records.where(is_state_geocode(F.col("geocode")))
        .groupBy(*C.MATRIX_COLUMNS)
        .agg(F.count(F.lit(1)).alias("state_copies"))
        .withColumnRenamed("geocode", "parent")
    )
    agreeing = F.coalesce(F.try_element_at("exact", F.struct(*TYPE_KEY)), F.lit(0))
    return (
        states.join(cities, ["parent", *SHARED_KEY])
        .withColumn("copies", F.col("state_copies") * (F.col("total") - agreeing))
        .where(F.col("copies") > 0)
        .withColumnRenamed("city_geocode", "geocode")
        .select(*C.MATRIX_COLUMNS, "copies")
    )


def expand_copies(counted: DataFrame) -> DataFrame:
    """Write a counted bag out, row by row.

    Entries are cut into chunks and the chunks shuffled first, so that one entry with
    very many copies is written by many tasks and no array grows with the data.
    """
    chunks = F.ceil(F.col("copies") / COPIES_PER_CHUNK).cast("int")
    chunked = (
        counted.withColumn("__chunk", F.explode(F.sequence(F.lit(1), chunks)))
        .withColumn(
            "__n",
            F.least(
                F.lit(COPIES_PER_CHUNK).cast("bigint"),
                F.col("copies") - (F.col("__chunk") - 1) * F.lit(COPIES_PER_CHUNK).cast("bigint"),
            ).cast("int"),
        )
        .drop("copies")
    )
    plain = [c for c in chunked.columns if c not in ("__n", "__chunk")]
    return (
        chunked.repartition(*[F.col(c) for c in [*plain, "__chunk"]])
        .withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__n"))))
        .select(*plain)
    )


def enhanced(records: DataFrame) -> DataFrame:
    """Original records followed by the replicated ones, as a bag."""
    return records.select(*C.MATRIX_COLUMNS).unionByName(expand_copies(replicated(records)))


def cities_without_state(records: DataFrame) -> DataFrame:
    """City records that pulled in nothing, counted by ``n`` per distinct key.

    The state records under the city's key are none, or all agree with it in tax type
    and category: then their total equals the count of agreeing ones.
    """
    states = (
        records.where(is_state_geocode(F.col("geocode")))
        .groupBy("geocode", *SHARED_KEY, *TYPE_KEY)
        .agg(F.count(F.lit(1)).alias("m"))
        .groupBy("geocode", *SHARED_KEY)
        .agg(
            F.count(F.lit(1)).alias("kinds"),
            F.first(F.struct(*TYPE_KEY)).alias("only_kind"),
        )
        .withColumnRenamed("geocode", "parent")
    )
    # One kind only, and the city's own: any other kind would have been replicated.
    own_kind = (F.col("kinds") == 1) & (F.col("only_kind") == F.struct(*TYPE_KEY))
    return (
        _city_counts(records)
        .withColumn("parent", parent_geocode(F.col("geocode")))
        .join(states, ["parent", *SHARED_KEY], "left")
        .where(F.col("kinds").isNull() | own_kind)
        .select("geocode", "parent", *SHARED_KEY, *TYPE_KEY, "n")
    )
