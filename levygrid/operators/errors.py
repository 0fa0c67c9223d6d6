"""Errors as rows: every exclusion is reported, nothing is only logged.

All error tables share the columns ``error_type, file_name, error_message``.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from levygrid import constants as C
from levygrid.config import MatrixConfig
from levygrid.functions.ids import parent_geocode
from levygrid.operators.dimensions import Dimensions
from levygrid.operators.lookup import lookup_join
from levygrid.operators.records import unknown_statuses
from levygrid.operators.rows import with_jurisdiction
from levygrid.operators.stages import durable


def first_n(df: DataFrame, key: list[str], order: list[str], n: int, item: str) -> DataFrame:
    """The first ``n`` items per key as ``sample`` text.

    The rank filter is pushed below the shuffle, so a task sends at most n rows per key
    however many rows the key has; the collected lists hold at most n items.
    """
    ranked = df.withColumn(
        "__rank", F.row_number().over(W.partitionBy(*key).orderBy(*order))
    ).where(F.col("__rank") <= n)
    texts = F.array_sort(F.collect_list(F.struct("__rank", F.col(item).alias("text"))))
    return (
        ranked.groupBy(*key)
        .agg(texts.alias("__texts"))
        .select(*key, F.array_join(F.col("__texts.text"), ", ").alias("sample"))
    )


def with_rest(sample: Column, count: Column, n: int) -> Column:
    rest = F.concat(F.lit(" ... and "), (count - n).cast("string"), F.lit(" more"))
    return F.concat(sample, F.when(count > n, rest).otherwise(F.lit("")))


def filled(template: str, **values: Column | str) -> Column:
    """A message text with its places filled in."""
    parts = []
    for text, name, _, _ in Formatter().parse(template):
        parts.append(F.lit(text))
        if name:
            value = values[name]
            parts.append(F.lit(value) if isinstance(value, str) else value.cast("string"))
    return F.concat(*parts)


def _error(df: DataFrame, kind: str, file_name: Column, message: Column) -> DataFrame:
    return df.select(
        F.lit(kind).alias("error_type"),
        file_name.alias("file_name"),
        message.alias("error_message"),
    )


def failed_files(rows: DataFrame, dims: Dimensions) -> DataFrame:
    """Files with rows whose name resolves to no geocode. A file without rows never fails."""
    files = rows.select("file_idx", "file_name").distinct()
    return lookup_join(
        with_jurisdiction(files), dims.locations, {"jurisdiction": F.col("jurisdiction")},
        "left_anti", ["file_idx"],
    ).select("file_idx", "file_name")


def file_errors(rows: DataFrame, dims: Dimensions) -> DataFrame:
    message = filled(C.MSG_FILE, file=F.col("file_name"))
    return _error(failed_files(rows, dims), C.ERR_FILE, F.col("file_name"), message)


def unknown_status_errors(
    rows: DataFrame, dims: Dimensions, config: MatrixConfig
) -> DataFrame:
    known = str(C.NOT_TAXABLE_TEXTS + C.TAXABLE_TEXTS)
    uncertain = str(C.UNCERTAIN_TEXTS)
    text = F.col("status_text")
    message = filled(
        C.MSG_UNKNOWN_STATUS, text=text, upper=F.upper(text), known=known, uncertain=uncertain
    )
    return _error(
        unknown_statuses(rows, dims, config), C.ERR_UNKNOWN_STATUS, F.col("file_name"), message
    )


def missing_tax_types(misses: DataFrame) -> DataFrame:
    """Per file, geocode and category without tax types: record count and first items."""
    key = ["file_idx", "file_name", "geocode", "tax_cat"]
    # Read twice, but computed once.
    misses = durable(misses.select(*key, "ordinal", "side_idx", "item"))
    counts = misses.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    samples = first_n(misses, key, ["ordinal", "side_idx"], C.MISSING_TYPE_SAMPLE, "item")
    return counts.join(samples, key)


def missing_tax_type_errors(misses: DataFrame) -> DataFrame:
    n = F.col("n")
    message = filled(
        C.MSG_NO_TAX_TYPE, geocode=F.col("geocode"), tax_cat=F.col("tax_cat"), n=n,
        items=with_rest(F.col("sample"), n, C.MISSING_TYPE_SAMPLE),
    )
    return _error(
        missing_tax_types(misses), C.ERR_NO_TAX_TYPE, F.col("file_name"), message
    )


def city_summary(misses: DataFrame) -> DataFrame:
    """Cities without state treatments: record count, distinct items, first items by name."""
    per_item = misses.groupBy("geocode", "item").agg(
        F.sum("n").alias("n"),
        F.collect_set("group").alias("groups"),
        F.collect_set("customer").alias("customers"),
    )
    totals = per_item.groupBy("geocode").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("groups")))).alias("groups"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("customers")))).alias("customers"),
    )
    samples = first_n(per_item, ["geocode"], ["item"], C.REPLICATION_SAMPLE, "item")
    return totals.join(samples, "geocode").withColumn("parent", parent_geocode(F.col("geocode")))


def replication_errors(misses: DataFrame) -> DataFrame:
    def quoted(values: str) -> Column:
        return F.concat(F.lit("['"), F.array_join(F.col(values), "', '"), F.lit("']"))

    message = filled(
        C.MSG_REPLICATION, geocode=F.col("geocode"), n=F.col("n"), parent=F.col("parent"),
        groups=quoted("groups"), customers=quoted("customers"),
        items=with_rest(F.col("sample"), F.col("items"), C.REPLICATION_SAMPLE),
    )
    return _error(
        city_summary(misses), C.ERR_REPLICATION, F.lit(None).cast("string"), message
    )


def unmapped_errors(unmapped: DataFrame) -> DataFrame:
    """One summary row if any id is unmapped; the ids themselves are a table of their own."""
    total = unmapped.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 0)
    return _error(
        total, C.ERR_UNMAPPED, F.lit(None).cast("string"), filled(C.MSG_UNMAPPED, n=F.col("n"))
    )
