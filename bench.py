"""Headline queries, timed one after the other; one JSON line on standard output.

One small read runs before the clock starts, so that class loading is not billed to the
first query. Look-ups are loaded by the first query that needs them and are billed to it.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from levygrid.plans.catalog import queries

HEADLINE = [
    "matrix_update",
    "product_item_update",
    "errors_report",
    "run_summary",
    "sheet_matrix",
    "replicate_state",
    "product_items",
    "sheet_scan",
    "write_matrix",
]


def _scale(folder: str) -> float | str:
    text = folder.rstrip("/").rsplit("sf", 1)[-1]
    try:
        return float(text)
    except ValueError:
        return text


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("levygrid-bench")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").groupBy("r_name").count().collect()
    known = queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": _scale(folder),
    }))


if __name__ == "__main__":
    main()
