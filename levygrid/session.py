"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Both engines and all exports read timestamps as UTC.
    "spark.sql.session.timeZone": "UTC",
    # Methods beyond 8000 bytes of byte code are never compiled by the JVM; have Spark
    # leave fused code generation for such a stage instead of interpreting it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Folders are listed in this many tasks; by default each of up to 10,000 is a task of its own.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
    # Listings live as long as the plan that reads them. Spark would keep each in a cache of 250 MB
    # on the driver too, under a key of its own that no later plan has.
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
    # With the usual 4 MB a task opens few of many small files (4 of up to 16 MB), and the driver
    # keeps an account of every task.
    "spark.sql.files.openCostInBytes": "1m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


class Tuned:
    """The settings in force; a ``with`` block puts the earlier ones back at its end."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.before = {name: spark.conf.get(name, None) for name in SETTINGS}
        for name, value in SETTINGS.items():
            spark.conf.set(name, value)

    def __enter__(self) -> SparkSession:
        return self.spark

    def __exit__(self, *_: object) -> None:
        for name, value in self.before.items():
            if value is None:
                self.spark.conf.unset(name)
            else:
                self.spark.conf.set(name, value)


def tuned(spark: SparkSession) -> Tuned:
    """Apply the settings to a running session."""
    return Tuned(spark)
