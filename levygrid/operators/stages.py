"""Stages written once for several readers."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_SCOPE: ContextVar[str | None] = ContextVar("levygrid_scratch", default=None)
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Have Spark delete the shuffle files of each write inside at its end.

    They would stay until the driver happens to collect its garbage. A write has a plan of
    its own, so nothing reads them again; what is executed elsewhere keeps its files.
    """
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE)
        else:
            spark.conf.set(_FREE, before)


@dataclass
class Manifest:
    """The stages of a resumable run, in the order in which a run with its key writes them.

    A stage is finished once Spark's committer has left its mark. Only finished stages count,
    so that attempts that failed don't shift those behind them.
    """

    spark: SparkSession
    folder: str
    finished: int = 0
    reused: int = 0

    def stage(self, df: DataFrame) -> DataFrame:
        shape = hashlib.sha256(df.schema.json().encode()).hexdigest()[:16]
        path = f"{self.folder}/{self.finished:03d}-{shape}"
        if exists(self.spark, f"{path}/_SUCCESS"):
            self.reused += 1
        else:
            with freed(self.spark):
                df.write.mode("overwrite").parquet(path)
        self.finished += 1
        return self.spark.read.schema(df.schema).parquet(path)


_MANIFEST: ContextVar[Manifest | None] = ContextVar("levygrid_manifest", default=None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a private one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="levygrid-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def ensure_checkpoint_root(spark: SparkSession) -> str:
    """The shared folder itself; Spark's own checkpoint folder in it is new in each session."""
    own = ensure_checkpoint_dir(spark)
    return spark.conf.get("spark.checkpoint.dir", None) or own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of the current run, or else in the checkpoint folder."""
    return f"{_SCOPE.get() or ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def measured(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """Like ``durable``, with aggregates of the rows taken while they are written."""
    if _MANIFEST.get():
        out = durable(df)
        found = out.agg(*[c.alias(n) for n, c in measures.items()])
        return out, found.first().asDict()
    seen = Observation()
    out = durable(df.observe(seen, *[c.alias(n) for n, c in measures.items()]))
    return out, seen.get


def durable(df: DataFrame) -> DataFrame:
    """Write a stage that several outputs reuse and read it back.

    The table survives the loss of executors and cuts the lineage like a checkpoint; being
    columnar it also lets every reader skip the columns it does not need.
    """
    if manifest := _MANIFEST.get():
        return manifest.stage(df)
    path = scratch_path(df.sparkSession, "stage")
    with freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables that nothing reads any more."""
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Put all stages written inside into one folder and delete it at the end."""
    folder = scratch_path(spark, "run")
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        discard(spark, folder)


@contextmanager
def resumable_scope(spark: SparkSession, key: str) -> Iterator[Manifest]:
    """Like ``scratch_scope``, but a run that fails leaves its finished stages behind.

    ``key`` stands for all that decides the contents of the stages. The next run with the
    same key reads those stages instead of computing them, and deletes them when it ends well.
    """
    folder = f"{ensure_checkpoint_root(spark)}/resume-{key}"
    manifest = Manifest(spark, folder)
    scope, token = _SCOPE.set(folder), _MANIFEST.set(manifest)
    try:
        yield manifest
    finally:
        _SCOPE.reset(scope)
        _MANIFEST.reset(token)
    discard(spark, folder)
