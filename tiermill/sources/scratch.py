"""Scratch tables in the shared checkpoint folder.

A scratch table cuts lineage: a lost executor costs a re-read, never a recomputation that could come out
differently. The folder must be visible to every executor, so it is the one named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Spark hands local properties down to the threads a job is split over.
_SCOPE = "tiermill.scratch.scope"


@dataclass(frozen=True)
class Stored:
    """A scratch table and the number of rows written to it."""

    df: DataFrame
    rows: int
    path: str


def scratch_root(spark: SparkSession) -> str:
    """Folder for scratch tables; a local folder is made only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if configured.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            log.warning("%s must be a mount that the driver and all executors share", configured)
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tiermill-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    return f"{scratch_root(spark)}/tiermill-{context.getLocalProperty(_SCOPE) or context.applicationId}"


def delete_folder(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for one scratch table."""
    return f"{_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage", codec: str | None = None) -> Stored:
    """Write ``df`` once and return it as a plain Parquet scan, with its row count from the same pass.

    ``codec`` compresses the files, by default that of the session.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path, compression=codec)
    return Stored(spark.read.schema(df.schema).parquet(path), seen.get["rows"], path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables written inside the block at its end, also when it fails."""
    context = spark.sparkContext
    outer = context.getLocalProperty(_SCOPE)
    context.setLocalProperty(_SCOPE, uuid.uuid4().hex)
    folder = _folder(spark)
    try:
        yield
    finally:
        delete_folder(spark, folder)
        context.setLocalProperty(_SCOPE, outer)


def release(spark: SparkSession) -> bool:
    """Delete what this application wrote outside a scope; call it once results are stored elsewhere."""
    return delete_folder(spark, _folder(spark))
