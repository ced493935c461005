"""Files of the shared scratch folder, read and written by workers.

A task writes a file under a name of its own and reports it as a row; only files named by stored rows are ever
read. A repeated task therefore leaves an unused file at worst, never a half-written one in use.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyarrow import fs
from pyspark.sql import SparkSession


def new_file(folder: str, label: str) -> str:
    return f"{folder}/{label}-{uuid.uuid4().hex}.bin"


@contextmanager
def writing(path: str):
    """An output stream into a new file, its folder made if needed."""
    system, place = fs.FileSystem.from_uri(path)
    system.create_dir(os.path.dirname(place), recursive=True)
    with system.open_output_stream(place) as out:
        yield out


@contextmanager
def reading(path: str):
    """A random-access input file."""
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_file(place) as source:
        yield source


def local_view(path: str, kind) -> np.ndarray:
    """Map a file of numbers into memory.

    A shared folder that is mounted is mapped in place. A file of another store is fetched into an unnamed local
    file, which goes with the process that maps it.
    """
    system, place = fs.FileSystem.from_uri(path)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(place, kind, "r") if os.path.getsize(place) else np.zeros(0, kind)
    with tempfile.TemporaryFile() as held, system.open_input_stream(place) as source:
        while block := source.read(8 << 20):
            held.write(block)
        held.flush()
        return np.memmap(held, kind, "r") if held.tell() else np.zeros(0, kind)


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Fewer rows in an Arrow batch while a job with large rows runs; the setting is put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Have Spark delete the shuffle files of each job at its end; for jobs that store what they make and are not run again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
