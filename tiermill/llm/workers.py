"""Make this package importable in Python workers."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

_kept: list[Callable[[], None]] = []


def keep(drop: Callable[[], None]) -> None:
    """Remember how to drop a cache of this worker, which lasts from task to task."""
    _kept.append(drop)


def let_go() -> None:
    """Drop the caches of earlier work; called where other work begins in the same worker."""
    if _kept:
        while _kept:
            _kept.pop()()
        trim()


def trim() -> None:
    """Give memory that earlier work of this worker has freed back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same work on batches; memory that earlier work or this has freed goes back to the system before and after it."""

    @functools.wraps(work)
    def tidied(batches: Iterator) -> Iterator:
        trim()
        try:
            yield from work(batches)
        finally:
            trim()

    return tidied


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers of this application, once."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="tiermill-code-"), "tiermill-code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
