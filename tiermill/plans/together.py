"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")
R = TypeVar("R")


def together(spark: SparkSession, work: Callable[[T], R], items: Iterable[T]) -> list[R]:
    """Do ``work`` for all items at once, so that small tables do not leave the cluster idle."""
    items = list(items)
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        # the wrapper copies this thread's local properties, so each item gets its own copy
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(work), i) for i in items]]
