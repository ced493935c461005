"""Look up one row per key for rows of which few keys may hold a large share.

A key with more than one of ``SHARE`` rows is one of at most ``SHARE`` keys, whatever the data, so the rows known for
such keys are broadcast and their many rows stay where they are. Rows of all other keys are joined by a shuffle, in
which no key has more than that share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 1000


def attach(rows: DataFrame, known: DataFrame, key: str, size: Column, total: int, columns: Sequence[str]) -> DataFrame:
    """Left join ``columns`` of ``known`` (one row per ``key``) to ``rows``.

    ``size`` is the number of rows of the key, computed from ``known``; ``total`` the number of all rows. Rows whose key
    is NULL or not known get NULLs. ``rows`` is read twice and should be stored.
    """
    found = F.struct(*columns).alias("__found")
    heavy = known.filter(size * SHARE > total).select(key, found)
    light = known.filter(size * SHARE <= total).select(key, found)
    first = rows.join(F.broadcast(heavy), key, "left")
    rest = first.filter(F.col("__found").isNull() & F.col(key).isNotNull()).drop("__found").join(light, key, "left")
    both = first.filter(F.col("__found").isNotNull() | F.col(key).isNull()).unionByName(rest)
    return both.select(*rows.columns, *[F.col(f"__found.{c}").alias(c) for c in columns])
