"""Session settings the operators count on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# A value that does not convert has to fail the job, not turn into NULL.
CONVERSION = {"spark.sql.ansi.enabled": "true"}

# Joins and aggregations are re-planned from measured sizes: a small side is broadcast, a hot join key is
# split over several tasks (also where that costs one more shuffle), small partitions are merged. Before
# anything is measured a scan counts as four times its compressed files, so that only tables that are small
# even unpacked are broadcast on the estimate. Two tables dealt by one column stay where they are when they are
# joined on that column and others (the grid of ``lookup_pair``).
ADAPTIVE = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# The JVM does not compile methods beyond 8000 bytes; wide cleaning projections that would get there are
# generated operator by operator instead.
CODE = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply all of the above to this session."""
    for name, value in {**CONVERSION, **ADAPTIVE, **CODE}.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def settings(spark: SparkSession) -> Iterator[SparkSession]:
    """Apply all of the above inside the block and put the caller's values back after it."""
    names = [*CONVERSION, *ADAPTIVE, *CODE]
    before = {name: spark.conf.get(name, None) for name in names}
    apply_settings(spark)
    try:
        yield spark
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
