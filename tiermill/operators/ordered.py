"""Operators that need one order over a whole table: row numbers, running maximum, next version.

A window without partition columns (or with one hot partition) sends everything to one task. Here Spark's own
sort deals the rows over partitions by ranges of a total order:

1. The input is written once to scratch, so that sampling, sorting and repeated tasks see the same rows.
2. The rows are sorted by the order asked for, then by all remaining columns, then by their place in the stored input. Only
   exact copies are told apart by the place, so which of them gets which key makes no difference, and they are
   spread like any other rows.
3. The sorted rows are written with the number of their partition and their number in it.
4. What earlier or later partitions contribute comes from a table with one row per partition, hence its broadcast.

Where rows of a partition are looked at together again (running maximum), each partition is written as one bucket of a bucketed
table, so that Spark knows it when it reads the files: the window runs on them as they lie, without another exchange.

Versions of one key need no order over the table. They meet by an exchange on the key; only keys with more rows than a
task's fair share, marked by a sketch beforehand, are dealt by ranges as above.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiermill.sources.scratch import materialize, scratch_path

_PART = "__part"
_ROW = "__row"
_PLACE = "__place"
_BUCKET = "__bucket"

# monotonically_increasing_id keeps the row's place within its partition in the lower 33 bits
_ROW_IN_PARTITION = (1 << 33) - 1

_UNORDERED = ("map", "variant", "interval")


def _remaining(df: DataFrame, used: Sequence[str]) -> list[str]:
    """Columns that can break ties."""
    return [n for n, kind in df.dtypes if n not in used and not any(word in kind for word in _UNORDERED)]


def _parts(df: DataFrame) -> int:
    """Number of ranges: that of shuffle partitions, whatever the size of the table."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sorted_rows(df: DataFrame, order: Sequence[Column], used: Sequence[str], label: str) -> DataFrame:
    """The rows sorted by ranges, not yet stored, with the number of their partition and their number in it."""
    stored = materialize(df, label).df.withColumn(_PLACE, F.monotonically_increasing_id())
    ties = [F.asc_nulls_last(f"`{c}`") for c in _remaining(df, used)]
    total = [*order, *ties, F.asc(_PLACE)]
    ordered = stored.repartitionByRange(_parts(df), *total).sortWithinPartitions(*total).drop(_PLACE)
    return ordered.select(
        "*",
        F.spark_partition_id().alias(_PART),
        F.monotonically_increasing_id().bitwiseAND(_ROW_IN_PARTITION).alias(_ROW),
    )


def _lay_out(df: DataFrame, order: Sequence[Column], used: Sequence[str], label: str) -> DataFrame:
    """The rows in scratch, with the number of their sorted partition and their number in it."""
    return materialize(_sorted_rows(df, order, used, label), f"{label}-ordered").df


@lru_cache(8)
def _bucket_values(spark: SparkSession, buckets: int) -> tuple[int, ...]:
    """For each bucket a number that Spark puts into it."""
    found: dict[int, int] = {}
    tried = 0
    while len(found) < buckets:
        some = spark.range(tried, tried + 16 * buckets, 1, 1).select(F.col("id").cast("int").alias("value"))
        placed = some.select("value", F.pmod(F.hash("value"), F.lit(buckets)).alias("bucket"))
        found = {r["bucket"]: r["least"] for r in placed.groupBy("bucket").agg(F.min("value").alias("least")).collect()} | found
        tried += 16 * buckets
    return tuple(found[i] for i in range(buckets))


def _lay_out_in_buckets(df: DataFrame, order: Sequence[Column], used: Sequence[str], label: str) -> DataFrame:
    """As ``_lay_out``, each sorted partition as one bucket by ``_BUCKET``, which a window over it reads where it lies.

    A bucketed table is only known by name, so it has one in the current database until it is resolved.
    """
    spark, buckets = df.sparkSession, _parts(df)
    values = F.array(*[F.lit(v) for v in _bucket_values(spark, buckets)])
    rows = _sorted_rows(df, order, used, label)
    placed = rows.withColumn(_BUCKET, F.element_at(values, F.col(_PART) + 1))
    path, name = scratch_path(spark, f"{label}-buckets"), f"tiermill_{uuid.uuid4().hex}"
    try:
        placed.write.bucketBy(buckets, _BUCKET).sortBy(_ROW).option("path", path).saveAsTable(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay: they are scratch


def _per_part(rows: DataFrame, over: Callable[[], Column], name: str, **aggregates: Column) -> DataFrame:
    """One row per partition: its number and what ``over`` makes of the aggregates of other partitions."""
    summary = rows.groupBy(_PART).agg(*[column.alias(f"__{key}") for key, column in aggregates.items()])
    return summary.select(_PART, over().alias(name))


def _within_part():
    """The rows of one sorted partition, which are those of one bucket, in their order."""
    return Window.partitionBy(_BUCKET).orderBy(_ROW)


def _earlier_parts():
    return Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)


def surrogate_key(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Prepend a dense key 1..n in ascending order of ``order_by``, NULLs last; all other columns break ties."""
    rows = _lay_out(df, [F.asc_nulls_last(c) for c in order_by], order_by, name)
    before = _per_part(rows, lambda: F.sum("__size").over(_earlier_parts()), "__before", size=F.count(F.lit(1)))
    keyed = rows.join(F.broadcast(before), _PART)
    key = F.col(_ROW) + 1 + F.coalesce("__before", F.lit(0))
    return keyed.withColumn(name, key).select(name, *[c for c in df.columns if c != name])


def version_end_date(
    df: DataFrame, key: str, start: str, name: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Add the start of the next version of the same key; NULL for the last one.

    Versions of one key are ordered by ``start`` (NULLs last), then ``tiebreak``, then all other columns. A key with
    more rows than a task's fair share is spread over many tasks.
    """
    used = [key, start, *tiebreak]
    order = [F.asc_nulls_last(f"`{c}`") for c in [*used[1:], *_remaining(df, used)]]
    window = Window.partitionBy(key).orderBy(*order)
    columns = list(dict.fromkeys([*df.columns, name]))
    follow = lambda rows: rows.withColumn(name, F.lead(start).over(window)).select(*columns)
    heavy = _heavy_keys(df, key)
    if not heavy:
        return follow(df)
    marked = F.xxhash64(key).isin(heavy)
    return follow(df.filter(~marked)).unionByName(_ranged_versions(df.filter(marked), key, start, name, used))


def _heavy_keys(df: DataFrame, key: str) -> list[int]:
    """Hashes of the keys with more rows than a fair share of a task; there are fewer of them than tasks.

    Estimates: a key marked or left out wrongly is treated the other way, with the same result.
    """
    parts = _parts(df)
    hashed = df.select(F.xxhash64(key).alias("key"))
    most = min(parts, 50_000)
    seen = hashed.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(key, {most}, {max(1024, 16 * most)})").alias("top")).first()
    return [item["item"] for item in seen["top"] or [] if item["count"] * parts > seen["rows"]]


def _ranged_versions(df: DataFrame, key: str, start: str, name: str, used: Sequence[str]) -> DataFrame:
    """Sorted partitions run across keys, so the versions of one hot key are spread over many tasks."""
    rows = _lay_out_in_buckets(df, [F.asc_nulls_last(c) for c in used], used, name)
    version = F.struct(F.col(key).alias("key"), F.col(start).alias("start"))
    # the last row of a partition is followed by the first row of the next one
    heads = _per_part(
        rows,
        lambda: F.lead("__head").over(Window.orderBy(_PART)),
        "__after",
        head=F.min_by(version, F.col(_ROW)),
    )
    following = rows.join(F.broadcast(heads), _PART).withColumn("__next", F.lead(version).over(_within_part()))
    following = following.withColumn("__next", F.coalesce("__next", "__after"))
    end = F.when(F.col("__next.key").eqNullSafe(F.col(key)), F.col("__next.start"))
    return following.withColumn(name, end).select(*dict.fromkeys([*df.columns, name]))


def running_max_fill(
    df: DataFrame,
    value: str,
    order_by: str,
    default: str | None = None,
    invalid: Sequence[str] = ("NaN",),
) -> DataFrame:
    """Replace ``value`` by the largest valid value seen so far in ascending order of ``order_by``.

    NULL and the ``invalid`` texts do not count; rows before the first valid value get ``default``. Rows equal
    in ``order_by`` are taken in ascending order of the value, missing ones first, then by all other columns.
    """
    usable = F.when(F.col(value).isNotNull() & ~F.col(value).isin(list(invalid)), F.col(value))
    order = [F.asc_nulls_last(order_by), usable.asc_nulls_first()]
    rows = _lay_out_in_buckets(df, order, [order_by], "running-max")
    carried = _per_part(rows, lambda: F.max("__best").over(_earlier_parts()), "__carried", best=F.max(usable))
    so_far = F.max(usable).over(_within_part().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = rows.join(F.broadcast(carried), _PART).withColumn("__filled", F.greatest(so_far, F.col("__carried")))
    if default is not None:
        filled = filled.withColumn("__filled", F.coalesce("__filled", F.lit(default)))
    return filled.withColumn(value, F.col("__filled")).select(*df.columns)
