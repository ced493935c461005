"""Data-quality checks. Each returns its violations as a DataFrame; an empty one means the check passed.

Whole numbers that fill their range well, as surrogate keys do, are checked by bitmaps: a bitmap covers 32,768 neighbouring
numbers with a bit each, tasks set the bits of what they read, and only these bitmaps are shuffled, a bit a key at best. They
decide exactly whether keys repeat, and whether a dimension lacks keys of a fact. Only where they say so are keys
themselves grouped or joined, to tell which.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.operators.conform import WHOLE_NUMBERS
from tiermill.sources.scratch import Stored, materialize

# Numbers in the range of a key, per key, up to which bitmaps are smaller than the keys themselves.
SPARSEST = 64


def unique_not_null(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, and NULL even when only one row has it."""
    copies = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return copies.filter((F.col("copies") > 1) | F.col(key).isNull())


def in_domain(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Distinct values outside ``domain``; NULL counts as one. The filter reaches the scan."""
    outside = F.col(column).isNull() | ~F.col(column).isin(list(domain))
    return df.filter(outside).select(column).distinct()


def non_negative(df: DataFrame, column: str, *show: str) -> DataFrame:
    """Rows whose value is NULL or below zero, with the columns in ``show``."""
    return df.filter(F.col(column).isNull() | (F.col(column) < 0)).select(*show, column)


def valid_date_int(df: DataFrame, column: str, bounds: tuple[int, int], *show: str) -> DataFrame:
    """Rows whose ``YYYYMMDD`` number lies outside ``bounds``; NULL passes.

    Both bounds have eight digits, so every number between them is positive and eight digits long, and the two
    comparisons cover sign and length as well. Zero is shown as NULL.
    """
    return df.filter(_outside(column, bounds)).select(*show, F.nullif(F.col(column), F.lit(0)).alias(column))


def _outside(column: str, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    if not 10_000_000 <= low <= high <= 99_999_999:
        raise ValueError(f"bounds must be ascending numbers of eight digits, not {bounds!r}")
    return (F.col(column) < low) | (F.col(column) > high)


def unparsed(df: DataFrame, column: str, parsed: Column, *show: str) -> DataFrame:
    """Rows whose value is there but gives NULL when it is parsed, with the columns in ``show``."""
    return df.filter(F.col(column).isNotNull() & parsed.isNull()).select(*show, column)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that several rows have; NULL does not count. A lookup by such a key multiplies rows."""
    copies = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return copies.filter("copies > 1")


def row_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with both sizes when ``left`` and ``right`` differ in their number of rows, else none."""
    one, none = F.lit(1), F.lit(0)
    rows = left.select(one.alias("l"), none.alias("r")).unionAll(right.select(none.alias("l"), one.alias("r")))
    size = lambda side: F.coalesce(F.sum(side), F.lit(0).cast("long"))
    return rows.agg(size("l").alias("left_rows"), size("r").alias("right_rows")).filter("left_rows <> right_rows")


def orphan_keys(
    fact: DataFrame, dimensions: Mapping[str, tuple[DataFrame, str]], strict: bool = False
) -> DataFrame:
    """Key combinations of fact rows that miss a dimension, with the number of rows.

    ``dimensions`` maps a fact column to (dimension, key column). A combination is reported when a key is NULL
    or it repeats; with ``strict`` also when it stands alone.

    Which parts of a dimension's range of keys lack keys of the fact is told by bitmaps. If none does, no key of the fact is
    shuffled, and the fact is only read for rows without a key. The keys that miss their dimension are found from
    those parts, and stored: seldom more than a few, so that Spark sees their size and need not move the fact to find its
    rows. Only rows with a missing key are then counted per combination.
    """
    keys = list(dimensions)
    orphans = fact.select(*keys)
    unmatched = [F.col(k).isNull() for k in keys]
    for i, (column, (dimension, key)) in enumerate(dimensions.items()):
        known = dimension.select(F.col(key).alias("__known")).filter("__known is not null")
        lost = fact.select(F.col(column).alias(f"__lost{i}")).filter(F.col(f"__lost{i}").isNotNull())
        part = _lacking_parts(lost, f"__lost{i}", known)
        if part is not None:
            bucket, parts = part
            if not parts.rows:
                continue
            lost = lost.join(parts.df, bucket.eqNullSafe(F.col("__bucket")), "left_semi")
        lost = lost.distinct().join(known, F.col(f"__lost{i}") == F.col("__known"), "left_anti")
        lost = materialize(lost, "unmatched").df
        orphans = orphans.join(lost, F.col(column) == F.col(f"__lost{i}"), "left")
        unmatched.append(F.col(f"__lost{i}").isNotNull())
    orphans = orphans.filter(reduce(lambda a, b: a | b, unmatched))
    pairs = orphans.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    for i, (column, (dimension, key)) in enumerate(dimensions.items()):
        # matches, not rows: a repeated dimension key must not multiply the intermediate result
        found = dimension.groupBy(F.col(key).alias(f"__key{i}")).agg(F.count(F.lit(1)).alias(f"__rows{i}"))
        pairs = pairs.join(found.filter(f"__rows{i} > 1"), pairs[column] == found[f"__key{i}"], "left")
    multiplied = reduce(
        lambda n, i: n * F.coalesce(F.col(f"__rows{i}"), F.lit(1)), range(len(keys)), F.col("copies")
    )
    pairs = pairs.select(*keys, multiplied.alias("copies"))
    if strict:
        return pairs
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return pairs.filter((F.col("copies") > 1) | null_key)


def _fills(least: int | None, most: int | None, rows: int) -> bool:
    """Whether bitmaps over this range are worth it."""
    return rows > 0 and most - least < SPARSEST * rows


def _lacking_parts(wanted: DataFrame, column: str, known: DataFrame) -> tuple[Column, Stored] | None:
    """The parts of the range of ``__known`` with numbers of ``column`` that it lacks; None if bitmaps do not suit it.

    Numbers outside the range, of which there could be any, are one part: NULL.
    """
    if dict(wanted.dtypes)[column] not in WHOLE_NUMBERS or dict(known.dtypes)["__known"] not in WHOLE_NUMBERS:
        return None
    least, most, rows = known.agg(F.min("__known"), F.max("__known"), F.count("__known")).first()
    if not _fills(least, most, rows):
        return None
    inside = F.col(column).between(least, most)
    bucket = F.when(inside, F.bitmap_bucket_number(F.col(column)))
    mine = wanted.select(bucket.alias("__bucket"), F.when(inside, F.bitmap_bit_position(F.col(column))).alias("__bit"), F.lit(False).alias("__in"))
    theirs = known.select(
        F.bitmap_bucket_number(F.col("__known")).alias("__bucket"), F.bitmap_bit_position(F.col("__known")).alias("__bit"), F.lit(True).alias("__in")
    )
    bits = lambda bit: F.bitmap_count(F.bitmap_construct_agg(bit))
    counted = mine.unionByName(theirs).groupBy("__bucket").agg(bits(F.col("__bit")).alias("all"), bits(F.when(F.col("__in"), F.col("__bit"))).alias("held"))
    lacking = counted.filter(F.col("__bucket").isNull() | (F.col("all") > F.col("held"))).select("__bucket")
    return bucket, materialize(lacking, "lacking")


@dataclass(frozen=True)
class Check:
    """A named check on one table.

    A check of single rows or values also tells how to count its violations in one aggregate over ``rows``; all such
    checks of one table share a scan. A check that ``key`` is unique shares it, too, as far as the range of the key goes;
    NULL is a violation with ``not_null``. ``same_rows`` is a table that must have as many rows.
    """

    name: str
    table: str
    violations: DataFrame | None = None
    rows: DataFrame | None = None
    count: Column | None = None
    key: str | None = None
    not_null: bool = False
    same_rows: DataFrame | None = None


def rows_where(condition: Column) -> Column:
    """Number of rows for which the condition holds."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def values_outside(column: str, domain: Sequence[str]) -> Column:
    """Number of distinct values outside ``domain``; NULL counts as one."""
    value = F.col(column)
    outside = F.when(~value.isin(list(domain)), value)
    return F.count_distinct(outside) + F.max(F.when(value.isNull(), 1).otherwise(0))


def missing_or_negative(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) < 0)


def outside_dates(column: str, bounds: tuple[int, int]) -> Column:
    return _outside(column, bounds)


def _summaries(checks: Sequence[Check]) -> dict[str, dict]:
    """One row per table: what its checks count in a single scan, the ranges of its keys, its number of rows."""
    asked: dict[int, tuple[DataFrame, dict[str, Column]]] = {}
    for i, check in enumerate(checks):
        if check.rows is not None:
            own = asked.setdefault(id(check.rows), (check.rows, {}))[1]
            if check.count is not None:
                own[f"n{i}"] = check.count.cast("long")
            if check.key is not None:
                whole = dict(check.rows.dtypes)[check.key] in WHOLE_NUMBERS
                own[f"n{i}"] = F.count(check.key)
                own[f"least{i}"], own[f"most{i}"] = [f(check.key).cast("long") if whole else F.lit(None).cast("long") for f in (F.min, F.max)]
        if check.same_rows is not None:
            asked.setdefault(id(check.same_rows), (check.same_rows, {}))
    if not asked:
        return {}
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows"), *[column.alias(name) for name, column in own.items()]).select(
            F.lit(str(table)).alias("table"), F.to_json(F.struct("rows", *own), {"ignoreNullFields": "false"}).alias("found")
        )
        for table, (df, own) in asked.items()
    ]
    return {row["table"]: json.loads(row["found"]) for row in reduce(DataFrame.unionByName, parts).collect()}  # a row per table


def _distinct(df: DataFrame, key: str) -> DataFrame:
    """Number of distinct values of a key that fills its range, NULL apart."""
    buckets = df.filter(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(F.col(key)))
    counted = buckets.agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key)))).alias("n"))
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def dq_report(checks: Sequence[Check]) -> DataFrame:
    """One row per check: (check, table, violations, passed). All checks run, none stops the others.

    One scan per table counts what can be counted in one aggregate. Keys are then checked side by side: by bitmaps if they fill
    their range, else per key; keys are grouped after bitmaps only if some repeat.
    """
    summaries = _summaries(checks)
    found: dict[int, int] = {}
    counts: dict[int, DataFrame] = {}
    bitmaps: dict[int, tuple[int, int]] = {}  # rows with a key, rows without
    for i, check in enumerate(checks):
        own = summaries.get(str(id(check.rows)), {})
        if check.count is not None:
            found[i] = own[f"n{i}"] or 0
        elif check.same_rows is not None:
            found[i] = int(own["rows"] != summaries[str(id(check.same_rows))]["rows"])
        elif check.key is not None and own[f"least{i}"] is not None and _fills(own[f"least{i}"], own[f"most{i}"], own[f"n{i}"]):
            bitmaps[i] = own[f"n{i}"], own["rows"] - own[f"n{i}"]
            counts[i] = _distinct(check.rows, check.key)
        else:
            counts[i] = _exact(check)
    seen = _counted(counts)
    again = {}
    for i, n in seen.items():
        if i not in bitmaps:
            found[i] = n
        elif n == bitmaps[i][0]:
            found[i] = int(checks[i].not_null and bitmaps[i][1] > 0)
        else:
            again[i] = _exact(checks[i])
    found |= _counted(again)
    spark = next(df for check in checks for df in (check.rows, check.violations) if df is not None).sparkSession
    rows = [(check.name, check.table, found[i], found[i] == 0) for i, check in enumerate(checks)]
    return spark.createDataFrame(rows, "check string, table string, violations bigint, passed boolean")


def _exact(check: Check) -> DataFrame:
    violations = check.violations
    if violations is None:
        violations = unique_not_null(check.rows, check.key) if check.not_null else repeated_keys(check.rows, check.key)
    return violations.agg(F.count(F.lit(1)).alias("violations"))


def _counted(counts: Mapping[int, DataFrame]) -> dict[int, int]:
    """Numbers that some aggregates give, all in one job."""
    if not counts:
        return {}
    parts = [df.select(F.lit(i).alias("i"), F.col("violations").cast("long").alias("n")) for i, df in counts.items()]
    return {row["i"]: row["n"] for row in reduce(DataFrame.unionByName, parts).collect()}


def enforce(report: DataFrame) -> None:
    """Raise when a check of the report failed, naming all that did."""
    failed = report.filter(~F.col("passed")).orderBy("check").collect()
    if failed:
        raise ValueError(
            "data-quality checks failed: "
            + ", ".join(f"{r['check']} on {r['table']} ({r['violations']})" for r in failed)
        )
