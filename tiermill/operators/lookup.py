"""Left joins from a table to its lookups.

A lookup that is too large to broadcast moves the table, and two of them one after the other move it twice, the second time
with the columns of the first. ``lookup_pair`` moves it once: partitions are the cells of a grid, with the hash of the first
key for the row and that of the second for the column. A row of the table goes to its one cell, a row of a lookup to all cells
of its grid row or column, so both joins find their matches where the row lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.operators.ordered import _bucket_values, _parts, _remaining

_MATCH = "__match"
_CELL = "__cell"

# Spark's own default for what it broadcasts; lookups below it are never dealt over a grid.
SMALL = 10 << 20

# Kinds of keys whose equal values have equal hashes.
_HASHED = ("bigint", "int", "string", "date")


def _require_unique(df: DataFrame, column: str) -> None:
    repeated = df.groupBy(column).count().filter((F.col("count") > 1) & F.col(column).isNotNull())
    if not repeated.isEmpty():
        raise ValueError(f"lookup column {column} is not unique")


def lookup_join(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, assert_unique: bool = False
) -> DataFrame:
    """Left outer join on one column; the right join column is dropped.

    A repeated right key multiplies left rows, as a plain join does; ``assert_unique`` raises instead. No
    broadcast hint is given: Spark compares the measured size of ``right`` with its broadcast threshold, and
    beyond it splits hot join keys of ``left`` at run time (adaptive skew join).
    """
    if assert_unique:
        _require_unique(right, right_on)
    keyed = right.withColumnRenamed(right_on, _MATCH)
    return left.join(keyed, F.col(left_on) == F.col(_MATCH), "left").drop(_MATCH)


def lookup_key(
    left: DataFrame,
    dimension: DataFrame,
    left_on: str,
    business_key: str,
    surrogate: str,
    assert_unique: bool = False,
) -> DataFrame:
    """Add the ``surrogate`` key of the dimension row whose ``business_key`` matches; NULL when none does."""
    return lookup_join(left, dimension.select(business_key, surrogate), left_on, business_key, assert_unique)


def lookup_pair(
    left: DataFrame,
    first: tuple[DataFrame, str, str],
    second: tuple[DataFrame, str, str],
    assert_unique: bool = False,
) -> DataFrame:
    """``lookup_join`` to two tables, each given with the column of ``left`` and its own column to join on.

    If both are too large to broadcast, ``left`` is moved once instead of twice. Rows of a hot key are then spread by the
    other key, and rows whose key is NULL by all of their columns.
    """
    lookups = (first, second)
    if assert_unique:
        for right, _, right_on in lookups:
            _require_unique(right, right_on)
    kinds = dict(left.dtypes)
    alike = all(kinds[on] in _HASHED and kinds[on] == dict(right.dtypes)[key] for right, on, key in lookups)
    sizes = [_estimated_bytes(right) for right, _, _ in lookups]
    small = max(_broadcast_bytes(left), SMALL)
    if alike and min(sizes) > small:
        return _over_grid(left, lookups, sizes)
    if sizes[0] <= small < sizes[1]:
        # rows are moved before the columns of the small one make them wide
        joined = lookup_join(lookup_join(left, *second), *first)
        return joined.select(*left.columns, *[c for right, _, key in lookups for c in right.columns if c != key])
    return lookup_join(lookup_join(left, *first), *second)


def _estimated_bytes(df: DataFrame) -> int:
    """What Spark takes for the size of a table before it has run; it decides on broadcasts by it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _broadcast_bytes(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _sides(cells: int, sizes: list[int]) -> tuple[int, int]:
    """Rows and columns of the grid that repeat the least of both lookups."""
    rows = min(range(1, cells + 1), key=lambda n: sizes[0] * (cells // n) + sizes[1] * n)
    return rows, cells // rows


def _over_grid(left: DataFrame, lookups: tuple[tuple[DataFrame, str, str], ...], sizes: list[int]) -> DataFrame:
    parts = _parts(left)
    rows, columns = _sides(parts, sizes)
    # numbers that Spark's hash deals to one partition each
    values = F.array(*[F.lit(v) for v in _bucket_values(left.sparkSession, parts)])
    cell = lambda row, column: F.element_at(values, (row * columns + column + 1).cast("int"))
    place = lambda key, count: F.pmod(F.xxhash64(key), F.lit(count))
    own = F.xxhash64(*[f"`{c}`" for c in _remaining(left, ())])

    def spread(key: str, count: int) -> Column:
        return F.when(F.col(key).isNull(), F.pmod(own, F.lit(count))).otherwise(place(key, count))

    (_, first_on, _), (_, second_on, _) = lookups
    joined = left.withColumn(_CELL, cell(spread(first_on, rows), spread(second_on, columns))).repartition(parts, _CELL)
    for i, (right, left_on, right_on) in enumerate(lookups):
        match, there = f"{_MATCH}{i}", f"{_CELL}{i}"
        if i == 0:
            cells = F.transform(F.sequence(F.lit(0), F.lit(columns - 1)), lambda n: cell(place(match, rows), n))
        else:
            cells = F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda n: cell(n, place(match, columns)))
        known = right.withColumnRenamed(right_on, match).filter(F.col(match).isNotNull())
        dealt = known.withColumn(there, F.explode(cells)).repartition(parts, there)
        joined = joined.join(dealt, (F.col(_CELL) == F.col(there)) & (F.col(left_on) == F.col(match)), "left").drop(match, there)
    return joined.drop(_CELL)
