"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def keep_first(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: Sequence[str],
    keep: str = "first",
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the first (or last) row of every key in ascending order, NULLs last.

    Rows equal in ``order_by`` are told apart by ``tiebreak``, by default all remaining columns, so the
    survivor never depends on how the data is split. Spark limits each key to one row per task before the
    shuffle, so a key with many copies does not pile up in one task.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first or last, not {keep!r}")
    keys = [key] if isinstance(key, str) else list(key)
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys and c not in order_by]
    ordering = [*order_by, *tiebreak]
    if keep == "first":
        sort = [F.col(c).asc_nulls_last() for c in ordering]
    else:
        sort = [F.col(c).desc_nulls_first() for c in ordering]
    window = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def require_key(df: DataFrame, *keys: str, on_null: str = "drop") -> DataFrame:
    """Drop rows with a NULL in a key column, or fail the job on the first one."""
    if on_null not in ("drop", "fail"):
        raise ValueError(f"on_null must be drop or fail, not {on_null!r}")
    for key in keys:
        present = F.col(key).isNotNull()
        if on_null == "fail":
            present = F.when(present, True).otherwise(
                F.raise_error(F.lit(f"NULL in key column {key}")).cast("boolean")
            )
        df = df.filter(present)
    return df
