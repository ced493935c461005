"""Conversion to a stored table's column types, the audit column, and the non-empty gate."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_COLUMN = "dwh_create_date"

WHOLE_NUMBERS = ("bigint", "int")


def _convert(name: str, source: str, target: str, strict: bool) -> Column:
    column = F.col(f"`{name}`")
    if source == target:
        return column
    if source == "string" and target in WHOLE_NUMBERS:
        return _whole_number(column, target, strict).alias(name)
    return (column.cast(target) if strict else column.try_cast(target)).alias(name)


def _whole_number(text: Column, target: str, strict: bool) -> Column:
    """Whole number from text that may carry a trailing ``.0``, as exports of nullable numbers do.

    The text decides, not a number made of it: any other fraction, however small, is no whole number.
    """
    digits = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)(?:\.0*)?\s*$", 1)
    whole = F.when(digits != "", digits.try_cast(target))
    if not strict:
        return whole
    wrong = F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast(target)
    return F.when(text.isNotNull() & whole.isNull(), wrong).otherwise(whole)


def conform(df: DataFrame, columns: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Select exactly ``columns`` (name to type) in order, casting what differs.

    A value that does not convert fails the job; with ``strict`` off it becomes NULL.
    """
    types = dict(df.dtypes)
    return df.select([_convert(name, types[name], target, strict) for name, target in columns.items()])


def stamp(df: DataFrame, run_ts: datetime | str, column: str = AUDIT_COLUMN) -> DataFrame:
    """Add the load time, one constant per run."""
    return df.withColumn(column, F.lit(str(run_ts)).cast("timestamp_ntz"))


def require_non_empty(df: DataFrame, name: str) -> DataFrame:
    """Return ``df``, or raise when it has no row; reads at most one row of one partition at a time."""
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df
