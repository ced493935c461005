"""Cleaning rules as Column expressions; all of them stay inside Catalyst."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.functions.codes import MISSING_DATE_TEXTS, UNKNOWN


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _check_choice(name: str, value: str, allowed: Sequence[str]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}, not {value!r}")


def standardize_codes(
    value: Column | str,
    codes: Mapping[str, str],
    default: str = UNKNOWN,
    upper: bool = True,
    passthrough: bool = False,
) -> Column:
    """Map a short code to its label.

    The text is trimmed (and upper-cased unless ``upper`` is off) before the lookup. Codes not in the map
    become ``default``; with ``passthrough`` only blank and NULL do, other texts keep their trimmed form.
    """
    text = F.trim(_column(value))
    code = F.upper(text) if upper else text
    by_label: dict[str, list[str]] = {}
    for source, label in codes.items():
        by_label.setdefault(label, []).append(source)
    mapped = None
    for label, sources in by_label.items():
        hit = code.isin(sources)
        mapped = F.when(hit, label) if mapped is None else mapped.when(hit, label)
    if not passthrough:
        return F.lit(default) if mapped is None else mapped.otherwise(default)
    blank = text.isNull() | (text == "")
    mapped = F.when(blank, default) if mapped is None else mapped.when(blank, default)
    return mapped.otherwise(text)


def trim_columns(df: DataFrame, *names: str) -> DataFrame:
    """Remove leading and trailing spaces (only spaces) from the named columns."""
    return df.withColumns({name: F.trim(F.col(name)) for name in names})


def sentinel_timestamp(
    value: Column | str,
    default: str,
    sentinels: Sequence[str] = MISSING_DATE_TEXTS,
    on_invalid: str = "null",
) -> Column:
    """Parse a text date, with or without time of day; sentinel texts give ``default``, NULL stays NULL."""
    _check_choice("on_invalid", on_invalid, ("null", "error"))
    text = _column(value)
    parsed = text.try_cast("timestamp_ntz")
    if on_invalid == "error":
        parsed = F.when(
            text.isNotNull() & parsed.isNull(),
            F.raise_error(F.concat(F.lit("not a timestamp: "), text)),
        ).otherwise(parsed)
    return F.when(text.isin(list(sentinels)), F.lit(default).cast("timestamp_ntz")).otherwise(parsed)


def split_product_key(value: Column | str) -> tuple[Column, Column]:
    """Split a composite code into (category id, product key).

    The first five characters are the category, with ``-`` turned into ``_``; the product key starts at the
    seventh character.
    """
    text = _column(value)
    category = F.replace(F.substring(text, 1, 5), F.lit("-"), F.lit("_"))
    return category, F.substr(text, F.lit(7))


def numeric_default(value: Column | str, default: float | Decimal = 0) -> Column:
    """Replace NaN and NULL; decimals stay decimals."""
    number = _column(value)
    return F.coalesce(F.when(~F.isnan(number.cast("double")), number), F.lit(default))


def yyyymmdd_to_timestamp(value: Column | str, default: str, on_invalid: str = "null") -> Column:
    """Turn a ``YYYYMMDD`` number into a timestamp.

    A number whose text is not eight characters long (zero, NaN, fractions included) gives ``default`` and
    NULL stays NULL. Eight characters that are no calendar date follow ``on_invalid``: ``null``, ``default``
    or ``error``. The date is built by arithmetic, without a text round trip.
    """
    _check_choice("on_invalid", on_invalid, ("null", "default", "error"))
    number = _column(value)
    fallback = F.lit(default).cast("timestamp_ntz")
    digits = number.try_cast("int")
    eight_long = (digits == number) & (F.length(digits.cast("string")) == 8)
    month = (F.call_function("div", digits, F.lit(100)) % 100).cast("int")
    day = (digits % 100).cast("int")
    zero = F.lit(0)
    # the range test spares most impossible dates the exception that try_make_timestamp_ntz has to catch
    parsed = F.when(
        (digits > 0) & month.between(1, 12) & day.between(1, 31),
        F.try_make_timestamp_ntz(
            F.call_function("div", digits, F.lit(10000)).cast("int"), month, day, zero, zero, zero
        ),
    )
    if on_invalid == "default":
        parsed = F.coalesce(parsed, fallback)
    elif on_invalid == "error":
        parsed = F.when(
            parsed.isNull(),
            F.raise_error(F.concat(F.lit("not a calendar date: "), digits.cast("string"))),
        ).otherwise(parsed)
    return F.when(eight_long, parsed).when(number.isNotNull(), fallback)


def reconcile_amounts(
    sales: Column | str, quantity: Column | str, price: Column | str
) -> tuple[Column, Column]:
    """Repair (sales, price) of one order line; both results read the original values.

    Sales that are NULL, not positive or different from quantity times absolute price are recomputed; a NULL
    price makes the comparison unknown, so positive sales stay. A price that is NULL or not positive becomes
    original sales over quantity, NULL for quantity zero.
    """
    sales, quantity, price = _column(sales), _column(quantity), _column(price)
    expected = quantity * F.abs(price)
    fixed_sales = F.when(sales.isNull() | (sales <= 0) | (sales != expected), expected).otherwise(sales)
    fixed_price = F.when(price.isNull() | (price <= 0), F.try_divide(sales, quantity)).otherwise(price)
    return fixed_sales, fixed_price


def strip_prefix(
    value: Column | str, length: int = 3, longer_than: int = 4, only_if_prefix: str | None = None
) -> Column:
    """Drop the first ``length`` characters of texts longer than ``longer_than``.

    The characters are dropped whatever they are, unless ``only_if_prefix`` names the text they must be.
    """
    text = _column(value)
    applies = F.length(text) > longer_than
    if only_if_prefix is not None:
        applies = applies & text.startswith(only_if_prefix)
    return F.when(applies, F.substr(text, F.lit(length + 1))).otherwise(text)


def null_future_dates(
    value: Column | str, as_of: date | str | None = None, on_invalid: str = "null"
) -> Column:
    """Parse a date and blank it out when it lies after ``as_of`` (today when not given).

    A text that is no date becomes NULL, or fails the job with ``on_invalid="error"``.
    """
    _check_choice("on_invalid", on_invalid, ("null", "error"))
    text = _column(value)
    day = text.try_cast("date")
    if on_invalid == "error":
        wrong = F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date")
        day = F.when(text.isNotNull() & day.isNull(), wrong).otherwise(day)
    limit = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return F.when(day <= limit, day)


def remove_chars(value: Column | str, chars: str = "-") -> Column:
    """Remove every occurrence of each character in ``chars``."""
    text = _column(value)
    for char in chars:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def prefer_master(master: Column | str, fallback: Column | str, unknown: str = UNKNOWN) -> Column:
    """Take the master value unless it is unknown or NULL, then the fallback, then ``unknown``."""
    master = _column(master)
    return F.when(master != unknown, master).otherwise(F.coalesce(_column(fallback), F.lit(unknown)))
