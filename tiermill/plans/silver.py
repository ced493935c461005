"""Bronze to silver: one pure function per table, returning the stored columns without the audit column."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.functions import codes
from tiermill.functions.cleaning import (
    null_future_dates,
    numeric_default,
    reconcile_amounts,
    remove_chars,
    sentinel_timestamp,
    split_product_key,
    standardize_codes,
    strip_prefix,
    trim_columns,
    yyyymmdd_to_timestamp,
)
from tiermill.operators.conform import conform
from tiermill.operators.dedup import keep_first, require_key
from tiermill.operators.ordered import running_max_fill, version_end_date
from tiermill.plans.schemas import MEASURE, SILVER, with_measures


def _date_text(on_invalid: str) -> str:
    """Dates written as text have no default of their own for values that are none."""
    return "error" if on_invalid == "error" else "null"


def silver_customers(customers: DataFrame, on_invalid: str = "null") -> DataFrame:
    """One row per customer id: the one with the earliest create date, in text order.

    A create date that is none becomes NULL, or fails the job with ``on_invalid="error"``.
    """
    unique = keep_first(require_key(customers, "cst_id"), "cst_id", ["cst_create_date"])
    cleaned = trim_columns(unique, "cst_firstname", "cst_lastname").withColumns(
        {
            "cst_marital_status": standardize_codes("cst_marital_status", codes.MARITAL_STATUS),
            "cst_gndr": standardize_codes("cst_gndr", codes.GENDER),
            "cst_create_date": sentinel_timestamp("cst_create_date", codes.CREATE_DATE_DEFAULT, on_invalid=_date_text(on_invalid)),
        }
    )
    return conform(cleaned, SILVER["crm_cust_info"])


def silver_products(products: DataFrame, measure: str = MEASURE) -> DataFrame:
    """Product versions with filled start dates; the end date is the start of the next version.

    The end date of the extract plays no part in the result, so it is not read.
    """
    filled = running_max_fill(
        products.drop("prd_end_dt"), "prd_start_dt", "prd_id", default=codes.START_DATE_DEFAULT
    )
    category, key = split_product_key("prd_key")
    cleaned = filled.select(
        "prd_id",
        category.alias("cat_id"),
        key.alias("prd_key"),
        "prd_nm",
        numeric_default("prd_cost").alias("prd_cost"),
        standardize_codes("prd_line", codes.PRODUCT_LINE).alias("prd_line"),
        "prd_start_dt",
    )
    versions = version_end_date(cleaned, "prd_key", "prd_start_dt", "prd_end_dt", tiebreak=["prd_id"])
    dated = versions.withColumns({c: F.col(c).cast("date") for c in ("prd_start_dt", "prd_end_dt")})
    return conform(dated, with_measures(SILVER["crm_prd_info"], measure))


def silver_sales(sales: DataFrame, on_invalid: str = "null", measure: str = MEASURE) -> DataFrame:
    """Order lines with parsed dates and repaired amounts."""
    amount, price = reconcile_amounts("sls_sales", "sls_quantity", "sls_price")
    defaults = {
        "sls_order_dt": codes.ORDER_DATE_DEFAULT,
        "sls_ship_dt": codes.SHIP_DATE_DEFAULT,
        "sls_due_dt": codes.DUE_DATE_DEFAULT,
    }
    cleaned = sales.withColumns(
        {c: yyyymmdd_to_timestamp(c, default, on_invalid) for c, default in defaults.items()}
        | {"sls_sales": amount, "sls_price": price}
    )
    return conform(cleaned, with_measures(SILVER["crm_sales_details"], measure))


def silver_erp_customers(
    demographics: DataFrame,
    as_of: date | str | None = None,
    only_if_prefix: str | None = None,
    on_invalid: str = "null",
) -> DataFrame:
    """Birth date and gender per customer key, the key without its three-character prefix."""
    cleaned = demographics.select(
        strip_prefix("cid", only_if_prefix=only_if_prefix).alias("cid"),
        null_future_dates("bdate", as_of, _date_text(on_invalid)).alias("bdate"),
        standardize_codes("gen", codes.GENDER_WORDS).alias("gen"),
    )
    return conform(cleaned, SILVER["erp_cust_az12"])


def silver_locations(locations: DataFrame) -> DataFrame:
    """Country per customer key, the key without dashes."""
    cleaned = locations.select(
        remove_chars("cid").alias("cid"),
        standardize_codes("cntry", codes.COUNTRY, upper=False, passthrough=True).alias("cntry"),
    )
    return conform(cleaned, SILVER["erp_loc_a101"])


def silver_categories(categories: DataFrame) -> DataFrame:
    """Product categories, unchanged."""
    return conform(categories, SILVER["erp_px_cat_g1v2"])
