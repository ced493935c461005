"""The quality checks of the stored layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.functions import codes
from tiermill.functions.cleaning import sentinel_timestamp, yyyymmdd_to_timestamp
from tiermill.operators.quality import (
    Check,
    missing_or_negative,
    orphan_keys,
    outside_dates,
    rows_where,
    values_outside,
)


def parsed_dates() -> dict[str, tuple[str, str, Column]]:
    """Per check: bronze table, column and its parsed value; NULL where the value is no date."""
    numbers = {"order": codes.ORDER_DATE_DEFAULT, "ship": codes.SHIP_DATE_DEFAULT, "due": codes.DUE_DATE_DEFAULT}
    found = {
        f"{name}_date_parses": (
            "crm_sales_details",
            f"sls_{name}_dt",
            yyyymmdd_to_timestamp(f"sls_{name}_dt", default),
        )
        for name, default in numbers.items()
    }
    created = sentinel_timestamp("cst_create_date", codes.CREATE_DATE_DEFAULT)
    found["create_date_parses"] = ("crm_cust_info", "cst_create_date", created)
    found["birth_date_parses"] = ("erp_cust_az12", "bdate", F.col("bdate").try_cast("date"))
    return found


def lookup_keys() -> dict[str, tuple[str, str, str]]:
    """Per check: layer, table and column that a lookup takes to be unique."""
    return {
        "demographics_lookup_unique": ("silver", "erp_cust_az12", "cid"),
        "location_lookup_unique": ("silver", "erp_loc_a101", "cid"),
        "category_lookup_unique": ("silver", "erp_px_cat_g1v2", "id"),
        "customer_lookup_unique": ("gold", "dim_customers", "customer_id"),
        "product_lookup_unique": ("gold", "dim_products", "product_number"),
    }


def store_checks(read: Callable[[str, str], DataFrame]) -> list[Check]:
    """Checks over the tables that ``read(layer, table)`` returns."""
    tables: dict[tuple[str, str], DataFrame] = {}

    def table(layer: str, name: str) -> DataFrame:
        if (layer, name) not in tables:
            tables[layer, name] = read(layer, name)
        return tables[layer, name]

    def rows(check: str, layer: str, name: str, count: Column) -> Check:
        return Check(check, f"{layer}.{name}", rows=table(layer, name), count=count)

    def key(check: str, layer: str, name: str, column: str, not_null: bool = False) -> Check:
        return Check(check, f"{layer}.{name}", rows=table(layer, name), key=column, not_null=not_null)

    dimensions = {
        "customer_key": (table("gold", "dim_customers"), "customer_key"),
        "product_key": (table("gold", "dim_products"), "product_key"),
    }
    sales = table("silver", "crm_sales_details")
    return [
        key("customer_id_unique", "silver", "crm_cust_info", "cst_id", not_null=True),
        key("product_id_unique", "silver", "crm_prd_info", "prd_id", not_null=True),
        rows(
            "marital_status_domain",
            "silver",
            "crm_cust_info",
            values_outside("cst_marital_status", codes.MARITAL_DOMAIN),
        ),
        rows("product_line_domain", "silver", "crm_prd_info", values_outside("prd_line", codes.LINE_DOMAIN)),
        rows("cost_not_negative", "silver", "crm_prd_info", rows_where(missing_or_negative("prd_cost"))),
        rows(
            "due_date_range",
            "bronze",
            "crm_sales_details",
            rows_where(outside_dates("sls_due_dt", codes.DATE_INT_RANGE)),
        ),
        rows("country_domain", "silver", "erp_loc_a101", values_outside("cntry", codes.COUNTRY_DOMAIN)),
        key("customer_key_unique", "gold", "dim_customers", "customer_key", not_null=True),
        key("product_key_unique", "gold", "dim_products", "product_key", not_null=True),
        Check("sales_orphans", "gold.fact_sales", orphan_keys(table("gold", "fact_sales"), dimensions)),
        *[
            rows(check, "bronze", name, rows_where(F.col(column).isNotNull() & parsed.isNull()))
            for check, (name, column, parsed) in parsed_dates().items()
        ],
        *[
            key(check, layer, name, column)
            for check, (layer, name, column) in lookup_keys().items()
        ],
        Check("fact_rows_as_sales", "gold.fact_sales", rows=table("gold", "fact_sales"), same_rows=sales),
    ]
