"""Columns of the eighteen tables, in order.

Fixed values: names, order and types of the stored tables. Whole-number identifiers and YYYYMMDD numbers are
bigint, measures are double unless ``with_measures`` says otherwise, timestamps carry no zone.
"""

from __future__ import annotations

from collections.abc import Mapping

MEASURE = "double"

BRONZE = {
    "crm_cust_info": {
        "cst_id": "bigint",
        "cst_key": "string",
        "cst_firstname": "string",
        "cst_lastname": "string",
        "cst_marital_status": "string",
        "cst_gndr": "string",
        "cst_create_date": "string",
    },
    "crm_prd_info": {
        "prd_id": "string",
        "prd_key": "string",
        "prd_nm": "string",
        "prd_cost": "double",
        "prd_line": "string",
        "prd_start_dt": "string",
        "prd_end_dt": "string",
    },
    "crm_sales_details": {
        "sls_ord_num": "string",
        "sls_prd_key": "string",
        "sls_cust_id": "bigint",
        "sls_order_dt": "bigint",
        "sls_ship_dt": "bigint",
        "sls_due_dt": "bigint",
        "sls_sales": "double",
        "sls_quantity": "double",
        "sls_price": "double",
    },
    "erp_cust_az12": {"cid": "string", "bdate": "string", "gen": "string"},
    "erp_loc_a101": {"cid": "string", "cntry": "string"},
    "erp_px_cat_g1v2": {"id": "string", "cat": "string", "subcat": "string", "maintenance": "string"},
}

# Silver tables are stored with the audit column after these.
SILVER = {
    "crm_cust_info": {
        "cst_id": "bigint",
        "cst_key": "string",
        "cst_firstname": "string",
        "cst_lastname": "string",
        "cst_marital_status": "string",
        "cst_gndr": "string",
        "cst_create_date": "timestamp_ntz",
    },
    "crm_prd_info": {
        "prd_id": "bigint",
        "cat_id": "string",
        "prd_key": "string",
        "prd_nm": "string",
        "prd_cost": "double",
        "prd_line": "string",
        "prd_start_dt": "timestamp_ntz",
        "prd_end_dt": "timestamp_ntz",
    },
    "crm_sales_details": {
        "sls_ord_num": "string",
        "sls_prd_key": "string",
        "sls_cust_id": "bigint",
        "sls_order_dt": "timestamp_ntz",
        "sls_ship_dt": "timestamp_ntz",
        "sls_due_dt": "timestamp_ntz",
        "sls_sales": "double",
        "sls_quantity": "double",
        "sls_price": "double",
    },
    "erp_cust_az12": {"cid": "string", "bdate": "date", "gen": "string"},
    "erp_loc_a101": {"cid": "string", "cntry": "string"},
    "erp_px_cat_g1v2": {"id": "string", "cat": "string", "subcat": "string", "maintenance": "string"},
}

GOLD = {
    "dim_customers": {
        "customer_key": "bigint",
        "customer_id": "bigint",
        "customer_number": "string",
        "first_name": "string",
        "last_name": "string",
        "country": "string",
        "marital_status": "string",
        "gender": "string",
        "birthdate": "date",
        "create_date": "date",
    },
    "dim_products": {
        "product_key": "bigint",
        "product_id": "bigint",
        "product_number": "string",
        "product_name": "string",
        "category_id": "string",
        "category": "string",
        "subcategory": "string",
        "maintenance": "string",
        "cost": "double",
        "product_line": "string",
        "start_date": "date",
    },
    "fact_sales": {
        "order_number": "string",
        "product_key": "bigint",
        "customer_key": "bigint",
        "order_date": "date",
        "shipping_date": "date",
        "due_date": "date",
        "sales_amount": "double",
        "quantity": "double",
        "price": "double",
    },
    "flat_sales": {
        "order_number": "string",
        "product_key": "bigint",
        "customer_key": "bigint",
        "order_date": "date",
        "shipping_date": "date",
        "due_date": "date",
        "sales_amount": "double",
        "quantity": "double",
        "price": "double",
        "product_number": "string",
        "product_name": "string",
        "category": "string",
        "subcategory": "string",
        "product_line": "string",
        "customer_number": "string",
        "first_name": "string",
        "last_name": "string",
        "country": "string",
        "gender": "string",
    },
    "sales_by_category": {
        "category": "string",
        "order_lines": "bigint",
        "quantity": "double",
        "sales_amount": "double",
    },
    "sales_by_country_month": {
        "country": "string",
        "order_month": "date",
        "order_lines": "bigint",
        "quantity": "double",
        "sales_amount": "double",
    },
}


def with_measures(columns: Mapping[str, str], measure: str) -> dict[str, str]:
    """The same columns with measures of another type, such as ``decimal(18,4)`` for exact amounts."""
    return {name: measure if kind == MEASURE else kind for name, kind in columns.items()}
