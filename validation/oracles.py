"""SQL that states the expected result of every validation query.

The statements work from the rules, not from the operators: code lists are joined as value tables, the first
row per key is a DISTINCT ON, global numbers are plain windows over the whole table.
"""

from __future__ import annotations

import re

from validation import bronze_views

AS_OF = "2025-10-07"
RUN_TS = "2025-10-08 06:00:00"


def _plain(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text)


def _date_from_int(column: str, default: str) -> str:
    digits = f"CAST(CAST({column} AS BIGINT) AS VARCHAR)"
    return (
        f"CASE WHEN {column} IS NULL THEN NULL WHEN length({digits}) = 8 "
        f"THEN try_strptime({digits}, '%Y%m%d') ELSE TIMESTAMP '{default}' END"
    )


_DATES = {
    "sls_order_dt": "2010-12-29 00:00:00",
    "sls_ship_dt": "2011-01-05 00:00:00",
    "sls_due_dt": "2011-01-10 00:00:00",
}
_AMOUNT = (
    "CASE WHEN sls_sales > 0 AND (sls_sales = sls_quantity * abs(sls_price) "
    "OR sls_quantity * abs(sls_price) IS NULL) THEN sls_sales ELSE sls_quantity * abs(sls_price) END"
)
_PRICE = "CASE WHEN sls_price > 0 THEN sls_price ELSE sls_sales / nullif(sls_quantity, 0) END"

# Named parts; a statement pulls in the parts it mentions, and their parts.
PARTS = {
    "b_cust": _plain(bronze_views.B_CUST),
    "b_az": _plain(bronze_views.B_AZ),
    "b_loc": _plain(bronze_views.B_LOC),
    "b_prd": _plain(bronze_views.B_PRD),
    "b_px": _plain(bronze_views.B_PX),
    "b_sales": _plain(bronze_views.B_SALES),
    "c_marital": "SELECT * FROM (VALUES ('S', 'Single'), ('M', 'Married')) v(code, label)",
    "c_gender": "SELECT * FROM (VALUES ('F', 'Female'), ('M', 'Male')) v(code, label)",
    "c_gender_words": (
        "SELECT * FROM (VALUES ('F', 'Female'), ('FEMALE', 'Female'), ('M', 'Male'), ('MALE', 'Male')) "
        "v(code, label)"
    ),
    "c_line": (
        "SELECT * FROM (VALUES ('M', 'Mountain'), ('R', 'Road'), ('S', 'Other Sales'), ('T', 'Touring')) "
        "v(code, label)"
    ),
    "c_country": (
        "SELECT * FROM (VALUES ('DE', 'Germany'), ('US', 'United States'), ('USA', 'United States'), "
        "('', 'n/a')) v(code, label)"
    ),
    "az_first": "SELECT DISTINCT ON (cid) cid, bdate, gen FROM b_az ORDER BY cid, ord",
    "s_cust": """
        SELECT cst_id, cst_key, trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname,
          coalesce(m.label, 'n/a') AS cst_marital_status, coalesce(g.label, 'n/a') AS cst_gndr,
          CASE WHEN cst_create_date IN ('NaN', 'NaT') THEN TIMESTAMP '2025-10-07 00:00:00'
               ELSE coalesce(try_strptime(cst_create_date, '%Y-%m-%d %H:%M:%S'), try_strptime(cst_create_date, '%Y-%m-%d'))
          END AS cst_create_date
        FROM (SELECT DISTINCT ON (cst_id) * FROM b_cust WHERE cst_id IS NOT NULL
              ORDER BY cst_id, cst_create_date NULLS LAST, cst_key, cst_firstname, cst_lastname) AS firsts
        LEFT JOIN c_marital m ON m.code = upper(trim(cst_marital_status))
        LEFT JOIN c_gender g ON g.code = upper(trim(cst_gndr))""",
    "prd_filled": """
        SELECT * EXCLUDE (prd_start_dt), coalesce(
            max(CASE WHEN prd_start_dt <> 'NaN' THEN prd_start_dt END)
              OVER (ORDER BY prd_id ROWS UNBOUNDED PRECEDING), '2007-12-28 00:00:00') AS prd_start_dt
        FROM b_prd""",
    "s_prd": """
        SELECT CAST(prd_id AS BIGINT) AS prd_id, replace(left(prd_key, 5), '-', '_') AS cat_id,
          substr(prd_key, 7) AS prd_key, prd_nm,
          CASE WHEN prd_cost IS NULL OR isnan(prd_cost) THEN 0 ELSE prd_cost END AS prd_cost,
          coalesce(l.label, 'n/a') AS prd_line,
          CAST(CAST(CAST(prd_start_dt AS TIMESTAMP) AS DATE) AS TIMESTAMP) AS prd_start_dt,
          CAST(CAST(CAST(lead(prd_start_dt) OVER (PARTITION BY substr(prd_key, 7) ORDER BY prd_start_dt, prd_id)
            AS TIMESTAMP) AS DATE) AS TIMESTAMP) AS prd_end_dt
        FROM prd_filled LEFT JOIN c_line l ON l.code = upper(trim(prd_line))""",
    "s_sales": "SELECT sls_ord_num, sls_prd_key, sls_cust_id, "
    + ", ".join(f"{_date_from_int(c, d)} AS {c}" for c, d in _DATES.items())
    + f", {_AMOUNT} AS sls_sales, sls_quantity, {_PRICE} AS sls_price FROM b_sales",
    "s_az": f"""
        SELECT CASE WHEN length(cid) > 4 THEN right(cid, -3) ELSE cid END AS cid,
          CASE WHEN TRY_CAST(bdate AS DATE) <= DATE '{AS_OF}' THEN TRY_CAST(bdate AS DATE) END AS bdate,
          coalesce(w.label, 'n/a') AS gen
        FROM az_first LEFT JOIN c_gender_words w ON w.code = upper(trim(gen))""",
    "s_loc": """
        SELECT translate(cid, '-', '') AS cid, coalesce(c.label, trim(cntry), 'n/a') AS cntry
        FROM b_loc LEFT JOIN c_country c ON c.code = trim(cntry)""",
    "g_cust": """
        SELECT row_number() OVER (ORDER BY cst_id NULLS LAST, cst_key NULLS LAST) AS customer_key,
          cst_id AS customer_id, cst_key AS customer_number, cst_firstname AS first_name,
          cst_lastname AS last_name, cntry AS country, cst_marital_status AS marital_status,
          coalesce(nullif(cst_gndr, 'n/a'), gen, 'n/a') AS gender, bdate AS birthdate,
          CAST(cst_create_date AS DATE) AS create_date
        FROM s_cust LEFT JOIN s_az a ON a.cid = cst_key LEFT JOIN s_loc l ON l.cid = cst_key""",
    "g_prd": """
        SELECT row_number() OVER (ORDER BY prd_start_dt NULLS LAST, prd_key NULLS LAST, prd_id) AS product_key,
          prd_id AS product_id, prd_key AS product_number, prd_nm AS product_name, cat_id AS category_id,
          cat AS category, subcat AS subcategory, maintenance, prd_cost AS cost, prd_line AS product_line,
          CAST(prd_start_dt AS DATE) AS start_date
        FROM s_prd LEFT JOIN b_px ON id = cat_id WHERE prd_end_dt IS NULL""",
    "g_sales": """
        SELECT sls_ord_num AS order_number, product_key, customer_key, CAST(sls_order_dt AS DATE) AS order_date,
          CAST(sls_ship_dt AS DATE) AS shipping_date, CAST(sls_due_dt AS DATE) AS due_date,
          sls_sales AS sales_amount, sls_quantity AS quantity, sls_price AS price
        FROM s_sales LEFT JOIN g_prd ON product_number = sls_prd_key
        LEFT JOIN g_cust ON customer_id = sls_cust_id""",
    "dirty_loc": """
        SELECT cid, CASE right(cid, 1) WHEN '0' THEN 'NA' WHEN '1' THEN 'n/a' WHEN '2' THEN 'null'
          WHEN '3' THEN ' NA' WHEN '4' THEN '#N/A' WHEN '5' THEN 'so "called", NaN' ELSE cntry END AS cntry
        FROM b_loc""",
    "kept_cust": "SELECT customer_key FROM g_cust WHERE customer_id % 10 <> 4",
    "kept_prd": "SELECT product_key FROM g_prd WHERE product_id % 10 <> 4",
    "lost_pairs": """
        SELECT f.customer_key, f.product_key, count(*) AS copies FROM g_sales f
        LEFT JOIN kept_cust c ON c.customer_key = f.customer_key
        LEFT JOIN kept_prd p ON p.product_key = f.product_key
        WHERE c.customer_key IS NULL OR p.product_key IS NULL GROUP BY f.customer_key, f.product_key""",
    "orphan_pairs": """
        SELECT f.customer_key, f.product_key, count(*) AS copies FROM g_sales f
        LEFT JOIN g_cust c ON c.customer_key = f.customer_key
        LEFT JOIN g_prd p ON p.product_key = f.product_key
        WHERE c.customer_key IS NULL OR p.product_key IS NULL GROUP BY f.customer_key, f.product_key""",
}


def _mapped(table: str, key: str, column: str, codes: str) -> str:
    return (
        f"SELECT {key}, {column} AS raw, coalesce(label, 'n/a') AS standardized FROM {table} "
        f"LEFT JOIN {codes} ON code = upper(trim({column}))"
    )


def _repeated(table: str, key: str, stage: str) -> str:
    return (
        f"SELECT '{stage}' AS stage, {key}, count(*) AS copies FROM {table} GROUP BY {key} "
        f"HAVING count(*) > 1 OR {key} IS NULL"
    )


def _outside(table: str, column: str, stage: str, domain: str) -> str:
    return (
        f"SELECT DISTINCT '{stage}' AS stage, {column} FROM {table} "
        f"WHERE {column} NOT IN ({domain}) OR {column} IS NULL"
    )


_MARITAL = "'Single', 'Married', 'n/a'"
_LINE = "'Other Sales', 'Road', 'Mountain', 'n/a', 'Touring'"
_COUNTRY = "'Australia', 'Canada', 'France', 'Germany', 'n/a', 'NaN', 'United Kingdom', 'United States'"
_BAD_DUE = "(sls_due_dt <= 0 OR length(CAST(sls_due_dt AS VARCHAR)) <> 8 OR sls_due_dt NOT BETWEEN 19000101 AND 20500101)"


def _bad_date(column: str) -> str:
    return (
        f"SELECT '{column}' AS date_column, sls_ord_num, CAST(nullif({column}, 0) AS BIGINT) AS date_number "
        f"FROM b_sales WHERE {_BAD_DUE.replace('sls_due_dt', column)}"
    )


def _verdict(check: str, table: str, violations: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", count(*) AS violations, "
        f"count(*) = 0 AS passed FROM ({violations}) AS v_{check}"
    )


_TOTALS = (
    "count(*) AS order_lines, round(sum(quantity), 2) AS quantity, round(sum(sales_amount), 2) AS sales_amount"
)

_PARSED = (
    *[("b_sales", "sls_ord_num", column, _date_from_int(column, default)) for column, default in _DATES.items()],
    (
        "b_cust",
        "cst_key",
        "cst_create_date",
        "CASE WHEN cst_create_date IN ('NaN', 'NaT') THEN TIMESTAMP '2025-10-07 00:00:00' "
        "ELSE try_strptime(cst_create_date, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d']) END",
    ),
    ("az_first", "cid", "bdate", "TRY_CAST(bdate AS DATE)"),
)
_PARSE_CHECKS = {
    "sls_order_dt": ("order_date_parses", "bronze.crm_sales_details"),
    "sls_ship_dt": ("ship_date_parses", "bronze.crm_sales_details"),
    "sls_due_dt": ("due_date_parses", "bronze.crm_sales_details"),
    "cst_create_date": ("create_date_parses", "bronze.crm_cust_info"),
    "bdate": ("birth_date_parses", "bronze.erp_cust_az12"),
}
_LOOKUPS = (
    ("demographics_lookup_unique", "silver.erp_cust_az12", "s_az", "cid"),
    ("location_lookup_unique", "silver.erp_loc_a101", "s_loc", "cid"),
    ("category_lookup_unique", "silver.erp_px_cat_g1v2", "b_px", "id"),
    ("customer_lookup_unique", "gold.dim_customers", "g_cust", "customer_id"),
    ("product_lookup_unique", "gold.dim_products", "g_prd", "product_number"),
)

STATEMENTS = {
    "scan_csv_na": """
        SELECT 'loc' AS source, cid AS record_key,
          CASE WHEN cntry NOT IN ('', 'NA', 'n/a', 'null', '#N/A') THEN cntry END AS record_value FROM dirty_loc
        UNION ALL SELECT 'px', id, subcat FROM b_px""",
    "conform_types": """
        SELECT CAST(prd_id AS BIGINT) AS prd_id, prd_nm, prd_cost,
          TRY_CAST(prd_start_dt AS TIMESTAMP) AS prd_start_dt,
          CAST(TRY_CAST(prd_end_dt AS TIMESTAMP) AS DATE) AS prd_end_dt FROM b_prd""",
    "erp_first_wins": "SELECT cid, bdate, nullif(gen, '') AS gen FROM az_first",
    "audit_stamp": f"SELECT *, TIMESTAMP '{RUN_TS}' AS dwh_create_date FROM b_px",
    "store_steps": """
        SELECT 'bronze.erp_loc_a101' AS step, count(*) AS rows FROM b_loc UNION ALL
        SELECT 'bronze.erp_px_cat_g1v2 from a missing extract', 0 UNION ALL
        SELECT 'bronze.erp_loc_a101 refreshed with nothing', 0 UNION ALL
        SELECT 'bronze.erp_loc_a101 refused as empty', count(*) FROM b_loc UNION ALL
        SELECT 'bronze.erp_loc_a101 previewed', least(count(*), 3) FROM b_loc UNION ALL
        SELECT 'silver.erp_loc_a101 by name', count(*) FROM s_loc UNION ALL
        SELECT 'silver.erp_loc_a101 by statement, ' || cntry, count(*) FROM s_loc GROUP BY cntry""",
    "step_counts": " UNION ALL ".join(
        f"SELECT 'bronze.{name}' AS step, count(*) AS rows FROM {part}"
        for name, part in (
            ("crm_cust_info", "b_cust"),
            ("crm_prd_info", "b_prd"),
            ("crm_sales_details", "b_sales"),
            ("erp_cust_az12", "b_az"),
            ("erp_loc_a101", "b_loc"),
            ("erp_px_cat_g1v2", "b_px"),
        )
    ),
    "keep_first_orders": "SELECT DISTINCT ON (o_custkey) * FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey",
    "keep_last_orders": (
        "SELECT DISTINCT ON (o_custkey) * FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC"
    ),
    "trim_names": """
        SELECT cst_key, cst_create_date, trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname
        FROM b_cust""",
    "standardize_marital": _mapped("b_cust", "cst_key", "cst_marital_status", "c_marital"),
    "standardize_gender": _mapped("b_cust", "cst_key", "cst_gndr", "c_gender"),
    "standardize_product_line": _mapped("b_prd", "prd_id", "prd_line", "c_line"),
    "standardize_gender_words": _mapped("b_az", "cid", "gen", "c_gender_words"),
    "standardize_country": """
        SELECT cid, cntry AS raw, coalesce(label, trim(cntry), 'n/a') AS standardized
        FROM b_loc LEFT JOIN c_country ON code = trim(cntry)""",
    "clean_location_key": "SELECT cid AS raw, translate(cid, '-', '') AS cid FROM b_loc",
    "sentinel_timestamp": """
        SELECT cst_key, cst_create_date AS raw, CASE cst_create_date WHEN 'NaN' THEN TIMESTAMP '2025-10-07 00:00:00'
          ELSE try_strptime(cst_create_date, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d']) END AS created FROM b_cust""",
    "split_product_key": """
        SELECT prd_id, translate(left(prd_key, 5), '-', '_') AS cat_id, right(prd_key, -6) AS prd_key FROM b_prd""",
    "numeric_default": """
        SELECT prd_id, CASE WHEN prd_cost <> CAST('NaN' AS DOUBLE) THEN prd_cost ELSE 0 END AS prd_cost
        FROM b_prd""",
    "running_max_fill": "SELECT prd_id, prd_nm, prd_start_dt FROM prd_filled",
    "version_end_date": """
        SELECT prd_id, prd_key, prd_start_dt,
          lead(prd_start_dt) OVER (PARTITION BY prd_key ORDER BY prd_start_dt, prd_id) AS next_start FROM b_prd""",
    "parse_int_dates": "SELECT sls_ord_num, "
    + ", ".join(f"{_date_from_int(c, d)} AS {c}" for c, d in _DATES.items())
    + " FROM b_sales",
    "reconcile_amounts": f"SELECT sls_ord_num, {_AMOUNT} AS sls_sales, sls_quantity, {_PRICE} AS sls_price FROM b_sales",
    "strip_prefix": """
        SELECT cid AS raw, CASE WHEN length(cid) > 4 THEN right(cid, -3) ELSE cid END AS cid,
          CASE WHEN starts_with(cid, 'NAS') THEN right(cid, -3) ELSE cid END AS cid_if_prefixed FROM b_az""",
    "null_future_dates": f"""
        SELECT cid, CASE WHEN bdate <= '{AS_OF}' THEN CAST(bdate AS DATE) END AS bdate FROM b_az""",
    "prefer_master": """
        SELECT cst_key, cst_gndr, gen, coalesce(nullif(cst_gndr, 'n/a'), gen, 'n/a') AS gender
        FROM s_cust LEFT JOIN s_az ON cid = cst_key""",
    "surrogate_key_customer": "SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, * FROM customer",
    "surrogate_key_part": "SELECT row_number() OVER (ORDER BY p_type, p_partkey) AS part_key, * FROM part",
    "surrogate_key_lineitem": """
        SELECT row_number() OVER (ORDER BY l_orderkey) AS order_sk, l_orderkey
        FROM (SELECT DISTINCT l_orderkey FROM lineitem) AS orders_seen""",
    "surrogate_lookup": """
        SELECT o_orderkey, o_custkey, customer_key FROM orders LEFT JOIN
          (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_key
           FROM customer WHERE c_acctbal >= 0) AS keyed ON c_custkey = o_custkey""",
    "silver_customers": "SELECT * FROM s_cust",
    "silver_products": "SELECT * FROM s_prd",
    "silver_sales": "SELECT * FROM s_sales",
    "silver_erp_customers": "SELECT * FROM s_az",
    "silver_locations": "SELECT * FROM s_loc",
    "silver_categories": "SELECT * FROM b_px",
    "gold_customers": "SELECT * FROM g_cust",
    "gold_products": "SELECT * FROM g_prd",
    "gold_sales": "SELECT * FROM g_sales",
    "gold_flat_sales": """
        SELECT f.*, product_number, product_name, category, subcategory, product_line, customer_number,
          first_name, last_name, country, gender
        FROM g_sales f LEFT JOIN g_prd p ON p.product_key = f.product_key
        LEFT JOIN g_cust c ON c.customer_key = f.customer_key""",
    "gold_sales_by_category": f"""
        SELECT category, {_TOTALS} FROM g_sales f LEFT JOIN g_prd p ON p.product_key = f.product_key
        GROUP BY category""",
    "gold_sales_by_country_month": f"""
        SELECT country, CAST(date_trunc('month', order_date) AS DATE) AS order_month, {_TOTALS}
        FROM g_sales f LEFT JOIN g_cust c ON c.customer_key = f.customer_key GROUP BY ALL""",
    "dq_pk_customer": f"{_repeated('b_cust', 'cst_id', 'bronze')} UNION ALL {_repeated('s_cust', 'cst_id', 'silver')}",
    "dq_pk_product": (
        "SELECT 'product' AS stage, CAST(prd_id AS VARCHAR) AS id, count(*) AS copies FROM s_prd GROUP BY prd_id "
        "HAVING count(*) > 1 OR prd_id IS NULL UNION ALL SELECT 'number', prd_key, count(*) FROM s_prd "
        "GROUP BY prd_key HAVING count(*) > 1 OR prd_key IS NULL"
    ),
    "dq_pk_dim_customer": (
        "SELECT 'customer_key' AS checked, customer_key AS value, count(*) AS copies FROM g_cust "
        "GROUP BY customer_key HAVING count(*) > 1 OR customer_key IS NULL UNION ALL "
        "SELECT 'fact.customer_key', customer_key, count(*) FROM g_sales "
        "GROUP BY customer_key HAVING count(*) > 1 OR customer_key IS NULL"
    ),
    "dq_pk_dim_product": (
        "SELECT 'product_key' AS checked, product_key AS value, count(*) AS copies FROM g_prd "
        "GROUP BY product_key HAVING count(*) > 1 OR product_key IS NULL UNION ALL "
        "SELECT 'fact.product_key', product_key, count(*) FROM g_sales "
        "GROUP BY product_key HAVING count(*) > 1 OR product_key IS NULL"
    ),
    "dq_domain_marital": f"{_outside('b_cust', 'cst_marital_status', 'bronze', _MARITAL)} UNION ALL "
    + _outside("s_cust", "cst_marital_status", "silver", _MARITAL),
    "dq_domain_line": f"{_outside('b_prd', 'prd_line', 'bronze', _LINE)} UNION ALL "
    + _outside("s_prd", "prd_line", "silver", _LINE),
    "dq_domain_country": f"{_outside('b_loc', 'cntry', 'bronze', _COUNTRY)} UNION ALL "
    + _outside("s_loc", "cntry", "silver", _COUNTRY)
    + " ORDER BY 1, 2",
    "dq_cost": (
        "SELECT 'bronze' AS stage, prd_id, prd_cost FROM b_prd WHERE prd_cost IS NULL OR prd_cost < 0 UNION ALL "
        "SELECT 'silver', CAST(prd_id AS VARCHAR), prd_cost FROM s_prd WHERE prd_cost IS NULL OR prd_cost < 0"
    ),
    "dq_date_int_range": f"{_bad_date('sls_order_dt')} UNION ALL {_bad_date('sls_due_dt')}",
    "dq_orphans": "SELECT * FROM lost_pairs WHERE copies > 1 OR customer_key IS NULL OR product_key IS NULL",
    "dq_orphans_strict": "SELECT * FROM lost_pairs",
    "dq_bitmap_keys": " UNION ALL ".join(
        _verdict(f"{key}_unique", table, f"SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1 {more}")
        for table, key, more in (
            ("orders", "o_orderkey", "OR o_orderkey IS NULL"),
            ("customer", "c_custkey", "OR c_custkey IS NULL"),
            ("part", "p_partkey", "OR p_partkey IS NULL"),
            ("lineitem", "l_orderkey", "AND l_orderkey IS NOT NULL"),
        )
    ),
    "dq_bitmap_orphans": """
        SELECT l_orderkey, l_partkey, count(*) AS copies FROM lineitem
        LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') AS known ON o_orderkey = l_orderkey
        LEFT JOIN part ON p_partkey = l_partkey WHERE o_orderkey IS NULL OR p_partkey IS NULL GROUP BY l_orderkey, l_partkey""",
    "dq_unparsed_dates": " UNION ALL ".join(
        f"SELECT '{column}' AS date_column, CAST({key} AS VARCHAR) AS record_key, CAST({column} AS VARCHAR) AS value "
        f"FROM {part} WHERE {column} IS NOT NULL AND {parsed} IS NULL"
        for part, key, column, parsed in _PARSED
    ),
    "dq_lookup_fanout": """
        SELECT cid, count(*) AS copies FROM (SELECT CASE WHEN length(cid) > 4 THEN right(cid, -3) ELSE cid END AS cid
          FROM (SELECT cid FROM az_first UNION ALL SELECT 'XYZAW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')
                FROM customer WHERE c_custkey % 100 = 50) AS ids) AS stripped
        GROUP BY cid HAVING count(*) > 1""",
    "dq_report": " UNION ALL ".join(
        (
            _verdict("customer_id_unique", "silver.crm_cust_info", _repeated("s_cust", "cst_id", "s")),
            _verdict("product_id_unique", "silver.crm_prd_info", _repeated("s_prd", "prd_id", "s")),
            _verdict(
                "marital_status_domain",
                "silver.crm_cust_info",
                _outside("s_cust", "cst_marital_status", "s", _MARITAL),
            ),
            _verdict("product_line_domain", "silver.crm_prd_info", _outside("s_prd", "prd_line", "s", _LINE)),
            _verdict(
                "cost_not_negative",
                "silver.crm_prd_info",
                "SELECT prd_cost FROM s_prd WHERE prd_cost IS NULL OR prd_cost < 0",
            ),
            _verdict(
                "due_date_range", "bronze.crm_sales_details", f"SELECT sls_due_dt FROM b_sales WHERE {_BAD_DUE}"
            ),
            _verdict("country_domain", "silver.erp_loc_a101", _outside("s_loc", "cntry", "s", _COUNTRY)),
            _verdict("customer_key_unique", "gold.dim_customers", _repeated("g_cust", "customer_key", "g")),
            _verdict("product_key_unique", "gold.dim_products", _repeated("g_prd", "product_key", "g")),
            _verdict(
                "sales_orphans",
                "gold.fact_sales",
                "SELECT * FROM orphan_pairs WHERE copies > 1 OR customer_key IS NULL OR product_key IS NULL",
            ),
            *[
                _verdict(*_PARSE_CHECKS[column], f"SELECT 1 FROM {part} WHERE {column} IS NOT NULL AND {parsed} IS NULL")
                for part, _, column, parsed in _PARSED
            ],
            *[
                _verdict(
                    check, table, f"SELECT 1 FROM {part} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1"
                )
                for check, table, part, key in _LOOKUPS
            ],
            _verdict(
                "fact_rows_as_sales",
                "gold.fact_sales",
                "SELECT 1 WHERE (SELECT count(*) FROM g_sales) <> (SELECT count(*) FROM s_sales)",
            ),
        )
    ),
}

_STORED = {
    "bronze.crm_cust_info": "b_cust",
    "bronze.crm_prd_info": "b_prd",
    "bronze.crm_sales_details": "b_sales",
    "bronze.erp_cust_az12": "az_first",
    "bronze.erp_loc_a101": "b_loc",
    "bronze.erp_px_cat_g1v2": "b_px",
    "silver.crm_cust_info": "s_cust",
    "silver.crm_prd_info": "s_prd",
    "silver.crm_sales_details": "s_sales",
    "silver.erp_cust_az12": "s_az",
    "silver.erp_loc_a101": "s_loc",
    "silver.erp_px_cat_g1v2": "b_px",
    "gold.dim_customers": "g_cust",
    "gold.dim_products": "g_prd",
    "gold.fact_sales": "g_sales",
    "gold.flat_sales": "g_sales",
    "gold.sales_by_category": "(SELECT DISTINCT category FROM g_sales f LEFT JOIN g_prd p ON p.product_key = f.product_key)",
    "gold.sales_by_country_month": (
        "(SELECT DISTINCT country, date_trunc('month', order_date) FROM g_sales f "
        "LEFT JOIN g_cust c ON c.customer_key = f.customer_key)"
    ),
}
STATEMENTS["refresh_fact_sales"] = "SELECT * FROM g_sales"
STATEMENTS["refresh_step_counts"] = " UNION ALL ".join(
    f"SELECT '{step}' AS step, count(*) AS rows FROM {part}" for step, part in _STORED.items()
)
STATEMENTS["refresh_manifest"] = " UNION ALL ".join(
    "SELECT '{}' AS layer, '{}' AS name, count(*) AS rows FROM {}".format(*step.split("."), part) for step, part in _STORED.items()
)
STATEMENTS["run_snapshots"] = " UNION ALL ".join(
    f"SELECT '{stage}' AS stage, o_orderstatus, c_nationkey, count(*) AS order_lines "
    f"FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = '{status}' GROUP BY ALL"
    for stage, status in (("kept", "F"), ("current", "O"), ("before", "F"))
)


def _needed(text: str) -> list[str]:
    """Parts mentioned in ``text`` and in those parts, each after what it needs."""
    order: list[str] = []
    for name in PARTS:
        if re.search(rf"\b{name}\b", text):
            for part in [*_needed(PARTS[name]), name]:
                if part not in order:
                    order.append(part)
    return order


def oracle(name: str) -> str:
    text = STATEMENTS[name]
    parts = ", ".join(f"{part} AS MATERIALIZED ({PARTS[part]})" for part in _needed(text))
    return f"WITH {parts} {text}" if parts else text
