"""Silver to gold: two dimensions, the sales fact, and the reporting tables on top."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.functions.cleaning import prefer_master
from tiermill.operators.conform import conform
from tiermill.operators.lookup import lookup_join, lookup_pair
from tiermill.operators.ordered import surrogate_key
from tiermill.plans.schemas import GOLD, MEASURE, with_measures


def dim_customers(customers: DataFrame, demographics: DataFrame, locations: DataFrame) -> DataFrame:
    """Customers with demographics and country, numbered by customer id."""
    people = demographics.select("cid", "bdate", "gen")
    places = locations.select("cid", "cntry")
    joined = lookup_join(lookup_join(customers, people, "cst_key", "cid"), places, "cst_key", "cid")
    renamed = joined.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("cntry").alias("country"),
        F.col("cst_marital_status").alias("marital_status"),
        prefer_master("cst_gndr", "gen").alias("gender"),
        F.col("bdate").alias("birthdate"),
        F.col("cst_create_date").alias("create_date"),
    )
    keyed = surrogate_key(renamed, ["customer_id", "customer_number"], "customer_key")
    return conform(keyed, GOLD["dim_customers"])


def dim_products(products: DataFrame, categories: DataFrame, measure: str = MEASURE) -> DataFrame:
    """Current product versions with their category, numbered by start date and product number."""
    current = products.filter(F.col("prd_end_dt").isNull())
    groups = categories.select("id", "cat", "subcat", "maintenance")
    renamed = lookup_join(current, groups, "cat_id", "id").select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("subcategory"),
        "maintenance",
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
    )
    order = ["start_date", "product_number", "product_id"]
    keyed = surrogate_key(renamed, order, "product_key")
    return conform(keyed, with_measures(GOLD["dim_products"], measure))


def fact_sales(
    sales: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    assert_unique: bool = False,
    measure: str = MEASURE,
) -> DataFrame:
    """Order lines with surrogate keys, NULL where the dimension has no row.

    ``products`` and ``customers`` are the dimensions of the same run.
    """
    columns = with_measures(GOLD["fact_sales"], measure)
    # in the types of the fact, which are narrower, before rows are moved
    renamed = sales.select(
        F.col("sls_prd_key").alias("__product"),
        F.col("sls_cust_id").alias("__customer"),
        F.col("sls_ord_num").alias("order_number"),
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("shipping_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("price"),
    )
    own = dict(renamed.dtypes) | {n: t for n, t in columns.items() if n in renamed.columns}
    keyed = lookup_pair(
        conform(renamed, own),
        (products.select("product_number", "product_key"), "__product", "product_number"),
        (customers.select("customer_id", "customer_key"), "__customer", "customer_id"),
        assert_unique,
    )
    return conform(keyed, columns)


def flat_sales(fact: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """One wide row per order line."""
    goods = products.select(
        "product_key",
        "product_number",
        "product_name",
        "category",
        "subcategory",
        "product_line",
    )
    buyers = customers.select(
        "customer_key",
        "customer_number",
        "first_name",
        "last_name",
        "country",
        "gender",
    )
    return lookup_pair(
        fact, (goods, "product_key", "product_key"), (buyers, "customer_key", "customer_key")
    )


def _totals(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.sum("order_lines").alias("order_lines"),
        F.round(F.sum("quantity"), 2).alias("quantity"),
        F.round(F.sum("sales_amount"), 2).alias("sales_amount"),
    )


def _summed(fact: DataFrame, *by) -> DataFrame:
    """Fact totals per surrogate key; joins and later sums see these few rows instead of the fact."""
    return fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("order_lines"),
        F.sum("quantity").alias("quantity"),
        F.sum("sales_amount").alias("sales_amount"),
    )


def sales_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines, quantity and amount per product category; unknown products under NULL."""
    categories = products.select("product_key", "category")
    return _totals(lookup_join(_summed(fact, "product_key"), categories, "product_key", "product_key"), "category")


def sales_by_country_month(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Order lines, quantity and amount per customer country and order month."""
    countries = customers.select("customer_key", "country")
    month = F.trunc("order_date", "month").alias("order_month")
    monthly = _summed(fact, "customer_key", month)
    return _totals(lookup_join(monthly, countries, "customer_key", "customer_key"), "country", "order_month")
