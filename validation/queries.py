"""Validation queries: each runs one operator or table build over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.functions import (
    codes,
    null_future_dates,
    numeric_default,
    prefer_master,
    reconcile_amounts,
    remove_chars,
    sentinel_timestamp,
    split_product_key,
    standardize_codes,
    strip_prefix,
    trim_columns,
    yyyymmdd_to_timestamp,
)
from tiermill.operators import (
    conform,
    dq_report,
    in_domain,
    keep_first,
    lookup_join,
    lookup_key,
    non_negative,
    orphan_keys,
    repeated_keys,
    require_key,
    require_non_empty,
    running_max_fill,
    stamp,
    surrogate_key,
    unique_not_null,
    unparsed,
    valid_date_int,
    version_end_date,
)
from tiermill.operators.quality import Check
from tiermill.plans import gold, silver
from tiermill.plans.checks import parsed_dates, store_checks
from tiermill.plans.refresh import RunResult, bronze_rows, build_layers, run_named, run_refresh
from tiermill.plans.schemas import BRONZE, SILVER
from tiermill.plans.together import together
from tiermill.settings import apply_settings
from tiermill.sources.extracts import SOURCES, read_source
from tiermill.sources.scratch import materialize, scratch_path
from tiermill.sources.warehouse import CODEC, LAYERS, MANIFEST, RunReport, Warehouse
from validation.bronze_views import BronzeViews

AS_OF = "2025-10-07"
RUN_TS = "2025-10-08 06:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


class Tables(BronzeViews):
    """Bronze views and what is built from them; dimensions are stored once, as in a real run."""

    @cached_property
    def az_first(self) -> DataFrame:
        return keep_first(require_key(self.az, "cid"), "cid", ["ord"], tiebreak=[]).drop("ord")

    @cached_property
    def silver_cust(self) -> DataFrame:
        return silver.silver_customers(self.cust)

    @cached_property
    def silver_prd(self) -> DataFrame:
        return silver.silver_products(self.prd)

    @cached_property
    def silver_sales(self) -> DataFrame:
        return silver.silver_sales(self.sales)

    @cached_property
    def silver_az(self) -> DataFrame:
        return silver.silver_erp_customers(self.az_first, AS_OF)

    @cached_property
    def silver_loc(self) -> DataFrame:
        return silver.silver_locations(self.loc)

    @cached_property
    def silver_px(self) -> DataFrame:
        return silver.silver_categories(self.px)

    @cached_property
    def dimensions(self) -> dict[str, DataFrame]:
        builds = {
            "customers": lambda: gold.dim_customers(self.silver_cust, self.silver_az, self.silver_loc),
            "products": lambda: gold.dim_products(self.silver_prd, self.silver_px),
        }
        return dict(together(self.spark, lambda n: (n, materialize(builds[n](), f"dim-{n}").df), builds))

    @property
    def dim_customers(self) -> DataFrame:
        return self.dimensions["customers"]

    @property
    def dim_products(self) -> DataFrame:
        return self.dimensions["products"]

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_sales(self.silver_sales, self.dim_products, self.dim_customers)


def query(name: str | None = None) -> Callable:
    """Register a build under its own name, or under ``name`` where an operator already has that one."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name or build.__name__] = lambda spark, folder: build(Tables(apply_settings(spark), folder))
        return build

    return register


def _union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _at(stage: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(stage).alias("stage"), "*")


# --- reading and storing


@query()
def scan_csv_na(t: Tables) -> DataFrame:
    last = F.substring("cid", -1, 1)
    dirty = F.when(last == "0", "NA").when(last == "1", "n/a").when(last == "2", "null")
    dirty = dirty.when(last == "3", " NA").when(last == "4", "#N/A").when(last == "5", 'so "called", NaN')
    parts = []
    for source, table, df in (
        ("loc", "erp_loc_a101", t.loc.select("cid", dirty.otherwise(F.col("cntry")).alias("cntry"))),
        ("px", "erp_px_cat_g1v2", t.px),
    ):
        path = scratch_path(t.spark, source) + ".csv"
        writer = df.toDF(*[c.upper() for c in df.columns]).write.option("header", True).option("escape", '"')
        keep_spaces = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        keep_spaces.csv(path)
        read = read_source(t.spark, path, BRONZE[table], on_missing="error")
        key, value = {"loc": ("cid", "cntry"), "px": ("id", "subcat")}[source]
        parts.append(
            read.select(
                F.lit(source).alias("source"), F.col(key).alias("record_key"), F.col(value).alias("record_value")
            )
        )
    return _union(*parts)


@query()
def conform_types(t: Tables) -> DataFrame:
    target = {
        "prd_id": "bigint",
        "prd_nm": "string",
        "prd_cost": "double",
        "prd_start_dt": "timestamp_ntz",
        "prd_end_dt": "date",
    }
    return conform(t.prd, target, strict=False)


def _write_csv(df: DataFrame, path: str) -> None:
    writer = df.write.option("header", True).option("compression", "gzip")  # a third of the bytes; one task reads a part
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _az_in_file_order(t: Tables) -> DataFrame:
    """The parts of a sorted table follow one another, as the lines of one file would."""
    return t.az.orderBy("ord", "cid").drop("ord")


@query()
def erp_first_wins(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "az") + ".csv"
    _write_csv(_az_in_file_order(t), path)
    read = read_source(t.spark, path, BRONZE["erp_cust_az12"], on_missing="error", with_order=True)
    return bronze_rows(SOURCES["cust_az1"], read)


@query()
def audit_stamp(t: Tables) -> DataFrame:
    return stamp(t.px, RUN_TS)


def _own_store(t: Tables) -> Warehouse:
    store = scratch_path(t.spark, "store")
    return Warehouse(t.spark, store, prefix=f"run_{store[-8:]}_").init()


def _leave(t: Tables, warehouse: Warehouse) -> None:
    """Drop the databases of a store with their files."""
    for layer in LAYERS:
        t.spark.sql(f"DROP DATABASE IF EXISTS `{warehouse.prefix}{layer}` CASCADE")


@query()
def step_counts(t: Tables) -> DataFrame:
    warehouse, report = _own_store(t), RunReport()
    frames = _bronze(t) | {"erp_cust_az12": t.az.drop("ord")}
    together(t.spark, lambda item: warehouse.full_refresh(item[1], "bronze", item[0], report=report), frames.items())
    _leave(t, warehouse)
    return report.to_df(t.spark)


@query()
def store_steps(t: Tables) -> DataFrame:
    warehouse, steps = _own_store(t), RunReport()
    steps.add("bronze.erp_loc_a101", warehouse.full_refresh(require_non_empty(t.loc, "loc"), "bronze", "erp_loc_a101").count())
    missing = read_source(t.spark, f"{warehouse.root}/nowhere.csv", BRONZE["erp_px_cat_g1v2"])
    steps.add("bronze.erp_px_cat_g1v2 from a missing extract", missing.count())
    steps.add("bronze.erp_loc_a101 previewed", warehouse.preview("bronze", "erp_loc_a101").count())
    try:
        warehouse.full_refresh(t.loc.limit(0), "bronze", "erp_loc_a101", require_rows=True)
    except ValueError:
        steps.add("bronze.erp_loc_a101 refused as empty", warehouse.read("bronze", "erp_loc_a101").count())
    built = run_named(warehouse, "silver", "erp_loc_a101")
    steps.add("silver.erp_loc_a101 by name", warehouse.full_refresh(built, "silver", "erp_loc_a101").count())
    name = warehouse.table_name("silver", "erp_loc_a101")
    for row in warehouse.query(f"SELECT cntry, count(*) AS n FROM {name} GROUP BY cntry").collect():
        steps.add(f"silver.erp_loc_a101 by statement, {row['cntry']}", row["n"])
    empty = warehouse.full_refresh(t.loc.limit(0), "bronze", "erp_loc_a101")
    steps.add("bronze.erp_loc_a101 refreshed with nothing", empty.count())
    _leave(t, warehouse)
    return steps.to_df(t.spark)


@query()
def run_snapshots(t: Tables) -> DataFrame:
    """Two runs of two tables that fit together only within a run; a reader keeps the first while the second is published."""
    warehouse, readers = _own_store(t), []
    customers, orders = t.table("customer").select("c_custkey", "c_nationkey"), t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for status in ("F", "O"):
        staged = warehouse.begin()
        fact = staged.write(orders.filter(F.col("o_orderstatus") == status), "gold", "lines")
        staged.write(customers.join(fact, F.col("c_custkey") == F.col("o_custkey"), "left_semi"), "gold", "buyers")
        readers.append(staged.publish())
    text = """SELECT '{stage}' AS stage, o_orderstatus, c_nationkey, count(*) AS order_lines
        FROM {gold_lines} LEFT JOIN {gold_buyers} ON c_custkey = o_custkey GROUP BY ALL"""
    found = [run.query(text.replace("{stage}", stage)) for stage, run in (("kept", readers[0]), ("current", warehouse.run()), ("before", warehouse.run(1)))]
    stored = materialize(_union(*found), "snapshots").df
    _leave(t, warehouse)
    return stored


# --- one row per key


@query()
def keep_first_orders(t: Tables) -> DataFrame:
    return keep_first(t.table("orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


@query()
def keep_last_orders(t: Tables) -> DataFrame:
    return keep_first(t.table("orders"), "o_custkey", ["o_orderdate", "o_orderkey"], keep="last")


# --- cleaning expressions


@query()
def trim_names(t: Tables) -> DataFrame:
    trimmed = trim_columns(t.cust, "cst_firstname", "cst_lastname")
    return trimmed.select("cst_key", "cst_create_date", "cst_firstname", "cst_lastname")


def _standardized(df: DataFrame, key: str, column: str, mapping: dict[str, str], **options) -> DataFrame:
    return df.select(
        key, F.col(column).alias("raw"), standardize_codes(column, mapping, **options).alias("standardized")
    )


@query()
def standardize_marital(t: Tables) -> DataFrame:
    return _standardized(t.cust, "cst_key", "cst_marital_status", codes.MARITAL_STATUS)


@query()
def standardize_gender(t: Tables) -> DataFrame:
    return _standardized(t.cust, "cst_key", "cst_gndr", codes.GENDER)


@query()
def standardize_product_line(t: Tables) -> DataFrame:
    return _standardized(t.prd, "prd_id", "prd_line", codes.PRODUCT_LINE)


@query()
def standardize_gender_words(t: Tables) -> DataFrame:
    return _standardized(t.az, "cid", "gen", codes.GENDER_WORDS)


@query()
def standardize_country(t: Tables) -> DataFrame:
    return _standardized(t.loc, "cid", "cntry", codes.COUNTRY, upper=False, passthrough=True)


@query()
def clean_location_key(t: Tables) -> DataFrame:
    return t.loc.select(F.col("cid").alias("raw"), remove_chars("cid").alias("cid"))


@query("sentinel_timestamp")
def _sentinel_timestamps(t: Tables) -> DataFrame:
    created = sentinel_timestamp("cst_create_date", codes.CREATE_DATE_DEFAULT)
    return t.cust.select("cst_key", F.col("cst_create_date").alias("raw"), created.alias("created"))


@query("split_product_key")
def _product_key_parts(t: Tables) -> DataFrame:
    category, key = split_product_key("prd_key")
    return t.prd.select("prd_id", category.alias("cat_id"), key.alias("prd_key"))


@query("numeric_default")
def _numeric_defaults(t: Tables) -> DataFrame:
    return t.prd.select("prd_id", numeric_default("prd_cost").alias("prd_cost"))


@query()
def parse_int_dates(t: Tables) -> DataFrame:
    return t.sales.select(
        "sls_ord_num",
        yyyymmdd_to_timestamp("sls_order_dt", codes.ORDER_DATE_DEFAULT).alias("sls_order_dt"),
        yyyymmdd_to_timestamp("sls_ship_dt", codes.SHIP_DATE_DEFAULT).alias("sls_ship_dt"),
        yyyymmdd_to_timestamp("sls_due_dt", codes.DUE_DATE_DEFAULT).alias("sls_due_dt"),
    )


@query("reconcile_amounts")
def _reconciled_amounts(t: Tables) -> DataFrame:
    amount, price = reconcile_amounts("sls_sales", "sls_quantity", "sls_price")
    return t.sales.select("sls_ord_num", amount.alias("sls_sales"), "sls_quantity", price.alias("sls_price"))


@query("strip_prefix")
def _stripped_prefix(t: Tables) -> DataFrame:
    return t.az.select(
        F.col("cid").alias("raw"),
        strip_prefix("cid").alias("cid"),
        strip_prefix("cid", only_if_prefix="NAS").alias("cid_if_prefixed"),
    )


@query("null_future_dates")
def _future_dates(t: Tables) -> DataFrame:
    return t.az.select("cid", null_future_dates("bdate", AS_OF).alias("bdate"))


@query("prefer_master")
def _preferred_gender(t: Tables) -> DataFrame:
    joined = lookup_join(t.silver_cust, t.silver_az, "cst_key", "cid")
    return joined.select("cst_key", "cst_gndr", "gen", prefer_master("cst_gndr", "gen").alias("gender"))


# --- operators over a whole order


@query("running_max_fill")
def _running_max(t: Tables) -> DataFrame:
    filled = running_max_fill(t.prd, "prd_start_dt", "prd_id", default=codes.START_DATE_DEFAULT)
    return filled.select("prd_id", "prd_nm", "prd_start_dt")


@query("version_end_date")
def _next_versions(t: Tables) -> DataFrame:
    versions = t.prd.select("prd_id", "prd_key", "prd_start_dt")
    return version_end_date(versions, "prd_key", "prd_start_dt", "next_start", tiebreak=["prd_id"])


@query()
def surrogate_key_customer(t: Tables) -> DataFrame:
    return surrogate_key(t.table("customer"), ["c_custkey"], "customer_key")


@query()
def surrogate_key_part(t: Tables) -> DataFrame:
    return surrogate_key(t.table("part"), ["p_type", "p_partkey"], "part_key")


@query()
def surrogate_key_lineitem(t: Tables) -> DataFrame:
    return surrogate_key(t.table("lineitem").select("l_orderkey").distinct(), ["l_orderkey"], "order_sk")


@query()
def surrogate_lookup(t: Tables) -> DataFrame:
    customers = t.table("customer").select("c_custkey", "c_acctbal")
    # customers in debt are left out, so that some orders find no key
    known = surrogate_key(customers.filter("c_acctbal >= 0"), ["c_custkey"], "customer_key")
    orders = t.table("orders").select("o_orderkey", "o_custkey")
    return lookup_key(orders, known, "o_custkey", "c_custkey", "customer_key")


# --- table builds


@query()
def silver_customers(t: Tables) -> DataFrame:
    return t.silver_cust


@query()
def silver_products(t: Tables) -> DataFrame:
    return t.silver_prd


@query()
def silver_sales(t: Tables) -> DataFrame:
    return t.silver_sales


@query()
def silver_erp_customers(t: Tables) -> DataFrame:
    return t.silver_az


@query()
def silver_locations(t: Tables) -> DataFrame:
    return t.silver_loc


@query()
def silver_categories(t: Tables) -> DataFrame:
    return t.silver_px


@query()
def gold_customers(t: Tables) -> DataFrame:
    return gold.dim_customers(t.silver_cust, t.silver_az, t.silver_loc)


@query()
def gold_products(t: Tables) -> DataFrame:
    return gold.dim_products(t.silver_prd, t.silver_px)


@query()
def gold_sales(t: Tables) -> DataFrame:
    return t.fact


@query()
def gold_flat_sales(t: Tables) -> DataFrame:
    return gold.flat_sales(t.fact, t.dim_products, t.dim_customers)


@query()
def gold_sales_by_category(t: Tables) -> DataFrame:
    return gold.sales_by_category(t.fact, t.dim_products)


@query()
def gold_sales_by_country_month(t: Tables) -> DataFrame:
    return gold.sales_by_country_month(t.fact, t.dim_customers)


# --- quality checks


@query()
def dq_pk_customer(t: Tables) -> DataFrame:
    return _union(
        _at("bronze", unique_not_null(t.cust, "cst_id")), _at("silver", unique_not_null(t.silver_cust, "cst_id"))
    )


@query()
def dq_pk_product(t: Tables) -> DataFrame:
    products = t.silver_prd.withColumn("prd_id", F.col("prd_id").cast("string"))
    return _union(
        _at("product", unique_not_null(products, "prd_id").withColumnRenamed("prd_id", "id")),
        _at("number", unique_not_null(products, "prd_key").withColumnRenamed("prd_key", "id")),
    )


def _checked_key(checked: str, df: DataFrame, key: str) -> DataFrame:
    return unique_not_null(df, key).select(F.lit(checked).alias("checked"), F.col(key).alias("value"), "copies")


@query()
def dq_pk_dim_customer(t: Tables) -> DataFrame:
    return _union(
        _checked_key("customer_key", t.dim_customers, "customer_key"),
        _checked_key("fact.customer_key", t.fact, "customer_key"),
    )


@query()
def dq_pk_dim_product(t: Tables) -> DataFrame:
    return _union(
        _checked_key("product_key", t.dim_products, "product_key"),
        _checked_key("fact.product_key", t.fact, "product_key"),
    )


@query()
def dq_domain_marital(t: Tables) -> DataFrame:
    column, domain = "cst_marital_status", codes.MARITAL_DOMAIN
    return _union(
        _at("bronze", in_domain(t.cust, column, domain)), _at("silver", in_domain(t.silver_cust, column, domain))
    )


@query()
def dq_domain_line(t: Tables) -> DataFrame:
    column, domain = "prd_line", codes.LINE_DOMAIN
    return _union(
        _at("bronze", in_domain(t.prd, column, domain)), _at("silver", in_domain(t.silver_prd, column, domain))
    )


@query()
def dq_domain_country(t: Tables) -> DataFrame:
    column, domain = "cntry", codes.COUNTRY_DOMAIN
    return _union(
        _at("bronze", in_domain(t.loc, column, domain)), _at("silver", in_domain(t.silver_loc, column, domain))
    ).orderBy("stage", column)


@query()
def dq_cost(t: Tables) -> DataFrame:
    products = t.silver_prd.withColumn("prd_id", F.col("prd_id").cast("string"))
    return _union(
        _at("bronze", non_negative(t.prd, "prd_cost", "prd_id")),
        _at("silver", non_negative(products, "prd_cost", "prd_id")),
    )


@query()
def dq_date_int_range(t: Tables) -> DataFrame:
    return _union(
        *[
            valid_date_int(t.sales, column, codes.DATE_INT_RANGE, "sls_ord_num").select(
                F.lit(column).alias("date_column"),
                "sls_ord_num",
                F.col(column).cast("bigint").alias("date_number"),
            )
            for column in ("sls_order_dt", "sls_due_dt")
        ]
    )


def _orphans(t: Tables, strict: bool) -> DataFrame:
    # a fact that is older than its dimensions: some rows of these are gone
    dimensions = {
        "customer_key": (t.dim_customers.filter("customer_id % 10 <> 4"), "customer_key"),
        "product_key": (t.dim_products.filter("product_id % 10 <> 4"), "product_key"),
    }
    return orphan_keys(t.fact, dimensions, strict)


@query()
def dq_orphans(t: Tables) -> DataFrame:
    return _orphans(t, strict=False)


@query()
def dq_orphans_strict(t: Tables) -> DataFrame:
    return _orphans(t, strict=True)


@query()
def dq_bitmap_keys(t: Tables) -> DataFrame:
    """Keys that fill their range: unique ones, and one that repeats."""
    keys = {"orders": ("o_orderkey", True), "customer": ("c_custkey", True), "part": ("p_partkey", True), "lineitem": ("l_orderkey", False)}
    return dq_report([Check(f"{column}_unique", name, rows=t.table(name), key=column, not_null=known) for name, (column, known) in keys.items()])


@query()
def dq_bitmap_orphans(t: Tables) -> DataFrame:
    """Order lines against dimensions of whole numbers, one of them without the pending orders."""
    dimensions = {
        "l_orderkey": (t.table("orders").filter("o_orderstatus <> 'P'"), "o_orderkey"),
        "l_partkey": (t.table("part"), "p_partkey"),
    }
    return orphan_keys(t.table("lineitem"), dimensions, strict=True)


@query()
def dq_unparsed_dates(t: Tables) -> DataFrame:
    tables = {"crm_sales_details": (t.sales, "sls_ord_num"), "crm_cust_info": (t.cust, "cst_key"), "erp_cust_az12": (t.az_first, "cid")}
    parts = []
    for table, column, parsed in parsed_dates().values():
        df, key = tables[table]
        found = unparsed(df, column, parsed, key)
        record, value = F.col(key).cast("string"), F.col(column).cast("string")
        parts.append(found.select(F.lit(column).alias("date_column"), record.alias("record_key"), value.alias("value")))
    return _union(*parts)


@query()
def dq_lookup_fanout(t: Tables) -> DataFrame:
    """Two ids of the extract that are one after the prefix is cut."""
    twins = t.table("customer").filter("c_custkey % 100 = 50")
    twins = twins.select(F.concat(F.lit("XYZAW"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("cid"))
    twins = twins.select("cid", F.lit("1970-01-01").alias("bdate"), F.lit("F").alias("gen"))
    return repeated_keys(silver.silver_erp_customers(t.az_first.unionByName(twins), AS_OF), "cid")


def _bronze(t: Tables) -> dict[str, DataFrame]:
    return {
        "crm_cust_info": t.cust,
        "crm_prd_info": t.prd,
        "crm_sales_details": t.sales,
        "erp_cust_az12": t.az_first,
        "erp_loc_a101": t.loc,
        "erp_px_cat_g1v2": t.px,
    }


@query("dq_report")
def _quality_report(t: Tables) -> DataFrame:
    # the checks read the layers up to the star schema, not the reports made from it
    tables = build_layers(_bronze(t), AS_OF, [*[("silver", name) for name in SILVER], ("gold", "fact_sales")])
    return dq_report(store_checks(lambda layer, table: tables[layer, table]))


# --- the whole run, from CSV extracts to the checked store


def _refreshed(t: Tables) -> tuple[Warehouse, RunResult]:
    folder = scratch_path(t.spark, "extracts")
    frames = _bronze(t) | {"erp_cust_az12": _az_in_file_order(t)}
    together(t.spark, lambda s: _write_csv(frames[s.table], f"{folder}/{s.path}"), SOURCES.values())
    warehouse = _own_store(t)
    return warehouse, run_refresh(t.spark, folder, warehouse, as_of=AS_OF, run_ts=RUN_TS)


@query()
def refresh_fact_sales(t: Tables) -> DataFrame:
    warehouse, _ = _refreshed(t)
    fact = materialize(warehouse.read("gold", "fact_sales"), "fact", CODEC).df
    _leave(t, warehouse)
    return fact


@query()
def refresh_step_counts(t: Tables) -> DataFrame:
    warehouse, result = _refreshed(t)
    _leave(t, warehouse)
    return result.report.to_df(t.spark)


@query()
def refresh_manifest(t: Tables) -> DataFrame:
    warehouse, _ = _refreshed(t)
    manifest = t.spark.table(warehouse.table_name("gold", MANIFEST)).filter("age = 0").select("layer", "name", "rows")
    stored = materialize(manifest, "manifest").df
    _leave(t, warehouse)
    return stored
