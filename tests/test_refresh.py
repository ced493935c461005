from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.oracle_check import actual, duck, expected
from tiermill.__main__ import main
from tiermill.plans.refresh import TABLES, run_named, run_refresh
from tiermill.sources.extracts import SOURCES
from tiermill.settings import settings
from tiermill.sources.warehouse import Warehouse
from validation.bronze_views import BronzeViews
from validation.oracles import AS_OF, RUN_TS, oracle

SMALL = "/root/testdata/sf0.001"


def write_extracts(views: BronzeViews, folder: str) -> None:
    """The bronze views as CSV parts, in file order, with missing cells written in different ways."""
    frames = {
        "cust_info": views.cust,
        "prd_info": views.prd,
        "sales_in": views.sales,
        "cust_az1": views.az.orderBy("ord").drop("ord"),
        "loc_a1": views.loc,
        "px_cat": views.px,
    }
    for name, df in frames.items():
        writer = df.write.option("header", True).option("nullValue", "NULL" if name == "loc_a1" else "")
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        writer.csv(f"{folder}/{SOURCES[name].path}")


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("extracts"))
    write_extracts(BronzeViews(spark, SMALL), folder)
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("store")), prefix="refresh_")
    result = run_refresh(spark, folder, warehouse, as_of=AS_OF, run_ts=RUN_TS)
    return folder, warehouse, result


def result_size(run, table):
    size = run[1].read("gold", table).count()
    assert size > 1
    return size


def test_row_counts(run):
    counts = dict(run[2].report.steps)
    assert counts == {
        "bronze.crm_cust_info": 165,
        "bronze.crm_prd_info": 200,
        "bronze.crm_sales_details": 6000,
        "bronze.erp_cust_az12": 150,
        "bronze.erp_loc_a101": 136,
        "bronze.erp_px_cat_g1v2": 25,
        "silver.crm_cust_info": 148,
        "silver.crm_prd_info": 200,
        "silver.crm_sales_details": 6000,
        "silver.erp_cust_az12": 150,
        "silver.erp_loc_a101": 136,
        "silver.erp_px_cat_g1v2": 25,
        "gold.dim_customers": 148,
        "gold.dim_products": 100,
        "gold.fact_sales": 6000,
        "gold.flat_sales": 6000,
        "gold.sales_by_category": result_size(run, "sales_by_category"),
        "gold.sales_by_country_month": result_size(run, "sales_by_country_month"),
    }


@pytest.mark.parametrize(
    ("layer", "table", "statement"),
    [
        ("silver", "erp_cust_az12", "silver_erp_customers"),
        ("silver", "erp_loc_a101", "silver_locations"),
        ("silver", "erp_px_cat_g1v2", "silver_categories"),
        ("silver", "crm_sales_details", "silver_sales"),
        ("silver", "crm_prd_info", "silver_products"),
        ("gold", "dim_products", "gold_products"),
    ],
)
def test_stored_tables_match_the_sql(run, layer, table, statement):
    stored = run[1].read(layer, table).drop("dwh_create_date")
    assert actual(stored) == expected(duck(SMALL), oracle(statement))


def test_missing_texts_are_null_after_landing(run):
    """The extract spells missing dates and costs ``NaN``: landed as NULL, unlike in the raw views."""
    bronze = run[1].read("bronze", "crm_cust_info")
    assert bronze.filter("cst_create_date = 'NaN'").isEmpty()
    assert bronze.filter("cst_create_date IS NULL").count() > 0
    assert run[1].read("bronze", "crm_prd_info").filter(F.isnan("prd_cost")).isEmpty()


def test_audit_column_is_in_silver_only(run):
    for spec in TABLES:
        columns = run[1].read(spec.layer, spec.name).columns
        assert columns == [*spec.columns, *(["dwh_create_date"] if spec.layer == "silver" else [])]


def test_fact_uses_dimensions_of_the_same_run(run):
    _, warehouse, result = run
    fact, customers = warehouse.read("gold", "fact_sales"), warehouse.read("gold", "dim_customers")
    unmatched = fact.filter("customer_key IS NOT NULL").join(customers, "customer_key", "left_anti")
    assert unmatched.isEmpty() and fact.filter("product_key IS NULL").isEmpty()
    passed = {r["check"]: r["passed"] for r in result.quality.collect()}
    assert len(passed) == 22  # rows without a key are counted for each of three extracts
    assert sorted(c for c, ok in passed.items() if not ok) == [
        "birth_date_parses",
        "cost_not_negative",
        "create_date_parses",
        "due_date_parses",
        "sales_orphans",
    ]
    lost = {r["check"]: r["violations"] for r in result.quality.collect()}["due_date_parses"]
    bronze, silver = warehouse.read("bronze", "crm_sales_details"), warehouse.read("silver", "crm_sales_details")
    assert lost == silver.filter("sls_due_dt IS NULL").count() - bronze.filter("sls_due_dt IS NULL").count() > 0


def test_named_build_repeats_the_stored_table(run):
    warehouse = run[1]
    for layer, name in (("silver", "crm_cust_info"), ("gold", "dim_customers"), ("gold", "fact_sales")):
        stored = warehouse.read(layer, name).drop("dwh_create_date")
        again = run_named(warehouse, layer, name, as_of=AS_OF)
        assert stored.exceptAll(again).isEmpty() and again.exceptAll(stored).isEmpty()
    with pytest.raises(KeyError):
        run_named(warehouse, "gold", "nothing")


def test_exact_amounts(spark, tmp_path):
    rows = {
        "cust_info": "1,AW1,a,b,S,M,2025-01-01 00:00:00",
        "prd_info": "1,AC-BR-P1,p,0.1,R,2010-07-01,",
        "sales_in": "SO1,P1,1,20101229,20110105,20110110,0.3,3,0.1\nSO2,P1,1,0,0,20110110,,3,0.1\nSO3,P1,1,0,0,20110110,1,3,",
        "cust_az1": "NASAW1,1970-01-01,F",
        "loc_a1": "AW-1,DE",
        "px_cat": "AC_BR,Accessories,Bike Racks,Yes",
    }
    for name, lines in rows.items():
        path = tmp_path / "x" / SOURCES[name].path
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(",".join(SOURCES[name].columns) + "\n" + lines + "\n")
    warehouse = Warehouse(spark, str(tmp_path / "store"), "exact_")
    result = run_refresh(spark, str(tmp_path / "x"), warehouse, as_of=AS_OF, measure="decimal(18,4)")
    assert all(r["passed"] for r in result.quality.collect())
    fact = warehouse.read("gold", "fact_sales")
    assert dict(fact.dtypes)["sales_amount"] == "decimal(18,4)"
    # in binary floating point three times 0.1 is not 0.3
    assert [tuple(r) for r in fact.orderBy("order_number").select("sales_amount", "price").collect()] == [
        (Decimal("0.3"), Decimal("0.1")),
        (Decimal("0.3"), Decimal("0.1")),
        (Decimal("1"), Decimal("0.3333")),
    ]
    assert warehouse.read("gold", "dim_products").first()["cost"] == Decimal("0.1")
    customer = warehouse.read("gold", "dim_customers").first()
    assert (customer["country"], customer["gender"]) == ("Germany", "Male")


def test_command_line(spark, run, tmp_path, capsys):
    folder = run[0]
    store, options = str(tmp_path / "store"), ["--prefix", "cli_", "--as-of", AS_OF]
    main([folder, store, *options])
    assert "gold.fact_sales" in capsys.readouterr().out
    assert Warehouse(spark, store, "cli_").read("gold", "fact_sales").count() == 6000
    with pytest.raises(ValueError, match="sales_orphans"):
        main([folder, store, *options, "--enforce"])


def test_second_run_gives_the_same_keys_and_failed_checks_delete_nothing(spark, run):
    folder, warehouse, _ = run
    before = warehouse.read("gold", "dim_customers").orderBy("customer_key").collect()
    reader = spark.read.parquet(warehouse.location("gold", "dim_customers"))
    with pytest.raises(ValueError, match="sales_orphans on gold.fact_sales"):
        run_refresh(spark, folder, warehouse, as_of=AS_OF, run_ts=RUN_TS, enforce_quality=True)
    assert warehouse.read("gold", "dim_customers").orderBy("customer_key").collect() == before
    assert reader.orderBy("customer_key").collect() == before
    assert warehouse.drop_superseded("gold", "dim_customers") == 0
    assert warehouse.drop_superseded("gold", "dim_customers", keep=0) == 1
    assert warehouse.read("gold", "dim_customers").count() == len(before)


def test_settings_are_put_back(spark):
    names = ("spark.sql.ansi.enabled", "spark.sql.sources.fileCompressionFactor")
    before = [spark.conf.get(name, None) for name in names]
    with settings(spark):
        assert spark.conf.get("spark.sql.sources.fileCompressionFactor") == "4.0"
    assert [spark.conf.get(name, None) for name in names] == before


def switched(spark, tmp_path, prefix):
    warehouse = Warehouse(spark, str(tmp_path / "store"), prefix).init()
    warehouse.full_refresh(spark.range(3).select("id"), "gold", "t")
    return warehouse


def test_switch_moves_the_location_only(spark, tmp_path, monkeypatch):
    warehouse = switched(spark, tmp_path, "moved_")
    monkeypatch.setattr(type(spark.catalog), "createTable", None)
    assert warehouse.full_refresh(spark.range(5).select("id"), "gold", "t").count() == 5


def test_failed_switch_keeps_the_table(spark, tmp_path, monkeypatch):
    warehouse = switched(spark, tmp_path, "kept_")

    def fail(*args, **kwargs):
        raise RuntimeError("no catalog")

    wider = spark.range(7).select("id", F.lit("x").alias("more"))
    with monkeypatch.context() as patched:
        patched.setattr(type(spark.catalog), "createTable", fail)
        with pytest.raises(RuntimeError, match="no catalog"):
            warehouse.full_refresh(wider, "gold", "t")
    assert warehouse.read("gold", "t").count() == 3
    assert warehouse.full_refresh(wider, "gold", "t").columns == ["id", "more"]
    assert warehouse.read("gold", "t").count() == 7 and not warehouse.exists("gold", "t__before")


DIRTY = {
    "cust_info": "1,AW1,a,b,S,M,soon",
    "prd_info": "1,AC-BR-P1,p,-2,R,2010-07-01,",
    "sales_in": "SO1,P1,1,20101399,20110105,20110110,0.3,3,0.1",
    "cust_az1": "NASAW1,unknown,F\nXYZAW1,1970-01-01,M\n,1970-01-01,M",
    "loc_a1": "AW-1,DE",
    "px_cat": "AC_BR,Accessories,Bike Racks,Yes",
}


def test_what_is_lost_or_multiplied_is_reported(spark, tmp_path):
    for name, lines in DIRTY.items():
        path = tmp_path / "x" / SOURCES[name].path
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(",".join(SOURCES[name].columns) + "\n" + lines + "\n")
    result = run_refresh(spark, str(tmp_path / "x"), Warehouse(spark, str(tmp_path / "s"), "dirty_"), as_of=AS_OF)
    failed = {r["check"]: r["violations"] for r in result.quality.filter("not passed").collect()}
    assert failed == dict.fromkeys(
        [
            "birth_date_parses",
            "cost_not_negative",
            "create_date_parses",
            "customer_lookup_unique",
            "demographics_lookup_unique",
            "fact_rows_as_sales",
            "order_date_parses",
            "rows_have_keys",
        ],
        1,
    )
    for option in ({"on_invalid": "error"}, {"on_null_key": "fail"}):
        with pytest.raises(Exception, match="not a|NULL in key"):
            run_refresh(spark, str(tmp_path / "x"), Warehouse(spark, str(tmp_path / "e"), "error_"), as_of=AS_OF, **option)


def test_empty_extract_stops_the_run_and_keeps_the_store(spark, run, tmp_path):
    _, warehouse, _ = run
    with pytest.raises(FileNotFoundError):
        run_refresh(spark, str(tmp_path), warehouse, as_of=AS_OF)
    with pytest.raises(ValueError, match="silver.* would have no rows"):
        run_refresh(spark, str(tmp_path), warehouse, as_of=AS_OF, on_missing="empty")
    assert warehouse.read("silver", "crm_cust_info").count() == 148
