"""Dirty bronze tables derived from the shared test tables.

Each text is one SELECT valid in Spark SQL and in the checking engine; ``{customer}`` and the like stand for
the source tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

B_CUST = """
SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_custkey END AS cst_id,
 'AW' || lpad(cast(c_custkey as string),8,'0') AS cst_key, '  ' || c_mktsegment || ' ' AS cst_firstname, ' ' || c_name AS cst_lastname,
 CASE c_custkey % 5 WHEN 0 THEN 'S' WHEN 1 THEN 'm ' WHEN 2 THEN ' M' WHEN 3 THEN 'x' END AS cst_marital_status,
 CASE c_nationkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN ' m' WHEN 2 THEN '' END AS cst_gndr,
 CASE WHEN c_custkey % 13 = 0 THEN 'NaN' WHEN c_custkey % 29 = 0 THEN 'soon' WHEN c_custkey % 31 = 0 THEN '2025-03-05' WHEN c_custkey % 37 = 0 THEN NULL
  ELSE '2025-01-' || lpad(cast(c_custkey % 28 + 1 as string),2,'0') || ' 00:00:00' END AS cst_create_date
FROM {customer}
UNION ALL
SELECT c_custkey, 'AW' || lpad(cast(c_custkey as string),8,'0'), 'LATE', c_name, 'M', 'F', '2025-11-01 00:00:00' FROM {customer} WHERE c_custkey % 10 = 3
"""

B_AZ = """
SELECT CASE WHEN c_custkey < 10 THEN 'A' || cast(c_custkey as string) WHEN c_custkey % 2 = 0 THEN 'NASAW' || lpad(cast(c_custkey as string),8,'0')
  ELSE 'AW' || lpad(cast(c_custkey as string),8,'0') END AS cid,
 CASE WHEN c_custkey % 43 = 0 THEN 'unknown' ELSE cast(1940 + c_custkey % 100 as string) || '-06-15' END AS bdate,
 CASE c_custkey % 6 WHEN 0 THEN 'F' WHEN 1 THEN 'Female ' WHEN 2 THEN 'male' WHEN 3 THEN 'M' WHEN 4 THEN '' END AS gen, 0 AS ord FROM {customer}
UNION ALL
SELECT CASE WHEN c_custkey < 10 THEN 'A' || cast(c_custkey as string) WHEN c_custkey % 2 = 0 THEN 'NASAW' || lpad(cast(c_custkey as string),8,'0')
  ELSE 'AW' || lpad(cast(c_custkey as string),8,'0') END, '1900-01-01', 'M', 1 FROM {customer} WHERE c_custkey % 7 = 0
"""

B_LOC = """
SELECT 'AW-' || lpad(cast(c_custkey as string),8,'0') AS cid,
 CASE c_nationkey % 8 WHEN 0 THEN 'DE' WHEN 1 THEN 'US' WHEN 2 THEN ' USA ' WHEN 3 THEN '' WHEN 4 THEN 'France ' WHEN 5 THEN 'Australia' WHEN 6 THEN '  ' END AS cntry
FROM {customer} WHERE c_custkey % 11 <> 0
"""

B_PRD = """
SELECT cast(p_partkey as string) AS prd_id,
 substr(p_type,1,2) || '-B' || cast(p_partkey % 5 as string) || '-' || 'P' || lpad(cast(p_partkey - p_partkey % 2 as string),6,'0') AS prd_key,
 p_name AS prd_nm, CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN cast('NaN' as double) WHEN p_partkey % 23 = 0 THEN -p_retailprice ELSE p_retailprice END AS prd_cost,
 CASE p_size % 6 WHEN 0 THEN 'M' WHEN 1 THEN 'r ' WHEN 2 THEN ' S' WHEN 3 THEN 't' WHEN 4 THEN 'Z' END AS prd_line,
 CASE WHEN p_partkey % 19 = 0 THEN 'NaN' ELSE cast(2003 + p_partkey % 11 as string) || '-07-01 00:00:00' END AS prd_start_dt,
 CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE '2014-06-30 00:00:00' END AS prd_end_dt FROM {part}
"""

B_PX = """
SELECT DISTINCT substr(p_type,1,2) || '_B' || cast(p_partkey % 5 as string) AS id, p_type AS cat, p_type || ' B' || cast(p_partkey % 5 as string) AS subcat,
 CASE WHEN p_partkey % 5 < 2 THEN 'Yes' ELSE 'No' END AS maintenance FROM {part} WHERE p_type <> 'PROMO'
"""

B_SALES = """
SELECT 'SO' || cast(l_orderkey as string) AS sls_ord_num, 'P' || lpad(cast(l_partkey - l_partkey % 2 as string),6,'0') AS sls_prd_key,
 CASE WHEN l_orderkey % 101 = 0 THEN -1 ELSE o_custkey END AS sls_cust_id,
 CASE WHEN l_orderkey % 50 = 0 THEN 0 WHEN l_orderkey % 53 = 0 THEN 32154 WHEN l_orderkey % 59 = 0 THEN NULL ELSE year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate) END AS sls_order_dt,
 year(l_shipdate)*10000+month(l_shipdate)*100+day(l_shipdate) AS sls_ship_dt,
 CASE WHEN l_orderkey % 61 = 0 THEN 20101399 ELSE year(l_shipdate)*10000+month(l_shipdate)*100+day(l_shipdate) END AS sls_due_dt,
 CASE WHEN l_linenumber = 1 AND l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN -5.0 WHEN l_orderkey % 13 = 0 THEN 1.0 ELSE l_quantity * l_extendedprice END AS sls_sales,
 CASE WHEN l_orderkey % 67 = 0 THEN 0.0 ELSE l_quantity END AS sls_quantity,
 CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 19 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS sls_price
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""


class BronzeViews:
    """The bronze tables over one folder of test tables, each planned when first asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _derive(self, text: str, *tables: str) -> DataFrame:
        return self.spark.sql(text, **{name: self.table(name) for name in tables})

    @cached_property
    def cust(self) -> DataFrame:
        return self._derive(B_CUST, "customer")

    @cached_property
    def az(self) -> DataFrame:
        return self._derive(B_AZ, "customer")

    @cached_property
    def loc(self) -> DataFrame:
        return self._derive(B_LOC, "customer")

    @cached_property
    def prd(self) -> DataFrame:
        return self._derive(B_PRD, "part")

    @cached_property
    def px(self) -> DataFrame:
        return self._derive(B_PX, "part")

    @cached_property
    def sales(self) -> DataFrame:
        return self._derive(B_SALES, "lineitem", "orders")
