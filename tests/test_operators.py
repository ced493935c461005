from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tiermill.operators import (
    Check,
    conform,
    dq_report,
    enforce,
    in_domain,
    keep_first,
    lookup_join,
    lookup_key,
    non_negative,
    orphan_keys,
    repeated_keys,
    require_key,
    require_non_empty,
    row_difference,
    stamp,
    unique_not_null,
    unparsed,
    valid_date_int,
)
from tiermill.operators.quality import missing_or_negative, rows_where, values_outside


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_keep_first_takes_the_earliest_text(spark):
    df = spark.createDataFrame(
        [(1, "2025-02-01", "a"), (1, "2025-01-01", "b"), (1, "NaN", "c"), (2, None, "d"), (2, "NaN", "e")],
        "id int, created string, v string",
    )
    assert rows(keep_first(df, "id", ["created"])) == [(1, "2025-01-01", "b"), (2, "NaN", "e")]
    assert rows(keep_first(df, "id", ["created"], keep="last")) == [(1, "NaN", "c"), (2, None, "d")]
    with pytest.raises(ValueError, match="keep"):
        keep_first(df, "id", ["created"], keep="any")


def test_keep_first_breaks_ties_by_the_other_columns(spark):
    data = [(1, "x", v) for v in ("c", "a", "b")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "id int, created string, v string").repartition(3)
        assert rows(keep_first(df, "id", ["created"])) == [(1, "x", "a")]


def test_keep_first_limits_a_hot_key_before_the_shuffle(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("o")
    )
    kept = keep_first(df, "k", ["o"])
    assert kept.count() == 20_000 + 1 - 0 and kept.filter("k = 0").first()["o"] == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_require_key(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "k int, w string")
    assert rows(require_key(df, "k")) == [(1, "a"), (2, None)]
    assert rows(require_key(df, "k", "w")) == [(1, "a")]
    with pytest.raises(Exception, match="NULL in key column k"):
        require_key(df, "k", on_null="fail").collect()
    assert require_key(df.filter("k = 1"), "k", on_null="fail").count() == 1


def test_conform(spark):
    df = spark.createDataFrame([("1", "2.5", "2025-01-02"), ("20101229.0", None, None)], "a string, b string, c string")
    got = conform(df, {"c": "date", "a": "bigint", "b": "double"})
    assert got.dtypes == [("c", "date"), ("a", "bigint"), ("b", "double")]
    assert rows(got) == rows(spark.createDataFrame([(dt.date(2025, 1, 2), 1, 2.5), (None, 20101229, None)], "c date, a bigint, b double"))
    bad = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="not a whole number: x"):
        conform(bad, {"a": "bigint"}).collect()
    assert conform(bad, {"a": "bigint"}, strict=False).first()[0] is None
    for text in ("1.5", "20101229.0000004", "1.0000000000000000000000001", "99999999999999999999", "1e3"):
        fraction = spark.createDataFrame([(text,)], "a string")
        with pytest.raises(Exception, match="not a whole number: " + text):
            conform(fraction, {"a": "bigint"}).collect()
        assert conform(fraction, {"a": "bigint"}, strict=False).first()[0] is None
    whole = spark.createDataFrame([(" -7. ",), ("+20101229.000",), (None,)], "a string")
    assert rows(conform(whole, {"a": "int"})) == [(-7,), (20101229,), (None,)]


def test_stamp_is_one_constant(spark):
    got = stamp(spark.range(3), dt.datetime(2025, 10, 8, 6, 0)).select("dwh_create_date").distinct().collect()
    assert [r[0] for r in got] == [dt.datetime(2025, 10, 8, 6, 0)]


def test_require_non_empty(spark):
    assert require_non_empty(spark.range(1), "x").count() == 1
    with pytest.raises(ValueError, match="x has no rows"):
        require_non_empty(spark.range(0), "x")


def test_lookups(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "code string, n int")
    dim = spark.createDataFrame([("a", 10), ("c", 30), (None, 40)], "code string, sk int")
    assert rows(lookup_key(fact, dim, "code", "code", "sk")) == [("a", 1, 10), ("b", 2, None), (None, 3, None)]
    twice = dim.union(dim)
    assert lookup_join(fact, twice, "code", "code").count() == 4
    with pytest.raises(ValueError, match="not unique"):
        lookup_join(fact, twice, "code", "code", assert_unique=True)
    # NULL keys never match, so repeated NULLs are harmless
    nulls = dim.union(dim.filter("code IS NULL"))
    assert lookup_join(fact, nulls, "code", "code", assert_unique=True).count() == 3


def test_unique_not_null(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows(unique_not_null(df, "k")) == [(1, 2), (None, 1)]


def test_in_domain(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "v string")
    assert rows(in_domain(df, "v", ["a"])) == [("b",), (None,)]
    assert rows(in_domain(df, "v", ["a", "b"])) == [(None,)]


def test_non_negative(spark):
    df = spark.createDataFrame([(1, 0.0), (2, -1.0), (3, None), (4, math.nan)], "id int, v double")
    assert rows(non_negative(df, "v", "id")) == [(2, -1.0), (3, None)]


@pytest.mark.parametrize("number", [20101229, 19000101, 20500101, None])
def test_valid_date_int_passes(spark, number):
    df = spark.createDataFrame([(number,)], "d bigint")
    assert valid_date_int(df, "d", (19000101, 20500101)).isEmpty()


@pytest.mark.parametrize("number", [0, -20101229, 32154, 20500102, 19000100, 201012290])
def test_valid_date_int_reports(spark, number):
    df = spark.createDataFrame([(number,)], "d bigint")
    assert valid_date_int(df, "d", (19000101, 20500101)).first()[0] == (number or None)


@pytest.mark.parametrize("bounds", [(0, 20500101), (20500101, 19000101), (19000101, 205001011)])
def test_date_bounds_have_eight_digits(spark, bounds):
    with pytest.raises(ValueError, match="eight digits"):
        valid_date_int(spark.createDataFrame([(1,)], "d bigint"), "d", bounds)


def test_lookup_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(repeated_keys(df, "k")) == [("a", 2)]
    assert row_difference(df, df).isEmpty()
    assert rows(row_difference(df, df.limit(2))) == [(5, 2)]
    dates = spark.createDataFrame([("2020-01-01",), ("x",), (None,)], "d string")
    assert rows(unparsed(dates, "d", F.col("d").try_cast("date"))) == [("x",)]


def test_checks_of_one_table_together(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", -1.0), ("z", None), (None, 2.0)], "k string, v double").write.parquet(path)
    df = spark.read.parquet(path)
    report = dq_report(
        [
            Check("domain", "t", rows=df, count=values_outside("k", ["a"])),
            Check("positive", "t", rows=df, count=rows_where(missing_or_negative("v"))),
            Check("unique", "t", unique_not_null(df, "k")),
        ]
    )
    assert rows(report) == [("domain", "t", 2, False), ("positive", "t", 2, False), ("unique", "t", 1, False)]
    empty = df.limit(0)
    assert rows(dq_report([Check("domain", "t", rows=empty, count=values_outside("k", ["a"]))])) == [("domain", "t", 0, True)]


def test_orphans(spark):
    customers = spark.createDataFrame([(1,), (2,)], "customer_key int")
    products = spark.createDataFrame([(7,), (8,), (8,)], "product_key int")
    fact = spark.createDataFrame(
        [(1, 7), (1, 8), (1, 99), (2, 98), (2, 98), (None, 7), (9, 8)], "customer_key int, product_key int"
    )
    dims = {"customer_key": (customers, "customer_key"), "product_key": (products, "product_key")}
    # a lone orphan with both keys is not reported; (9, 8) counts twice because product 8 is doubled
    assert rows(orphan_keys(fact, dims)) == [(2, 98, 2), (9, 8, 2), (None, 7, 1)]
    assert rows(orphan_keys(fact, dims, strict=True)) == [(1, 99, 1), (2, 98, 2), (9, 8, 2), (None, 7, 1)]


def test_orphans_count_as_the_plain_join_does(spark):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 40).alias("c"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 13).alias("p"),
    )
    customers = spark.range(30).select(F.col("id").alias("ck")).union(spark.range(3))
    products = spark.range(1, 12).select(F.col("id").alias("pk"))
    plain = (
        fact.join(customers, F.col("c") == F.col("ck"), "left")
        .join(products, F.col("p") == F.col("pk"), "left")
        .filter("ck IS NULL OR pk IS NULL")
        .groupBy("c", "p")
        .agg(F.count("*").alias("copies"))
    )
    got = orphan_keys(fact, {"c": (customers, "ck"), "p": (products, "pk")}, strict=True)
    assert rows(got) == rows(plain)


def test_report_runs_all_checks_before_it_fails(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    report = dq_report(
        [
            Check("unique", "t", unique_not_null(df, "k")),
            Check("fine", "t", unique_not_null(df.distinct().filter("k = 1"), "k")),
            Check("positive", "u", non_negative(df, "k")),
        ]
    )
    assert rows(report) == [("fine", "t", 0, True), ("positive", "u", 1, False), ("unique", "t", 2, False)]
    with pytest.raises(ValueError, match=r"positive on u \(1\), unique on t \(2\)"):
        enforce(report)
    enforce(report.filter("passed"))
