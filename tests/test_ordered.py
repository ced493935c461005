from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tiermill.operators import ordered
from tiermill.operators.ordered import running_max_fill, surrogate_key, version_end_date

HOT = 0.34


@pytest.fixture(scope="module")
def versions(spark):
    """Versions of many keys; one key holds a third of the rows, many of them exact copies."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, 6000, 1, 7).select(
        F.when(hot, "hot").when(F.col("id") % 41 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))
        ).alias("key"),
        F.when(F.col("id") % 17 == 0, F.lit(None))
        .when(hot, F.lit("2010"))
        .otherwise((2000 + F.pmod(F.xxhash64("id"), F.lit(12))).cast("string"))
        .alias("start"),
        F.when(hot, 0).otherwise(F.col("id") % 7).alias("tie"),
    )


def same(left, right):
    assert left.columns == right.columns
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture(autouse=True, params=[8, 1, 23])
def parts(request, spark):
    """The same results over any number of ranges, more than rows included."""
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_surrogate_key_equals_global_row_number(spark):
    df = spark.range(0, 5000, 1, 6).select(
        F.when(F.col("id") % 9 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(40))).alias("a"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("ä"), F.col("id"))).alias("b"),
        F.col("id"),
    )
    window = Window.orderBy(F.asc_nulls_last("a"), F.asc_nulls_last("b"), "id")
    expected = df.select(F.row_number().over(window).cast("bigint").alias("sk"), "*")
    same(surrogate_key(df, ["a", "b", "id"], "sk"), expected)


@pytest.mark.parametrize(
    "column",
    [
        "timestamp_micros(1700000000000000 + id)",
        "cast(timestamp_micros(1700000000000000 + id) as timestamp_ntz)",
        "cast(id / 7 as decimal(38,18))",
        "if(id % 10 = 0, double('NaN'), id / 3)",
        "date_add(date'0001-01-01', cast(id as int))",
        "if(id > 10, '\"\\\\\\n' || id, '')",
        "id % 2 = 0",
    ],
)
def test_surrogate_key_order_types(spark, column):
    df = spark.range(0, 2000, 1, 5).select(F.expr(column).alias("v"), "id")
    expected = df.select(
        F.row_number().over(Window.orderBy(F.asc_nulls_last("v"), "id")).cast("bigint").alias("sk"), "*"
    )
    same(surrogate_key(df, ["v", "id"], "sk"), expected)


def test_more_ranges_than_rows(spark):
    df = spark.range(0, 5, 1, 2)
    assert [tuple(r) for r in surrogate_key(df, ["id"], "sk").orderBy("sk").collect()] == [(i + 1, i) for i in range(5)]
    ends = version_end_date(df.withColumn("k", F.lit(1)), "k", "id", "e").orderBy("id").collect()
    assert [r["e"] for r in ends] == [1, 2, 3, 4, None]


def test_ties_get_the_same_keys_on_every_call(spark):
    df = spark.range(0, 4000, 1, 7).select(F.pmod(F.xxhash64("id"), F.lit(5)).alias("v"), F.concat(F.lit("x"), F.col("id")).alias("w"))
    first = surrogate_key(df, ["v"], "sk")
    same(surrogate_key(df.repartition(3), ["v"], "sk"), first)
    keyed = df.withColumn("start", F.lit("2010"))
    same(version_end_date(keyed.repartition(5), "v", "start", "e"), version_end_date(keyed, "v", "start", "e"))


def test_exact_copies_are_spread_and_numbered_once(spark, parts):
    copies = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"))
    rows = ordered._lay_out(copies, [F.asc_nulls_last("v")], ["v"], "test")
    sizes = [r["count"] for r in rows.groupBy("__part").count().collect()]
    assert len(sizes) >= 0.8 * parts and sum(sizes) == 9000
    assert max(sizes) < 3 * 9000 / parts
    keyed = surrogate_key(copies, ["v"], "sk")
    stats = keyed.agg(F.countDistinct("sk"), F.min("sk"), F.max("sk"), F.count("*")).first()
    assert tuple(stats) == (9000, 1, 9000, 9000)
    assert keyed.filter("v = 1").agg(F.max("sk")).first()[0] == keyed.filter("v = 1").count() + keyed.filter(
        "v < 1"
    ).count()


def test_empty_and_single_row(spark):
    empty = spark.createDataFrame([], "v int, w string")
    assert surrogate_key(empty, ["v"], "sk").collect() == []
    assert version_end_date(empty, "w", "v", "e").collect() == []
    assert running_max_fill(empty, "w", "v", "x").collect() == []
    one = spark.createDataFrame([(5, "a")], "v int, w string")
    assert surrogate_key(one, ["v"], "sk").first() == (1, 5, "a")


def test_next_version_equals_lead(versions):
    window = Window.partitionBy("key").orderBy(F.asc_nulls_last("start"), "tie")
    expected = versions.withColumn("end", F.lead("start").over(window))
    same(version_end_date(versions, "key", "start", "end", ["tie"]), expected)


def test_next_version_of_texts_that_are_no_valid_unicode(spark):
    df = spark.range(0, 900, 1, 4).select(
        F.expr("cast(concat(unhex('ff'), cast(cast(id % 4 as string) as binary)) as string)").alias("key"),
        F.col("id").alias("start"),
    )
    window = Window.partitionBy("key").orderBy("start")
    expected = df.withColumn("end", F.lead("start").over(window))
    same(version_end_date(df, "key", "start", "end"), expected)


def test_exactly_one_open_version_among_copies(spark):
    copies = spark.range(2000).select(F.lit("p").alias("key"), F.lit("2010").alias("start"))
    ended = version_end_date(copies, "key", "start", "end")
    assert ended.filter("end IS NULL").count() == 1
    assert ended.filter("end = '2010'").count() == 1999


def running_max_expected(df, value, key, default):
    usable = F.when(F.col(value) != "NaN", F.col(value))
    window = Window.orderBy(F.asc_nulls_last(key), usable.asc_nulls_first())
    so_far = F.max(usable).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(value, F.coalesce(so_far, F.lit(default)))


def test_running_max_equals_global_window(spark):
    noise = F.pmod(F.xxhash64("id"), F.lit(400))
    df = spark.range(0, 4000, 1, 6).select(
        # repeated and missing keys, one key holding a third of the rows
        F.when(F.col("id") % 3 == 0, "1500").when(F.col("id") % 31 == 0, None).otherwise(
            F.col("id").cast("string")
        ).alias("k"),
        F.when(F.col("id") < 20, "NaN").when(F.col("id") % 13 == 0, None).otherwise(
            F.lpad((F.col("id") / 20 + noise / 40).cast("int").cast("string"), 5, "0")
        ).alias("v"),
    )
    got = running_max_fill(df, "v", "k", "none")
    same(got, running_max_expected(df, "v", "k", "none"))


def test_running_max_only_invalid_values(spark):
    df = spark.createDataFrame([(1, "NaN"), (2, None)], "k int, v string")
    assert {r["v"] for r in running_max_fill(df, "v", "k", "d").collect()} == {"d"}
    assert {r["v"] for r in running_max_fill(df, "v", "k").collect()} == {None}


def test_running_max_of_texts_that_are_no_valid_unicode(spark):
    text = "cast(concat(unhex('ff'), cast(lpad(cast(id % 7 as string), 2, '0') as binary)) as string)"
    df = spark.range(0, 300, 1, 4).select("id", F.expr(text).alias("v"))
    same(running_max_fill(df, "v", "id", "none"), running_max_expected(df, "v", "id", "none"))


def test_running_max_keeps_full_precision(spark):
    base = dt.datetime(2020, 1, 1)
    rows = [(i, base + dt.timedelta(microseconds=i * 7 % 11)) for i in range(30)]
    df = spark.createDataFrame(rows, "k int, v timestamp_ntz")
    got = [r["v"] for r in running_max_fill(df, "v", "k", invalid=()).orderBy("k").collect()]
    best, want = base, []
    for _, value in rows:
        best = max(best, value)
        want.append(best)
    assert got == want
    rows = [(i, Decimal(f"{i % 5}.{i:018d}")) for i in range(20)]
    df = spark.createDataFrame(rows, "k int, v decimal(30,18)")
    got = [r["v"] for r in running_max_fill(df, "v", "k", invalid=()).orderBy("k").collect()]
    assert got == [max(v for _, v in rows[: i + 1]) for i in range(20)]
