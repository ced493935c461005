"""Keys checked by bitmaps give what grouping and joining the keys gives."""

from __future__ import annotations

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from tiermill.operators import dq_report, orphan_keys, repeated_keys, unique_not_null
from tiermill.operators import quality
from tiermill.operators.quality import Check

KEYS = {
    "dense": [*range(1, 70_000)],
    "around zero": [*range(-40_000, 40_000)],
    "repeated": [*range(1, 70_000), 5, 5, 69_999],
    "null": [*range(100), None, None],
    "one null": [1, None],
    "sparse": [i * 10**6 for i in range(-500, 500)],
    "sparse, repeated": [i * 10**6 for i in range(500)] * 2,
    "edges": [-(2**63), 2**63 - 1, 0],
    "borders of bitmaps": [-32768, -32767, 0, 1, 32767, 32768, 32769, 65536, 65537, 32768],
    "only null": [None] * 3,
    "none": [],
}


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
@pytest.mark.parametrize("name", KEYS)
def test_uniqueness(spark, name, kind):
    keys = [k for k in KEYS[name] if kind != "int" or k is None or abs(k) < 2**31]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(3).select(F.col("k").cast(kind))
    checks = [Check("key", "t", rows=df, key="k", not_null=True), Check("lookup", "t", rows=df, key="k")]
    found = [r["violations"] for r in dq_report(checks).collect()]
    assert found == [unique_not_null(df, "k").count(), repeated_keys(df, "k").count()]


def test_checks_of_one_table_share_a_scan(spark, tmp_path, monkeypatch):
    spark.range(70_000).select("id", (F.col("id") + 7).alias("other"), F.lit("x").alias("v")).write.parquet(str(tmp_path / "t"))
    df, fewer = spark.read.parquet(str(tmp_path / "t")), spark.range(3)
    seen = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: (seen.append(self), collect(self))[1])
    checks = [
        Check("a", "t", rows=df, key="id", not_null=True),
        Check("b", "t", rows=df, key="other"),
        Check("c", "t", rows=df, count=quality.values_outside("v", ["y"])),
        Check("d", "t", rows=df, count=quality.rows_where(F.col("id") < 4)),
        Check("e", "t", rows=df, same_rows=df),
        Check("f", "t", rows=df, same_rows=fewer),
    ]
    report = dq_report(checks)
    monkeypatch.undo()
    assert [(r["check"], r["violations"]) for r in report.collect()] == [("a", 0), ("b", 0), ("c", 1), ("d", 4), ("e", 0), ("f", 1)]
    summary, keys = [s._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0] for s in seen]
    assert summary.count("FileScan parquet") == 1
    # keys: a bitmap per 32,768 numbers is all that is shuffled
    assert keys.count("FileScan parquet") == 2 and keys.count("bitmap_construct_agg") >= 2
    assert "hashpartitioning(id" not in keys and "hashpartitioning(other" not in keys


def plain_orphans(fact, known, strict):
    pairs = {}
    for pair in fact:
        if any(k is None or k not in held for k, held in zip(pair, known, strict=True)):
            pairs[pair] = pairs.get(pair, 0) + 1
    return {(*pair, n) for pair, n in pairs.items() if strict or n > 1 or None in pair}


@pytest.mark.parametrize("kinds", [("bigint", "bigint"), ("int", "bigint"), ("string", "bigint")])
@pytest.mark.parametrize("lost", ["none", "some", "outside", "all"])
def test_orphans(spark, lost, kinds):
    rnd = random.Random(4)
    known = [set(range(1, 40_000)), set(range(-300, 300))]
    kept = {"none": known, "some": [known[0] - {5, 33_000}, known[1] - {0}], "outside": known, "all": [set(), set()]}[lost]
    fact = [(rnd.choice([5, 7, 33_000, rnd.randint(1, 39_999)]), rnd.choice([-300, 0, 299, rnd.randint(-300, 299)])) for _ in range(3000)]
    fact += [(None, 5), (6, None), (None, None), (None, None)]
    if lost == "outside":
        fact += [(50_000, 1), (50_000, 1), (0, 1), (-(2**31), 7), (2**31 - 1, 999)]
    facts = spark.createDataFrame(fact, "a bigint, b bigint").repartition(3).select(F.col("a").cast(kinds[0]), F.col("b").cast(kinds[1]))
    dimensions = {}
    for column, kind, keys in zip("ab", kinds, kept, strict=True):
        dimensions[column] = (spark.createDataFrame([(k,) for k in [*keys, None]], "k bigint").select(F.col("k").cast(kind)), "k")
    for strict in (False, True):
        found = {tuple(r) for r in orphan_keys(facts, dimensions, strict).select(F.col("a").cast("bigint"), F.col("b").cast("bigint"), "copies").collect()}
        assert found == plain_orphans(fact, kept, strict)


def test_no_key_of_the_fact_is_shuffled_when_all_match(spark, tmp_path):
    spark.range(60_000).select((F.col("id") % 900 + 1).alias("a"), (F.col("id") % 70).alias("b")).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    dimensions = {"a": (spark.range(1, 1001), "id"), "b": (spark.range(70), "id")}
    text = orphan_keys(fact, dimensions, strict=True)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line)
    assert "PushedFilters: [Or(IsNull(a),IsNull(b))]" in scan  # only rows without a key are read further
    found = orphan_keys(fact, dimensions, strict=True)
    assert found.count() == 0


def test_bitmaps_are_left_out_where_they_would_be_larger_than_the_keys(spark):
    wide = spark.range(1000).select((F.col("id") * 10**9).alias("__known"))
    assert quality._lacking_parts(wide.withColumnRenamed("__known", "k"), "k", wide) is None
    assert quality._lacking_parts(wide.withColumnRenamed("__known", "k"), "k", wide.limit(0)) is None
    union = reduce(type(wide).union, [spark.range(10).withColumnRenamed("id", "__known")] * 2)
    assert quality._lacking_parts(wide.withColumnRenamed("__known", "k"), "k", union) is not None
