from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, and extra columns whose names operators use."""
    rows = [
        (1, None, "a"),
        (2, "", None),
        (3, "One two Three four five six seven eight nine ten eleven twelve.", "x"),
        (3, "One two Three four five six seven eight nine ten eleven twelve.", "x"),
        (4, "one  two three four five six seven eight nine ten eleven twelve.\n", None),
        (5, " \t\n\x0b\x0c\r ", "x"),
        (6, "é漢🙂 \x85 \xa0x 　 it's they'll 123 ### <|endoftext|>", "x"),
        (None, "One two Three four five six seven eight nine ten eleven twelve.", "x"),
        (None, None, None),
        (7, "word" * 60_000, "x"),
        (8, "many words " * 30_000, "x"),
        (9, "a\nb\na\n\na b", "x"),
    ]
    schema = "doc_id long, text string, ids string"
    df = spark.createDataFrame(rows, schema)
    for name in ("score", "shard", "keys", "batch", "n", "label", "kept", "spans", "component_id", "set", "tokens", "html"):
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit(None).cast("string") if name in ("n", "label") else F.lit("z"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
