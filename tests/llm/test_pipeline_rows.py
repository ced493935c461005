"""Stages of the pipeline judge each row by its own text, also where the id is missing or repeated."""

from __future__ import annotations

import corpus_pipeline

SCHEMA = "doc_id long, text string, source string"


def kept(stage, spark, small, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(r.source for r in stage(spark, docs, small).collect())


def words(label, count=60):
    return " ".join(f"{label}{i}" for i in range(count))


def test_benchmark_passages_go_whatever_the_id(spark, small):
    item = spark.read.parquet(f"{small}/benchmark.parquet").orderBy("item_id").first().text
    leak = f"{words('a')} {item} {words('b')}"
    rows = [(None, leak, "leak, no id"), (None, words("c"), "clean, no id"), (1, leak, "leak, id 1"), (1, words("d"), "clean, id 1"), (2, None, "empty")]
    assert kept(corpus_pipeline.without_benchmark, spark, small, rows) == ["clean, id 1", "clean, no id", "empty"]


def test_copies_go_whatever_the_id(spark, small):
    rows = [
        (3, words("a"), "first"),
        (None, words("a"), "copy, no id"),
        (5, words("a") + " end", "copy, id 5"),
        (5, words("b"), "other text, id 5"),
        (3, words("a"), "first"),
        (None, words("c"), "pair, no id"),
        (None, words("c"), "pair, no id"),
        (6, "", "bare, id 6"),
        (6, None, "bare, id 6"),
        (7, " ", "bare, id 7"),
        (None, None, "bare, no id"),
        (None, "", "bare, no id"),
    ]
    expected = ["bare, id 6", "bare, id 7", "bare, no id", "bare, no id", "first", "other text, id 5", "pair, no id"]
    assert kept(corpus_pipeline.one_of_each, spark, small, rows) == expected
