"""Documents with too many shingles of their own are counted out of the near-copy join before sets are compared."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tiermill.llm import ngram_join


def texts_with_a_line(count):
    """Texts of words of their own around one common line, and near copies of some of them."""
    rnd = random.Random(count)
    line = [f"line{i}" for i in range(14)]
    rows = []
    for i in range(count):
        at = rnd.randint(0, 40)
        words = [f"a{i}x{k}" for k in range(at)] + line + [f"b{i}x{k}" for k in range(40 - at)]
        rows.append((len(rows), " ".join(words)))
        if i % 20 == 0:
            words[-1] = f"c{i}"
            rows.append((len(rows), " ".join(words)))
    return rows


def test_texts_that_share_a_line_are_not_compared(spark, monkeypatch):
    rows = texts_with_a_line(200)
    compared, rounds = [], ngram_join._in_rounds

    def recorded(pairs, sets):
        compared.extend((r.u, r.v) for r in pairs.collect())
        return rounds(pairs, sets)

    monkeypatch.setattr(ngram_join, "_in_rounds", recorded)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link(df, shingle=5, percent=80).collect()}
    assert found == brute.near_copies(rows, 5, 80)
    assert len({c for _, c in found.values()}) == 200
    copies = [(i, i + 1) for i in range(0, 210, 21)]
    assert set(copies) <= set(compared)
    assert {doc for pair in compared for doc in pair} == {doc for pair in copies for doc in pair}


@pytest.mark.parametrize("shards", [1, 5, 300])
def test_private_shingles_are_counted_by_fragment(spark, shards):
    """Whatever the number of shards, and over several batches and negative numbers."""
    rnd = random.Random(3)
    rows = [(i * 1_000_003 - 40_000_000, " ".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(0, 90)))) for i in range(90)] + [(7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = {r.doc_id: r.parts for r in ngram_join._sets(df, 3).collect()}
    seen = Counter(key for parts in sets.values() for part in parts for key in part)
    want = {doc: [sum(seen[key] == 1 for key in part) for part in parts] for doc, parts in sets.items()}
    found = {r.doc_id: r.private for r in ngram_join._private(df, shards, 4, 3).collect()}
    assert found == {doc: counts for doc, counts in want.items() if any(counts)} and len(found) > 50


def test_only_those_over_the_limit_are_left_alone(spark):
    """A link of 80 % may differ in a quarter of the smaller set."""
    private = spark.createDataFrame([(1, [10, 15]), (2, [10, 16]), (3, [25, 0])], "doc_id long, private array<long>")
    sizes = spark.createDataFrame([(1, 100), (2, 100), (3, 99)], "doc_id long, n long")
    found = ngram_join._lonely(private, sizes, 80)
    assert sorted(r.doc_id for r in found.collect()) == [2, 3]
    assert found.filter(F.col("doc_id").isNull()).count() == 0
