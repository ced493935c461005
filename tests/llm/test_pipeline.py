"""The corpus pipeline against plain stages."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_pipeline_copies import kept_ids
from tiermill.llm import queries
from tiermill.llm.bpe_fst import Vocabulary


def test_stages_are_in_order_and_return_documents(spark, small, documents):
    docs = documents
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small).cache()
        assert docs.columns == documents.columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    given = {r.doc_id: r.text for r in documents.collect()}
    good = kept["quality classifier"]
    predicted = {r.doc_id for r in queries.op7_quality_gbt(spark, small).filter("predicted = 1").collect()}
    assert set(good) == predicted and all(good[d] == given[d] for d in good)
    single = kept["n-gram Jaccard join"]
    assert set(single) == kept_ids(list(good.items()))
    cut = kept["suffix-array dedup"]
    assert set(cut) == set(single)
    plain = {row[0]: row for row in brute.repeats(list(single.items()))}
    for doc, text in cut.items():  # a character that is cut in two stays
        left = plain[doc][1] - plain[doc][2]
        assert left <= len(text.encode()) <= left + 6 * plain[doc][3]
        assert plain[doc][3] or text == single[doc]
    clean = kept["benchmark decontamination"]
    items = [f" {' '.join(brute.WORD.findall(brute.lower(r.text)))} " for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    for doc, text in clean.items():
        words = f" {' '.join(brute.WORD.findall(brute.lower(text)))} "
        assert not any(item in words for item in items)


def test_run_gives_ids_that_spell_the_texts(spark, small):
    rows = corpus_pipeline.run(spark, small).collect()
    tokens = Vocabulary.load(queries.tokenizer_file("byte_bpe_50k.tiktoken")).tokens
    assert rows and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    b"".join(tokens[i] for i in rows[0].ids).decode()


@pytest.mark.parametrize("table", ["odd", "nothing"])
def test_stages_take_odd_tables(request, spark, small, table):
    docs = request.getfixturevalue(table)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, small).cache()
        assert docs.columns == columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).filter(~F.col("round_trip")).count() == 0


def test_queries_of_this_package_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names
