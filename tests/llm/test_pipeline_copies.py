"""The near-copy stage of the pipeline: five words in a row, a similarity of 0.8 or more."""

from __future__ import annotations

import itertools

import corpus_pipeline
import pytest

from tests.llm import brute


def kept_ids(rows):
    """Ids that stay, by comparing all pairs; ids are unique."""
    sets = {}
    for doc, text in rows:
        words = brute.WORD.findall(brute.lower(text))
        sets[doc] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    first = {doc: doc for doc in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= 80 * len(sets[a] | sets[b]) and first[a] != first[b]:
            old, new = max(first[a], first[b]), min(first[a], first[b])
            first = {doc: new if of == old else of for doc, of in first.items()}
    return {doc for doc, of in first.items() if doc == of}


def test_a_copy_with_one_word_of_fifty_replaced_goes(spark, small):
    words = [f"w{i}" for i in range(50)]
    near, far = [*words[:25], "new", *words[26:]], [*words[:15], "new", *words[16:35], "other", *words[36:]]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, small).collect()}
    assert kept == kept_ids(rows) == {1, 3, 4, 5}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_copies_equal_plain_comparison(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, folder).collect()}
    assert kept == kept_ids([(r.doc_id, r.text) for r in docs.collect()])


def test_later_stages_on_what_is_left(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small).cache()
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    single, cut, clean = list(kept.values())[1:]
    assert set(single) == kept_ids(list(kept["quality classifier"].items()))
    assert set(cut) == set(single)
    for doc, n_bytes, n_removed, n_spans, _ in brute.repeats(list(single.items())):
        left = n_bytes - n_removed
        assert left <= len(cut[doc].encode()) <= left + 6 * n_spans
        assert n_spans or cut[doc] == single[doc]
    items = [f" {' '.join(brute.WORD.findall(brute.lower(r.text)))} " for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    for doc, text in clean.items():
        words = f" {' '.join(brute.WORD.findall(brute.lower(text)))} "
        assert text == cut[doc] and not any(item in words for item in items)
