"""What the stages of the pipeline send at once stays small, and is the same rows."""

from __future__ import annotations

import corpus_pipeline
import pyarrow as pa

from tests.llm.test_tokens import noise
from tiermill.llm import ngram_join

NAME = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_stages_send_small_batches(spark, small, documents, monkeypatch):
    before, seen, store = spark.conf.get(NAME), {}, corpus_pipeline.materialize

    def recorded(df, label, *more):
        seen[label] = int(spark.conf.get(NAME))
        return store(df, label, *more)

    monkeypatch.setattr(corpus_pipeline, "materialize", recorded)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [corpus_pipeline.STAGES[i] for i in (0, 2, 4)])
    corpus_pipeline.run(spark, small)
    assert seen["quality-classifier"] <= 500 and seen["cut"] <= 2 and seen["tokens"] <= 100
    assert spark.conf.get(NAME) == before


def test_blocks_of_fingerprints_hold_several_batches():
    class Captured:
        def mapInArrow(self, work, schema):
            self.work = work
            return self

    work = ngram_join._describe(Captured(), 3, 3, 90).work
    texts = [f"{text} one two three four five six" for text in noise(3, 60)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(at, at + 20)), pa.array(texts[at : at + 20])], ["doc_id", "text"]) for at in (0, 20, 40)]
    found = [row for batch in work(iter(batches)) for row in batch.to_pylist()]
    assert [row["doc_id"] for row in found if row["shard"] is None] == list(range(60))
    blocks = [row["shard"] for row in found if row["shard"] is not None]
    assert blocks == sorted(set(blocks))
    whole = pa.Table.from_batches(batches).combine_chunks().to_batches()
    assert [row for batch in work(iter(whole)) for row in batch.to_pylist() if row["shard"] is not None] == [row for row in found if row["shard"] is not None]


def test_rounds_move_each_member_once(spark, monkeypatch):
    rows = [(i, [[j * 100 + k for k in range(i % 7 + j % 3)] for j in range(ngram_join.PARTS)]) for i in range(40)]
    sets = spark.createDataFrame(rows, "doc_id long, parts array<array<long>>")
    pairs = spark.createDataFrame([(u, v) for u in range(3) for v in range(u + 1, 40)], "u long, v long")
    expected = sorted(map(str, ngram_join._overlaps(pairs, sets).collect()))
    moved, overlaps = [], ngram_join._overlaps

    def recorded(pairs, sets, members):
        moved.append([r.doc_id for r in members.select("doc_id").collect()])
        return overlaps(pairs, sets, members)

    monkeypatch.setattr(ngram_join, "ROUND_KEYS", 1)
    monkeypatch.setattr(ngram_join, "_overlaps", recorded)
    assert sorted(map(str, ngram_join._in_rounds(pairs, sets).collect())) == expected
    assert len(moved) > 1 and sorted(sum(moved, [])) == list(range(40))
