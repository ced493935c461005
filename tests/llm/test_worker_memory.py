"""Workers of one stage do not hold the memory of the stage before."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tests.llm.test_tokens import RANKS, noise
from tiermill.llm import bpe_fst, ngram_join, suffix_levels, workers


def test_memory_goes_back_before_and_after(monkeypatch):
    seen = []
    monkeypatch.setattr(workers, "trim", lambda: seen.append("trim"))

    def work(batches: Iterator[int]) -> Iterator[int]:
        for b in batches:
            seen.append(b)
            yield b + 1

    tidied = workers.tidy(work)
    assert tidied.__name__ == "work"
    assert list(tidied(iter([1, 2]))) == [2, 3] and seen == ["trim", 1, 2, "trim"]


def test_freed_memory_leaves_the_process():
    def resident() -> int:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGESIZE")

    def work(batches: Iterator[int]) -> Iterator[int]:
        held = [np.ones(8000, np.uint64) for _ in range(3000)]  # below what is mapped on its own
        pins = [np.ones(8, np.uint64) for _ in range(10)]
        yield from batches
        del held
        pins.clear()

    before = resident()
    assert list(workers.tidy(work)(iter([pa.scalar(1)]))) == [pa.scalar(1)]
    assert resident() - before < 100 << 20  # 192 MB were held


def test_stages_that_hold_arrays_are_tidied():
    for module in (suffix_levels, ngram_join):
        with open(module.__file__) as f:
            text = f.read()
        assert text.count("mapInArrow(") == text.count("mapInArrow(tidy(") > 0


def test_encoding_gives_memory_back_after_each_batch(spark, monkeypatch):
    rows = [(i, text) for i, text in enumerate(noise(3, 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    work, seen = [], []
    monkeypatch.setattr(bpe_fst.F, "arrow_udf", lambda kind: lambda f: work.append(f) or (lambda column: bpe_fst.F.struct(column.alias("ids"), column.alias("text"))))
    bpe_fst.round_trip(df, RANKS)
    batches = [pa.array([text for _, text in rows[at : at + 20]]) for at in (0, 20, 40)]
    bpe_fst._encoder(RANKS, bpe_fst.CACHE_ENTRIES, bpe_fst.MOST_STATES)
    monkeypatch.setattr(bpe_fst, "trim", lambda: seen.append("trim"))
    for done in work[0](iter(batches)):
        seen.append(len(done))
    assert seen == [20, "trim", 20, "trim", 20, "trim"]
