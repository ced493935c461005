"""Benchmark decontamination with spaced seeds over words.

Texts become lower-cased words (A-Z only). A mask marks some places of a run of words; the hash of the words at the
marked places is a seed, so words at the other places may differ. Seeds of the benchmark are looked up among those of every
place of every document; a hit fixes how item and document lie against each other. There the overlap is grown
from the hit in both directions, one point for an equal word, ``MISMATCH`` off for another, until the score is ``DROP``
below its best. An overlap counts when it has at least ``FEWEST`` words, or the whole item if that is shorter, and at
least ``EQUAL_PERCENT`` of its words are equal. Where the item lies wholly within the document, all of it is compared as
well, so that words replaced at its ends do not hide it.

The benchmark is sent to the workers in blocks of at most ``BLOCK_BYTES`` of text (one item more at most); every block is held
against all documents and its overlaps are stored before the next one is sent. Items shorter than ``FEWEST`` words have masks of
their own (``whole_masks``), which miss none of their whole occurrences. NULL and empty texts match nothing;
rows without an id are held against the benchmark like others and reported with a NULL id. Repeated rows are reported once per
pair of ids, with the largest overlap (ties: the first place). Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.arrays import Texts, Words, mix, text_slices, word_hashes
from tiermill.llm.workers import ship
from tiermill.sources.scratch import materialize

MASKS = ("11010011", "10110101", "11100111")
BLOCK_BYTES = 16 << 20
FEWEST = 13
EQUAL_PERCENT = 80
MISMATCH = 2
DROP = 8
_SIEVE_BITS = 20


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Seed at every place where the mask fits."""
    count = max(0, len(hashes) - len(mask) + 1)
    out = np.full(count, len(mask), np.uint64)
    for i, marked in enumerate(mask):
        if marked == "1":
            out = out * np.uint64(0x9FB21C651E98DF25) + hashes[i : i + count]
    return mix(out)


def whole_masks(size: int) -> list[str]:
    """Masks over a whole short item, one of which fits however its words are replaced, as long as enough stay equal.

    An item of which ``k`` words may differ is cut into ``k + 2`` parts; at least two parts stay, and each mask marks two.
    """
    changes = size - -(-size * EQUAL_PERCENT // 100)
    if not changes:
        return ["1" * size]
    cuts = [size * i // (changes + 2) for i in range(changes + 3)]
    parts = [range(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
    return ["".join("1" if i in x or i in y else "0" for i in range(size)) for x, y in combinations(parts, 2)]


@dataclass
class Benchmark:
    """Seeds of some items: per mask the sorted seeds, their item and their place in it."""

    ids: list
    words: list[np.ndarray]
    tables: list[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def build(cls, ids: list, texts: pa.Array, masks: tuple[str, ...] = MASKS) -> Benchmark:
        own: list[np.ndarray] = []
        for part in text_slices(texts):
            found, hashes = word_hashes(part)
            own += [hashes[a:b] for a, b in zip(found.offsets[:-1], found.offsets[1:], strict=True)]
        longest = max(map(len, masks))
        plans = [(mask, [i for i, w in enumerate(own) if len(w) >= longest]) for mask in masks]
        for size in sorted({len(w) for w in own if 0 < len(w) < FEWEST}):
            items = [i for i, w in enumerate(own) if len(w) == size]
            plans += [(mask, items) for mask in whole_masks(size)]
        tables = []
        for mask, items in plans:
            if not items:
                continue
            keys = [seeds(own[i], mask) for i in items]
            item = np.repeat(items, [len(k) for k in keys])
            place = np.concatenate([np.arange(len(k)) for k in keys])
            key = np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            sieve = np.zeros(1 << _SIEVE_BITS, bool)
            sieve[key >> np.uint64(64 - _SIEVE_BITS)] = True
            tables.append((mask, key[order], item[order], place[order], sieve))
        return cls(ids, own, tables)


def _grow(same: np.ndarray, at: int) -> tuple[int, int]:
    """The range around ``at`` with the best score."""
    ends = []
    for part in (same[at:], same[:at][::-1]):
        score = np.cumsum(np.where(part, 1, -MISMATCH))
        if not len(score):
            ends.append(0)
            continue
        best = np.maximum(np.maximum.accumulate(score), 0)
        stop = np.flatnonzero(best - score >= DROP)
        score = score[: stop[0]] if len(stop) else score
        top = int(score.argmax()) if len(score) else 0
        ends.append(top + 1 if len(score) and score[top] > 0 else 0)
    return at - ends[1], at + ends[0]


def overlaps(texts: Texts, found: Words, hashes: np.ndarray, benchmark: Benchmark) -> Iterator[tuple[int, int, int, int, int]]:
    """Text, item, equal words, words and first word of each overlap that counts, largest one of a pair."""
    owner = found.owners()
    hits = []
    for mask, keys, item, place, sieve in benchmark.tables:
        own = seeds(hashes, mask)
        at = np.flatnonzero(sieve[own >> np.uint64(64 - _SIEVE_BITS)])
        at = at[owner[at] == owner[at + len(mask) - 1]]
        first, last = np.searchsorted(keys, own[at], "left"), np.searchsorted(keys, own[at], "right")
        many = last - first
        source = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        hits.append(np.column_stack([np.repeat(at, many), item[source], place[source]]))
    hits = np.concatenate(hits) if hits else np.zeros((0, 3), np.int64)
    hits = hits[np.lexsort((hits[:, 0], hits[:, 1], owner[hits[:, 0]]))] if len(hits) else hits
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    done: dict[tuple[int, int], int] = {}
    for at, item, place in hits.tolist():
        text, words = int(owner[at]), benchmark.words[item]
        low, high = int(found.offsets[text]), int(found.offsets[text + 1])
        start = at - place
        if done.get((item, start), -1) > at:
            continue
        a, b = max(low, start), min(high, start + len(words))
        same = hashes[a:b] == words[a - start : b - start]
        x, y = _grow(same, at - a)
        done[item, start] = a + y
        equal, size = int(same[x:y].sum()), y - x
        if b - a == len(words) and 100 * int(same.sum()) >= EQUAL_PERCENT * len(words):  # the whole item, changes at its ends included
            x, y, equal, size = 0, len(words), int(same.sum()), len(words)
            done[item, start] = b
        if size >= min(FEWEST, len(words)) and 100 * equal >= EQUAL_PERCENT * size:
            old = best.get((text, item))
            if old is None or (equal, -(a + x)) > (old[0], -old[2]):
                best[text, item] = (equal, size, a + x)
    for (text, item), (equal, size, first) in best.items():
        yield text, item, equal, size, first - int(found.offsets[text])


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[Benchmark]:
    """The benchmark in blocks whose size was checked before they are fetched."""
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull()).dropDuplicates()
    size = F.octet_length("text")
    total = items.agg(F.sum(size)).first()[0] or 0
    count = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
        largest = dealt.groupBy("block").agg(F.sum(size).alias("bytes"), F.max(size).alias("one")).filter(F.col("bytes") > F.col("one") + block_bytes)
        if count == 1 or largest.isEmpty():
            break
        count *= 2
    for block in range(count):
        rows = dealt.filter(F.col("block") == block).orderBy("item_id", "text").toArrow()
        if rows.num_rows:
            yield Benchmark.build(rows["item_id"].to_pylist(), rows["text"].combine_chunks())


def contaminated(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document and item that overlap: ``doc_id``, ``item_id``, ``n_equal``, ``n_words``, ``first_word``, ``item_words``."""
    spark = documents.sparkSession
    ship(spark)
    schema = "doc_id long, item_id long, n_equal long, n_words long, first_word long, item_words long"
    names = [field.split()[0] for field in schema.split(", ")]
    texts = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def against(block) -> DataFrame:
        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = block.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = []
                for part in text_slices(batch.column(1)):
                    found, hashes = word_hashes(part)
                    for row, item, equal, size, first in overlaps(part, found, hashes, own):
                        rows.append((ids[part.first + row], own.ids[item], equal, size, first, len(own.words[item])))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        return texts.mapInArrow(look, schema)

    found = []
    for block in _blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        found.append(materialize(against(shared), "overlaps").df)
        shared.destroy()  # executors hold one block at a time
    if not found:
        return spark.createDataFrame([], schema)
    pairs = reduce(DataFrame.unionAll, found)
    best = Window.partitionBy("doc_id", "item_id").orderBy(F.desc("n_equal"), "first_word", "n_words")
    return pairs.withColumn("rank", F.row_number().over(best)).filter("rank = 1").drop("rank")
