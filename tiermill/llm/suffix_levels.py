"""Removal of passages that an earlier document holds, with a logarithmic family of suffix arrays.

A byte goes when it is covered by a string of ``LENGTH`` bytes that also starts in a document with a smaller id.

Documents are cut into batches of consecutive ids, and a batch is a set of suffixes. Only the first ``LENGTH`` bytes of a
suffix matter, so suffixes are ordered by a 64-bit fingerprint of these bytes; equal ones are neighbours. The space of
fingerprints is dealt over shards, and each shard keeps a family of levels: the array of a new batch is
scanned against all levels, which hold the batches before it, and is then added; levels of about equal size
merge, so there are only logarithmically many and each suffix is merged logarithmically often. A batch sends each
suffix once however often it holds it, so a passage that very many documents share loads no shard. There are no more shards than
batches' worth of text: small tables in many batches would else be dealt in tiny blocks, one per batch and shard.

Not all suffixes are sent. Of the strings of ``GRAM`` bytes within each window of ``LENGTH`` bytes the one with the smallest hash is
its anchor; equal windows have equal anchors. Four rounds narrow the search down, each a scan as above:
  1. anchors by their string: those that no other document has cannot lie in a repeated window;
  2. windows that start at remaining anchors: they settle the inside of repeated passages;
  3. anchors that have windows left open, at the ends of passages: whoever has the same string is told;
  4. all windows of these anchors: they settle the ends, byte by byte.
Answers go back to the batch as a file of the scratch folder, beside what the batch keeps from round to round.

Documents with equal ids are one document to each other; rows without an id come first and are also equal to each other; rows
of one id are kept in one batch. NULL texts are empty: nothing is removed. Texts shorter than ``LENGTH`` bytes stay whole. Texts
are bytes of UTF-8; a cut may fall inside a character, unless whole characters are asked for. Columns to keep are named; others play no part.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.arrays import RollingHash, mix, pack, pack_counts, text_slices, unpack, unpack_counts
from tiermill.llm.files import new_file, reading, rows_per_batch, writing
from tiermill.llm.workers import ship, tidy
from tiermill.sources.scratch import delete_folder, materialize, scratch_path

LENGTH = 50
GRAM = 20
BATCH_BYTES = 2 << 20
TILE = 1 << 18
SHARDS_PER_PARTITION = 2
EARLIER, OTHER, ASKED = 1, 2, 4


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values, by its first."""
    out, reach = values, 1
    while 2 * reach <= width:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


@dataclass
class Batch:
    """Texts of consecutive documents; ``document`` numbers them, with one number for equal ids."""

    data: np.ndarray
    offsets: np.ndarray
    document: np.ndarray

    def tiles(self) -> Iterator[tuple[int, np.ndarray, RollingHash]]:
        """Overlapping pieces: first byte, bytes and their hashes."""
        for at in range(0, max(0, len(self.data) - LENGTH + 1), TILE):
            part = self.data[at : at + TILE + LENGTH - 1]
            yield at, part, RollingHash(part)

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, places, "right") - 1

    def whole(self, first: int, count: int) -> np.ndarray:
        """Which of the windows from ``first`` on end within their text."""
        places = np.arange(first, first + count)
        ends = np.zeros(count, np.int64)
        begin = np.searchsorted(self.offsets, first, "right") - 1
        stop = np.searchsorted(self.offsets, first + count, "left")
        for row in range(begin, min(stop, len(self.offsets) - 1)):
            ends[max(0, self.offsets[row] - first) : max(0, self.offsets[row + 1] - first)] = self.offsets[row + 1]
        return places + LENGTH <= ends

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of anchors and the fingerprints of their strings."""
        places, grams = [], []
        for at, part, rolling in self.tiles():
            hashes = rolling.windows(GRAM)
            least = _sliding(hashes, LENGTH - GRAM + 1, np.minimum)
            valid = self.whole(at, len(least))
            # a string is an anchor if it is the least of some valid window that holds it
            best = np.where(valid, least, 0)
            best = np.concatenate([np.zeros(LENGTH - GRAM, np.uint64), best, np.zeros(LENGTH - GRAM, np.uint64)])
            chosen = np.flatnonzero(_sliding(best, LENGTH - GRAM + 1, np.maximum) == hashes)
            places.append(chosen + at)
            grams.append(hashes[chosen])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        where, first = np.unique(np.concatenate(places), return_index=True)
        return where, np.concatenate(grams)[first]

    def strings_at(self, places: np.ndarray, length: int = LENGTH) -> np.ndarray:
        """Fingerprints of the strings of ``length`` bytes that start at ``places`` (ascending)."""
        out = np.zeros(len(places), np.uint64)
        cuts = np.searchsorted(places, np.arange(0, len(self.data) + TILE, TILE))
        for tile in np.flatnonzero(np.diff(cuts)):
            at, own = tile * TILE, slice(cuts[tile], cuts[tile + 1])
            begins = places[own] - at
            out[own] = RollingHash(self.data[at : at + TILE + length]).spans(begins, begins + length)
        return out

    def fits(self, places: np.ndarray) -> np.ndarray:
        return places + LENGTH <= self.offsets[self.owner(places) + 1] if len(places) else np.zeros(0, bool)

    def around(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of all windows that hold one of the anchors, within its text."""
        if not len(anchors):
            return np.zeros(0, np.int64)
        row = self.owner(anchors)
        low = np.maximum(anchors - (LENGTH - GRAM), self.offsets[row])
        high = np.minimum(anchors, self.offsets[row + 1] - LENGTH) + 1
        marks = np.zeros(len(self.data) + 1, np.int32)
        use = high > low
        np.add.at(marks, low[use], 1)
        np.add.at(marks, high[use], -1)
        return np.flatnonzero(np.cumsum(marks[:-1]) > 0)

    def covered(self, starts: np.ndarray) -> np.ndarray:
        marks = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + LENGTH, -1)
        return np.cumsum(marks[:-1]) > 0


def _first_owner(which: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    first = np.full(count, np.iinfo(np.int64).max)
    np.minimum.at(first, which, owner)
    return first


class Asked:
    """Keys of a batch, one for each of ``places``; answers are found for the distinct ones, in the order of their mixed values:
    anchors are least hashes, so shards cut by the hash itself would be uneven.

    ``which`` tells the distinct key of each place; it is all that has to be kept until the answers are there.
    """

    def __init__(self, batch: Batch, places: np.ndarray, keys: np.ndarray, flags: np.ndarray | None = None):
        self.distinct, self.which = np.unique(mix(keys), return_inverse=True)
        self.flags = np.zeros(len(self.distinct), bool)
        if flags is not None:
            self.flags[self.which[flags]] = True


def _answers(batch: Batch, places: np.ndarray, which: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Answers for every place; documents of the batch itself count too."""
    owner = batch.document[batch.owner(places)]
    first = _first_owner(which, owner, len(codes))
    last = -_first_owner(which, -owner, len(codes))
    out = codes[which] | np.where(owner > first[which], EARLIER, 0).astype(np.uint8)
    return out | np.where((first < last)[which], OTHER, 0).astype(np.uint8)


State = dict[str, np.ndarray]

# Rounds: what a batch asks, and what it keeps for the next round; ``state`` and ``codes`` are those of the round before.


def _ask_anchors(batch: Batch, state: State, codes: np.ndarray) -> tuple[Asked, State]:
    return Asked(batch, *batch.anchors()), {}


def _ask_starts(batch: Batch, state: State, codes: np.ndarray) -> tuple[Asked, State]:
    places, keys = batch.anchors()
    answers = _answers(batch, places, Asked(batch, places, keys).which, codes)
    shared = answers & OTHER > 0
    places = places[shared]
    starts = places[batch.fits(places)]
    asked = Asked(batch, starts, batch.strings_at(starts))
    return asked, {"places": places, "earlier": (answers & EARLIER > 0)[shared], "which": asked.which}


def _ask_open(batch: Batch, state: State, codes: np.ndarray) -> tuple[Asked, State]:
    places = state["places"]
    starts = places[batch.fits(places)]
    settled = starts[_answers(batch, starts, state["which"], codes) & EARLIER > 0]
    row = batch.owner(places)
    left = np.concatenate([[0], np.cumsum(~batch.covered(settled))])
    low = np.maximum(places - (LENGTH - GRAM), batch.offsets[row])
    high = np.minimum(places + LENGTH, batch.offsets[row + 1])
    open_ = (state["earlier"] > 0) & (left[high] > left[low])
    asked = Asked(batch, places, batch.strings_at(places, GRAM), open_)
    return asked, {"places": places, "which": asked.which, "settled": settled}


def _ask_ends(batch: Batch, state: State, codes: np.ndarray) -> tuple[Asked, State]:
    wanted = _answers(batch, state["places"], state["which"], codes) & ASKED > 0
    places = batch.around(state["places"][wanted])
    asked = Asked(batch, places, batch.strings_at(places))
    return asked, {"places": places, "which": asked.which, "settled": state["settled"]}


def _found(batch: Batch, state: State, codes: np.ndarray) -> np.ndarray:
    """Starts of windows that an earlier document holds, enough to cover all that goes."""
    ends = state["places"][_answers(batch, state["places"], state["which"], codes) & EARLIER > 0]
    return np.concatenate([state["settled"], ends])


ROUNDS: tuple[Callable[[Batch, State, np.ndarray], tuple[Asked, State]], ...] = (_ask_anchors, _ask_starts, _ask_open, _ask_ends)


class Levels:
    """Sorted arrays of keys; a new array is scanned against all of them, then those of about equal size merge."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def scan(self, keys: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), bool)
        for level in self.levels:
            at = np.searchsorted(level, keys)
            at[at == len(level)] = 0
            found |= level[at] == keys
        return found

    def add(self, keys: np.ndarray) -> None:
        if not len(keys):
            return
        self.levels.append(keys)
        while len(self.levels) > 1 and 2 * len(self.levels[-1]) >= len(self.levels[-2]):
            last, before = self.levels.pop(), self.levels.pop()
            both = np.sort(np.concatenate([before, last]), kind="stable")
            self.levels.append(both[np.append(True, both[1:] != both[:-1])])


_DEALT = "shard int, batch long, keys binary, flags binary"
_CODES = "batch long, shard int, codes binary"


def _answer(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard at a time, its batches in order: scan each against the levels of those before it."""

    def flush(held: list[tuple[int, np.ndarray, np.ndarray]], shard: int) -> pa.RecordBatch:
        family, codes = Levels(), []
        for _, keys, flags in held:
            codes.append(np.where(family.scan(keys), EARLIER, 0).astype(np.uint8))
            family.add(keys)
        everything = np.concatenate([keys for _, keys, _ in held])
        distinct, which, count = np.unique(everything, return_inverse=True, return_counts=True)
        asked = np.bincount(which, np.concatenate([flags for _, _, flags in held]), len(distinct)) > 0
        more = np.where(count > 1, OTHER, 0).astype(np.uint8) | np.where(asked, ASKED, 0).astype(np.uint8)
        at, out = 0, []
        for (_, keys, _), code in zip(held, codes, strict=True):
            out.append(zstandard.compress((code | more[which[at : at + len(keys)]]).tobytes(), 1))
            at += len(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _, _ in held], pa.int64()), pa.array([shard] * len(held), pa.int32()), pa.array(out, pa.binary())], ["batch", "shard", "codes"]
        )

    shard, held = None, []
    for batch in rows:
        for now, number, keys, flags in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if now != shard and held:
                yield flush(held, shard)
                held = []
            shard = now
            own = unpack(keys)
            held.append((number, own, np.unpackbits(np.frombuffer(flags, np.uint8), count=len(own)).astype(bool)))
    if held:
        yield flush(held, shard)


def _put(folder: str, name: str, data: bytes) -> None:
    """Write a file under its final name in one step; a repeated task writes the same again."""
    path = new_file(folder, "new")
    with writing(path) as out:
        out.write(zstandard.compress(data, 1))
    system, place = fs.FileSystem.from_uri(path)
    system.move(place, fs.FileSystem.from_uri(f"{folder}/{name}")[1])


def _get(folder: str, name: str) -> bytes:
    with reading(f"{folder}/{name}") as source:
        return zstandard.decompress(source.read())


def _store(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write the answers of each batch, shard after shard, to its file."""

    def store(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, held, done = None, [], []
        for part in rows:
            for number, codes in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True):
                if number != batch and held:
                    _put(folder, f"{batch}.codes", b"".join(held))
                    done.append(batch)
                    held = []
                batch = number
                held.append(zstandard.decompress(codes))
        if held:
            _put(folder, f"{batch}.codes", b"".join(held))
            done.append(batch)
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], ["batch"])

    return store


#: Arrays of a state that ascend; they are kept as differences.
_ASCENDING = ("places", "settled")


def _before(folder: str | None, batch: int) -> tuple[State, np.ndarray]:
    """What the batch kept in the round before, and the answers to what it asked then."""
    if folder is None:
        return {}, np.zeros(0, np.uint8)
    held, asked = pickle.loads(_get(folder, f"{batch}.state"))
    state = {name: (unpack if name in _ASCENDING else unpack_counts)(blob).view(np.int64) for name, blob in held.items()}
    return state, np.frombuffer(_get(folder, f"{batch}.codes") if asked else b"", np.uint8)


def _keep(folder: str, batch: int, state: State, asked: int) -> None:
    held = {name: (pack if name in _ASCENDING else pack_counts)(array.astype(np.uint64)) for name, array in state.items()}
    _put(folder, f"{batch}.state", pickle.dumps((held, asked)))


_BATCHES = "batch long, size long, ids binary, offsets binary, texts binary, rest binary"


def _pack_batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come in order of ids, packed into batches of about ``BATCH_BYTES``; equal ids stay together."""
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        nonlocal number
        chunks = pa.Table.from_batches(parts).combine_chunks().to_batches()
        if len(chunks) != 1:
            raise ValueError("the rows of one id are too large for one batch")
        whole = chunks[0]
        texts = list(text_slices(whole.column(1), 1 << 62))[0]
        rest = whole.select(whole.schema.names[2:])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rest.schema) as stream:
            stream.write_batch(rest)
        ids = pa.BufferOutputStream()
        with pa.ipc.new_stream(ids, pa.schema([whole.schema.field(0)])) as stream:
            stream.write_batch(whole.select(whole.schema.names[:1]))
        number += 1
        z = zstandard.ZstdCompressor(level=1)
        columns = [ids.getvalue().to_pybytes(), texts.offsets.tobytes(), texts.data.tobytes(), sink.getvalue().to_pybytes()]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([len(texts.data)], pa.int64()), *(pa.array([z.compress(c)], pa.binary()) for c in columns)], ["batch", "size", "ids", "offsets", "texts", "rest"])

    last = None
    for batch in rows:
        ids = batch.column(0).to_pylist()
        sizes = np.array(pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0))
        first = 0
        for row in range(batch.num_rows):
            if size >= BATCH_BYTES and ids[row] != last:
                if row > first:
                    held.append(batch.slice(first, row - first))
                yield packed(held)
                held, size, first = [], 0, row
            size += int(sizes[row])
            last = ids[row]
        if batch.num_rows > first:
            held.append(batch.slice(first))
    if held:
        yield packed(held)


def _unpacked(row: dict) -> tuple[pa.Array, pa.RecordBatch, Batch]:
    z = zstandard.ZstdDecompressor()
    ids = pa.ipc.open_stream(z.decompress(row["ids"])).read_next_batch().column(0)
    rest = pa.ipc.open_stream(z.decompress(row["rest"])).read_next_batch()
    data = np.frombuffer(z.decompress(row["texts"]), np.uint8) if row["texts"] else np.zeros(0, np.uint8)
    known = np.array(ids.fill_null(0)) + 0
    change = np.ones(len(known), np.int64)
    change[1:] = (known[1:] != known[:-1]) | (np.array(ids.is_null())[1:] != np.array(ids.is_null())[:-1])
    return ids, rest, Batch(data, np.frombuffer(z.decompress(row["offsets"]), np.int64), np.cumsum(change))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def remove_repeated(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), whole_characters: bool = False
) -> DataFrame:
    """One row per document: ``doc_id``, the columns ``keep``, ``n_bytes``, ``spans`` (removed ranges of bytes) and ``kept`` (the other bytes).

    With ``whole_characters`` a character goes only if all its bytes do, so that ``kept`` is UTF-8.
    """
    spark = documents.sparkSession
    ship(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    ordered = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *rest)
    ordered = ordered.repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"))
    with rows_per_batch(spark, 1000):
        batches = materialize(ordered.mapInArrow(tidy(_pack_batches), _BATCHES), "batches").df
    size = batches.agg(F.sum("size")).first()[0] or 0
    shards = max(1, min(SHARDS_PER_PARTITION * partitions, size // BATCH_BYTES))

    before: str | None = None
    for round_, ask in enumerate(ROUNDS):
        folder = scratch_path(spark, f"answers-{round_}")

        def send(rows: Iterator[pa.RecordBatch], ask=ask, before=before, folder=folder) -> Iterator[pa.RecordBatch]:
            for row in _rows(rows):
                asked, state = ask(_unpacked(row)[2], *_before(before, row["batch"]))
                keys, flags = asked.distinct, asked.flags
                _keep(folder, row["batch"], state, len(keys))
                cuts = np.searchsorted((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32), np.arange(shards + 1))
                for shard in np.flatnonzero(np.diff(cuts)):
                    own = slice(cuts[shard], cuts[shard + 1])
                    columns = [pa.array([shard], pa.int32()), pa.array([row["batch"]], pa.int64()), pa.array([pack(keys[own])]), pa.array([np.packbits(flags[own]).tobytes()])]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "batch", "keys", "flags"])

        with rows_per_batch(spark, 4):
            sent = batches.mapInArrow(tidy(send), _DEALT).repartition(partitions, "shard").sortWithinPartitions("shard", "batch")
            answered = sent.mapInArrow(tidy(_answer), _CODES).repartition(partitions, "batch").sortWithinPartitions("batch", "shard")
            materialize(answered.mapInArrow(tidy(_store(folder)), "batch long"), "stored")
        if before:
            delete_folder(spark, before)
        before = folder

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema.fields[2:]]
    schema = ", ".join(["doc_id long", *kinds, "n_bytes long", "spans array<struct<from:long,until:long>>", "kept binary"])

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(rows):
            ids, rest, batch = _unpacked(row)
            gone = batch.covered(_found(batch, *_before(before, row["batch"])))
            if whole_characters and len(gone):
                first = np.flatnonzero((batch.data & 0xC0) != 0x80)
                gone = np.repeat(np.logical_and.reduceat(gone, first), np.diff(np.append(first, len(gone))))
            kept = np.concatenate([[0], np.cumsum(~gone)])[batch.offsets]
            inside = np.concatenate([[False], gone, [False]])
            begins, stops = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
            # a run that goes on over the end of a text is one in either text
            edges = batch.offsets[1:-1]
            edges = np.unique(edges[inside[edges] & inside[edges + 1]])
            begins, stops = np.sort(np.append(begins, edges)), np.sort(np.append(stops, edges))
            owner = batch.owner(begins)
            spans = pa.StructArray.from_arrays([pa.array(begins - batch.offsets[owner]), pa.array(stops - batch.offsets[owner])], ["from", "until"])
            per_text = np.searchsorted(owner, np.arange(len(ids) + 1)).astype(np.int32)
            data = pa.py_buffer(batch.data[~gone].tobytes())
            left = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(kept.astype(np.int32)), data])
            columns = [ids, *rest.columns, pa.array(np.diff(batch.offsets)), pa.ListArray.from_arrays(pa.array(per_text), spans), left]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *rest.schema.names, "n_bytes", "spans", "kept"])

    out = batches.mapInArrow(tidy(cut), schema)
    return out.withColumnsRenamed({f"keep_{i}": c for i, c in enumerate(keep)})
