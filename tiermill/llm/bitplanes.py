"""Token ids of documents in plane-shuffled files.

A file holds the ids of consecutive documents. Ids are cut into blocks of fixed size; a block is transposed, so that
all first bytes (or bits) of its ids lie together, then all second ones, and so on; planes above the largest id are
left out, and each other plane is compressed with zstandard. At the end stand the chunk index (place, sizes of the
planes and first id of each block), the document index (ids and lengths) and the length of both:

    "TMBP1" | planes of block 0 | planes of block 1 | ... | index as JSON | document index | two 64-bit lengths

Documents are dealt over files by ranges of the document id, so files follow one another in that order;
documents with equal ids are ordered by text, ranges cut them by its first characters, and a NULL id comes first. A NULL text is
an empty one: it has no ids of its own. A special string of the tokenizer inside a text gets its own id, as the library
gives it. Other columns play no part. An empty table gives no file and no rows.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiermill.llm.files import new_file, reading, rows_per_batch, writing
from tiermill.llm.segments import PieceCache
from tiermill.llm.workers import keep, let_go, ship
from tiermill.sources.scratch import materialize, scratch_path

MAGIC = b"TMBP1"
BLOCK = 1 << 16
FILE_IDS = 64 << 20
CACHED_PIECES = 400_000
ORDER_CHARS = 32
_TEXTS_AT_ONCE = 2048


def split_planes(ids: np.ndarray, unit: str = "byte") -> list[bytes]:
    """Planes of a block of ids, lowest first, without those above its largest id."""
    cells = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if unit == "byte":
        used = max(1, (int(ids.max()).bit_length() + 7) // 8) if len(ids) else 0
        return [np.ascontiguousarray(cells[:, i]).tobytes() for i in range(used)]
    used = max(1, int(ids.max()).bit_length()) if len(ids) else 0
    bits = np.unpackbits(cells, axis=1, bitorder="little")[:, :used]
    return [plane.tobytes() for plane in np.packbits(np.ascontiguousarray(bits.T), axis=1)]


def join_planes(planes: list[bytes], count: int, unit: str = "byte") -> np.ndarray:
    if unit == "byte":
        cells = np.zeros((count, 4), np.uint8)
        for i, plane in enumerate(planes):
            cells[:, i] = np.frombuffer(plane, np.uint8)
        return cells.view("<u4").ravel()
    bits = np.zeros((count, 32), np.uint8)
    for i, plane in enumerate(planes):
        bits[:, i] = np.unpackbits(np.frombuffer(plane, np.uint8), count=count)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


class PlaneWriter:
    """Writes one file, block by block."""

    def __init__(self, out, unit: str = "byte", block: int = BLOCK, level: int = 3):
        self._out, self._unit, self._block = out, unit, block
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._waiting: list[np.ndarray] = []
        self._held = 0
        self._at = len(MAGIC)
        self._index: list[list[int]] = []
        self._documents: list[tuple[int | None, int]] = []
        self.ids = 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._documents.append((doc_id, len(ids)))
        self._waiting.append(ids)
        self._held += len(ids)
        self.ids += len(ids)
        if self._held >= self._block:
            held = np.concatenate(self._waiting)
            whole = len(held) - len(held) % self._block
            for at in range(0, whole, self._block):
                self._write(held[at : at + self._block])
            self._waiting, self._held = [held[whole:]], len(held) - whole

    def _write(self, ids: np.ndarray) -> None:
        packed = [self._zstd.compress(plane) for plane in split_planes(ids, self._unit)]
        self._index.append([self._at, len(ids), *map(len, packed)])
        for plane in packed:
            self._out.write(plane)
            self._at += len(plane)

    def close(self) -> None:
        if self._held:
            self._write(np.concatenate(self._waiting))
        index = json.dumps({"unit": self._unit, "block": self._block, "chunks": self._index}).encode()
        table = pa.table({"doc_id": pa.array([d for d, _ in self._documents], pa.int64()), "n": pa.array([n for _, n in self._documents], pa.int64())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        documents = self._zstd.compress(sink.getvalue().to_pybytes())
        for part in (index, documents, np.array([len(index), len(documents)], "<i8").tobytes()):
            self._out.write(part)


class PlaneReader:
    """Random access to the ids of one file by the chunk index."""

    def __init__(self, source):
        self._source = source
        size = source.size()
        sizes = np.frombuffer(source.read_at(16, size - 16), "<i8")
        tail = source.read_at(int(sizes.sum()), size - 16 - int(sizes.sum()))
        head = json.loads(tail[: sizes[0]])
        self.unit, self.block, self.chunks = head["unit"], head["block"], head["chunks"]
        table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(tail[sizes[0] :])).read_all()
        self.doc_ids = table["doc_id"].to_pylist()
        self.offsets = np.concatenate([[0], np.cumsum(table["n"].to_numpy())]).astype(np.int64)

    def chunk(self, number: int) -> np.ndarray:
        at, count, *sizes = self.chunks[number]
        raw, planes, used = self._source.read_at(sum(sizes), at), [], 0
        for size in sizes:
            planes.append(zstandard.ZstdDecompressor().decompress(raw[used : used + size]))
            used += size
        return join_planes(planes, count, self.unit)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids from ``start`` to ``end`` of the file; only the chunks that hold them are read."""
        if start == end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        found = np.concatenate([self.chunk(i) for i in range(first, last + 1)])
        return found[start - first * self.block : end - first * self.block]


class _Encoder:
    """Ids of whole texts as the library gives them; pieces of texts without special strings are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        plain.encode_special_tokens = True  # pieces hold no special strings, so none are looked for
        self._special = [token.content for token in self._whole.get_added_tokens_decoder().values()]
        self._pieces = PieceCache(lambda pieces, _: _encode(plain, pieces), CACHED_PIECES)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        marked = [i for i, text in enumerate(texts) if text and any(special in text for special in self._special)]
        if not marked:
            return self._pieces.ids(texts)
        whole = dict(zip(marked, _encode(self._whole, [texts[i] for i in marked]), strict=True))
        plain = self._pieces.ids([None if i in whole else text for i, text in enumerate(texts)])
        return [whole.get(i, ids) for i, ids in enumerate(plain)]


def _encode(tokenizer, texts: list[str]) -> Iterator[bytes]:
    for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
        yield array("I", found.ids).tobytes()


@lru_cache(2)
def _encoder(path: str) -> _Encoder:
    keep(_encoder.cache_clear)
    return _Encoder(path)


def write_ids(
    df: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", unit: str = "byte"
) -> DataFrame:
    """Encode ``text`` with a byte-level tokenizer file, append ``end_id`` to each document and write the ids.

    Gives one row per file, in order: ``file``, ``first_id`` (ids in files before it) and ``n_ids``.
    """
    spark = df.sparkSession
    ship(spark)
    folder = scratch_path(spark, "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        end = np.array([end_id], "<u4")
        rows = ((d, ids) for batch in batches for d, ids in encoded(batch))
        row = next(rows, None)
        while row is not None:
            path, first = new_file(folder, "ids"), row[0]
            with writing(path) as out:
                writer = PlaneWriter(out, unit)
                while row is not None and writer.ids < FILE_IDS:
                    writer.add(row[0], np.concatenate([row[1], end]))
                    row = next(rows, None)
                writer.close()
            yield pa.RecordBatch.from_pydict({"file": [path], "first_doc": pa.array([first], pa.int64()), "n_ids": [writer.ids]})

    def encoded(batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
        cache = _encoder(tokenizer)
        for at in range(0, batch.num_rows, _TEXTS_AT_ONCE):
            part = batch.slice(at, _TEXTS_AT_ONCE)
            for d, ids in zip(part.column(0).to_pylist(), cache.ids(part.column(1).to_pylist()), strict=True):
                yield d, np.frombuffer(ids, "<u4")

    placed = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    placed = placed.repartitionByRange(F.asc_nulls_first("doc_id"), F.substring("text", 1, ORDER_CHARS)).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    numbered = placed.mapInArrow(write, "file string, first_doc long, n_ids long").withColumn("part", F.monotonically_increasing_id())
    with rows_per_batch(spark, 2000):
        files = materialize(numbered, "id-files").df
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    first = F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    return files.select("file", first.alias("first_id"), "n_ids", "part")


def read_ids(files: DataFrame) -> DataFrame:
    """Read files back: ``doc_id``, ``start`` (ids of all documents before it) and ``ids``, little-endian 32-bit numbers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()  # the files were written in the same workers
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with reading(path) as source:
                    reader = PlaneReader(source)
                    at = 0
                    while at < len(reader.doc_ids):
                        until = max(at + 1, int(np.searchsorted(reader.offsets, reader.offsets[at] + (1 << 20), "right")) - 1)
                        own = reader.offsets[at : until + 1]
                        data = reader.ids(int(own[0]), int(own[-1])).astype("<u4").tobytes()
                        ids = pa.Array.from_buffers(
                            pa.binary(), until - at, [None, pa.py_buffer(((own - own[0]) * 4).astype(np.int32)), pa.py_buffer(data)]
                        )
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(reader.doc_ids[at:until], pa.int64()), pa.array(own[:-1] + first, pa.int64()), ids],
                            ["doc_id", "start", "ids"],
                        )
                        at = until

    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = files.select("file", "first_id").repartition(tasks, "file")  # a given number is not merged
    return spread.mapInArrow(read, "doc_id long, start long, ids binary")


def read_slice(spark: SparkSession, file: str, start: int, end: int) -> list[int]:
    """Some ids of one file, by its chunk index."""
    with reading(file) as source:
        return PlaneReader(source).ids(start, end).tolist()
