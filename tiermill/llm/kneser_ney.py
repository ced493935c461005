"""Interpolated modified Kneser-Ney language model over words, counted in Spark and mapped into memory for scoring.

Words are runs of bytes other than space and 0x09-0x0D, A-Z in lower case; each text ends with one end token. ``order`` is the
length of the longest runs of words counted, two or more, three unless stated; a text begins with order - 1 start marks.

Counting. Tasks count the distinct words of some texts and deal them over shards by ranges of the word hash; a shard adds
the counts up and writes sorted hashes with counts. The place of a hash in all shards is the number of its word. The longest
runs, as numbers, are counted alike, in shards by ranges of a hash of the run. Each level then gives the one below: a run adds to the
statistics of its context, the run without its last word (what follows it, and how many different words do so once, twice, more
often), and one to the count of its suffix, the run without its first word (different words before it). A shard sums this
before it is dealt, so no run, context or word is too frequent, and none has a shard of its own.

Files. Counted runs are kept packed until the level below is counted and they are written as sorted hashes; runs that
have the plainest record (seen once) are a sorted array without records, records of others are as wide as a shard needs.

Scoring. Workers map the arrays into memory and look up the distinct words and runs of a slice of texts in ascending order, so
a page of a file is touched once per slice. Nothing goes through the driver but one row per shard and level.

A NULL or empty text is a text of one end token. Repeated rows count each time. With nothing to learn from, every token
is unknown and has probability 1. Other columns stay; columns with the names of results are replaced. Counts have 64 bits; equality of
runs of three or more words rests on a hash of 64 bits, of words likewise, of pairs on their numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.arrays import Texts, mix, pack, text_slices, unpack, word_hashes
from tiermill.llm.files import local_view, new_file, reading, rows_per_batch, shuffles_deleted, writing
from tiermill.llm.workers import ship
from tiermill.sources.scratch import delete_folder, materialize, scratch_path

ORDER = 3
END = np.uint64(0x5851F42D4C957F2D)
TOKENS_AT_ONCE = 3 << 20
STRIDE = 64
SCORED_BYTES = 2 << 20
BLOCK = 1 << 20
_UNKNOWN = 0xFFFFFFFF
_HALF = np.uint64(32)
#: What is known of a run: different words before it, tokens after it, and different words after it once, twice, more often.
_FIELDS = ("count", "total", "once", "twice", "more")
#: The commonest record: one word before, one token after.
_PLAIN = (1, 1, 1, 0, 0)

Columns = list[np.ndarray]


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a slice, an end token after each text, and the places of the texts (one more at the end)."""
    found, hashes = word_hashes(texts)
    offsets = found.offsets + np.arange(len(found.offsets))
    out = np.full(offsets[-1], END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[offsets[1:] - 1] = False
    out[inside] = hashes
    return out, offsets


def _order(keys: np.ndarray) -> np.ndarray:
    """Places of the keys in ascending order, equal ones as they come.

    Whole numbers are sorted faster than their places are, so each key is sorted with its place in its lowest bits; keys that
    then differ in those bits only, few among hashes, are put in order afterwards.
    """
    if not len(keys):
        return np.zeros(0, np.int64)
    keys = keys.astype(np.uint64, copy=False)
    bits = len(keys).bit_length()
    low = np.uint64((1 << bits) - 1)
    free = np.uint64(64 - int(keys.max()).bit_length())
    placed = keys << free if free < 64 else keys
    placed = (placed & ~low) | np.arange(len(keys), dtype=np.uint64)
    placed.sort()
    order = (placed & low).astype(np.int64)
    if free < bits:
        found = keys[order]
        if (found[1:] < found[:-1]).any():
            order = order[np.argsort(found, kind="stable")]  # nearly sorted
    return order


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, and for each key its place among them."""
    order = _order(keys)
    ascending = keys[order]
    first = np.append(True, ascending[1:] != ascending[:-1]) if len(keys) else np.zeros(0, bool)
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(first) - 1
    return ascending[first], place


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> _HALF) * np.uint64(shards) >> _HALF).astype(np.int64)


def _key(columns: Columns) -> np.ndarray:
    """One column is its own key; of a run of numbers it is a hash, one to one for pairs."""
    key = columns[0]
    for column in columns[1:]:
        key = mix((key << _HALF | key >> _HALF) ^ column)
    return key


def _merged(columns: Columns, fields: Columns) -> tuple[np.ndarray, Columns, Columns]:
    """Sum the fields of equal runs: keys (ascending), columns, fields."""
    key = _key(columns)
    order = _order(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    sums = [np.add.reduceat(f[order], first) if len(first) else f for f in fields]
    return key[first], [c[order[first]] for c in columns], sums


def _lead(columns: Columns) -> np.ndarray:
    return columns[0] if len(columns) == 1 else columns[0] << _HALF | columns[1]


def _lead_order(columns: Columns) -> np.ndarray:
    """Places of runs in ascending order of their first two words."""
    if len(columns) == 1 or not len(columns[0]):
        return _order(columns[0])
    most = int(columns[1].max()) + 1
    narrow = int(columns[0].max()) * most + most < 1 << 64
    return _order(columns[0] * np.uint64(most) + columns[1] if narrow else _lead(columns))


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same values, each as wide as the largest one needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))).newbyteorder("<"))


def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers, their width first, then byte plane by byte plane, compressed."""
    values = _narrow(values)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return bytes([values.itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _expand(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(blob[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{blob[0]}").ravel()


def _packed(columns: Columns, fields: Columns) -> list[bytes]:
    """Runs in ascending order of their first two words."""
    return [pack(_lead(columns)), *(_squeeze(c) for c in columns[2:]), *(_squeeze(f) for f in fields)]


def _unpacked(parts: list[bytes], words: int) -> tuple[Columns, Columns]:
    lead = unpack(parts[0])
    columns = [lead] if words == 1 else [lead >> _HALF, lead & np.uint64(_UNKNOWN)]
    rest = [_expand(part) for part in parts[1:]]
    more = max(0, words - 2)
    return columns + [c.astype(np.uint64) for c in rest[:more]], [f.astype(np.int64) for f in rest[more:]]


_DEALT = "shard int, parts array<binary>"


def _deal(columns: Columns, fields: Columns, place: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """Rows of packed runs, one per shard."""
    order = _lead_order(columns)
    order = order[np.argsort(place[order].astype(np.min_scalar_type(shards)), kind="stable")]
    cuts = np.searchsorted(place[order], np.arange(shards + 1))
    for shard in np.flatnonzero(np.diff(cuts)):
        own = order[cuts[shard] : cuts[shard + 1]]
        parts = _packed([c[own] for c in columns], [f[own] for f in fields])
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([parts], pa.list_(pa.binary()))], ["shard", "parts"])


def _by_shard(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[int, np.ndarray, Columns, Columns]]:
    """Rows that come sorted by shard, a shard at a time; fields are added up as they come."""
    shard, held, size, limit = None, [], 0, TOKENS_AT_ONCE

    def joined() -> tuple[np.ndarray, Columns, Columns]:
        columns, fields = ([np.concatenate(c) for c in zip(*side, strict=True)] for side in zip(*held, strict=True))
        held.clear()
        return _merged(columns, fields)

    for batch in batches:
        for now, parts in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
            if now != shard and held:
                yield shard, *joined()
                size, limit = 0, TOKENS_AT_ONCE
            shard = now
            held.append(_unpacked(parts, words))
            size += len(held[-1][0][0])
            if size > limit and len(held) > 1:
                key, *rest = joined()
                held.append(tuple(rest))
                size = len(key)
                limit = max(TOKENS_AT_ONCE, 2 * size)
    if held:
        yield shard, *joined()


def _write(folder: str, label: str, values: np.ndarray) -> str:
    if not len(values):
        return ""
    path = new_file(folder, label)
    with writing(path) as out:
        out.write(np.ascontiguousarray(values).tobytes())
    return path


def _write_records(folder: str, fields: Columns) -> str:
    """Records side by side, each value as wide as the largest one needs."""
    return _write(folder, "records", _narrow(np.stack(fields, axis=1)))


def _row(names: str, values: list) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    columns = [pa.array([v], kinds[name.split()[1]]) for name, v in zip(names.split(", "), values, strict=True)]
    return pa.RecordBatch.from_arrays(columns, [name.split()[0] for name in names.split(", ")])


_COUNTED = "shard int, path string, sizes array<long>, total long, n long, n1 long, n2 long, n3 long, n4 long"


def _kinds(counts: np.ndarray) -> list[int]:
    """Sum of counts, how many there are, and how many are one to four."""
    return [int(counts.sum()), int((counts > 0).sum()), *(int((counts == i).sum()) for i in range(1, 5))]


def _counted(folder: str, shard: int, columns: Columns, fields: Columns) -> pa.RecordBatch:
    """Write the runs of a shard, which come in ascending order of their keys, packed in blocks."""
    path, sizes = new_file(folder, "counted"), []
    with writing(path) as out:
        for at in range(0, len(fields[0]), BLOCK):
            own = _lead_order([c[at : at + BLOCK] for c in columns]) + at
            for part in _packed([c[own] for c in columns], [f[own] for f in fields]):
                out.write(part)
                sizes.append(len(part))
    return _row(_COUNTED, [shard, path, sizes, *_kinds(fields[0])])


def _blocks(path: str, sizes: list[int], words: int, fields: int) -> Iterator[tuple[Columns, Columns]]:
    parts = 1 + max(0, words - 2) + fields
    with reading(path) as source:
        for at in range(0, len(sizes), parts):
            yield _unpacked([source.read(size) for size in sizes[at : at + parts]], words)


_FILES = "shard int, once string, keys string, records string, n_once long, n_more long, total long"


def _indexed(folder: str, shard: int, blocks: Iterator[tuple[np.ndarray, Columns]], plain: tuple[int, ...]) -> pa.RecordBatch:
    """Write sorted keys, those with the plainest record apart; keys ascend within and across blocks."""
    once, keys, records, total = [], [], [], 0
    for key, fields in blocks:
        same = np.logical_and.reduce([f == v for f, v in zip(fields, plain, strict=True)])
        once.append(key[same])
        keys.append(key[~same])
        records.append([f[~same] for f in fields])
        total += int(fields[0].sum())
    once, keys = np.concatenate(once).astype("<u8"), np.concatenate(keys).astype("<u8")
    fields = [np.concatenate(f) for f in zip(*records, strict=True)]
    paths = [_write(folder, "once", once), _write(folder, "keys", keys), _write_records(folder, fields) if len(keys) else ""]
    return _row(_FILES, [shard, *paths, len(once), len(keys), total])


@lru_cache(1 << 14)
def _mapped(path: str, kind: str) -> np.ndarray:
    return local_view(path, np.dtype(kind)).view(np.ndarray)  # without a memmap's cost per slice


@lru_cache(1 << 14)
def _guide(path: str) -> np.ndarray:
    """Every 64th key, in memory."""
    return _mapped(path, "<u8")[::STRIDE].copy()


def _last_up_to(path: str, sought: np.ndarray) -> np.ndarray:
    """For each key sought the place of the last stored one up to it, else the first: by the guide, then by halving the stride
    for all at once, so that reads of memory overlap."""
    held = _mapped(path, "<u8")
    at = np.maximum(np.searchsorted(_guide(path), sought, "right") - 1, 0) * STRIDE
    step = STRIDE // 2
    while step:
        probe = np.minimum(at + step, len(held) - 1)
        at = np.where(held[probe] <= sought, probe, at)
        step //= 2
    return at


def _records(path: str, rows: int, fields: int) -> np.ndarray:
    raw = _mapped(path, "u1")
    return raw.view(f"<u{len(raw) // (rows * fields)}").reshape(rows, fields)


@dataclass
class Level:
    """Paths of the shards of sorted arrays, their sizes, and where each shard begins in the whole."""

    shards: int
    plain: tuple[int, ...]
    files: list[tuple[str, str, str, int, int]]
    starts: list[int]

    @classmethod
    def of(cls, rows: list, shards: int, plain: tuple[int, ...]) -> Level:
        files = [("", "", "", 0, 0)] * shards
        for row in rows:
            files[row.shard] = (row.once, row.keys, row.records, row.n_once, row.n_more)
        return cls(shards, plain, files, np.concatenate([[0], np.cumsum([f[3] + f[4] for f in files])]).astype(int).tolist())

    def __len__(self) -> int:
        return self.starts[-1]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For ascending keys their place in the whole, or -1, and their records (fields by keys), zeros for unknown ones."""
        where, out = np.full(len(keys), -1), np.zeros((len(self.plain), len(keys)), np.int64)
        cuts = np.searchsorted(_shard(keys, self.shards), np.arange(self.shards + 1))
        for shard in np.flatnonzero(np.diff(cuts)):
            asked, left = keys[cuts[shard] : cuts[shard + 1]], None
            once, more, records, n_once, n_more = self.files[shard]
            parts = [(once, n_once, 0, False), (more, n_more, n_once, True)]
            for path, rows, start, recorded in sorted(parts, key=lambda part: -part[1]):  # most are found in the longer one
                if not rows or left is not None and not len(left):
                    continue
                sought = asked if left is None else asked[left]
                at = _last_up_to(path, sought)
                same = _mapped(path, "<u8")[at] == sought
                own = np.flatnonzero(same)
                at, to = at[own], (own if left is None else left[own]) + cuts[shard]
                left = np.flatnonzero(~same) if left is None else left[~same]
                where[to] = self.starts[shard] + start + at
                out[:, to] = _records(records, rows, len(self.plain))[at].T if recorded else np.array(self.plain)[:, None]
        return where, out


def _discounts(n: tuple[int, int, int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of runs seen once to four times."""
    if min(n) <= 0:
        return 0.5, 0.75, 0.9
    y = n[0] / (n[0] + 2 * n[1])
    found = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])
    return tuple(float(np.clip(d, 0.05, i - 0.05)) for i, d in enumerate(found, 1))


def _discount(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *by])[np.minimum(counts, 3)]


@dataclass
class Model:
    """Where the arrays lie, and the totals that every score needs."""

    order: int
    words: Level
    tokens: int
    singles: list[str] = field(default_factory=list)
    levels: dict[int, Level] = field(default_factory=dict)
    discounts: dict[int, tuple[float, float, float]] = field(default_factory=dict)
    pair_kinds: int = 0
    spread: float = 1.0

    @property
    def n_words(self) -> int:
        return len(self.words)

    def columns(self, numbers: np.ndarray, offsets: np.ndarray) -> Columns:
        """The runs that end at each token, word by word; start marks have the number after the last word."""
        place = np.arange(len(numbers)) - np.repeat(offsets[:-1], np.diff(offsets))
        own = numbers.astype(np.uint64) & np.uint64(_UNKNOWN)
        out = [own]
        for back in range(1, self.order):
            before = np.full(len(own), self.n_words, np.uint64)
            before[back:] = np.where(place[back:] >= back, own[: len(own) - back], np.uint64(self.n_words))
            out.insert(0, before)
        return out

    def single(self, numbers: np.ndarray) -> np.ndarray:
        """Records of words by their numbers (ascending); those of unknown ones are zero."""
        out = np.zeros((len(_FIELDS), len(numbers)), np.int64)
        width = _width(self.n_words, len(self.singles))
        cuts = np.searchsorted(numbers.astype(np.int64), np.arange(len(self.singles) + 1) * width)
        for shard in np.flatnonzero(np.diff(cuts)):
            if self.singles[shard]:
                own = slice(cuts[shard], cuts[shard + 1])
                out[:, own] = _records(self.singles[shard], width, len(_FIELDS))[numbers[own].astype(np.int64) - shard * width].T
        return out

    def scores(self, texts: Texts) -> list[np.ndarray]:
        """Per text: tokens, known tokens, base score and model score."""
        hashes, offsets = tokens(texts)
        distinct, which = _distinct(hashes)
        number, (count,) = self.words.find(distinct)
        base = np.log10((count + 0.1) / (self.tokens + 0.1 * (self.n_words + 1)))
        chance = self.chances(self.columns(number[which], offsets), offsets) if self.pair_kinds else np.ones(len(hashes))
        total = lambda values: np.add.reduceat(values, offsets[:-1])
        return [np.diff(offsets), total((count > 0)[which].astype(np.int64)), total(base[which]), total(np.log10(chance))]

    def chances(self, columns: Columns, offsets: np.ndarray) -> np.ndarray:
        """Probability of each token of some texts, from words alone to the longest runs.

        The context of a token is the run that ends at the token before, so each run is looked up once, and one of start marks.
        """
        size, d = len(columns[-1]), self.discounts[1]
        records, which = self.records(columns[-1:])
        left = np.maximum(records[0] - _discount(records[0], d), 0)
        chance = (left / self.pair_kinds + self.spread / (self.n_words + 1))[which[:-1]]
        for words in range(2, self.order + 1):
            d, total = self.discounts[words], records[1]
            rest = np.where(total > 0, (d[0] * records[2] + d[1] * records[3] + d[2] * records[4]) / np.maximum(total, 1), 1.0)
            context = np.empty(size, np.int64)
            context[1:] = which[: size - 1]
            context[offsets[:-1]] = which[-1]
            records, which = self.records(columns[self.order - words :])
            seen = np.maximum(records[0] - _discount(records[0], d), 0)[which[:-1]] / np.maximum(total, 1)[context]
            chance = seen + rest[context] * chance
        return chance

    def records(self, columns: Columns) -> tuple[np.ndarray, np.ndarray]:
        """Records of distinct runs, and for each run, and for one of start marks at the end, which of them is its own."""
        keys = _key([np.append(c, np.uint64(self.n_words)) for c in columns])
        if len(columns) < self.order:
            distinct, which = _distinct(keys)
            return self.single(distinct) if len(columns) == 1 else self.levels[len(columns)].find(distinct)[1], which
        order = _order(keys)  # the longest runs are mostly different ones
        which = np.empty(len(keys), np.int64)
        which[order] = np.arange(len(keys))
        return self.levels[self.order].find(keys[order])[1], which


def _width(n_words: int, shards: int) -> int:
    return -(-(n_words + 1) // max(1, shards))


def _flushed(batches: Iterator[pa.RecordBatch], runs_of: Callable[[Texts], Columns]) -> Iterator[tuple[np.ndarray, Columns, Columns]]:
    """Distinct runs and their counts, for some texts at a time."""
    held, size = [], 0

    def joined() -> tuple[np.ndarray, Columns, Columns]:
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        held.clear()
        return _merged(columns, [np.ones(len(columns[0]), np.int64)])

    for batch in batches:
        for part in text_slices(batch.column(0)):
            held.append(runs_of(part))
            size += len(held[-1][0])
            if size >= TOKENS_AT_ONCE:
                yield joined()
                size = 0
    if size:
        yield joined()


def fit(documents: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """Count the words and runs of all texts; the model lies in files of the scratch folder."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = documents.sparkSession
    ship(spark)
    folder = scratch_path(spark, "model")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = documents.select(F.col(text).alias("text"))

    def stored(rows: DataFrame, add: Callable, schema: str, label: str) -> DataFrame:
        """Rows added up per shard."""
        return materialize(rows.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(add, schema), label).df

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, columns, fields in _flushed(batches, lambda part: [tokens(part)[0]]):
            yield from _deal(columns, fields, _shard(key, shards), shards)

    def add_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, key, _, fields in _by_shard(batches, 1):
            yield _indexed(folder, shard, iter([(key, fields)]), (1,))

    with rows_per_batch(spark, 200), shuffles_deleted(spark):
        rows = stored(texts.mapInArrow(count_words, _DEALT), add_words, _FILES, "words").collect()  # one row per shard
    model = Model(order, Level.of(rows, shards, (1,)), sum(row.total for row in rows))
    n_words = model.n_words
    if n_words + shards >= _UNKNOWN:
        raise ValueError("too many distinct words for numbers of 32 bits")
    width = _width(n_words, shards)

    def count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs(part: Texts) -> Columns:
            hashes, offsets = tokens(part)
            distinct, which = _distinct(hashes)
            return model.columns(model.words.find(distinct)[0][which], offsets)

        for key, columns, fields in _flushed(batches, runs):
            yield from _deal(columns, fields, _shard(key, shards), shards)

    def adder(words: int, place: str) -> Callable:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for shard, _, columns, fields in _by_shard(batches, words):
                yield _counted(place, shard, columns, fields)

        return add

    def splitter(words: int) -> Callable:
        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """What runs add to their contexts and suffixes."""
            fields = 1 if words == order else len(_FIELDS)
            for batch in batches:
                for path, sizes in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                    for columns, (count, *_) in _blocks(path, sizes, words, fields):
                        use = count > 0  # runs of start marks alone are contexts only
                        columns, count = [c[use] for c in columns], count[use]
                        none = np.zeros(len(count), np.int64)
                        context = [none, count, *(x.astype(np.int64) for x in (count == 1, count == 2, count > 2))]
                        suffix = [none + 1, none, none, none, none]
                        both = [np.concatenate(x) for x in zip(columns[:-1], columns[1:], strict=True)]
                        key, *parts = _merged(both, [np.concatenate(x) for x in zip(context, suffix, strict=True)])
                        yield from _deal(*parts, key.astype(np.int64) // width if words == 2 else _shard(key, shards), shards)

        return split

    def indexer(words: int) -> Callable:
        def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            plain = (1,) if words == order else _PLAIN
            for batch in batches:
                for path, sizes, shard in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    blocks = (_merged(*block) for block in _blocks(path, sizes, words, len(plain)))
                    yield _indexed(folder, shard, ((key, fields) for key, _, fields in blocks), plain)

        return index

    def add_singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, key, _, fields in _by_shard(batches, 1):
            whole = [np.zeros(width, np.int64) for _ in fields]
            for values, own in zip(whole, fields, strict=True):
                values[key.astype(np.int64) - shard * width] = own
            yield _row(_COUNTED, [shard, _write_records(folder, whole), [], *_kinds(whole[0])])

    def learned(words: int, rows: list) -> None:
        model.discounts[words] = _discounts(tuple(sum(getattr(row, f"n{i}") for row in rows) for i in range(1, 5)))

    with rows_per_batch(spark, 200), shuffles_deleted(spark):
        place = scratch_path(spark, "runs")
        counted = stored(texts.mapInArrow(count_runs, _DEALT), adder(order, place), _COUNTED, "runs")
        for words in range(order, 1, -1):
            learned(words, counted.collect())  # one row per shard
            own = counted.select("path", "sizes", "shard").repartition(shards, "path")
            parts = own.mapInArrow(splitter(words), _DEALT)
            below = scratch_path(spark, "runs")
            shorter = stored(parts, add_singles if words == 2 else adder(words - 1, below), _COUNTED, "runs")
            files = materialize(own.mapInArrow(indexer(words), _FILES), "files").df.collect()  # one row per shard
            model.levels[words] = Level.of(files, shards, (1,) if words == order else _PLAIN)
            delete_folder(spark, place)
            counted, place = shorter, below
        rows = counted.collect()  # one row per shard
    learned(1, rows)
    model.singles = [""] * shards
    for row in rows:
        model.singles[row.shard] = row.path
    model.pair_kinds = sum(row.total for row in rows)
    if model.pair_kinds:
        d, n = model.discounts[1], [sum(getattr(row, name) for row in rows) for name in ("n", "n1", "n2")]
        model.spread = (d[0] * n[1] + d[1] * n[2] + d[2] * (n[0] - n[1] - n[2])) / model.pair_kinds
    return model


RESULTS = ("n_tokens", "n_known", "base_score", "score")


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10) of each text."""
    ship(df.sparkSession)

    @F.arrow_udf("struct<n_tokens:long,n_known:long,base_score:double,score:double>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [model.scores(part) for part in text_slices(texts, SCORED_BYTES)]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            columns = [pa.array(np.concatenate([p[i] for p in parts]) if parts else [], k) for i, k in enumerate(kinds)]
            yield pa.StructArray.from_arrays(columns, list(RESULTS))

    both = df.withColumn("__scored", scored(F.col(text)))
    return both.withColumns({name: F.col(f"__scored.{name}") for name in RESULTS}).drop("__scored")


def perplexity(total: float, n_tokens: int) -> float:
    """Perplexity of a text from its log10 score."""
    return float(10 ** (-total / max(1, n_tokens)))
