"""Group spelling variants: words one edit apart, found by Bloom filters over the vocabulary.

1. ``count_words`` counts words of whole texts: tasks add up what they meet in tables of bounded size, Spark sums by word.
2. The vocabulary is cut into shards by length and, above ``SHARD_WORDS``, by hash. Each shard becomes a blocked Bloom
   filter: a word sets eight bits of one block of 256.
3. Filters are broadcast in rounds of at most ``ROUND_BYTES``, whatever the size of the vocabulary; a vocabulary of up to
   32 million words takes one round. In a round every word whose edits could lie in a shard at hand generates them and
   probes: its deletions in the shards one character shorter, and its replacements by a later character in those of
   its own length. An insertion is the deletion seen from the other word, so each pair is met once.
4. Only edits that a filter lets pass are shuffled, to be joined with the vocabulary on the exact text; what the filters
   passed wrongly finds no partner. A word of n characters has at most n deletions and n replacements per character
   of the alphabet, so no word meets more partners than that.

Hashes of edits come from sums over positions, so an edit costs a few operations instead of a new string. No hash
decides a result.

NULL texts have no words; a NULL id counts as an empty text where the id plays a part. Rows that repeat are counted as
often as they occur. Texts are read in pieces that end between words, so the longest word bounds the memory, not
the text. Other columns play no part; no documents, no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.arrays import mix
from tiermill.llm.files import rows_per_batch
from tiermill.llm.workers import let_go, ship
from tiermill.sources.scratch import materialize

SHARD_WORDS = 1 << 13
ROUND_BYTES = 64 << 20
KEYS_PER_BLOCK = 16  # of 256 bits
_HELD_WORDS = 400_000
_PIECE = 1 << 20
_CUBE = 1 << 20

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SEED = np.uint64(0x9E3779B97F4A7C15)
_LANES = np.uint64(0xD6E8FEB86659FD93)


def runs(text: str) -> Iterator[list[str]]:
    """Maximal runs of letters with A-Z in lower case, in lists of about a piece of the text."""
    at = 0
    while at < len(text):
        until = at + _PIECE
        inside = _RUN.match(text, until)
        until = inside.end() if inside else until
        yield _RUN.findall(text[at:until].encode("utf-8", "replace").translate(_LOWER).decode())
        at = until


def slipped(word: str, code: int) -> str:
    """The word without one of its characters, chosen by ``code``."""
    at = code % len(word)
    return word[:at] + word[at + 1 :]


def count_words(df: DataFrame, doc_id: str = "doc_id", text: str = "text", slip: int | None = None, shortest: int = 6, fewest: int = 5) -> DataFrame:
    """``word``, ``n``: words of ``shortest`` characters or more that occur ``fewest`` times or more, stored.

    With ``slip``, one in so many (document, word) pairs loses a character before counting, chosen by the crc32 of
    ``<id>:<word>``: known misspellings for trials.
    """
    spark = df.sparkSession
    ship(spark)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held: Counter[str] = Counter()
        for batch in batches:
            for own, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                begin = zlib.crc32(f"{'' if own is None else own}:".encode())
                for words in runs(whole.as_py() or ""):
                    if not slip:
                        held.update(w for w in words if len(w) >= shortest)
                    else:
                        for word, n in Counter(words).items():
                            if len(word) >= shortest:
                                code = zlib.crc32(word.encode(), begin)
                                word = word if code % slip else slipped(word, code)
                                if len(word) >= shortest:
                                    held[word] += n
                    if len(held) > _HELD_WORDS:
                        yield counted(held)
                        held.clear()
        yield counted(held)

    def counted(held: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    parts = df.select(F.col(doc_id).cast("string"), F.col(text).cast("string")).mapInArrow(count, "word string, n long")
    words = parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)
    with rows_per_batch(spark, 1000):
        return materialize(words, "words").df


def _cells(at: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """What a character adds to the hash of a word at a position."""
    return mix(((at.astype(np.uint64) << np.uint64(32)) | codes.astype(np.uint64)) + _SEED)


def _finish(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums ^ mix(np.array([length], np.uint64) + _LANES))


def matrix(words: list[str]) -> np.ndarray:
    """Words of equal length as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def hashes(codes: np.ndarray) -> np.ndarray:
    return _finish(_cells(np.arange(codes.shape[1]), codes).sum(axis=1, dtype=np.uint64), codes.shape[1])


def _bits(keys: np.ndarray, lane: int) -> np.ndarray:
    """The two bits of each key in a lane."""
    spread = (keys * _LANES) >> np.uint64(12 * lane + 12)
    return (np.uint64(1) << (spread & np.uint64(63))) | (np.uint64(1) << ((spread >> np.uint64(6)) & np.uint64(63)))


def _block(keys: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The block of each key among so many, by its upper bits."""
    return ((keys >> np.uint64(32)) * blocks >> np.uint64(32)).astype(np.int64)


def blocked_bloom(keys: np.ndarray) -> np.ndarray:
    """Blocks of four 64-bit lanes; a key sets two bits in each lane of one block."""
    lanes = np.zeros((max(1, -(-len(keys) // KEYS_PER_BLOCK)), 4), np.uint64)
    block = _block(keys, np.uint64(len(lanes)))
    for lane in range(4):
        np.bitwise_or.at(lanes[:, lane], block, _bits(keys, lane))
    return lanes


class Shards:
    """The filters at hand: by length, some or all parts of the words of that length, one behind the other."""

    def __init__(self, rows: list[tuple[int, int, int, bytes]]):
        self._lanes = np.frombuffer(b"".join(r[3] for r in rows), "<u8").reshape(-1, 4)
        self._first: dict[int, np.ndarray] = {}
        self._blocks: dict[int, np.ndarray] = {}
        at = 0
        for length, part, parts, lanes in rows:
            self._first.setdefault(length, np.zeros(parts, np.int64))[part] = at
            self._blocks.setdefault(length, np.zeros(parts, np.uint64))[part] = len(lanes) // 32
            at += len(lanes) // 32

    def __contains__(self, length: int) -> bool:
        return length in self._first

    def passed(self, keys: np.ndarray, length: int) -> np.ndarray:
        """Places of the keys that may be in the parts at hand; later lanes are read for those only that passed the earlier ones."""
        blocks = self._blocks[length]
        part = keys.view(np.int64) % len(blocks)
        left = np.flatnonzero(blocks[part])
        keys, part = keys[left], part[left]
        block = self._first[length][part] + _block(keys, blocks[part])
        for lane in range(4):
            bits = _bits(keys, lane)
            hit = np.flatnonzero((self._lanes[block, lane] & bits) == bits)
            left, keys, block = left[hit], keys[hit], block[hit]
        return left


def near_candidates(words: list[str], shards: Shards, alphabet: np.ndarray) -> Iterator[tuple[int, str]]:
    """(Number of the word, edit) for deletions and later replacements that a filter lets pass; words of equal length."""
    codes = matrix(words)
    length = codes.shape[1]
    at = np.arange(length)
    own = _cells(at, codes)
    if length - 1 in shards:
        before = np.cumsum(own, axis=1, dtype=np.uint64) - own
        moved = np.zeros_like(own)
        moved[:, 1:] = _cells(at[:-1], codes[:, 1:])
        after = moved.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
        once = np.ones(codes.shape, bool)
        once[:, 1:] = codes[:, 1:] != codes[:, :-1]  # deleting either of two equal neighbours gives the same
        row, place = np.nonzero(once)
        for i in shards.passed(_finish((before + after)[row, place], length - 1), length - 1).tolist():
            word, p = words[row[i]], int(place[i])
            yield int(row[i]), word[:p] + word[p + 1 :]
    if length in shards:
        whole = own.sum(axis=1, dtype=np.uint64)
        step = max(1, _CUBE // (len(words) * max(1, len(alphabet))))
        for begin in range(0, length, step):
            some = at[begin : begin + step]
            bare = whole[:, None] - own[:, some]
            cube = bare[:, :, None] + _cells(some[:, None], alphabet[None, :])[None]
            row, place, letter = np.nonzero(alphabet[None, None, :] > codes[:, some, None])
            for i in shards.passed(_finish(cube[row, place, letter], length), length).tolist():
                word, p = words[row[i]], begin + int(place[i])
                yield int(row[i]), word[:p] + chr(alphabet[letter[i]]) + word[p + 1 :]


def _by_length(words: list[str], most: int) -> Iterator[list[int]]:
    """Numbers of words of equal length, few enough that their edits fit into memory."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length).tolist()
        step = max(1, most // max(1, length))
        yield from (own[i : i + step] for i in range(0, len(own), step))


def _hashed(words: DataFrame) -> DataFrame:
    """Words with length and hash, stored."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            found = np.zeros(len(own), np.uint64)
            for some in _by_length(own, _CUBE):
                found[some] = hashes(matrix([own[i] for i in some]))
            lengths = pa.array([len(w) for w in own], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, lengths, pa.array(found.view(np.int64))], ["word", "n", "length", "hash"])

    return materialize(words.select("word", "n").mapInArrow(add, "word string, n long, length int, hash long"), "hashed-words").df


def _alphabet(words: DataFrame) -> np.ndarray:
    """The code points that occur in words."""

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"code": pa.array(sorted({ord(c) for c in set().union(*batch.column(0).to_pylist())}), pa.int32())})

    found = words.select("word").mapInArrow(used, "code int").distinct().collect()
    return np.array(sorted(r.code for r in found), np.uint32)


def _filters(words: DataFrame) -> DataFrame:
    """One row per shard of the vocabulary: ``length``, ``part`` of ``parts``, and its filter, stored."""
    sizes = words.groupBy("length").agg(F.ceil(F.count(F.lit(1)) / SHARD_WORDS).cast("int").alias("parts"))
    placed = words.select("length", "hash").join(sizes, "length").withColumn("part", F.expr("int(pmod(hash, parts))"))

    def build(key: tuple, group: pa.Table) -> pa.Table:
        keys = group.column("hash").to_numpy().view(np.uint64)
        shard = [pa.array([value.as_py()], pa.int32()) for value in key]
        return pa.table([*shard, pa.array([blocked_bloom(keys).astype("<u8").tobytes()])], ["length", "part", "parts", "lanes"])

    # dealt by part as well: the join before leaves all parts of a length in one task
    groups = placed.repartition("length", "part").groupBy("length", "part", "parts").applyInArrow(build, "length int, part int, parts int, lanes binary")
    return materialize(groups.withColumn("bytes", F.octet_length("lanes")), "word-filters").df


def _rounds(filters: DataFrame) -> Iterator[list[tuple[int, int]]]:
    """Shards in ascending order, packed into rounds of ``ROUND_BYTES``."""
    held, size = [], 0
    for r in filters.select("length", "part", "bytes").orderBy("length", "part").collect():  # a row per ``SHARD_WORDS``
        if held and size + r.bytes > ROUND_BYTES:
            yield held
            held, size = [], 0
        held.append((r.length, r.part))
        size += r.bytes
    if held:
        yield held


def near_words(words: DataFrame) -> DataFrame:
    """Pairs of words one edit apart, each pair once: ``word``, ``n``, ``other``, ``other_n``. ``words`` has distinct ``word`` and ``n``."""
    spark = words.sparkSession
    ship(spark)
    hashed = _hashed(words)
    alphabet, filters = _alphabet(hashed), _filters(hashed)
    passed = spark.createDataFrame([], "word string, n long, other string")
    for shards in _rounds(filters):
        passed = passed.unionByName(_probe(hashed, filters, shards, alphabet))
    exact = hashed.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return passed.join(exact, "other").select("word", "n", "other", "other_n")


def _probe(hashed: DataFrame, filters: DataFrame, shards: list[tuple[int, int]], alphabet: np.ndarray) -> DataFrame:
    """Edits of all words that pass the filters of some shards, stored."""
    context = hashed.sparkSession.sparkContext
    low, high = shards[0], shards[-1]
    place = F.struct("length", "part")
    some = filters.filter((place >= F.struct(F.lit(low[0]), F.lit(low[1]))) & (place <= F.struct(F.lit(high[0]), F.lit(high[1]))))
    shared = context.broadcast([(r.length, r.part, r.parts, bytes(r.lanes)) for r in some.collect()])  # ROUND_BYTES at most

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_hand = Shards(shared.value)
        for batch in batches:
            own, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for few in _by_length(own, _CUBE // 64):
                found = [(few[i], edit) for i, edit in near_candidates([own[i] for i in few], at_hand, alphabet)]
                if found:
                    cells = [own[i] for i, _ in found], [n[i] for i, _ in found], [edit for _, edit in found]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["word", "n", "other"])

    near = hashed.filter(F.col("length").between(low[0], high[0] + 1)).select("word", "n")
    spread = near.repartition(int(hashed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    try:
        return materialize(spread.mapInArrow(probe, "word string, n long, other string"), "near-words").df
    finally:
        shared.destroy()


def forms(words: DataFrame, ratio: float = 5) -> DataFrame:
    """Add ``n_near``, ``form`` and ``form_n``, ``root`` to ``words`` (distinct ``word``, ``n``).

    The form is the near word of largest ``n``, ties by code-point order, if that is ``ratio`` times the word's own or
    more. With a ratio above 1 counts grow along forms, so following them ends: at the root.
    """
    if ratio <= 1:
        raise ValueError("with a ratio of 1 or less, forms could lead in circles")
    pairs = near_words(words)
    back = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other")))
    near = pairs.unionByName(back).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    chosen = F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best"))
    joined = words.select("word", "n").join(near, "word", "left").withColumn("best", chosen)
    known = materialize(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.other").alias("form"), (-F.col("best.less")).alias("form_n")
        ),
        "forms",
    ).df
    return known.join(_roots(known), "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(known: DataFrame) -> DataFrame:
    """The last form of every word that has one: each round doubles the number of steps that a word looks ahead."""
    steps = materialize(known.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "steps")
    moved = steps.rows
    while moved:
        ahead = steps.df.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        taken = steps.df.join(ahead, "root", "left")
        steps = materialize(taken.select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "steps")
        moved = steps.df.filter("moved").count()
    return steps.df.select("word", "root")
