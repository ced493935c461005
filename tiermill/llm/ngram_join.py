"""Near-duplicate documents: a Jaccard join of word-shingle sets by vertical partitioning.

The global order of shingles is the order of their 64-bit hashes. Documents with equal sets form a class; only its
smallest document goes on.

Finding. A link needs 90 % overlap, so the sets of a pair differ in at most ``n // 9`` shingles, n being the smaller size. The
order is cut into more fragments than that (their number depends on a class of sizes; a document is also entered
into the class of its largest possible partner). Then some fragment holds the same shingles of both: within each
fragment, apart from all others, documents are matched by a fingerprint of their shingles in it. A document
that fills no more fragments than it may differ in is matched by each single shingle instead, as is then its partner.

Leaving alone. A small fragment is often the same by chance, in a line or phrase that many documents have. Shingles that no other
matched document has are missing in whatever a document is compared with; one with more of them than a link may differ in is
linked with nothing. Such documents, most of the matched ones, are counted out before any sets are compared.

Counting. For each pair found, the overlap is counted in each of ``PARTS`` fragments of the order separately, and the
counts are summed per pair and compared with the sizes, without any estimate.

Linking. Documents that share a fingerprint are first compared with the smallest of them, their hub, and linked documents
are merged into components. Then pairs of one hub but of different components are compared, except those that cannot be
linked: the differences of both from the hub, and the shingles that no other document has, bound what they differ in
from below. So no link between components is missed, while the pairs of a large group need not all be counted.

A document with fewer words than a shingle has its whole sequence as one shingle; one without words, or with a NULL
text, has none and is linked with nothing, itself its component. A NULL id stays NULL and is linked with nothing. Repeated rows
stay repeated. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.arrays import Texts, mix, pack, pack_counts, text_slices, unpack, unpack_counts, word_hashes
from tiermill.llm.components import components
from tiermill.llm.files import rows_per_batch, shuffles_deleted
from tiermill.llm.textstats import grams
from tiermill.llm.workers import ship, tidy
from tiermill.sources.scratch import delete_folder, materialize, scratch_path, scratch_scope

SHINGLE = 3
PERCENT = 90
PARTS = 16
LANES = 4
ROUND_KEYS = 1 << 25
SHARDS_PER_PARTITION = 4
#: Rows of texts in an Arrow batch, and in what a worker packs at once: shards have fewer, larger blocks with more rows.
TEXTS_AT_ONCE = 500
PACKED_ROWS = 4000
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(texts: Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """All shingles, ascending within each text and without repetition, and where each text's begin (one more at the end)."""
    found, hashes = word_hashes(texts)
    owner = found.owners()
    keys = grams(hashes, size)
    whole = owner[: len(keys)] == owner[size - 1 :][: len(keys)]
    keys, of = keys[whole], owner[: len(keys)][whole]
    for short in range(1, size):
        rows = np.flatnonzero(np.diff(found.offsets) == short)
        first = found.offsets[rows]
        value = np.full(len(rows), short, np.uint64)
        for i in range(short):
            value = value * _SALT + hashes[first + i]
        keys, of = np.concatenate([keys, mix(value)]), np.concatenate([of, rows])
    order = np.argsort(keys)
    order = order[np.argsort(of[order].astype(np.uint32), kind="stable")]
    keys, of = keys[order], of[order]
    if len(keys):
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
        keys, of = keys[new], of[new]
    return keys, np.searchsorted(of, np.arange(len(texts) + 1))


def _size_classes(largest: int, percent: int) -> np.ndarray:
    """Lower bounds of classes of set sizes; a set and its largest partner lie in one class or in two neighbours."""
    bounds = [1]
    while bounds[-1] <= largest:
        low = bounds[-1]
        bounds.append(max(low + 1, low * 100 // percent + 1, low * 5 // 4))
    return np.array(bounds)


def fingerprints(keys: np.ndarray, offsets: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the fragments of every set, and the set each belongs to."""
    sizes = np.diff(offsets)
    differ = lambda n: n * (100 - percent) // percent
    bounds = _size_classes(int(sizes.max(initial=1)) * 100 // percent + 1, percent)
    own = np.searchsorted(bounds, sizes, "right") - 1
    partner = np.searchsorted(bounds, sizes * 100 // percent, "right") - 1
    fragments = differ(bounds[1:] - 1) + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(keys + _SALT), dtype=np.uint64)])
    out, of = [], []
    for level, use in ((own, differ(sizes) > 0), (partner, (differ(sizes) > 0) & (partner != own))):
        rows = np.flatnonzero(use)
        owner = np.repeat(rows, sizes[rows])
        at = np.repeat(offsets[rows] - np.cumsum(sizes[rows]) + sizes[rows], sizes[rows]) + np.arange(len(owner))
        count = fragments[level[owner]].astype(np.uint64)
        cut = (keys[at] >> np.uint64(32)) * count >> np.uint64(32)
        begins = np.ones(len(at), bool)
        begins[1:] = (owner[1:] != owner[:-1]) | (cut[1:] != cut[:-1])
        first = np.flatnonzero(begins)
        if not len(first):
            continue
        last = np.append(first[1:], len(at))
        total = sums[at[last - 1] + 1] - sums[at[first]]
        place = level[owner[first]].astype(np.uint64) * np.uint64(1 << 40) + cut[first]
        out.append(mix(total ^ mix(place + np.uint64(1))))
        of.append(owner[first])
        filled = np.bincount(owner[first], minlength=len(sizes))
        few = rows[filled[rows] <= differ(sizes[rows])]
        for row in few:  # seldom any
            out.append(mix(keys[offsets[row] : offsets[row + 1]] ^ _SALT))
            of.append(np.full(sizes[row], row))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(of)


def _describe(documents: DataFrame, shards: int, shingle: int, percent: int) -> DataFrame:
    """Rows of documents (``doc_id``, ``n``, ``set``) and rows of packed fingerprints (``shard``, ``keys``, ``ids``)."""

    def packed(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        prints, of = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(prints)
        prints, of = prints[order], of[order]
        cuts = np.searchsorted((prints >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32), np.arange(shards + 1))
        for shard in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[shard], cuts[shard + 1]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([shard], pa.int32()), pa.array([pack(prints[a:b])]), pa.array([pack_counts(of[a:b])])],
                ["doc_id", "n", "set", "shard", "keys", "ids"],
            )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            ids = batch.column(0)
            for part in text_slices(batch.column(1)):
                keys, offsets = shingle_sets(part, shingle)
                sizes = np.diff(offsets)
                sums = np.zeros((2, len(keys) + 1), np.uint64)
                np.cumsum(mix(keys), out=sums[0, 1:])
                np.cumsum(mix(keys ^ _SALT), out=sums[1, 1:])
                whole = np.ascontiguousarray((sums[:, offsets[1:]] - sums[:, offsets[:-1]]).T)
                own = ids.slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(sizes), pa.array([x.tobytes() for x in whole], pa.binary()), *(pa.nulls(len(part), k) for k in (pa.int32(), pa.binary(), pa.binary()))],
                    ["doc_id", "n", "set", "shard", "keys", "ids"],
                )
                prints, of = fingerprints(keys, offsets, percent)
                numbers = own.fill_null(-1).to_numpy(zero_copy_only=False)
                known = np.array(own.is_valid())[of] if len(of) else np.zeros(0, bool)
                held.append((prints[known], numbers[of][known]))
            rows += batch.num_rows
            if held and rows >= PACKED_ROWS:
                yield from packed(held)
                held, rows = [], 0
        if held:
            yield from packed(held)

    return documents.mapInArrow(tidy(describe), "doc_id long, n long, set binary, shard int, keys binary, ids binary")


def _by_shard(blocks: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and documents of one shard after the other, ordered by key; blocks come sorted by shard."""

    def whole(held: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([unpack(k) for k, _ in held])
        ids = np.concatenate([unpack_counts(i) for _, i in held]).view(np.int64)
        order = np.argsort(keys, kind="stable")
        return keys[order], ids[order]

    shard, held = None, []
    for batch in blocks:
        for now, keys, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if now != shard and held:
                yield whole(held)
                held = []
            shard = now
            held.append((keys, ids))
    if held:
        yield whole(held)


def _shared(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints that several documents have, with these."""
    for keys, ids in _by_shard(blocks):
        same = keys[1:] == keys[:-1]
        use = np.zeros(len(keys), bool)
        use[1:] |= same
        use[:-1] |= same
        yield pa.RecordBatch.from_arrays([pa.array(keys[use].view(np.int64)), pa.array(ids[use])], ["print", "doc_id"])


def _sets(documents: DataFrame, shingle: int) -> DataFrame:
    """The sets, cut into ``PARTS`` fragments: ``doc_id`` and ``parts``."""

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch.column(1)):
                keys, offsets = shingle_sets(piece, shingle)
                owner = np.repeat(np.arange(len(piece)), np.diff(offsets)) * PARTS + _part(keys)
                bounds = np.searchsorted(owner, np.arange(len(piece) * PARTS + 1)).astype(np.int32)
                inner = pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys.view(np.int64)))
                outer = pa.ListArray.from_arrays(pa.array(np.arange(len(piece) + 1, dtype=np.int32) * PARTS), inner)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(piece.first, len(piece)), outer], ["doc_id", "parts"])

    return documents.mapInArrow(tidy(fragments), "doc_id long, parts array<array<long>>")


def _part(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(PARTS) >> np.uint64(32)).astype(np.int64)


def _private(texts: DataFrame, shards: int, partitions: int, shingle: int) -> DataFrame:
    """How many shingles of each document no other one of ``texts`` has, per fragment: ``doc_id``, ``private``, if it has any.

    Shingles are dealt by their order; what is found there goes on by document, in packed blocks, as a document may have a few in
    each of very many shards."""

    def packed(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], ids[order]
        cuts = np.searchsorted((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32), np.arange(shards + 1))
        for shard in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[shard], cuts[shard + 1])
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([pack(keys[own])]), pa.array([pack_counts(ids[own])])], ["shard", "keys", "ids"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            numbers = batch.column(0).to_numpy(zero_copy_only=False)
            for piece in text_slices(batch.column(1)):
                keys, offsets = shingle_sets(piece, shingle)
                held.append((keys, np.repeat(numbers[piece.first : piece.first + len(piece)], np.diff(offsets))))
            rows += batch.num_rows
            if rows >= PACKED_ROWS:
                yield from packed(held)
                held, rows = [], 0
        if held:
            yield from packed(held)

    def alone(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for keys, ids in _by_shard(blocks):
            same = keys[1:] == keys[:-1]
            single = np.ones(len(keys), bool)
            single[1:] &= ~same
            single[:-1] &= ~same
            own, part = ids[single], _part(keys[single])
            for i in np.unique(part).tolist():
                found, counts = np.unique(own[part == i], return_counts=True)
                held.append((found.view(np.uint64), np.full(len(found), i, np.int64), counts))
        if not held:
            return
        own, part, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        bucket = ((mix(own) >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((own, bucket))
        own, part, counts = own[order], part[order], counts[order]
        cuts = np.searchsorted(bucket[order], np.arange(partitions + 1))
        for i in np.flatnonzero(np.diff(cuts)):
            at = slice(cuts[i], cuts[i + 1])
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *(pa.array([x]) for x in (pack(own[at]), pack_counts(part[at]), pack_counts(counts[at])))], ["bucket", "ids", "part", "n"])

    def summed(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole(held: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
            own = np.concatenate([unpack(x) for x, _, _ in held])
            part, counts = (np.concatenate([unpack_counts(x[i]) for x in held]).view(np.int64) for i in (1, 2))
            found, which = np.unique(own, return_inverse=True)
            table = np.bincount(which * PARTS + part, counts, len(found) * PARTS).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * PARTS), pa.array(table))
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), lists], ["doc_id", "private"])

        bucket, held = None, []
        for batch in blocks:
            for now, *row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if now != bucket and held:
                    yield whole(held)
                    held = []
                bucket = now
                held.append(row)
        if held:
            yield whole(held)

    dealt = texts.select("doc_id", "text").mapInArrow(tidy(deal), "shard int, keys binary, ids binary")
    found = dealt.repartition(partitions, "shard").sortWithinPartitions("shard").mapInArrow(tidy(alone), "bucket int, ids binary, part binary, n binary")
    return found.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(summed), "doc_id long, private array<long>")


def _lonely(private: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Documents with more private shingles than a link of a set of their size (``n``) may differ in."""
    return private.join(sizes, "doc_id").filter(percent * _total(F.col("private")) > (100 - percent) * F.col("n")).select("doc_id")


def _sketch(keys: str, name: str) -> list[Column]:
    """Whether an odd number of ``keys`` falls into each of ``64 * LANES`` buckets, as ``LANES`` numbers.

    Two sets whose sketches differ in k bits differ in k keys at least.
    """
    lane = "aggregate(filter({keys}, k -> shiftrightunsigned(k, 6) & {last} = {i}), 0L, (odd, k) -> odd ^ shiftleft(1L, int(k & 63)))"
    return [F.expr(lane.format(keys=keys, last=LANES - 1, i=i)).alias(f"{name}_{i}") for i in range(LANES)]


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda n, x: n + x)


def _overlaps(pairs: DataFrame, sets: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """The pairs (``u``, ``v``) with sizes and partial overlaps per fragment (``parts_*``, ``parts``) and their sums (``n_*``, ``shared``);
    ``members`` are the sets of all ``v``, if those are fewer."""
    side = lambda of, name: of.select(F.col("doc_id").alias(name), F.col("parts").alias(f"keys_{name}"))
    both = pairs.join(side(sets, "u"), "u").join(side(sets if members is None else members, "v"), "v")
    # once, in columns of their own: within the functions of a sketch each lane would compare the sets anew
    both = both.withColumns({name: F.expr(f"array_except(flatten(keys_{a}), flatten(keys_{b}))") for name, a, b in (("gone", "u", "v"), ("new", "v", "u"))})
    sizes = lambda keys: F.transform(keys, lambda part: F.size(part).cast("long"))
    counted = both.select(
        "u",
        "v",
        sizes("keys_u").alias("parts_u"),
        sizes("keys_v").alias("parts_v"),
        F.zip_with("keys_u", "keys_v", lambda a, b: F.size(F.array_intersect(a, b)).cast("long")).alias("parts"),
        *_sketch("gone", "missing"),
        *_sketch("new", "added"),
    )
    sums = {"n_u": _total(F.col("parts_u")), "n_v": _total(F.col("parts_v")), "shared": _total(F.col("parts"))}
    return counted.withColumns(sums)


def _in_rounds(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``_overlaps`` of stored pairs, stored. A pair moves a whole set, and a set may be in many pairs, so pairs are taken in as many
    rounds as they outweigh the sets, and ``ROUND_KEYS``: no round moves much more than the larger of both, and its shuffle files
    go with it. All pairs of one ``v`` are in one round, so that its set moves for itself in that round only: a ``v`` has no more
    hubs than fragments, while a hub may have very many pairs."""
    sized = sets.select("doc_id", _total(F.transform("parts", lambda part: F.size(part).cast("long"))).alias("n"))
    whole = sized.agg(F.sum("n")).first()[0] or 1
    moved = pairs.join(sized, F.col("u") == F.col("doc_id")).agg(F.sum("n")).first()[0] or 0
    rounds = -(-moved // max(whole, ROUND_KEYS)) or 1
    mine = lambda name, i: F.pmod(F.xxhash64(name), F.lit(rounds)) == i
    parts = [materialize(_overlaps(pairs.filter(mine("v", i)), sets, sets.filter(mine("doc_id", i))), "overlaps").df for i in range(rounds)]
    return reduce(DataFrame.unionByName, parts)


def _enough(percent: int):
    return 100 * F.col("shared") >= percent * (F.col("n_u") + F.col("n_v") - F.col("shared"))


def _across(stars: DataFrame, labels: DataFrame, private: DataFrame, percent: int) -> DataFrame:
    """Pairs across components that share a hub and may be linked, as far as their differences from the hub tell.

    Two sets differ by what one differs from the hub and the other does not. Within each fragment that is all private
    shingles of both, and of the shingles of the hub that are missing, and of the others that are added, at least as many as
    their numbers are apart. Over all fragments it is also at least as many as the sketches of the missing and of the added
    shingles are apart, which tells members of one group from each other that lie equally far from their hub.

    These bounds hold at every hub that two sets share, so a pair is taken at the smallest of them only, once, and not at all if
    one set is a hub of the other: then it has been counted.
    """
    of = lambda side: labels.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    own = private.select(F.col("doc_id").alias("v"), "private")
    hubs = stars.groupBy("v").agg(F.collect_set("u").alias("hubs"))  # no more than a set has fragments
    known = stars.join(of("u"), "u", "left").join(of("v"), "v", "left").join(own, "v", "left").join(hubs, "v")
    known = known.withColumn("private", F.coalesce("private", F.array_repeat(F.lit(0).cast("long"), PARTS)))
    sketches = [f"{kind}_{i}" for kind in ("missing", "added") for i in range(LANES)]
    missing = F.zip_with("parts_u", "parts", lambda n, shared: n - shared)
    more = F.zip_with(F.zip_with("parts_v", "parts", lambda n, shared: n - shared), "private", lambda n, alone: n - alone)
    known = known.select(
        "u",
        "v",
        F.coalesce("c_u", "u").alias("c_u"),
        F.coalesce("c_v", "v").alias("c"),
        _total(F.col("private")).alias("p"),
        (F.col("n_u") - F.col("shared")).alias("gone"),
        F.concat(missing, more).alias("counts"),
        F.floor(F.col("n_v") * (100 - percent) / percent).alias("most"),
        "hubs",
        *sketches,
    ).filter("p <= most")
    columns = lambda side: [F.col(c).alias(f"{c}_{side}") for c in ("v", "c", "p", "gone", "counts", "most", "hubs", *sketches)]
    left = known.filter("c <> c_u").select("u", *columns("a"))
    right = known.select("u", (F.col("c") == F.col("c_u")).alias("with_hub"), *columns("b"))
    may = (F.col("v_a") != F.col("v_b")) & (F.col("c_a") != F.col("c_b")) & (F.col("with_hub") | (F.col("v_a") < F.col("v_b")))
    alone, most = F.col("p_a") + F.col("p_b"), F.least("most_a", "most_b")
    may = may & (alone + F.abs(F.col("gone_a") - F.col("gone_b")) <= most)
    bits = lambda kind: sum(F.bit_count(F.col(f"{kind}_{i}_a").bitwiseXOR(F.col(f"{kind}_{i}_b"))) for i in range(LANES))
    may = may & (bits("missing") + F.greatest(bits("added"), alone) <= most)
    apart = _total(F.zip_with("counts_a", "counts_b", lambda a, b: F.abs(a - b)))
    may = may & (alone + apart <= most) & ~F.array_contains("hubs_a", F.col("v_b")) & ~F.array_contains("hubs_b", F.col("v_a"))
    once = F.array_min(F.array_intersect("hubs_a", "hubs_b")) == left["u"]
    found = left.join(right, (left["u"] == right["u"]) & may & once)
    return found.select(F.least("v_a", "v_b").alias("u"), F.greatest("v_a", "v_b").alias("v"))


def link(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest document reachable by links."""
    spark = documents.sparkSession
    ship(spark)
    texts = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    result = scratch_path(spark, "linked")
    with scratch_scope(spark), shuffles_deleted(spark):
        linked = _link(texts, partitions, shingle, percent)
        linked.write.parquet(result)
    return spark.read.schema(linked.schema).parquet(result)


def _link(texts: DataFrame, partitions: int, shingle: int, percent: int) -> DataFrame:
    spark, shards = texts.sparkSession, SHARDS_PER_PARTITION * partitions
    with rows_per_batch(spark, TEXTS_AT_ONCE):
        stored = materialize(_describe(texts, shards, shingle, percent), "shingles")
    described = stored.df
    own = materialize(described.filter("shard is null").select("doc_id", "n", "set"), "documents").df
    known = own.filter("doc_id is not null and n > 0")
    classes = known.groupBy("set", "n").agg(F.min("doc_id").alias("first"))
    members = materialize(known.join(classes, ["set", "n"]).select("doc_id", "n", "set", "first").distinct(), "classes").df

    blocks = described.filter("shard is not null").select("shard", "keys", "ids")
    with rows_per_batch(spark, 200):
        dealt = blocks.repartition(shards, "shard").sortWithinPartitions("shard")
        firsts = members.select("doc_id", "first").distinct()
        shared = dealt.mapInArrow(tidy(_shared), "print long, doc_id long").join(firsts, "doc_id")
        prints = materialize(shared.select("print", F.col("first").alias("doc_id")).distinct(), "prints")
    delete_folder(spark, stored.path)  # the fingerprints, which are as large as the texts, have been read
    several = prints.df.groupBy("print").agg(F.min("doc_id").alias("u"), F.max("doc_id").alias("last")).filter("u <> last")
    entries = materialize(prints.df.join(several, "print", "left_semi"), "entries").df
    delete_folder(spark, prints.path)
    # the ids grow with the input: one plan at every size
    matched = texts.join(entries.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    needed = materialize(matched.dropDuplicates(["doc_id"]), "needed", "zstd").df
    with rows_per_batch(spark, 200):
        private = materialize(_private(needed, shards, partitions, shingle), "private").df
    lonely = _lonely(private, members.groupBy("doc_id").agg(F.max("n").alias("n")), percent)
    entries = materialize(entries.join(lonely.hint("merge"), "doc_id", "left_anti"), "social").df
    groups = entries.groupBy("print").agg(F.min("doc_id").alias("u"), F.max("doc_id").alias("last")).filter("u <> last")
    pairs = entries.join(groups, "print").filter("u <> doc_id").select("u", F.col("doc_id").alias("v")).distinct()
    pairs = materialize(pairs, "stars").df
    wanted = pairs.select(F.col("v").alias("doc_id")).union(pairs.select(F.col("u").alias("doc_id"))).distinct()
    needed = needed.join(wanted.hint("merge"), "doc_id", "left_semi")
    with rows_per_batch(spark, TEXTS_AT_ONCE):
        sets = materialize(_sets(needed, shingle), "sets").df
    stars = _in_rounds(pairs, sets)
    links = stars.filter(_enough(percent)).select("u", "v")
    labels = materialize(components(links), "labels").df
    across = materialize(_across(stars, labels, private, percent), "across").df
    more = _in_rounds(across, sets).filter(_enough(percent)).select("u", "v")
    if not more.isEmpty():
        labels = components(links.union(more))
    found = members.join(labels, F.col("first") == F.col("node"), "left").select(
        F.col("doc_id").alias("member"), F.col("set").alias("members_set"), F.coalesce("component", "first").alias("component_id")
    )
    joined = own.join(found, (F.col("doc_id") == F.col("member")) & (F.col("set") == F.col("members_set")), "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
