"""Repeated passages, near copies, benchmark passages and components."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tiermill.llm import ngram_join, queries, spaced_seeds, suffix_levels
from tiermill.llm.arrays import text_slices, word_hashes
from tiermill.llm.components import components


def cut_rows(df):
    rows = suffix_levels.remove_repeated(df).collect()
    sizes = [sum(s["until"] - s["from"] for s in r.spans) for r in rows]
    return sorted(((r.doc_id, r.n_bytes, n, len(r.spans), brute.sha(bytes(r.kept))) for r, n in zip(rows, sizes, strict=True)), key=str)


def passages(seed, count=300):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcd efé") for _ in range(rnd.randint(30, 200))) for _ in range(25)]
    rows = []
    for _ in range(count):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            kind = rnd.random()
            if kind < 0.5:
                own = rnd.choice(pool)
                parts.append(own[rnd.randint(0, 20) : len(own) - rnd.randint(0, 20)])
            elif kind < 0.7:
                parts.append("ab" * rnd.randint(1, 60))
            else:
                parts.append("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 80))))
        rows.append((rnd.randint(0, 350) * 3, "".join(parts)))
    return [*rows, (None, pool[0] * 2), (None, pool[0]), (5, None), (6, ""), (7, "x" * 49), (8, "x" * 50), (9, "x" * 51), (10, "x" * 300)]


def test_passages_equal_plain_removal(spark):
    df = spark.createDataFrame(passages(5), "doc_id long, text string").repartition(7)
    assert cut_rows(df) == brute.repeats([(r.doc_id, r.text) for r in df.collect()])


def test_passage_query(spark, small, documents):
    found = queries.op3_suffix_levels(spark, small).collect()
    mine = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found), key=str)
    assert mine == brute.repeats([(r.doc_id, r.text) for r in documents.collect()])


def test_passages_of_odd_tables(odd, nothing):
    short = odd.filter("doc_id is null or doc_id < 7")
    assert cut_rows(short) == brute.repeats([(r.doc_id, r.text) for r in short.collect()])
    long = {r.doc_id: r for r in suffix_levels.remove_repeated(odd, keep=("ids", "batch")).collect()}
    assert long[7].n_bytes == 240_000 and long[7].spans == [] and long[8].n_bytes == 330_000
    assert long[3].ids == "x" and long[3].batch == "z"
    assert suffix_levels.remove_repeated(nothing).count() == 0


def test_whole_characters_stay(spark):
    shared = "é" * 40
    rows = [(1, "a" + shared + "b"), (2, "c" + shared + "漢字" * 40), (3, "漢字" * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for row in suffix_levels.remove_repeated(df, whole_characters=True).collect():
        text = bytes(row.kept).decode()
        assert len(text.encode()) + sum(s["until"] - s["from"] for s in row.spans) == row.n_bytes


def test_tiles_and_levels_do_not_change_what_is_found(monkeypatch):
    texts = [t or "" for _, t in passages(6, 60)]
    part = next(text_slices(pa.array(texts), 1 << 62))
    batch = suffix_levels.Batch(part.data, part.offsets, np.arange(len(texts)))
    whole = batch.anchors()
    monkeypatch.setattr(suffix_levels, "TILE", 97)
    tiled = suffix_levels.Batch(part.data, part.offsets, np.arange(len(texts))).anchors()
    assert (whole[0] == tiled[0]).all() and (whole[1] == tiled[1]).all()
    rng, family, plain = np.random.default_rng(7), suffix_levels.Levels(), set()
    for _ in range(60):
        keys = np.unique(rng.integers(0, 2000, rng.integers(0, 50)).astype(np.uint64))
        assert family.scan(keys).tolist() == [k in plain for k in keys.tolist()]
        family.add(keys)
        plain.update(keys.tolist())
        assert len(family.levels) <= 12 and all(len(a) > len(b) for a, b in zip(family.levels, family.levels[1:], strict=False))


def check_components(df):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link(df).collect()}
    assert found == brute.near_copies([(r.doc_id, r.text) for r in df.collect()])


def near_rows(seed):
    rnd = random.Random(seed)
    rows = []
    for _ in range(50):
        size = rnd.choice([3, 5, 9, 10, 11, 12, 15, 20, 25, 30, 40, 60, 100, 150])
        words = [rnd.choice("abcdefghijklmnopqrstuvwxyz") + str(rnd.randint(0, 30)) for _ in range(size + 2)]
        for _ in range(rnd.randint(1, 12)):
            new = list(words)
            for _ in range(rnd.randint(0, max(1, size // 20))):
                kind, at = rnd.random(), rnd.randrange(len(new))
                if kind < 0.3:
                    new[at] = f"z{rnd.randint(0, 99)}"
                elif kind < 0.6 and len(new) > 3:
                    new.pop(0 if rnd.random() < 0.5 else -1)
                elif kind < 0.8:
                    new.append(f"q{rnd.randint(0, 9)}")
            words = new if rnd.random() < 0.5 else words
            rows.append((len(rows) * 7 % 5003, " ".join(new)))
    return rows


def test_rows_of_one_id_stay_as_many_as_they_are(spark):
    rows = [(1, "a b c d"), (1, "x y"), (2, "a b c d"), (1, "a b c d")]
    found = ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in found) == [(1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1)]


@pytest.mark.parametrize(("shingle", "percent"), [(3, 90), (5, 80)])
def test_members_far_from_their_hub_are_linked_with_each_other(spark, shingle, percent):
    """Copies of one text with many words replaced, in families: links lie within families, not with the hub."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(90)]
    rows = [(0, " ".join(base))]
    for family in range(12):
        words = list(base)
        for at in rnd.sample(range(90), rnd.randint(3, 9)):
            words[at] = f"f{family}x{at}"
        for _ in range(8):
            own = list(words)
            for at in rnd.sample(range(90), rnd.randint(0, 2)):
                own[at] = f"o{len(rows)}x{at}"
            rows.append((len(rows), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link(df, shingle=shingle, percent=percent).collect()}
    assert found == brute.near_copies([(r.doc_id, r.text) for r in df.collect()], shingle, percent)
    assert 3 < len({c for _, c in found.values()}) < len(rows) / 2


def test_near_copies_equal_plain_links(spark):
    odd = [(6000, None), (6001, ""), (6002, "a"), (6003, "A"), (6004, "a b"), (6005, "a  B\n"), (6006, " \t")]
    check_components(spark.createDataFrame([*near_rows(4), *odd], "doc_id long, text string").repartition(5))


def test_near_copy_query(spark, small, documents):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op9_ngram_join(spark, small).collect()}
    assert found == brute.near_copies([(r.doc_id, r.text) for r in documents.collect()])


def test_near_copies_of_odd_tables(odd, nothing):
    rows = ngram_join.link(odd).collect()
    assert len(rows) == odd.count()
    by = {(r.doc_id, r.component_id) for r in rows}
    assert {(1, 1), (2, 2), (3, 3), (4, 3), (5, 5), (None, None)} <= by
    assert ngram_join.link(nothing).count() == 0


def test_linked_sets_share_a_fingerprint():
    rng = np.random.default_rng(8)
    for size in [*range(1, 60), 100, 333, 1000]:
        keys = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) << np.uint64(1))
        for drop in {0, size // 20, size // 10}:
            other = np.sort(np.concatenate([rng.permutation(keys)[drop:], rng.integers(0, 1 << 63, size // 9 - drop if size // 9 > drop else 0).astype(np.uint64)]))
            other = np.unique(other)
            shared = len(np.intersect1d(keys, other))
            if 100 * shared < 90 * (len(keys) + len(other) - shared) or (len(keys) == len(other) == shared):
                continue
            both = np.concatenate([keys, other])
            prints, of = ngram_join.fingerprints(both, np.array([0, len(keys), len(both)]))
            assert set(prints[of == 0].tolist()) & set(prints[of == 1].tolist())


def test_size_classes_hold_partners_in_neighbours():
    bounds = ngram_join._size_classes(200_000, 90)
    sizes = np.arange(1, 180_000)
    own, partner = (np.searchsorted(bounds, x, "right") for x in (sizes, sizes * 100 // 90))
    assert (partner - own <= 1).all()


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = [*chain, (7, 3), (3, 7), (5, 5), (9, 3), (200, 9), *[(300, i) for i in range(301, 340)]]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100} and {found[i] for i in (3, 7, 9, 200)} == {3}
    assert {found[i] for i in range(300, 340)} == {300}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.fixture(scope="module")
def items(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (1, " ".join(words)), (2, "tiny item here"), (3, None), (4, ""), (None, "some item without a number at all here")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_substitutions_are_tolerated_and_chance_is_not(spark, items):
    words = [f"w{i}" for i in range(40)]
    changed = [w if i % 7 else "other" for i, w in enumerate(words)]
    rows = [
        (10, "x y " + " ".join(words).upper() + " z"),
        (11, "x " + " ".join(changed) + " z"),
        (12, " ".join(words[:20])),
        (13, " ".join(words[:6])),
        (14, " ".join(w if i % 2 else "other" for i, w in enumerate(words))),
        (15, "so tiny item here is"),
        (16, None),
        (17, ""),
        (None, " ".join(words)),
        (10, "x y " + " ".join(words) + " z"),
    ]
    found = spaced_seeds.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    pairs = {(r.doc_id, r.item_id): (r.n_equal, r.n_words, r.first_word) for r in found}
    assert len(found) == len(pairs) and set(pairs) == {(10, 1), (11, 1), (12, 1), (15, 2), (None, 1)}
    assert pairs[10, 1] == (40, 40, 2) and pairs[11, 1][0] == 34 and pairs[12, 1] == (20, 20, 0)


def test_blocks_of_the_benchmark_find_the_same(spark, small, documents):
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    whole = {tuple(r) for r in spaced_seeds.contaminated(documents, benchmark).collect()}
    assert {tuple(r) for r in spaced_seeds.contaminated(documents, benchmark, block_bytes=1000).collect()} == whole


def test_every_whole_passage_is_found(spark):
    folder = "/root/testdata/sf0.01"
    plain = lambda text: f" {' '.join(brute.WORD.findall(brute.lower(text)))} "
    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()
    held = {(r.doc_id, i) for r in documents for text in [plain(r.text)] for i, item in items if item in text}
    rows = queries.op10_spaced_seeds(spark, folder).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    assert held and held <= found
    # a passage whose last word has something attached is one, too
    assert all(r.n_equal >= 0.9 * r.item_words for r in rows)


def test_benchmarks_of_odd_tables(odd, nothing, items):
    assert spaced_seeds.contaminated(odd, items.limit(0)).count() == 0
    assert spaced_seeds.contaminated(nothing, items).count() == 0
    own = odd.filter("doc_id = 3").select(F.lit(5).cast("long").alias("item_id"), "text")
    assert {r.doc_id for r in spaced_seeds.contaminated(odd, own).collect()} == {3, 4, None}


def test_seeds_skip_unmarked_places():
    part = next(text_slices(pa.array(["a b c d e f g h", "a b X d X X g h"])))
    found, hashes = word_hashes(part)
    first, second = (spaced_seeds.seeds(hashes[a:b], "11010011") for a, b in zip(found.offsets[:-1], found.offsets[1:], strict=True))
    assert first[0] == second[0]


def test_shards_of_anchors_are_even(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").select("text").toArrow()["text"]
    part = next(text_slices(documents, 1 << 30))
    batch = suffix_levels.Batch(part.data, part.offsets, np.arange(len(part)))
    keys = suffix_levels.Asked(batch, *batch.anchors()).distinct
    assert (keys[1:] > keys[:-1]).all()
    sizes = np.bincount(((keys >> np.uint64(32)) * np.uint64(16) >> np.uint64(32)).astype(int), minlength=16)
    assert sizes.max() < 1.5 * sizes.mean() and sizes.min() > sizes.mean() / 1.5


def test_overlaps_equal_plain_ones(spark):
    rng = random.Random(5)
    word = lambda: f"v{int(rng.paretovariate(0.4))}"
    texts = [[word() for _ in range(size)] for size in (*range(1, 20), 25, 40)]
    rows = []
    for own in texts:
        for _ in range(6):
            changed = [w if rng.random() > 0.12 else word() for w in own]
            a, b = sorted((rng.randint(0, len(own)), rng.randint(0, len(own))))
            rows.append([word() for _ in range(rng.randint(0, 6))] + rng.choice([changed, own, own[a:b]]) + [word() for _ in range(rng.randint(0, 6))])
    as_table = lambda lists, name: spark.createDataFrame([(i, " ".join(own)) for i, own in enumerate(lists)], f"{name} long, text string")
    found = spaced_seeds.contaminated(as_table(rows, "doc_id"), as_table(texts, "item_id")).collect()
    plain = {(d, i): one for d, own in enumerate(rows) for i, item in enumerate(texts) if (one := brute.overlap(own, item, spaced_seeds))}
    assert len(plain) > 60
    assert {(r.doc_id, r.item_id): (r.n_equal, r.n_words, r.first_word) for r in found} == plain


@pytest.mark.parametrize("size", [5, 7, 8, 9, 12, 13, 14, 15, 30])
def test_an_item_with_one_replaced_word_is_found_wherever_it_is(spark, size):
    item = [f"w{i}" for i in range(size)]
    rows = [(k, " ".join(["before", *item[:k], "other", *item[k + 1 :], "behind"])) for k in range(size)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = spaced_seeds.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert {(r.doc_id, r.n_equal, r.n_words, r.first_word) for r in found} == {(k, size - 1, size, 1) for k in range(size)}


def test_short_items_are_found_however_their_words_are_replaced():
    for size in range(1, spaced_seeds.FEWEST):
        masks = spaced_seeds.whole_masks(size)
        for changed in itertools.combinations(range(size), size // 5):
            assert any(all(mask[i] == "0" for i in changed) for mask in masks)


def test_sets_of_a_pair_are_compared_once(spark):
    pairs = spark.createDataFrame([(1, 2)], "u long, v long")
    sets = spark.createDataFrame([(1, [[1, 2], [3]]), (2, [[2], [3, 70]])], "doc_id long, parts array<array<long>>")
    found = ngram_join._overlaps(pairs, sets)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_except(") == 2
    row = found.first()
    lane = lambda name: sum(row[f"{name}_{i}"] != 0 for i in range(ngram_join.LANES))
    assert (row.n_u, row.n_v, row.shared, lane("missing"), lane("added")) == (3, 3, 2, 1, 1)
