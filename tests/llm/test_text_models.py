"""Language model, quality trees and line labelling."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tiermill.llm import kneser_ney, line_crf, quality_gbt, queries
from tiermill.llm.arrays import HASH_BLOCK, RollingHash, pack, pack_counts, text_slices, unpack, unpack_counts
from tiermill.llm.textstats import FEATURES, document_features


def test_packed_arrays_come_back():
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64))
    assert (unpack(pack(keys)) == keys).all() and (unpack_counts(pack_counts(keys)) == keys).all()
    assert len(unpack(pack(keys[:0]))) == 0


def test_equal_strings_have_equal_hashes_wherever_they_lie():
    data = np.frombuffer(b"abc" * 80, np.uint8)
    windows = RollingHash(data).windows(6)
    assert len(np.unique(windows)) == 3 and (windows[0::3] == windows[0]).all()
    places = np.arange(len(windows))
    assert (RollingHash(data).spans(places, places + 6) == windows).all()


def alternating(turns):
    out = "ab"
    for _ in range(turns):
        out += out.translate(str.maketrans("ab", "ba"))
    return out


@pytest.mark.parametrize("turns", [6, 9, 11, 15])
def test_alternating_strings_have_different_hashes(turns):
    first = alternating(turns)
    second = first.translate(str.maketrans("ab", "ba"))
    data = np.frombuffer(f"{first} {second}  {first}".encode(), np.uint8)
    size = len(first)
    starts = np.array([0, size + 1, 2 * size + 3])
    a, b, c = RollingHash(data).spans(starts, starts + size).tolist()
    assert a == c != b


def test_hashes_of_all_lengths_differ_and_match_windows():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    rolling, sizes = RollingHash(data), np.arange(1, 400)
    found = rolling.spans(np.zeros(len(sizes), np.int64), sizes)
    assert len(set(found.tolist())) == len(sizes)
    at = np.arange(5000 - HASH_BLOCK + 1)
    assert (rolling.windows(HASH_BLOCK) == rolling.spans(at, at + HASH_BLOCK)).all()
    same = RollingHash(np.concatenate([data[:777], data])).spans(np.zeros(len(sizes), np.int64) + 777, sizes + 777)
    assert (same == found).all()


def test_learning_takes_one_text_per_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_gbt, "grow", lambda features, labels: seen.append((features.tolist(), labels.tolist())))
    rows = [(1, "short"), *((1, f"a longer text with number {i}") for i in range(50)), (2, None), (2, "b"), (3, "c"), (None, "d")]
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1)], "doc_id long, quality int")
    for order in (rows, rows[::-1]):
        quality_gbt.learn(spark.createDataFrame(order, "doc_id long, text string").repartition(3), labels)
    assert seen[0] == seen[1] and seen[0][1] == [1.0, 0.0]


def test_slices_hold_all_texts_in_order():
    texts = ["", None, "abc", "é" * 50, "x", None]
    parts = list(text_slices(pa.array(texts), 10))
    joined = [bytes(p.data[a:b]).decode() for p in parts for a, b in zip(p.offsets[:-1], p.offsets[1:], strict=True)]
    assert joined == [t or "" for t in texts]
    assert [p.first for p in parts] == list(np.cumsum([0, *[len(p) for p in parts[:-1]]]))


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("table", ["documents", "odd"])
def test_scores_equal_plain_kneser_ney(request, table, order):
    df = request.getfixturevalue(table).select("doc_id", "text")
    rows = df.collect()
    texts = [row.text for row in rows]
    model = kneser_ney.fit(df, order=order)
    found = sorted(tuple(r) for r in kneser_ney.score(df, model).select(*kneser_ney.RESULTS).collect())
    for mine, plain in zip(found, sorted(brute.kneser_ney(texts, texts, kneser_ney._discounts, order)), strict=True):
        assert mine == pytest.approx(plain, rel=1e-9)


def test_language_model_query(spark, small, documents):
    found = queries.op1_kneser_ney(spark, small).collect()
    rows = documents.collect()
    train = [r.text for r in rows if zlib.crc32(str(r.doc_id).encode()) % 10]
    plain = dict(zip([r.doc_id for r in rows], brute.kneser_ney(train, [r.text for r in rows], kneser_ney._discounts), strict=True))
    assert len(found) == len(rows)
    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 10 == 0)
        assert (row.n_tokens, row.n_known, row.base_score, row.score) == pytest.approx(plain[row.doc_id], rel=1e-9)
    held = [row for row in found if row.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("words", [1, 2, 3, 4])
def test_runs_dealt_and_stored_in_small_pieces_are_summed(tmp_path, monkeypatch, words):
    monkeypatch.setattr(kneser_ney, "BLOCK", 64)
    monkeypatch.setattr(kneser_ney, "TOKENS_AT_ONCE", 100)
    rng = np.random.default_rng(words)
    plain, dealt = Counter(), []
    for _ in range(20):
        columns = [rng.integers(0, 7, 300).astype(np.uint64) for _ in range(words)]
        plain.update(zip(*(c.tolist() for c in columns), strict=True))
        key, *parts = kneser_ney._merged(columns, [np.ones(300, np.int64)])
        dealt += kneser_ney._deal(*parts, (parts[0][0] % np.uint64(3)).astype(np.int64), 3)
    found = Counter()
    for shard, _, columns, fields in kneser_ney._by_shard(iter(sorted(dealt, key=lambda b: b.column(0)[0].as_py())), words):
        row = kneser_ney._counted(f"{tmp_path}/runs", shard, columns, fields).to_pylist()[0]
        for own, (counts,) in kneser_ney._blocks(row["path"], row["sizes"], words, 1):
            assert (own[0] % 3 == shard).all() and len(counts) <= 64
            found.update(dict(zip(zip(*(c.tolist() for c in own), strict=True), counts.tolist(), strict=True)))
    assert found == plain


@pytest.mark.parametrize("size", [1, 2, 63, 64, 65, 128, 129, 1000])
def test_search_finds_every_stored_key(tmp_path, size):
    keys = np.unique(np.random.default_rng(size).integers(1, 1 << 63, size).astype(np.uint64))
    path = kneser_ney._write(f"{tmp_path}/keys", "keys", keys)
    assert (kneser_ney._last_up_to(path, keys) == np.arange(len(keys))).all()
    assert (kneser_ney._last_up_to(path, keys + np.uint64(1)) == np.arange(len(keys))).all()
    assert (kneser_ney._last_up_to(path, np.array([0, (1 << 64) - 1], np.uint64)) == [0, len(keys) - 1]).all()


def test_values_of_any_width_come_back():
    for top in (0, 1, 255, 256, 65536, 1 << 32, 1 << 62):
        values = np.append(np.arange(5), top).astype(np.uint64)
        assert (kneser_ney._expand(kneser_ney._squeeze(values)) == values).all()
    assert len(kneser_ney._expand(kneser_ney._squeeze(values[:0]))) == 0


def test_longer_runs_predict_held_out_texts_better(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").withColumn("held", queries.held_out(10))
    totals = [kneser_ney.score(df.filter("held"), kneser_ney.fit(df.filter("not held"), order=n)).agg(F.sum("score")).first()[0] for n in (2, 3)]
    assert totals[1] > totals[0]


def test_chances_after_any_words_add_up_to_one(documents):
    df = documents.select("text").limit(200)
    model = kneser_ney.fit(df)
    last = np.append(np.arange(model.n_words), 0xFFFFFFFF).astype(np.uint64)
    for start in ([], [5], [7, 3], [0xFFFFFFFF, 4], [4, 0xFFFFFFFF], [0xFFFFFFFF] * 2):
        texts = np.stack([*(np.full(len(last), number, np.uint64) for number in start), last], axis=1)
        offsets = np.arange(len(last) + 1) * texts.shape[1]
        chances = model.chances(model.columns(texts.ravel(), offsets), offsets)
        assert chances.reshape(texts.shape)[:, -1].sum() == pytest.approx(1, abs=1e-6)


def test_order_below_two_is_refused(documents):
    with pytest.raises(ValueError, match="order"):
        kneser_ney.fit(documents, order=1)


def test_a_model_of_nothing_knows_nothing(nothing, odd):
    model = kneser_ney.fit(nothing)
    assert {r.score for r in kneser_ney.score(odd, model).collect()} == {0.0}
    assert kneser_ney.score(nothing, model).count() == 0


def test_features_of_odd_texts_are_finite(odd):
    rows = [document_features(part) for part in text_slices(pa.array([r.text for r in odd.collect()]))]
    assert np.isfinite(np.concatenate(rows)).all() and rows[0].shape[1] == len(FEATURES)


def test_trees_learn_a_rule_and_flat_scores_are_chances():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(3000, 5))
    labels = ((rows[:, 1] > 0) & (rows[:, 3] < 0.5)).astype(float)
    model = quality_gbt.grow(rows, labels, trees=20)
    scores = model.score(rows)
    assert ((scores > 0.5) == labels).mean() > 0.98 and scores.min() >= 0 and scores.max() <= 1


def test_quality_query_separates_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op7_quality_gbt(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("quality is not null")
    held = found.filter("held_out").join(labels, "doc_id").collect()
    assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert np.mean([row.predicted == row.quality for row in held]) > 0.95
    assert all(row.predicted == int(row.score >= 0.3) for row in held)


def test_quality_of_odd_tables(spark, odd, nothing):
    labels = spark.createDataFrame([(3, 1), (3, 0), (8, 0), (None, 1), (4, None), (9, 7), (77, 1)], "doc_id long, quality int")
    model = quality_gbt.learn(odd, labels)
    rows = quality_gbt.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality_gbt.score(nothing, model).count() == 0
    nobody = quality_gbt.learn(odd, labels.limit(0))
    assert {r.score for r in quality_gbt.score(odd, nobody).collect()} == {0.5}


def test_learning_takes_no_more_than_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_gbt, "grow", lambda rows, labels: seen.append(len(rows)))
    folder = "/root/testdata/sf0.01"
    quality_gbt.learn(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"), sample=100)
    assert 50 < seen[0] < 150


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(4)
    model = line_crf.Chain(np.zeros((0, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    owner = np.repeat(np.arange(30), rng.integers(1, 8, 30))
    scores = rng.normal(size=(len(owner), 2))
    found = line_crf.viterbi(scores, model, owner)
    import itertools

    for text in range(30):
        rows = np.flatnonzero(owner == text)

        def value(labels, rows=rows):
            total = model.first[labels[0]] + sum(scores[r, k] for r, k in zip(rows, labels, strict=True))
            return total + sum(model.move[a, b] for a, b in itertools.pairwise(labels))

        assert tuple(found[rows]) == max(itertools.product((0, 1), repeat=len(rows)), key=value)


def test_equal_lines_have_equal_scores_in_any_slice():
    rng = np.random.default_rng(6)
    model = line_crf.Chain(rng.normal(size=(len(line_crf.OBSERVATIONS), 2)), np.zeros((2, 2)), np.zeros(2))
    seen = rng.integers(0, 2, (1001, len(line_crf.OBSERVATIONS))).astype(float)
    whole = line_crf.line_scores(seen, model)
    assert all((line_crf.line_scores(seen[i : i + 1], model) == whole[i]).all() for i in range(len(seen)))
    assert np.allclose(whole, seen @ model.seen)


def test_fitting_follows_the_slope_of_the_likelihood():
    rng = np.random.default_rng(5)
    owner = np.repeat(np.arange(200), rng.integers(1, 9, 200))
    labels = rng.integers(0, 2, 200)[owner]
    seen = np.zeros((len(owner), len(line_crf.OBSERVATIONS)))
    seen[:, 0] = 1
    seen[:, 5] = labels ^ (rng.random(len(owner)) < 0.2)
    model = line_crf.fit(seen, owner, labels, steps=60)
    assert (line_crf.viterbi(seen @ model.seen, model, owner) == labels).mean() > 0.85
    assert model.move[0, 0] + model.move[1, 1] > model.move[0, 1] + model.move[1, 0]


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_line_counts_equal_plain_ones(request, table):
    df = request.getfixturevalue(table).select("doc_id", "text")
    for row in line_crf.judge(df, line_crf.Chain.empty()).collect():
        plain = brute.line_counts(row.text)
        assert [row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words] == plain
        assert row.base_failed == (plain[0] < 10 or 100 * plain[4] > 20 * plain[0])
        assert row.kept == (not row.base_failed)


@pytest.mark.parametrize("table", ["documents", "odd"])
@pytest.mark.parametrize("seed", [1, 2])
def test_labels_and_verdicts_equal_plain_ones(request, table, seed):
    df = request.getfixturevalue(table).select("doc_id", "text")
    rng = np.random.default_rng(seed)
    model = line_crf.Chain(rng.normal(size=(len(line_crf.OBSERVATIONS), 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    verdicts = set()
    for row in line_crf.judge(df, model).collect():
        n_lines, best = brute.content_lines(row.text, model)
        assert row.n_lines == n_lines and (row.n_content_lines, row.n_content_words) in best
        assert row.kept == (not row.base_failed and row.n_content_words >= line_crf.CONTENT_SHARE * row.n_words)
        verdicts.add((row.base_failed, row.kept))
    assert table == "odd" or {(False, True), (False, False)} <= verdicts


def test_line_rules_keep_good_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op8_line_crf(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = found.filter(~F.col("base_failed") & queries.held_out(5)).collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.97 and (not bad or np.mean(bad) < 0.5)


def test_rules_of_empty_tables(spark, odd, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = line_crf.learn(odd, labels)
    assert line_crf.judge(nothing, model).count() == 0 and line_crf.judge(odd, model).count() == odd.count()


def test_places_sorted_with_keys_are_those_of_a_stable_sort():
    draw = np.random.default_rng(11)
    hashes = draw.integers(0, 1 << 64, 3000, dtype=np.uint64)
    near = (hashes[0] & ~np.uint64(0xFFFF)) + draw.integers(0, 1 << 16, 5000, dtype=np.uint64)  # differ in the lowest bits only
    for keys in (hashes, near, hashes % np.uint64(50), hashes >> np.uint64(30), np.concatenate([near, hashes, near]), hashes[:1], hashes[:0], hashes * np.uint64(0)):
        assert (kneser_ney._order(keys) == np.argsort(keys, kind="stable")).all()
        distinct, place = kneser_ney._distinct(keys)
        want = np.unique(keys, return_inverse=True)
        assert (distinct == want[0]).all() and (place == want[1]).all() and len(place) == len(keys)
    for top in (40, 1 << 20, 1 << 32):
        columns = [draw.integers(0, top, 4000, dtype=np.uint64) for _ in range(3)]
        assert (kneser_ney._lead_order(columns) == np.lexsort((columns[1], columns[0]))).all()
        assert (kneser_ney._lead_order(columns[:1]) == np.argsort(columns[0], kind="stable")).all()
