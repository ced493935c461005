"""Words one edit apart, their forms and roots."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tiermill.llm import spelling


def edits(word, alphabet):
    cut = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    found = {a + b[1:] for a, b in cut if b} | {a + c + b[1:] for a, b in cut if b for c in alphabet} | {a + c + b for a, b in cut for c in alphabet}
    return found - {word}


def plain_forms(counts, ratio=5):
    alphabet = sorted(set("".join(counts)))
    near = {w: [x for x in edits(w, alphabet) if x in counts] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, n, len(near[w]), form[w], counts.get(form[w]), root))
    return out


def plain_counts(rows, slip=None, shortest=6, fewest=5):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda c: c[0].lower(), run)
            code = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if slip and code % slip == 0:
                word = word[: code % len(word)] + word[code % len(word) + 1 :]
            counts[word] += len(word) >= shortest
    return {w: n for w, n in counts.items() if n >= fewest}


def found_forms(words, **options):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.forms(words, **options).collect()}


def counted(df, **options):
    return {r.word: r.n for r in spelling.count_words(df, **options).collect()}


def made_up(seed, count=400):
    rnd = random.Random(seed)
    words = set()
    while len(words) < count:
        word = "".join(rnd.choice("abcéñ÷") for _ in range(rnd.randint(1, 9)))
        words.add(word)
        words.update(rnd.sample(sorted(edits(word, "abcéñz")), 3))
    return {w: rnd.choice([5, 6, 25, 30, 124, 125, 700, 4000, 10**12]) for w in sorted(words)}


def test_forms_equal_plain_search(spark):
    counts = made_up(1)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert found_forms(words) == plain_forms(counts)
    assert found_forms(words, ratio=1.1) == plain_forms(counts, ratio=1.1)
    with pytest.raises(ValueError):
        spelling.forms(words, ratio=1)


def test_parts_and_rounds_do_not_change_what_is_found(spark, monkeypatch):
    counts = made_up(2)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    monkeypatch.setattr(spelling, "SHARD_WORDS", 20)
    monkeypatch.setattr(spelling, "ROUND_BYTES", 300)
    assert len(list(spelling._rounds(spelling._filters(spelling._hashed(words))))) > 3
    assert found_forms(words) == plain_forms(counts)


def test_long_chains_end_at_their_root(spark):
    counts = {"a" * k: 5 ** (22 - k) for k in range(6, 21)} | {"b" * 3000: 7, "b" * 2999: 35, "b" * 2999 + "c": 36, "": 10**13, "q": 5}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: (r.form, r.root, r.n_near) for r in spelling.forms(words).collect()}
    assert {w: found[w][1] for w in counts if "a" in w} == {w: "a" * 6 for w in counts if "a" in w}
    assert found["b" * 3000] == ("b" * 2999 + "c", "b" * 2999 + "c", 2) and found["b" * 2999] == (None, "b" * 2999, 2)
    assert found["q"] == ("", "", 1)


def test_ties_take_the_first_in_code_point_order(spark):
    words = spark.createDataFrame([("aaaaab", 50), ("aaaaaa", 50), ("aaaaaé", 50), ("aaaaac", 10)], "word string, n long")
    assert {r.word: r.form for r in spelling.forms(words).collect()}["aaaaac"] == "aaaaaa"


def test_counts_equal_plain_counts(spark, documents, odd):
    for df in (documents, odd):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        for slip in (None, 7, 199):
            assert counted(df, slip=slip) == plain_counts(rows, slip)
    assert counted(odd.select("doc_id", "text"), shortest=1, fewest=1) == plain_counts([(r.doc_id, r.text) for r in odd.collect()], None, 1, 1)


def test_pieces_end_between_words(spark, monkeypatch):
    text = "Straße ÀÈÌÕÚ×÷ naïve-CAFÉ déjà\x00vu " * 50 + "w" * 999 + " 漢字tail"
    whole = [w for words in spelling.runs(text) for w in words]
    for size in (1, 7, 64):
        monkeypatch.setattr(spelling, "_PIECE", size)
        assert [w for words in spelling.runs(text) for w in words] == whole
    assert whole[:3] == ["straße", "ÀÈÌÕÚ×÷", "naïve"]


def test_full_tables_of_counts_are_passed_on(spark, documents, monkeypatch):
    want = counted(documents, slip=199)
    monkeypatch.setattr(spelling, "_HELD_WORDS", 50)
    assert counted(documents, slip=199) == want


def test_nothing(spark, nothing, documents):
    assert spelling.forms(spelling.count_words(nothing)).count() == 0
    one = spark.createDataFrame([(1, "single " * 5)], "doc_id long, text string")
    assert [tuple(r) for r in spelling.forms(spelling.count_words(one)).collect()] == [("single", 5, 0, None, None, "single")]


@pytest.mark.parametrize("size", [0, 1, 17, 5000])
def test_filters_pass_all_their_keys_and_few_others(size):
    rng = np.random.default_rng(size)
    keys, others = rng.integers(0, 1 << 64, (2, size), np.uint64, endpoint=False) if size else np.zeros((2, 0), np.uint64)
    part = keys.view(np.int64) % 3
    rows = [(7, p, 3, spelling.blocked_bloom(keys[part == p]).tobytes()) for p in range(3)]
    made, some = spelling.Shards(rows), spelling.Shards(rows[1:])
    assert made.passed(keys, 7).tolist() == list(range(size))
    assert some.passed(keys, 7).tolist() == np.flatnonzero(part != 0).tolist()
    assert len(made.passed(others, 7)) <= max(2, size // 100) and 8 not in made


def test_hash_of_an_edit_is_that_of_the_new_word(spark):
    word, alphabet = "abcddeé", np.array([ord(c) for c in "acdéz"], np.uint32)

    class Everything(dict):
        def __contains__(self, length):
            return True

        def passed(self, keys, length):
            self.setdefault(length, keys)
            return np.arange(len(keys))

    seen = Everything()
    found = [e for _, e in spelling.near_candidates([word], seen, alphabet)]
    assert len(found) == len(set(found)) and all(spelling.hashes(spelling.matrix([e]))[0] in seen[len(e)] for e in found)
    assert set(found) == {e for e in edits(word, "acdéz") if len(e) < 7 or len(e) == 7 and e > word}
