"""Dataset manifests against a plain tree of lists."""

from __future__ import annotations

import hashlib
import random
import string
import zlib

import pytest
from pyspark.sql import functions as F

from tiermill.llm import merkle, queries

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
CLASHING = ("tree", "lo", "hi", "digest", "children", "rank", "total", "path", "key", "c0", "name", "bucket", "leaf", "root", "__part", "subroot")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Top of a tree, and for each leaf its siblings (before, behind) on the way."""
    own, ways = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, at in enumerate(own):
            run = at // 8 * 8
            ways[i].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 8])))
        own = [at // 8 for at in own]
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], ways


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    members = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in names}
    trees = {g: climb([leaf(r) for r in members[g]]) for g in names}
    root, upper = climb([trees[g][0] for g in names])
    out = []
    for g, above in zip(names, upper, strict=True):
        top, ways = trees[g]
        for row, way in zip(members[g], ways, strict=True):
            path = way + above
            start = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                lowered = row[4] and row[4].translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
                start = leaf([*row[:4], lowered])
            for before, behind in path:
                start = sha(before + start + behind)
            out.append((row[0], leaf(row), top, root, sha("".join(a + b for a, b in path)), start, start == root))
    return sorted(out, key=str)


def found(spark, rows, tmp_path, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.withColumns({c: F.lit("z") for c in CLASHING if extra}).repartition(5)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    made = queries.op12_merkle(spark, str(tmp_path)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in made.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_manifest_equals_plain_trees(spark, tmp_path, seed):
    rnd = random.Random(seed)
    rows, sizes = [], {"a": 1, "b": 8, "é": 9, "c": 64, "d": 65, None: 20, "": 3, "B": 2, "漢": 7, "x\U0001f642": 1}
    sizes |= {f"l{i}": 1 for i in range(60 if seed == 2 else 0)}
    for lang, size in sizes.items():
        for _ in range(size):
            text = rnd.choice([None, "", "Some Text", "lower", "É", "A" * 100_000, "a:1\n-"])
            rows.append((rnd.randint(-9, 3000), rnd.choice([None, "s", "3:x"]), lang, rnd.choice([None, 0, -5, 10**12]), text))
    assert found(spark, rows, tmp_path) == plain(rows)


def test_rows_alike_and_without_an_id(spark, tmp_path):
    rows = [(None, "s", "en", 1, "Same")] * 70 + [(5, "s", "en", 1, "Same")] * 20 + [(5, "s", "en", 1, f"T{i}") for i in range(9)] + [(None, None, None, None, None)] * 9
    assert found(spark, rows, tmp_path) == plain(rows)


@pytest.mark.parametrize("size", [1, 2, 9])
def test_one_group(spark, tmp_path, size):
    rows = [(i, "s", "en", i, "Text") for i in range(size)]
    assert found(spark, rows, tmp_path) == plain(rows)


def test_no_rows(spark, tmp_path):
    assert found(spark, [], tmp_path) == []


def test_query_tells_tampered_texts(spark, small, documents):
    rows = [tuple(r[c] for c in COLUMNS) for r in documents.collect()]
    made = queries.op12_merkle(spark, small).collect()
    assert sorted((tuple(r) for r in made), key=str) == plain(rows)
    assert {r.verified for r in made} == {True, False}


def test_one_proof_by_hand(spark):
    df = spark.createDataFrame([(i, "en") for i in range(10)], "doc_id long, lang string")
    rows = {r.doc_id: r for r in merkle.manifest(df, "lang", "doc_id", ["doc_id", "lang"]).collect()}
    leaves = [sha(f"1:{i}2:en") for i in range(10)]
    left, right = sha("".join(leaves[:8])), sha("".join(leaves[8:]))
    assert rows[9].leaf == leaves[9] and rows[9].root == rows[9].subroot == sha(left + right)
    assert [tuple(s) for s in rows[9].path] == [(leaves[8], ""), (left, "")]
    assert [tuple(s) for s in rows[2].path] == [("".join(leaves[:2]), "".join(leaves[3:8])), ("", right)]
