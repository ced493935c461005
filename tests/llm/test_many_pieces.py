"""Pieces read side by side, against the library and the transducer that reads them one by one."""

from __future__ import annotations

import base64
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_tokens import RANKS, noise
from tiermill.llm import bpe_arrays, bpe_fst, queries

MULTI = queries.tokenizer_file("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=bpe_fst.PATTERN, mergeable_ranks=ranks, special_tokens={})


def words(count):
    rnd = random.Random(count)
    parts = ["the", "an", "tion", "er", "ou", "é", "ß", "qu", "x", "漢", "st", "ing", "ed", "re", "'s", "12", "--"]
    return [" ".join("".join(rnd.choices(parts, k=rnd.randint(1, 6))) for _ in range(9)) for _ in range(count)]


def test_new_words_make_no_states(library, monkeypatch):
    def refused(*_):
        raise AssertionError("a state was made")

    texts = [None, "", *words(300), *noise(7, 300)]
    monkeypatch.setattr(bpe_fst.Transducer, "_step", refused)
    assert bpe_fst._encode_column(pa.array(texts), RANKS, 100, 100).to_pylist() == [library.encode_ordinary(t or "") for t in texts]


@pytest.mark.parametrize("vocabulary", [RANKS, MULTI])
def test_many_pieces_are_read_as_one_by_one(vocabulary, monkeypatch):
    """Also in small groups, with few remembered pairs, and where a long piece or a whole token is among them."""
    rnd = random.Random(4)
    tokens = bpe_fst.Vocabulary.load(vocabulary).tokens
    pieces = [bytes(rnd.choices(range(256), k=rnd.randint(1, 12))) for _ in range(300)]
    pieces += [b"".join(rnd.choices(tokens, k=rnd.randint(1, 5))) for _ in range(1500)] + [b"the" * 50, b" " * 64, b" " * 65, tokens[1000]]
    one_by_one = bpe_fst.Transducer(bpe_fst.Vocabulary.load(vocabulary))
    want = [one_by_one.encode(piece) for piece in pieces]
    for at_once, bits in ((1 << 13, 20), (7, 3)):
        monkeypatch.setattr(bpe_arrays, "PIECES_AT_ONCE", at_once)
        monkeypatch.setattr(bpe_arrays, "PAIR_BITS", bits)
        many = bpe_fst.Transducer(bpe_fst.Vocabulary.load(vocabulary))
        for _ in range(2):
            assert [np.frombuffer(ids, "<i4").tolist() for ids in many.encode_many(pieces)] == want
    assert many.encode_many([]) == []


def test_every_node_is_found_by_its_byte_alone():
    rnd = random.Random(6)
    children, count = {}, 1
    while count < 3000:
        node = rnd.randrange(count)
        if node not in children:
            steps = rnd.sample(range(256), rnd.choice([1, 1, 1, 2, 5, 256]))
            children[node] = {byte: count + i for i, byte in enumerate(steps)}
            count += len(steps)
    children.setdefault(0, {7: count})
    slot, base, parent = bpe_arrays.slots(children)
    assert slot[0] == 0 and len(set(slot.values())) == len(slot)
    for node, below in children.items():
        at = base[slot[node]] + np.arange(256)
        found = np.flatnonzero(parent[at] == slot[node])
        assert {int(byte): int(at[byte]) for byte in found} == {byte: slot[child] for byte, child in below.items()}
