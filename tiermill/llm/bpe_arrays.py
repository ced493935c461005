"""The transducer of ``bpe_fst`` over many short pieces side by side, one byte of each at a time.

An item is what it is there: the trie node that the bytes since some place lead to, and the token before that place. The items of
all pieces are arrays, those of later places first. With each byte all items advance along the trie; of the items of a piece that
reach a token which may follow their token before, the one of the earliest place tells the token that ends here, and with
it a new item begins. So a new piece costs some array elements, and no state or transition is made for it. Verdicts on pairs of
tokens are remembered in a table of fixed size, in which a new one takes the place of an older one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Pieces that are read side by side, and the logarithm of the number of pairs that are remembered.
PIECES_AT_ONCE = 1 << 13
PAIR_BITS = 20
_SHIFT = 24
_NEVER = np.int32((1 << 31) - 1)
_NO_PAIR = (1 << 63) - 1
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def slots(children: dict[int, dict[int, int]]) -> tuple[dict[int, int], np.ndarray, np.ndarray]:
    """A trie as arrays, from the children by byte of its inner nodes; node 0 is the root.

    Each node has a slot, the root the first one; a child's is ``base`` of its parent plus the byte, where ``parent`` names it.
    """
    size = 2 * (1 + sum(map(len, children.values()))) + 512
    free, base, parent = np.ones(size, bool), np.zeros(size, np.int32), np.full(size, -1, np.int32)
    free[0], free[-256:] = False, False  # any byte may be looked up at any base
    first: dict[int, int] = {}
    at, width = 1, 0
    for node in sorted((node for node, below in children.items() if len(below) > 1), key=lambda node: -len(children[node])):
        steps = np.sort(np.fromiter(children[node], np.int64))
        if len(steps) != width:
            at, width = 1, len(steps)  # what was too full for more children may do
        while True:
            at += int(free[at:].argmax())
            places = at + np.flatnonzero(free[at : at + 64])
            fits = np.flatnonzero(free[np.minimum(places[:, None] + (steps - steps[0]), size - 1)].all(1))
            if len(fits):
                break
            at += 64
        first[node] = int(places[fits[0]] - steps[0])
        free[first[node] + steps] = False
    single = {node: next(iter(below)) for node, below in children.items() if len(below) == 1}
    places = np.flatnonzero(free)[: len(single)].tolist()
    first |= {node: place - byte for (node, byte), place in zip(single.items(), places, strict=True)}
    slot = {0: 0} | {child: first[node] + byte for node, below in children.items() for byte, child in below.items()}
    base[[slot[node] for node in children]] = [first[node] for node in children]
    edges = [(slot[child], slot[node]) for node, below in children.items() for child in below.values()]
    parent[[child for child, _ in edges]] = [node for _, node in edges]
    return slot, base, parent


class Verdicts:
    """Whether two tokens stay apart when their joined bytes are merged, for many pairs at once.

    ``spine`` gives the tokens at one end of a token while it is merged, each with the rank of the merge that ends it, as in
    ``bpe_fst.Vocabulary``; they are kept as arrays once asked for.
    """

    def __init__(self, tokens: list[bytes], ranks: dict[bytes, int], spine: Callable[[int, int], list[tuple[int, int]]]):
        merges = [(ranks[token[:i]] << _SHIFT | ranks[token[i:]], rank) for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        merges.sort()
        self._merged = np.array([pair for pair, _ in merges] + [_NO_PAIR], np.int64)
        self._rank = np.array([rank for _, rank in merges] + [_NEVER], np.int32)
        self._spine, self._known = spine, np.zeros((2, len(tokens)), bool)
        self._token, self._ends = (np.full((2, len(tokens), 8), fill, np.int32) for fill in (0, _NEVER))

    def _learn(self, side: int, wanted: np.ndarray) -> None:
        for token in np.unique(wanted[~self._known[side, wanted]]).tolist():
            found = self._spine(token, side)
            more = len(found) - self._token.shape[2]
            if more > 0:
                self._token, self._ends = (np.pad(x, ((0, 0), (0, 0), (0, more)), constant_values=fill) for x, fill in ((self._token, 0), (self._ends, _NEVER)))
            self._token[side, token, : len(found)] = [t for t, _ in found]
            self._ends[side, token, : len(found)] = [min(until, _NEVER) for _, until in found]
            self._known[side, token] = True

    def stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The verdict on each pair of tokens, by rank."""
        self._learn(1, left)
        self._learn(0, right)
        out, live = np.ones(len(left), bool), np.arange(len(left))
        i, j = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
        while len(live):
            l, r, at, to = left[live], right[live], i[live], j[live]  # noqa: E741
            l_ends, r_ends = self._ends[1, l, at], self._ends[0, r, to]
            pair = self._token[1, l, at].astype(np.int64) << _SHIFT | self._token[0, r, to]
            place = np.searchsorted(self._merged, pair)
            across = np.where(self._merged[place] == pair, self._rank[place], _NEVER)
            # of merges with one rank the leftmost comes first: inside the left token, across, inside the right one
            joined = (across < l_ends) & (across <= r_ends) & (across < _NEVER)
            out[live[joined]] = False
            first = l_ends <= r_ends
            i[live] += first
            j[live] += ~first
            live = live[~joined & ((l_ends < _NEVER) | (r_ends < _NEVER))]
        return out


class SideBySide:
    """Encodes many pieces with a trie (``child`` by node and byte, the ``token`` of each node) of tokens of these ``sizes``, by rank + 1."""

    def __init__(self, child: dict[int, int], token: list[int], sizes: list[int], verdicts: Verdicts):
        children: dict[int, dict[int, int]] = {}
        for edge, node in child.items():
            children.setdefault(edge >> 8, {})[edge & 255] = node
        slot, self._base, self._parent = slots(children)
        self._token, self._inner = np.zeros(len(self._base), np.int32), np.zeros(len(self._base), bool)
        self._token[[slot[node] for node in range(len(token))]] = np.array(token) + 1
        self._inner[[slot[node] for node in children]] = True
        self._sizes, self._verdicts = np.array(sizes, np.int32), verdicts
        self._pairs = np.full(1 << PAIR_BITS, -2, np.int64)  # a pair, and in the last bit its verdict

    def _may_follow(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether ``token`` may follow ``before``, both as rank + 1; anything may follow 0, the start of a piece."""
        pair = before.astype(np.int64) << _SHIFT | token
        place = (pair.view(np.uint64) * _SPREAD >> np.uint64(64 - PAIR_BITS)).view(np.int64)
        known = self._pairs[place]
        out = (known & 1).astype(bool) | (before == 0)
        new = np.flatnonzero((known >> 1 != pair) & (before > 0))
        if len(new):
            distinct, which = np.unique(pair[new], return_inverse=True)
            out[new] = self._verdicts.stay_apart((distinct >> _SHIFT) - 1, (distinct & ((1 << _SHIFT) - 1)) - 1)[which]
            self._pairs[place[new]] = pair[new] << 1 | out[new]
        return out

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Tokens of each piece, none of which is empty, as 32-bit numbers."""
        out: list[bytes] = []
        for at in range(0, len(pieces), PIECES_AT_ONCE):
            out += self._encode(pieces[at : at + PIECES_AT_ONCE])
        return out

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-sizes, kind="stable")
        starts = (np.cumsum(sizes) - sizes)[order]
        ends = self._read(np.frombuffer(b"".join(pieces), np.uint8), starts, sizes[order])
        counts, ids = self._tokens(ends, sizes[order])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        until = np.cumsum(counts)
        stops, begins = (4 * until[rank]).tolist(), (4 * (until - counts)[rank]).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(begins, stops, strict=True)]

    def _read(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The token (rank + 1) that ends after each byte of each piece, by place and piece; longer pieces come first."""
        longest = int(sizes[0])
        left = np.searchsorted(-sizes, -np.arange(longest + 1), "left")  # pieces of more bytes than that
        ends = np.zeros((longest + 1, len(sizes)), np.int32)
        every = np.arange(len(sizes), dtype=np.int32)
        of, node, before = every, np.zeros(len(sizes), np.int32), np.zeros(len(sizes), np.int32)
        for place in range(longest):
            byte = data[starts[: left[place]] + place]
            further = self._base[node] + byte[of]
            there = np.flatnonzero(self._parent[further] == node)
            of, node, before = of[there], further[there], before[there]
            token = self._token[node]
            ended = np.flatnonzero(token)
            ended = ended[self._may_follow(before[ended], token[ended])]
            here = ends[place + 1]
            here[of[ended]] = token[ended]  # of several the last one stays, which began first
            go_on = np.flatnonzero(self._inner[node] & (of < left[place + 1]))
            new = left[place + 1]
            of = np.concatenate([every[:new], of[go_on]])
            node = np.concatenate([np.zeros(new, np.int32), node[go_on]])
            before = np.concatenate([here[:new], before[go_on]])
        return ends

    def _tokens(self, ends: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens each piece has, and the tokens, read back from the end of each piece."""
        counts, at, live, read = np.zeros(len(sizes), np.int64), sizes.copy(), np.arange(len(sizes)), []
        while len(live):
            token = ends[at[live], live]
            read.append((live, token - 1))
            counts[live] += 1
            at[live] -= self._sizes[token]
            live = live[at[live] > 0]
        last = np.cumsum(counts) - 1
        ids = np.empty(int(counts.sum()), "<i4")
        for back, (of, token) in enumerate(read):
            ids[last[of] - back] = token
        return counts, ids
