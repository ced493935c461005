"""Byte-level BPE by a lazily determinised transducer, and a streaming decoder.

Encoding. A sequence of tokens is the BPE encoding of its bytes exactly if each two neighbours are: so every prefix
of a piece has one encoding, whose last token alone decides what may follow. A state of the transducer holds one
item for each place of the piece where a token that is still being read may have begun: the node of the
vocabulary trie that the bytes since then lead to, and the token before that place. States and their transitions
are made when a text first needs them. Tokens are emitted when all items agree on them; an ordinary piece is shorter
than the lookahead of a long one, so it is emitted at its end.

Many short pieces are read side by side, their items as arrays that advance together (``bpe_arrays``): with words that are
seldom met again, states would be made about as often as they are used. A longer piece is read alone, by states.

Decoding. Token bytes are fed to a state machine that keeps the bytes of an unfinished UTF-8 character until the next
feed; so ids may be decoded in blocks of any size.

Nulls, empty texts and rows: a NULL text is an empty one and has no ids; NULL ids give an empty text. Repeated rows are
encoded alike. Other columns, whatever their names, stay; a column with the name of the result is replaced.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from tiermill.llm.bpe_arrays import SideBySide, Verdicts
from tiermill.llm.segments import CACHE_ENTRIES, PieceCache
from tiermill.llm.workers import keep, ship, trim

#: Fixed value: how texts are split before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

MOST_STATES = 180_000
MOST_PAIRS = 400_000
_NEVER = 1 << 60
_SHIFT = 24
_LOW = (1 << _SHIFT) - 1
_LONG_PIECE = 1 << 14
_SHORT_PIECE = 64


def _load_tokens(path: str) -> list[bytes]:
    """Tokens by rank, from a file with a token in base64 and its rank on each line."""
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_stream(place) as source:
        lines = [line.split() for line in source.read().splitlines() if line]
    tokens: list[bytes] = [b""] * (max(int(rank) for _, rank in lines) + 1)
    for token, rank in lines:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class Vocabulary:
    """Tokens by rank, and the merges that make each of them."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ranks = {token: rank for rank, token in enumerate(tokens)}
        self._spines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.known_pairs: dict[int, bool] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        return cls(_load_tokens(path))

    def merge(self, piece: bytes, below: int = _NEVER) -> list[int]:
        """Apply merges of rank under ``below`` in order of rank, leftmost first."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at one end of a token while it is merged, each with the rank of the merge that ends it."""
        found = self._spines.get((token, side))
        if found is None:
            inner = self.merge(self.tokens[token], token)
            if len(inner) < 2:
                found = [(token, _NEVER)]
            else:
                below = self.spine(inner[-1 if side else 0], side)
                found = [*below[:-1], (below[-1][0], token), (token, _NEVER)]
            self._spines[token, side] = found
        return found

    def together(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their joined bytes are merged."""
        if len(self.known_pairs) > MOST_PAIRS:
            self.known_pairs.clear()
        found = self._stay_apart(self.spine(left, 1), self.spine(right, 0))
        self.known_pairs[left << _SHIFT | right] = found
        return found

    def _stay_apart(self, left: list[tuple[int, int]], right: list[tuple[int, int]]) -> bool:
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = left[i], right[j]
            across = self.ranks.get(self.tokens[a] + self.tokens[b], _NEVER)
            # of merges with one rank the leftmost comes first: inside the left token, across, inside the right one
            if across < a_ends and across <= b_ends and across < _NEVER:
                return False
            if a_ends == b_ends == _NEVER:
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1


class Transducer:
    """Reads bytes of a piece and emits tokens as soon as no continuation can change them.

    An item is one number: trie node, then the token before (0 at the start of the piece, else its rank + 1). The
    last item of a state is the root of the trie after the token that ends there.
    """

    def __init__(self, vocabulary: Vocabulary, most_states: int = MOST_STATES):
        self.vocabulary, self._most = vocabulary, most_states
        self._child: dict[int, int] = {}
        self._token: list[int] = [-1]
        inner = {0}
        for rank, token in enumerate(vocabulary.tokens):
            node = 0
            for byte in token:
                inner.add(node)
                node = self._child.setdefault(node << 8 | byte, len(self._token))
                if node == len(self._token):
                    self._token.append(-1)
            self._token[node] = rank
        self._inner = [node in inner for node in range(len(self._token))]
        self._sizes = [0, *map(len, vocabulary.tokens)]
        self._many: SideBySide | None = None
        self._reset()

    def _reset(self) -> None:
        self._numbers = {(0,): 0}
        self._states: list[tuple[int, ...]] = [(0,)]
        self._steps: dict[int, int] = {}
        self._ended = [0]

    def _step(self, state: int, byte: int) -> int:
        """Make the transition: advance every item, and begin one after the token that ends here."""
        items, ended = [], 0
        child, token_of, inner, together = self._child, self._token, self._inner, self.vocabulary.together
        known = self.vocabulary.known_pairs
        for item in self._states[state]:
            node = child.get(item >> _SHIFT << 8 | byte)
            if node is None:
                continue
            before = item & _LOW
            if not ended and (token := token_of[node]) >= 0:
                apart = known.get((before - 1) << _SHIFT | token) if before else True
                if apart or apart is None and together(before - 1, token):
                    ended = token + 1
            if inner[node]:
                items.append(node << _SHIFT | before)
        items.append(ended)
        key = tuple(items)
        number = self._numbers.get(key)
        if number is None:
            number = self._numbers[key] = len(self._states)
            self._states.append(key)
            self._ended.append(ended)
        self._steps[state << 8 | byte] = number
        return number

    def _chain(self, ends: list[int], until: int) -> list[int]:
        """Tokens (rank + 1) of the encoding of the first ``until`` bytes, last one first."""
        out = []
        while until > 0:
            out.append(ends[until])
            until -= self._sizes[ends[until]]
        return out

    def _decided(self, ends: list[int], state: int, depth: list[int]) -> int:
        """How many leading bytes all items of the state have cut into the same tokens."""
        open_places = [len(ends) - 1 - depth[item >> _SHIFT] for item in self._states[state]]
        if min(open_places) <= 0:
            return 0
        chains = []
        for place in open_places:
            cuts, at = [], place
            while at > 0:
                cuts.append(at)
                at -= self._sizes[ends[at]]
            chains.append(cuts[::-1])
        same = 0
        for cuts in zip(*chains, strict=False):
            if min(cuts) != max(cuts):
                break
            same = cuts[0]
        return same

    def stream(self, data: Iterable[int], block: int = 1 << 12) -> Iterator[int]:
        """Tokens of one piece that may be as long as it likes; holds about ``block`` undecided bytes."""
        depth = self._depths()
        ends, state = [0], 0
        for byte in data:
            found = self._steps.get(state << 8 | byte)
            state = self._step(state, byte) if found is None else found
            ends.append(self._ended[state])
            if len(ends) > block and (cut := self._decided(ends, state, depth)):
                yield from (token - 1 for token in reversed(self._chain(ends, cut)))
                ends = ends[cut:]
        yield from (token - 1 for token in reversed(self._chain(ends, len(ends) - 1)))

    def _depths(self) -> list[int]:
        """Length of the bytes that lead to each trie node."""
        depth = [0] * len(self._token)
        for edge, node in self._child.items():
            depth[node] = depth[edge >> 8] + 1
        return depth

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one piece that the pattern matched."""
        whole = self.vocabulary.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self._states) > self._most:
            self._reset()
        if len(piece) > _LONG_PIECE:
            return list(self.stream(piece))
        ends, state, steps, ended = [0], 0, self._steps, self._ended
        for byte in piece:
            found = steps.get(state << 8 | byte)
            state = self._step(state, byte) if found is None else found
            ends.append(ended[state])
        sizes, at, out = self._sizes, len(piece), []
        while at:
            token = ends[at]
            out.append(token - 1)
            at -= sizes[token]
        out.reverse()
        return out


    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """Tokens of each of these pieces, as 32-bit numbers."""
        ranks = self.vocabulary.ranks
        if self._many is None:
            self._many = SideBySide(self._child, self._token, self._sizes, Verdicts(self.vocabulary.tokens, ranks, self.vocabulary.spine))
        alone = [i for i, piece in enumerate(pieces) if len(piece) > _SHORT_PIECE or piece in ranks]
        if not alone:
            return self._many.encode(pieces)
        short = pieces.copy()
        for i in alone:
            short[i] = short[i][:1]
        out = self._many.encode(short)
        for i in alone:
            out[i] = array("i", self.encode(pieces[i])).tobytes()
        return out


class StreamDecoder:
    """Decodes ids fed in blocks; an unfinished character waits for the next block."""

    def __init__(self, tokens: list[bytes]):
        self._tokens, self._kept = tokens, b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """Length of a begun but unfinished UTF-8 character at the end."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue
            needs = 2 if 0xC2 <= byte <= 0xDF else 3 if 0xE0 <= byte <= 0xEF else 4 if 0xF0 <= byte <= 0xF4 else 1
            return back if needs > back else 0
        return 0

    def feed_bytes(self, data: bytes) -> str:
        data = self._kept + data
        cut = len(data) - self.unfinished(data)
        self._kept = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def feed(self, ids) -> str:
        return self.feed_bytes(b"".join([self._tokens[i] for i in ids]))

    def finish(self) -> str:
        rest, self._kept = self._kept.decode("utf-8", "replace"), b""
        return rest


@lru_cache(2)
def _encoder(path: str, pieces: int = CACHE_ENTRIES, states: int = MOST_STATES) -> PieceCache:
    trim()
    transducer, split = Transducer(Vocabulary.load(path), states), regex.compile(PATTERN).findall
    letters = regex.compile(r" ?\p{L}+").fullmatch
    gc.set_threshold(1_000_000, 50, 1000)  # the tables hold many objects and no cycles

    def encode(pieces: list[str], cache: PieceCache) -> list[bytes]:
        # of letters alone, behind a space at most, most pieces are one match
        plain = [p.isalpha() or p[0] == " " and p[1:].isalpha() if p.isascii() else letters(p) is not None for p in pieces]
        whole, cut = list(compress(pieces, plain)), [split(p) for p, is_plain in zip(pieces, plain, strict=True) if not is_plain]
        new = list(dict.fromkeys(match for matches in cut for match in matches if cache.get(match) is None))
        found = transducer.encode_many([piece.encode() for piece in whole + new])
        known = dict(zip(new, found[len(whole) :], strict=True))
        for match, ids in known.items():
            cache.put(match, ids)
        whole_ids = iter(found)
        cut_ids = (b"".join([known.get(match) or cache.get(match) for match in matches]) for matches in cut)
        return [next(whole_ids if is_plain else cut_ids) for is_plain in plain]

    keep(_encoder.cache_clear)
    return PieceCache(encode, pieces)


@lru_cache(2)
def _token_bytes(path: str) -> pa.Array:
    return pa.array(_load_tokens(path), pa.binary())


_TEXTS_AT_ONCE = 1024
_IDS_AT_ONCE = 1 << 16


def _encode_column(texts: pa.Array, path: str, *kept: int) -> pa.Array:
    cache, sizes, data = _encoder(path, *kept), [], []
    for at in range(0, len(texts), _TEXTS_AT_ONCE):
        found = cache.ids(texts.slice(at, _TEXTS_AT_ONCE).to_pylist())
        sizes += [len(x) // 4 for x in found]
        data.append(b"".join(found))
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    ids = pa.array(np.frombuffer(b"".join(data), "<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids)


def _decode_column(ids: pa.Array, path: str) -> pa.Array:
    tokens, out = _token_bytes(path), []
    decoder = StreamDecoder([])
    for i in range(len(ids)):
        own = ids[i].values if ids[i].is_valid else None
        parts = []
        for at in range(0, len(own) if own is not None else 0, _IDS_AT_ONCE):
            spelled = tokens.take(own.slice(at, _IDS_AT_ONCE))
            parts.append(decoder.feed_bytes(spelled.buffers()[2].to_pybytes()[: _spelled_size(spelled)]))
        out.append("".join(parts) + decoder.finish())
    return pa.array(out, pa.string())


def _both_ways(texts: pa.Array, path: str, *kept: int) -> pa.Array:
    ids = _encode_column(texts, path, *kept)
    return pa.StructArray.from_arrays([ids, _decode_column(ids, path)], ["ids", "text"])


def _spelled_size(spelled: pa.Array) -> int:
    return int(np.frombuffer(spelled.buffers()[1], np.int32)[len(spelled)])


def encode_bpe(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of ``text``; ``vocabulary`` is the path of a file of ranks."""
    ship(df.sparkSession)

    @F.arrow_udf(ArrayType(IntegerType()))
    def encoded(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield _encode_column(batch, vocabulary)

    return df.withColumn(ids, encoded(F.col(text)))


def decode_bpe(df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add the text that the ids spell; bytes that are no UTF-8 become U+FFFD."""
    ship(df.sparkSession)

    @F.arrow_udf(StringType())
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _decode_column(batch, vocabulary)

    return df.withColumn(text, decoded(F.col(ids)))


def round_trip(
    df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", pieces: int = CACHE_ENTRIES, states: int = MOST_STATES
) -> DataFrame:
    """Add the ids of ``text`` and what they decode to, in one pass through the workers.

    A worker remembers the ids of up to twice ``pieces`` pieces and as many ``states``; with fewer it works more and holds less.
    """
    ship(df.sparkSession)

    @F.arrow_udf("struct<ids:array<int>,text:string>")
    def there_and_back(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _both_ways(texts, vocabulary, pieces, states)
            trim()  # a batch leaves more freed memory behind than all tables hold

    both = df.withColumn("__both", there_and_back(F.col(text)))
    return both.withColumns({ids: F.col("__both.ids"), decoded: F.col("__both.text")}).drop("__both")


def id_text(ids: Column) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(ids.cast("array<string>"), " ")
