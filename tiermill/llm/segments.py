"""Cut texts where no byte-level BPE token can cross, so that each distinct piece is encoded once.

The pre-tokenizer of the public byte-level vocabularies splits at every change from a non-space to a white-space
character and between letters or digits and other characters, and a single leading space belongs to what follows.
Pieces between such places are encoded alone with the same result as inside the text.
"""

from __future__ import annotations

import re
from collections import ChainMap
from collections.abc import Callable, Iterable, Mapping
from itertools import chain

import numpy as np
import pyarrow as pa

# The characters with the Unicode property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_COARSE = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]")

# Runs of letters and digits apart from other runs. An apostrophe may belong to the letters behind it, an underscore is none
# of the letters, and beyond the first letters of Unicode the classes of two programs may differ: such texts stay coarse.
_FINE = re.compile(f" ?[^\\W_]+| ?[^\\w{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]")
_DOUBTFUL = re.compile("['_\u0250-\U0010ffff]")


def pieces_of(text: str) -> list[str]:
    """The text cut into pieces that are encoded alone with the same result."""
    return (_COARSE if _DOUBTFUL.search(text) else _FINE).findall(text)


#: Classes of the first characters of Unicode, those that ``_FINE`` is for: white space, letters and digits, others.
_SPACE, _WORD, _OTHER = range(3)
_FAR = re.compile("[\u0250-\U0010ffff]")
_CLASSES = np.full(0x250, _OTHER, np.uint8)
_CLASSES[[c for c in range(0x250) if re.match(f"[{WHITE_SPACE}]", chr(c))]] = _SPACE
_CLASSES[[c for c in range(0x250) if re.match(r"[^\W_]", chr(c))]] = _WORD


def _starts(chars: np.ndarray, offsets: np.ndarray, coarse: np.ndarray) -> np.ndarray:
    """Where the pieces of texts of the first characters begin, as ``pieces_of`` cuts them; no text is empty."""
    kind = _CLASSES[chars]
    if coarse.any():
        kind[np.repeat(coarse, np.diff(offsets)) & (kind == _OTHER)] = _WORD
    space = kind == _SPACE
    begins = np.ones(len(chars), bool)
    # each change of class begins a piece, but one space belongs to what follows
    begins[1:] = (kind[1:] != kind[:-1]) & (space[1:] | (chars[:-1] != 32))
    begins[:-1] |= space[:-1] & ~space[1:]  # the last of a run of white space stands apart,
    ends = offsets[1:] - 1
    ends = ends[space[ends]]
    begins[ends] = ~space[ends - 1]  # unless the text ends there
    begins[offsets[:-1]] = True
    return np.flatnonzero(begins)


CACHE_ENTRIES = 400_000
LONGEST_CACHED = 64
CHARS_AT_ONCE = 4 << 20


class PieceCache:
    """Ids of pieces as little-endian bytes, found once per distinct piece.

    ``encode`` gets the pieces that are not known yet, in one list, and this cache. There are two generations: a full one
    becomes the older one, from which pieces that are still met come back; what is forgotten is encoded again.
    """

    def __init__(self, encode: Callable[[list[str], PieceCache], Iterable[bytes]], entries: int = CACHE_ENTRIES):
        self._encode, self._entries = encode, entries
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def get(self, piece: str) -> bytes | None:
        return self._young.get(piece) or self._old.get(piece)

    def put(self, piece: str, ids: bytes) -> None:
        if len(piece) <= LONGEST_CACHED:
            self._young[piece] = ids

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids as 32-bit little-endian numbers; NULL has none."""
        if len(self._young) > self._entries:
            self._old, self._young = self._young, {}
        out = [b""] * len(texts)
        near, far = [], []
        for i, text in enumerate(texts):
            if text:
                (near if text.isascii() or not _FAR.search(text) else far).append(i)
        sizes = np.cumsum([len(texts[i]) for i in near])
        while near:
            until = max(1, int(np.searchsorted(sizes, CHARS_AT_ONCE + sizes[0] - len(texts[near[0]]), "right")))
            for i, ids in zip(near[:until], self._near([texts[i] for i in near[:until]]), strict=True):
                out[i] = ids
            near, sizes = near[until:], sizes[until:]
        if far:
            pieces = [pieces_of(texts[i]) for i in far]
            known = self._learned(set(chain.from_iterable(pieces)))
            for i, own in zip(far, pieces, strict=True):
                out[i] = b"".join(map(known.__getitem__, own))
        return out

    def _learned(self, pieces: Iterable[str]) -> Mapping[str, bytes]:
        """Ids by piece for these distinct pieces at least."""
        known, old = self._young, self._old
        new = [piece for piece in pieces if piece not in known]
        missing = [piece for piece in new if piece not in old] if old else new
        if len(missing) < len(new):
            known.update((piece, old[piece]) for piece in new if piece in old)
        known.update(zip(missing, self._encode(missing, self), strict=True))
        long = {piece: known.pop(piece) for piece in missing if len(piece) > LONGEST_CACHED}
        return ChainMap(known, long) if long else known

    def _near(self, texts: list[str]) -> list[bytes]:
        """The same for texts of the first characters, none empty: cut all at once, each distinct piece looked up once."""
        whole = "".join(texts)
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(text) for text in texts], out=offsets[1:])
        coarse = np.array(["'" in text or "_" in text for text in texts])
        chars, data = np.frombuffer(whole.encode("utf-16-le"), "<u2"), whole.encode()
        begins = _starts(chars, offsets, coarse)
        cuts = np.append(begins, len(chars))
        if len(data) > len(chars):  # some characters take two bytes
            cuts[1:] += np.cumsum(np.add.reduceat(chars >= 0x80, begins, dtype=np.int64))
        pieces = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(cuts), pa.py_buffer(data)]).dictionary_encode()
        distinct, which = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy()
        known = self._learned(distinct)
        blobs = list(map(known.__getitem__, distinct))
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) >> 2
        places, sizes = (np.cumsum(sizes) - sizes)[which], sizes[which]
        until = np.cumsum(sizes)
        ids = np.frombuffer(b"".join(blobs), "<u4")[np.arange(until[-1]) + np.repeat(places - until + sizes, sizes)].tobytes()
        ends = [*(4 * (until - sizes)[np.searchsorted(begins, offsets[:-1])]).tolist(), len(ids)]
        return [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]
