"""Statistics of documents and of their lines, for a slice of texts at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tiermill.llm.arrays import RollingHash, Texts, Words, mix, words

# Classes of bytes. 0 is for all other ASCII characters.
_GROUPS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c",
    "newline": b"\n",
    "stop": b".",
    "comma": b",;:",
    "shout": b"!",
    "ask": b"?",
    "bar": b"|",
    "sign": b"#*$%&<>",
    "quote": b"\"'()[]{}",
    "link": b"@/\\_=+-",
}
CLASSES = ("other", *_GROUPS, "lead", "rest")
_CLASS = np.zeros(256, np.int64)
for _number, _members in enumerate(_GROUPS.values(), 1):
    _CLASS[list(_members)] = _number
_CLASS[0xC0:] = len(_GROUPS) + 1
_CLASS[0x80:0xC0] = len(_GROUPS) + 2

SIGNS = np.zeros(256, bool)
SIGNS[list(b"#*$%&|<>")] = True


def class_counts(texts: Texts, offsets: np.ndarray) -> np.ndarray:
    """Bytes of each class in the ranges between consecutive ``offsets``."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    cells = owner * len(CLASSES) + _CLASS[texts.data[offsets[0] : offsets[-1]]]
    return np.bincount(cells, minlength=(len(offsets) - 1) * len(CLASSES)).reshape(-1, len(CLASSES))


def per_range(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


@dataclass
class Lines:
    """Lines of a slice: byte ranges without the line feed, and for each text the number of its first line."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def lines(texts: Texts) -> Lines:
    """Every text has one line more than line feeds."""
    feeds = np.flatnonzero(texts.data == 10)
    starts = np.sort(np.concatenate([texts.offsets[:-1], feeds + 1]), kind="stable")
    ends = np.sort(np.concatenate([texts.offsets[1:], feeds]), kind="stable")
    per_text = np.searchsorted(feeds, texts.offsets[1:]) - np.searchsorted(feeds, texts.offsets[:-1]) + 1
    return Lines(starts, ends, np.concatenate([[0], np.cumsum(per_text)]))


def equal_to_earlier(keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Marks keys that occurred before with the same owner."""
    order = np.lexsort((keys, owners))
    same = (keys[order][1:] == keys[order][:-1]) & (owners[order][1:] == owners[order][:-1])
    marked = np.zeros(len(keys), bool)
    marked[order[1:][same]] = True
    return marked


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of ``size`` words, by the first; the last ``size - 1`` places are missing."""
    count = max(0, len(hashes) - size + 1)
    out = np.zeros(count, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes[i : i + count]
    return mix(out)


def whole_grams(found: Words, size: int) -> np.ndarray:
    """Which runs of ``size`` words lie within one text."""
    count = max(0, len(found.starts) - size + 1)
    owner = found.owners()
    return owner[:count] == owner[size - 1 : size - 1 + count]


def repeated_words(found: Words, hashes: np.ndarray, size: int) -> np.ndarray:
    """Marks words that lie in a run of ``size`` words found twice or more in their text."""
    marked = np.zeros(len(hashes) + 1, np.int64)
    keys, whole = grams(hashes, size), whole_grams(found, size)
    places = np.flatnonzero(whole)
    if len(places):
        keys, owner = keys[places], found.owners()[places]
        order = np.lexsort((keys, owner))
        keys, owner = keys[order], owner[order]
        same = (keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1])
        twice = np.zeros(len(keys), bool)
        twice[1:] |= same
        twice[:-1] |= same
        at = places[order[twice]]
        np.add.at(marked, at, 1)
        np.add.at(marked, at + size, -1)
    return np.cumsum(marked)[:-1] > 0


FEATURES = (
    "log_bytes", "log_words", "word_bytes", "word_spread", "distinct_words", "upper_words", "signed_words", "barred",
    "plain_words", "words_per_line", "double_lines", "double_pairs", "longest_word", "short_words",
    *(f"share_{name}" for name in CLASSES),
)


def document_features(texts: Texts) -> np.ndarray:
    """One row of ``FEATURES`` per text; shares of an empty text are 0."""
    n = len(texts)
    found = words(texts)
    rolling = RollingHash(texts.data)
    hashes = rolling.spans(found.starts, found.ends)
    owner = found.owners()
    counts = class_counts(texts, texts.offsets).astype(float)
    size = np.diff(texts.offsets).astype(float)
    n_words = np.diff(found.offsets).astype(float)
    some_words, some_bytes = np.maximum(n_words, 1), np.maximum(size, 1)
    lengths = (found.ends - found.starts).astype(float)
    total = np.bincount(owner, lengths, n)
    square = np.bincount(owner, lengths**2, n)
    mean = total / some_words
    per_word = class_counts(texts, np.concatenate([found.starts, [len(texts.data)]])) if len(lengths) else np.zeros((0, len(CLASSES)))
    has = lambda *names: sum(per_word[:, CLASSES.index(name)] for name in names)
    upper, letters = has("upper"), has("upper", "lower", "lead")
    of_words = lambda marked: np.bincount(owner, marked, n) / some_words
    pairs, whole = grams(hashes, 2), whole_grams(found, 2)
    double = np.zeros(len(hashes), bool)
    double[np.flatnonzero(whole)] = equal_to_earlier(pairs[whole], owner[: len(pairs)][whole])
    own = lines(texts)
    line_hashes = rolling.spans(own.starts, own.ends)
    full = own.ends > own.starts
    again = equal_to_earlier(line_hashes, own.owners()) & full
    n_lines = np.maximum(np.bincount(own.owners(), full, n), 1)
    longest = np.zeros(n)
    np.maximum.at(longest, owner, lengths)
    first = ~equal_to_earlier(hashes, owner)
    columns = [
        np.log1p(size), np.log1p(n_words), mean, np.sqrt(np.maximum(square / some_words - mean**2, 0)), of_words(first),
        of_words((upper >= 2) & (upper == letters)), of_words(has("sign") > 0), of_words(has("bar") > 0),
        of_words(letters == lengths - has("rest", "space", "newline")), n_words / n_lines,
        np.bincount(own.owners(), again, n) / n_lines, of_words(double), np.log1p(longest), of_words(lengths <= 3),
    ]
    return np.column_stack([*columns, counts / some_bytes[:, None]])
