"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def kneser_ney(train, texts, discounts, order=3):
    """Per text: tokens, known tokens, base score, score."""
    tokens = lambda text: [*WORD.findall(lower(text)), "</s>"]

    def runs(own):
        padded = ["<s>"] * (order - 1) + own
        return [tuple(padded[i : i + order]) for i in range(len(own))]

    words, counts = Counter(), {m: Counter() for m in range(1, order + 1)}
    for text in train:
        words.update(tokens(text))
        counts[order].update(runs(tokens(text)))
    for m in range(order, 1, -1):
        counts[m - 1].update(run[1:] for run in counts[m])
    total, kinds = sum(words.values()), len(words)
    d = {m: discounts(tuple(sum(v == i for v in own.values()) for i in range(1, 5))) for m, own in counts.items()}
    after = defaultdict(lambda: [0, 0, 0, 0])
    for own in counts.values():
        for run, count in own.items():
            after[run[:-1]][0] += count
            after[run[:-1]][min(count, 3)] += 1

    def chance(run):
        shorter = chance(run[1:]) if len(run) > 1 else 1 / (kinds + 1)
        if run[:-1] not in after:
            return shorter
        off, (n, *seen), count = d[len(run)], after[run[:-1]], counts[len(run)][run]
        left = max(count - off[min(count, 3) - 1], 0) if count else 0
        return left / n + sum(x * y for x, y in zip(off, seen, strict=True)) / n * shorter

    out = []
    for text in texts:
        own = tokens(text)
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        out.append((len(own), sum(words[w] > 0 for w in own), base, sum(math.log10(chance(run)) for run in runs(own))))
    return out


def repeats(rows, length=50):
    """Per row (doc_id, text): doc_id, bytes, removed bytes, runs, hash of the rest."""
    rank = lambda doc: (doc is not None, doc or 0)
    first = {}
    for doc, text in sorted(rows, key=lambda row: rank(row[0])):
        data = (text or "").encode()
        for at in range(len(data) - length + 1):
            first.setdefault(data[at : at + length], rank(doc))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if first[data[at : at + length]] < rank(doc):
                gone[at : at + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), runs, sha(bytes(c for c, g in zip(data, gone, strict=True) if not g))))
    return sorted(out, key=str)


def line_counts(text):
    """Words, their characters, symbols, lines equal to an earlier one, words in repeated runs of five."""
    words = WORD.findall(text or "")
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(repeated)]


def line_observations(text):
    """Per line with a word: yes/no statements and number of words."""
    groups = {"upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "sign": "#*$%&<>", "bar": "|", "quote": "\"'()[]{}", "link": "@/\\_=+-"}
    seen, out = set(), []
    for line in (text or "").split("\n"):
        words = WORD.findall(line)
        if not words:
            continue
        n = len(words)
        of = {name: sum(line.count(c) for c in members) for name, members in groups.items()}
        letters = sum("a" <= c.lower() <= "z" and c.isascii() or ord(c) > 127 for c in line)
        last, begins = words[-1][-1], words[0][0]
        mean = sum(c not in " \t\r\x0b\x0c" for c in line) / n
        told = (
            True, n == 1, n <= 3, n <= 8, n > 40, last in ".?", last == ",", last in "#*$%&|<>!", of["sign"] > 0, of["sign"] > 0.05 * len(line),
            of["bar"] > 0, of["bar"] > 0.2 * n, line.count("!") > 0.1 * n, of["upper"] > 0.6 * letters and letters > 3,
            "A" <= begins <= "Z" or ord(begins) > 127, of["digit"] > 0, of["digit"] > 0.1 * len(line), of["quote"] > 0.5 * n,
            of["link"] > 0.2 * n, line in seen, mean > 9, mean < 3,
        )
        seen.add(line)
        out.append((told, n))
    return out


def content_lines(text, model):
    """Lines, and what the best paths through all lines give: lines marked as content and their words. Paths that differ by rounding are equal."""
    told, paths = line_observations(text), {}
    for i, (marks, n) in enumerate(told):
        own = [sum(model.seen[k][label] for k, mark in enumerate(marks) if mark) for label in (0, 1)]
        now = {}
        for b in (0, 1):
            steps = [(paths[a][0] + model.move[a][b], paths[a][1]) for a in (0, 1)] if i else [(model.first[b], {(0, 0)})]
            top = max(value for value, _ in steps)
            now[b] = top + own[b], {(c + b, w + b * n) for value, found in steps if value > top - 1e-9 for c, w in found}
        paths = now
    top = max((value for value, _ in paths.values()), default=0)
    return len(told), set().union(*(found for value, found in paths.values() if value > top - 1e-9)) or {(0, 0)}


def near_copies(rows, shingle=3, percent=90):
    """Per document: shingles and the smallest document reachable by links."""
    sets = {}
    for doc, text in rows:
        words = WORD.findall(lower(text))
        sets[doc] = {tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()
    parent = {doc: doc for doc in sets}

    def root(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    holders = defaultdict(list)
    for doc, own in sets.items():
        for shingle in own:
            holders[shingle].append(doc)
    shared = Counter(pair for docs in holders.values() for pair in itertools.combinations(sorted(docs), 2))
    for (a, b), count in shared.items():
        if 100 * count >= percent * (len(sets[a]) + len(sets[b]) - count):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {doc: (len(own), root(doc)) for doc, own in sets.items()}


def turn_digests(rows):
    """Per conversation: turns, their hash, learned characters, their hash."""
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in said.items():
        turns.sort()
        learned = "".join(text for *_, role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        out[conv] = (len(turns), sha(whole), len(learned), sha(learned))
    return out


def overlap(document, item, rules):
    """Equal words, words and first word of the largest overlap of a document and an item, both lists of words; ``rules`` has the constants."""
    masks = list(rules.MASKS) if len(item) >= 8 else []
    masks += rules.whole_masks(len(item)) if 0 < len(item) < rules.FEWEST else []

    def reach(same):
        score = best = top = 0
        for i, equal in enumerate(same, 1):
            score += 1 if equal else -rules.MISMATCH
            if best - score >= rules.DROP:
                break
            if score > best:
                best, top = score, i
        return top

    found = []
    for start in range(1 - len(item), len(document)):
        low, high = max(0, start), min(len(document), start + len(item))
        same = [document[k] == item[k - start] for k in range(low, high)]
        hits = {k for mask in masks for k in range(len(same) - len(mask) + 1) if all(same[k + i] for i, c in enumerate(mask) if c == "1")}
        done = -1
        for hit in sorted(hits):
            if done > hit:
                continue
            first, done = hit - reach(same[:hit][::-1]), hit + reach(same[hit:])
            last = done
            if len(same) == len(item) and 100 * sum(same) >= rules.EQUAL_PERCENT * len(item):
                first, last, done = 0, len(item), len(item)
            if last - first >= min(rules.FEWEST, len(item)) and 100 * sum(same[first:last]) >= rules.EQUAL_PERCENT * (last - first):
                found.append((sum(same[first:last]), -(low + first), last - first))
    if not found:
        return None
    equal, first, size = max(found, key=lambda x: x[:2])
    return equal, size, -first
