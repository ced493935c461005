"""Quality rules with a line labelling: a linear-chain conditional random field marks content and boilerplate.

Every line with a word is a step of a chain; its observations are some yes/no statements about it. Weights of the
observations and of the four transitions are learned by conditional likelihood (forward and backward sums), from
at most ``SAMPLE`` documents: lines of documents labelled good count as content, lines of bad ones as boilerplate. All lines
of these documents are taken; a document that would bring the sample above ``SAMPLED_LINES`` is left out whole.
Viterbi decoding labels all lines of a document together, and a document is kept when lines marked as
content hold at least ``CONTENT_SHARE`` of its words.

Before that come fixed rules: too few words, or too many words in repeated runs of five. A NULL text is an empty one;
it has no words and is not kept. Repeated rows get equal results. Of equally probable label sequences the one that has the larger sum
in floating point is taken, then boilerplate; equal texts are always labelled alike. Without labels all weights are zero and every line
counts as content. Other columns stay; columns named like results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.arrays import RollingHash, Texts, text_slices, words
from tiermill.llm.textstats import CLASSES, SIGNS, class_counts, equal_to_earlier, lines, per_range, repeated_words
from tiermill.llm.workers import ship
from tiermill.sources.scratch import materialize

SAMPLE = 6_000
SAMPLED_LINES = 400_000
STEPS = 80
CONTENT_SHARE = 0.5
REPEATED_RUN = 5
FEWEST_WORDS = 10
MOST_REPEATED_PERCENT = 20

OBSERVATIONS = (
    "any", "one_word", "up_to_3_words", "up_to_8_words", "over_40_words", "ends_in_stop", "ends_in_comma", "ends_in_sign",
    "some_sign", "many_signs", "a_bar", "many_bars", "many_shouts", "mostly_upper", "begins_upper", "a_digit", "many_digits",
    "quotes", "links", "equal_earlier", "long_words", "short_words",
)


@dataclass
class LineRows:
    """Lines with a word of a slice: observations, words of each, and the text each belongs to."""

    seen: np.ndarray
    n_words: np.ndarray
    owner: np.ndarray
    again: np.ndarray


def line_rows(texts: Texts) -> LineRows:
    found, own = words(texts), lines(texts)
    first_word = np.searchsorted(found.starts, own.starts)
    count = np.searchsorted(found.starts, own.ends) - first_word
    use = count > 0
    starts, ends, n_words, owner = own.starts[use], own.ends[use], count[use], own.owners()[use]
    if not len(starts):
        return LineRows(np.zeros((0, len(OBSERVATIONS))), n_words, owner, np.zeros(0, bool))
    again = equal_to_earlier(RollingHash(texts.data).spans(starts, ends), owner)
    edges = np.ravel(np.column_stack([starts, ends]))
    # every second range is a line; what lies between is dropped
    counts = class_counts(texts, np.append(edges, len(texts.data)))[::2].astype(float)
    of = lambda *names: sum(counts[:, CLASSES.index(name)] for name in names)
    size = counts.sum(1) - of("rest")
    letters = of("upper", "lower", "lead")
    last = texts.data[found.ends[first_word[use] + n_words - 1] - 1]
    begins = texts.data[found.starts[first_word[use]]]
    mean = (size - of("space")) / n_words
    columns = (
        np.ones(len(starts)), n_words == 1, n_words <= 3, n_words <= 8, n_words > 40, np.isin(last, [46, 63]), last == 44,
        np.isin(last, list(b"#*$%&|<>!")), of("sign") > 0, of("sign") > 0.05 * size, of("bar") > 0, of("bar") > 0.2 * n_words,
        of("shout") > 0.1 * n_words, (of("upper") > 0.6 * letters) & (letters > 3), (begins >= 65) & (begins <= 90) | (begins >= 0xC0),
        of("digit") > 0, of("digit") > 0.1 * size, of("quote") > 0.5 * n_words, of("link") > 0.2 * n_words, again, mean > 9, mean < 3,
    )
    return LineRows(np.column_stack(columns).astype(float), n_words, owner, again)


@dataclass
class Chain:
    """Weights of observations for boilerplate (0) and content (1), of transitions and of the first label."""

    seen: np.ndarray
    move: np.ndarray
    first: np.ndarray

    @classmethod
    def empty(cls) -> Chain:
        return cls(np.zeros((len(OBSERVATIONS), 2)), np.zeros((2, 2)), np.zeros(2))


class Batch:
    """Chains side by side, longest first, so that step ``t`` is an array operation over those that reach it."""

    def __init__(self, owner: np.ndarray):
        _, self.first, sizes = np.unique(owner, return_index=True, return_counts=True)
        order = np.argsort(-sizes, kind="stable")
        self.first, self.sizes = self.first[order], sizes[order]
        reach = np.searchsorted(-self.sizes, -np.arange(1, self.sizes.max(initial=0) + 1), "right")
        self.steps = [self.first[:n] + t for t, n in enumerate(reach)]


def line_scores(seen: np.ndarray, model: Chain) -> np.ndarray:
    """Weights of each line, added in one order, so that equal lines have equal sums wherever they lie in a slice."""
    out = np.zeros((len(seen), 2))
    for marks, weights in zip(seen.T, model.seen, strict=True):
        out += marks[:, None] * weights
    return out


def viterbi(scores: np.ndarray, model: Chain, owner: np.ndarray) -> np.ndarray:
    """The most probable labels of all lines; ``owner`` is ascending."""
    batch = Batch(owner)
    labels = np.zeros(len(scores), np.int64)
    if not batch.steps:
        return labels
    best = scores[batch.steps[0]] + model.first
    back = np.zeros((len(scores), 2), np.int8)
    last = best.copy()
    for rows in batch.steps[1:]:
        step = best[: len(rows), :, None] + model.move
        back[rows] = step.argmax(1)
        best = step.max(1) + scores[rows]
        last[: len(rows)] = best
    state = np.zeros(len(last), np.int64)
    for t in range(len(batch.steps) - 1, -1, -1):
        rows = batch.steps[t]
        ends = batch.sizes[: len(rows)] == t + 1
        state[: len(rows)][ends] = last[: len(rows)][ends].argmax(1)
        labels[rows] = state[: len(rows)]
        if t:
            state[: len(rows)] = back[rows, state[: len(rows)]]
    return labels


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def fit(seen: np.ndarray, owner: np.ndarray, labels: np.ndarray, steps: int = STEPS, rate: float = 0.1, decay: float = 1e-3) -> Chain:
    """Weights of largest conditional likelihood, by gradient steps of adapted size."""
    model = Chain.empty()
    if len(np.unique(labels)) < 2:
        return model
    batch, n = Batch(owner), len(owner)
    moment = [np.zeros_like(w) for w in (model.seen, model.move, model.first)]
    square = [np.zeros_like(w) for w in moment]
    one = np.eye(2)[labels]
    same = owner[1:] == owner[:-1]
    moves = np.zeros((2, 2))
    np.add.at(moves, (labels[:-1][same], labels[1:][same]), 1)
    starts = one[batch.first].sum(0)
    for step in range(1, steps + 1):
        scores = seen @ model.seen
        ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[batch.steps[0]] = scores[batch.steps[0]] + model.first
        for rows in batch.steps[1:]:
            ahead[rows] = _log_sum(ahead[rows - 1][:, :, None] + model.move, 1) + scores[rows]
        for rows in batch.steps[:0:-1]:
            behind[rows - 1] = _log_sum(model.move + (behind[rows] + scores[rows])[:, None, :], 2)
        ends = batch.first + batch.sizes - 1
        total = np.zeros(n)
        total[batch.first] = _log_sum(ahead[ends], 1)
        total = np.repeat(total[np.sort(batch.first)], np.diff(np.append(np.sort(batch.first), n)))
        chance = np.exp(ahead + behind - total[:, None])
        later = np.flatnonzero(same) + 1
        pair = ahead[later - 1][:, :, None] + model.move + (scores[later] + behind[later])[:, None, :] - total[later][:, None, None]
        slopes = (
            seen.T @ (one - chance) / n - decay * model.seen,
            (moves - np.exp(pair).sum(0)) / n - decay * model.move,
            (starts - chance[batch.first].sum(0)) / n - decay * model.first,
        )
        for i, weight in enumerate((model.seen, model.move, model.first)):
            moment[i] = 0.9 * moment[i] + 0.1 * slopes[i]
            square[i] = 0.99 * square[i] + 0.01 * slopes[i] ** 2
            weight += rate * (moment[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-8)
    return model


def learn(documents: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", sample: int = SAMPLE) -> Chain:
    """Weights from all lines of labelled documents (at most about ``sample``, and ``SAMPLED_LINES`` lines of whole documents)."""
    ship(documents.sparkSession)
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    usable = usable.groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    there = usable.groupBy("label").count().toPandas().set_index("label")["count"].to_dict()
    share = F.lit(0)
    for value, count in there.items():  # as many of either label
        share = F.when(F.col("label") == value, int(min(1, sample / 2 / count) * (1 << 20))).otherwise(share)
    usable = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per document; the observations of a line are the bits of a number."""
        bits = 1 << np.arange(len(OBSERVATIONS), dtype=np.int64)
        for batch in batches:
            for part in text_slices(batch.column(2)):
                found = line_rows(part)
                starts = np.searchsorted(found.owner, np.arange(len(part) + 1)).astype(np.int32)
                seen = pa.ListArray.from_arrays(pa.array(starts), pa.array((found.seen.astype(np.int64) @ bits).astype(np.int32)))
                own = [batch.column(i).slice(part.first, len(part)) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(starts)), seen], ["doc_id", "label", "n", "seen"])

    known = documents.select(F.col(doc_id).alias("doc_id"), "text").join(F.broadcast(usable), "doc_id")
    known = known.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # of several texts with one id the smallest
    taught = known.select("doc_id", "label", "text").mapInArrow(rows, "doc_id long, label int, n int, seen array<int>")
    taught = materialize(taught.filter("n > 0"), "lines").df
    order = F.xxhash64("doc_id", F.lit(1))
    sizes = taught.select("doc_id", "n").orderBy(order, "doc_id").toPandas()
    chosen, left = [], SAMPLED_LINES
    for doc, n in zip(sizes["doc_id"].tolist(), sizes["n"].tolist(), strict=True):
        if n <= left:
            chosen.append((doc,))
            left -= n
    if len(chosen) < len(sizes):
        taught = taught.join(F.broadcast(documents.sparkSession.createDataFrame(chosen, "doc_id long")), "doc_id", "left_semi")
    pdf = taught.select("doc_id", "label", "n", "seen").toPandas().sort_values("doc_id", kind="stable")
    marks = np.concatenate([np.zeros(0, np.int64), *pdf["seen"]]).astype(np.int64)
    seen = (marks[:, None] >> np.arange(len(OBSERVATIONS)) & 1).astype(float)
    n = pdf["n"].to_numpy(np.int64)
    return fit(seen, np.repeat(np.arange(len(n)), n), np.repeat(pdf["label"].to_numpy(np.int64), n))


#: What ``judge`` adds; ``n_content_words`` counts words of lines marked as content.
RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_content_lines long,"
    " n_content_words long, base_failed boolean, kept boolean"
)


def _judge(texts: Texts, model: Chain) -> list[np.ndarray]:
    n = len(texts)
    found, own = words(texts), line_rows(texts)
    n_words = np.diff(found.offsets)
    points = (texts.data & 0xC0) != 0x80
    inside = np.zeros(len(texts.data) + 1, np.int64)
    inside[found.starts] += 1
    np.add.at(inside, found.ends, -1)
    in_words = np.cumsum(inside[:-1]) > 0
    hashes = RollingHash(texts.data).spans(found.starts, found.ends)
    repeated = np.bincount(found.owners(), repeated_words(found, hashes, REPEATED_RUN), n).astype(np.int64)
    content = viterbi(line_scores(own.seen, model), model, own.owner) == 1 if model.seen.any() else np.ones(len(own.owner), bool)
    per_text = lambda values: np.bincount(own.owner, values, n).astype(np.int64)
    content_words = per_text(own.n_words * content)
    failed = (n_words < FEWEST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n_words)
    return [
        n_words, per_range(points & in_words, texts.offsets), per_range(SIGNS[texts.data], texts.offsets), per_text(own.again), repeated,
        per_text(np.ones(len(own.owner))), per_text(content), content_words, failed, ~failed & (content_words >= CONTENT_SHARE * n_words),
    ]


def judge(df: DataFrame, model: Chain, text: str = "text") -> DataFrame:
    """Add counts, ``base_failed`` and ``kept`` for each text."""
    ship(df.sparkSession)
    names = [field.split()[0] for field in RESULT.split(",")]

    @F.arrow_udf(f"struct<{RESULT.replace(' long', ':long').replace(' boolean', ':boolean')}>")
    def judged(texts: pa.Array) -> pa.Array:
        parts = [_judge(part, model) for part in text_slices(texts)]
        kinds = [pa.bool_() if name in ("base_failed", "kept") else pa.int64() for name in names]
        columns = [
            pa.array(np.concatenate([part[i] for part in parts]) if parts else [], kind) for i, kind in enumerate(kinds)
        ]
        return pa.StructArray.from_arrays(columns, names)

    return df.withColumn("__judged", judged(F.col(text))).withColumns({n: F.col(f"__judged.{n}") for n in names}).drop("__judged")
