"""Document quality by histogram gradient-boosted trees.

Documents become rows of statistics (``textstats.FEATURES``), each cut into at most 64 bins. Trees are grown level
by level from histograms of gradients, with the logistic loss, and flattened into arrays: a level of all documents is
one array operation. Learning takes at most ``SAMPLE`` labelled documents, picked by a hash of the id; scoring
covers every document.

NULL and empty texts have the statistics of an empty text and are scored like any other. Labels other than 0 and 1 and
rows without an id teach nothing; of several labels of one document the largest counts. Without any labels the
score is 0.5. Repeated rows get equal scores; other columns stay as they are, a column named like the score is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.arrays import text_slices
from tiermill.llm.textstats import FEATURES, document_features
from tiermill.llm.workers import ship

SAMPLE = 40_000
BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.2
SMOOTHING = 5.0
KEEP_FROM = 0.3


@dataclass
class Trees:
    """All trees in flat arrays; node ``i`` of a tree goes on to ``2 i + 1`` or ``2 i + 2``."""

    cuts: list[np.ndarray]
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    base: float

    def binned(self, rows: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(cut, rows[:, i]) for i, cut in enumerate(self.cuts)])

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not len(rows):
            return np.zeros(0)
        if not len(self.feature):
            return np.full(len(rows), 1 / (1 + np.exp(-self.base)))
        cells = self.binned(rows)
        total = np.full(len(rows), self.base)
        each = np.arange(len(rows))
        for feature, cut, value in zip(self.feature, self.bin, self.value, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (cells[each, feature[node]] > cut[node])
            total += value[node]
        return 1 / (1 + np.exp(-total))


def grow(rows: np.ndarray, labels: np.ndarray, trees: int = TREES) -> Trees:
    """Fit trees to rows of features and labels 0 or 1."""
    share = np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3)
    model = Trees([], np.zeros((0, 0), np.int64), np.zeros((0, 0), np.int64), np.zeros((0, 0)), float(np.log(share / (1 - share))))
    if len(np.unique(labels)) < 2:
        return model
    model.cuts = [np.unique(np.quantile(rows[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(rows.shape[1])]
    cells = model.binned(rows)
    n, width = cells.shape
    inner, nodes = 2**DEPTH - 1, 2 ** (DEPTH + 1) - 1
    total = np.full(n, model.base)
    kept = []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, curve = labels - chance, chance * (1 - chance)
        feature, cut, value = np.zeros(nodes, np.int64), np.full(nodes, BINS, np.int64), np.zeros(nodes)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, wide = 2**level - 1, 2**level
            place = (node - first) * BINS
            best = np.full(wide, 1e-3)
            for f in range(width):
                at = place + cells[:, f]
                g = np.bincount(at, slope, wide * BINS).reshape(wide, BINS).cumsum(1)
                h = np.bincount(at, curve, wide * BINS).reshape(wide, BINS).cumsum(1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + SMOOTHING) + (all_g - g) ** 2 / (all_h - h + SMOOTHING) - all_g**2 / (all_h + SMOOTHING)
                gain[(h < 1) | (all_h - h < 1)] = 0
                where = gain.argmax(1)
                gains = gain[np.arange(wide), where]
                better = gains > best
                best[better] = gains[better]
                feature[first : first + wide][better] = f
                cut[first : first + wide][better] = where[better]
            node = 2 * node + 1 + (cells[np.arange(n), feature[node]] > cut[node])
        g, h = np.bincount(node, slope, nodes), np.bincount(node, curve, nodes)
        value[inner:] = (RATE * g / (h + SMOOTHING))[inner:]
        total += value[node]
        kept.append((feature, cut, value))
    model.feature, model.bin, model.value = (np.array(x) for x in zip(*kept, strict=True))
    return model


def feature_table(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and the statistics of each text as one array."""
    ship(df.sparkSession)

    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        rows = [document_features(part) for part in text_slices(texts)]
        flat = np.concatenate(rows).ravel() if rows else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * len(FEATURES)), pa.array(flat))

    return df.select(*keep, features(F.col(text)).alias("features"))


def learn(documents: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", sample: int = SAMPLE) -> Trees:
    """Trees from labelled documents; of more than ``sample`` labels a part is picked by a hash of the id."""
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    usable = usable.groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    there = usable.count()
    if there > sample:
        part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(sample / there * (1 << 20))
        usable = usable.filter(part)
    # no more than about ``sample`` short rows; of several texts with one id the smallest counts
    known = documents.select(F.col(doc_id).alias("doc_id"), "text").join(F.broadcast(usable), "doc_id")
    known = known.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = feature_table(known, keep=("doc_id", "label")).orderBy("doc_id").toPandas()
    features = np.array(rows["features"].tolist(), float).reshape(len(rows), len(FEATURES))
    return grow(features, rows["label"].to_numpy(float))


def score(df: DataFrame, model: Trees, text: str = "text", name: str = "score") -> DataFrame:
    """Add the score of each text, between 0 and 1."""
    ship(df.sparkSession)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [model.score(document_features(part)) for part in text_slices(texts)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return df.withColumn(name, scored(F.col(text)))

