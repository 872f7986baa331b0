"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics come from the text alone.  The trees are fitted on a bounded sample
of labelled rows, and flattened into arrays: all trees are complete binary trees of
one depth, so scoring is a few numpy gathers over documents x trees.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import raw_texts, text_slices
from seriesloom.llm.quality_rules import CLASSES, class_counts

MARKS = [b"!", b"|", b".", b",", b"?"]
STATISTICS = [
    "log_words", "log_chars", "mean_word", "distinct_words", "top_word", "distinct_pairs", "repeated_next",
    "words_per_line", "repeated_lines", *(f"share_{name}" for name in CLASSES), *(f"marks_{mark.decode()}" for mark in MARKS),
]


@dataclass(frozen=True)
class Settings:
    """Parameters of the fit; ``sample_rows`` bounds the labelled rows that the driver holds."""

    sample_rows: int = 30_000
    trees: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.2
    smoothing: float = 1.0
    min_rows: int = 10


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: inner nodes (trees x 2^depth - 1) and leaves (trees x 2^depth)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of statistics."""
        trees, inner = self.feature.shape
        node = np.zeros((len(rows), trees), dtype=np.int64)
        tree, row = np.arange(trees)[None, :], np.arange(len(rows))[:, None]
        for _ in range((inner + 1).bit_length() - 1 if trees else 0):
            node = 2 * node + 1 + (rows[row, self.feature[tree, node]] > self.threshold[tree, node])
        margin = self.base + self.leaf[tree, node - inner].sum(axis=1) if trees else np.full(len(rows), self.base)
        return 1 / (1 + np.exp(-margin))


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of statistics per text; an empty text has zeros."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for row, text in enumerate(texts):
        words = text.split()
        if not words:
            continue
        n, classes = len(words), class_counts(text)
        chars, counts = int(classes.sum()), Counter(words)
        lines = [line for line in text.split(b"\n") if line.strip()]
        pairs = max(n - 1, 1)
        out[row] = [
            np.log1p(n), np.log1p(chars), (chars - classes[CLASSES.index("space")]) / n, len(counts) / n,
            max(counts.values()) / n, len(set(pairwise(words))) / pairs, sum(a == b for a, b in pairwise(words)) / pairs,
            np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines), *(classes / chars), *(text.count(mark) / n for mark in MARKS),
        ]
    return out


def fit(rows: np.ndarray, labels: np.ndarray, settings: Settings) -> Forest:
    """Boosted trees for the logistic loss, grown level by level on histograms of quantile bins."""
    depth, inner = settings.depth, 2**settings.depth - 1
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    base = float(np.log(share / (1 - share)))
    none = np.zeros((0, inner))
    if not len(labels) or labels.min() == labels.max():
        return Forest(base, none.astype(np.int64), none, np.zeros((0, inner + 1)))
    width = rows.shape[1]
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, settings.bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], rows[:, j], side="left") for j in range(width)], axis=1)
    flat = binned + np.arange(width) * settings.bins
    features, thresholds, leaves = [], [], []
    margin = np.full(len(rows), base)
    for _ in range(settings.trees):
        chance = 1 / (1 + np.exp(-margin))
        slope, bend = chance - labels, chance * (1 - chance)
        node = np.zeros(len(rows), dtype=np.int64)
        feature, cut, threshold = np.zeros(inner, np.int64), np.full(inner, settings.bins), np.full(inner, np.inf)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            place = ((node - first)[:, None] * width * settings.bins + flat).ravel()
            size = many * width * settings.bins
            g, h, c = (
                np.bincount(place, weights=np.repeat(w, width), minlength=size).reshape(many, width, settings.bins)
                for w in (slope, bend, np.ones(len(rows)))
            )
            gl, hl, cl = g.cumsum(axis=2), h.cumsum(axis=2), c.cumsum(axis=2)
            gt, ht, ct = gl[:, :, -1:], hl[:, :, -1:], cl[:, :, -1:]
            gain = gl**2 / (hl + settings.smoothing) + (gt - gl) ** 2 / (ht - hl + settings.smoothing) - gt**2 / (ht + settings.smoothing)
            gain[(cl < settings.min_rows) | (ct - cl < settings.min_rows)] = 0
            best = gain.reshape(many, -1).argmax(axis=1)
            for i in range(many):
                j, b = divmod(int(best[i]), settings.bins)
                if gain[i, j, b] > 1e-9 and b < len(edges[j]):
                    feature[first + i], cut[first + i], threshold[first + i] = j, b, edges[j][b]
            node = 2 * node + 1 + (binned[np.arange(len(rows)), feature[node]] > cut[node])
        at = node - inner
        g, h = np.bincount(at, weights=slope, minlength=inner + 1), np.bincount(at, weights=bend, minlength=inner + 1)
        leaf = -settings.rate * g / (h + settings.smoothing)
        margin = margin + leaf[at]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Forest(base, np.array(features), np.array(thresholds), np.array(leaves))


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text is 1 modulo 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    documents: DataFrame, labels: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> Forest:
    """A forest for the labels of documents that are not held out.

    Documents without a key, label or text do not teach; of a document labelled more than once the smallest label counts, of
    a repeated document each copy.  At most ``sample_rows`` labelled documents, chosen by a hash of their id,
    are used.  Without labels of both kinds every score is the share of label 1, or a half.
    """
    settings = settings or Settings()
    known = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).dropna().where(~held_out(F.col("key")))
    sample = known.groupBy("key").agg(F.min("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(settings.sample_rows)
    texts = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    chosen = texts.join(F.broadcast(sample), "key")  # at most sample_rows narrow rows

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                rows = statistics(raw_texts(part)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("label"), pa.array(rows, pa.list_(pa.float64()))], names=["key", "label", "row"]
                )

    schema = chosen.select("key", "label").schema.add("row", T.ArrayType(T.DoubleType()))
    found = chosen.mapInArrow(measure, schema).orderBy(F.xxhash64("key"), "key", "row").limit(settings.sample_rows).toArrow()
    rows = np.array(found.column("row").to_pylist(), dtype=np.float64).reshape(-1, len(STATISTICS))
    return fit(rows, (found.column("label").to_numpy() > 0).astype(np.float64), settings)


def score(documents: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, held_out, score, predicted for every row; NULL and empty texts are scored as texts without words.

    Repeated rows are scored each, NULL keys stay and are not held out; other columns are not read.
    """
    frame = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), held_out(F.col(key)).alias("held_out"))
    schema = frame.select("key", "held_out").schema.add("score", "double").add("predicted", "integer")
    shipped = documents.sparkSession.sparkContext.broadcast(forest)  # trees x 2^depth numbers

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                scores = shipped.value.scores(statistics(raw_texts(part)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=schema.names
                )

    return frame.mapInArrow(rate, schema).withColumnRenamed("key", key)


def keep_good(documents: DataFrame, forest: Forest, text: str = "text") -> DataFrame:
    """The documents, with all their columns, that the classifier accepts."""
    schema = documents.schema
    shipped = documents.sparkSession.sparkContext.broadcast(forest)
    column = documents.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [f"c{i}" for i in range(batch.num_columns)]
            for part in text_slices(pa.RecordBatch.from_arrays(batch.columns, names=names), names[column]):
                good = shipped.value.scores(statistics(raw_texts(part, names[column]))) >= 0.5
                yield pa.RecordBatch.from_arrays(part.filter(pa.array(good)).columns, names=schema.names)

    return documents.mapInArrow(keep, schema)
