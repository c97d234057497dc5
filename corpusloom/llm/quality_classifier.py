"""A supervised subword embedding classifier, trained by numpy gradient descent.

A document is the average of learned vectors of its hashed words and character
n-grams; a softmax layer gives the class. As the layer is linear, a document's logit
is the average of one number per hash bucket, which is all that scoring needs.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    LOWER_ASCII,
    byte_values,
    mix64,
    span_hashes,
    text_blocks,
    window_hashes,
    word_spans,
)

BUCKET_BITS = 16
DIMENSIONS = 16
#: Lengths of the character n-grams, taken on the bytes of the lower-cased text.
NGRAMS = (3, 5)
EPOCHS = 6
LEARNING_RATE = 0.6
#: Most labelled rows that the classifier learns from: those with the smallest id hashes.
TRAINING_ROWS = 4000


def _buckets(hashes: np.ndarray, seed: int) -> np.ndarray:
    return (mix64(hashes + np.uint64(seed)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def feature_groups(data: np.ndarray, offsets: np.ndarray):
    """Buckets of each kind of feature, and where each document's begin and end.

    Kinds are words, pairs of successive words and n-grams of each length. No
    feature crosses the end of a document.
    """
    data = LOWER_ASCII[data]
    starts, ends, first = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    yield _buckets(words, 1), first[:-1], first[1:]
    yield _buckets(window_hashes(words, 2), 2), first[:-1], np.maximum(first[1:] - 1, first[:-1])
    values = byte_values(data)
    for n in NGRAMS:
        last = np.maximum(offsets[1:] - n + 1, offsets[:-1])
        yield _buckets(window_hashes(values, n), 10 + n), offsets[:-1], last


def document_features(data: np.ndarray, offsets: np.ndarray):
    """Per document its different buckets and their weights, which sum to 1 at most."""
    groups = list(feature_groups(data, offsets))
    for row in range(len(offsets) - 1):
        total = np.zeros(1 << BUCKET_BITS, np.float32)
        for buckets, first, last in groups:
            found = buckets[first[row] : last[row]]
            if len(found):
                counts = np.bincount(found, minlength=len(total))
                total += (counts / (len(found) * len(groups))).astype(np.float32)
        used = np.flatnonzero(total)
        yield used.astype(np.int32), total[used]


@dataclass
class Model:
    """One score per bucket and a bias: the logit of class 1 against class 0."""

    bucket_scores: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each text."""
        logits = np.full(len(offsets) - 1, self.bias)
        groups = list(feature_groups(data, offsets))
        for buckets, first, last in groups:
            sums = np.concatenate(([0.0], np.cumsum(self.bucket_scores[buckets])))
            top = len(buckets)
            first, last = np.minimum(first, top), np.minimum(last, top)
            logits += (sums[last] - sums[first]) / np.maximum(last - first, 1) / len(groups)
        return 1.0 / (1.0 + np.exp(-np.clip(logits, -60, 60)))


def train(
    examples: list[tuple[np.ndarray, np.ndarray, int]],
    epochs: int = EPOCHS,
    rate: float = LEARNING_RATE,
    seed: int = 0,
) -> Model:
    """Stochastic gradient descent over (buckets, weights, class) examples.

    Classes are weighted to equal shares. Without examples the model answers 0.5.
    """
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSIONS)) / DIMENSIONS
    vectors = vectors.astype(np.float32)
    layer = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.zeros(2, np.float32)
    labels = np.array([label for _, _, label in examples], dtype=int)
    shares = np.bincount(labels, minlength=2) / max(1, len(labels))
    weight = 0.5 / np.maximum(shares, 0.05)
    steps, step = epochs * len(examples), 0
    for _ in range(epochs):
        for at in random.permutation(len(examples)):
            buckets, weights, label = examples[at]
            speed = np.float32(rate * (1 - step / steps) * weight[label])
            step += 1
            rows = vectors[buckets]
            mean = weights @ rows
            logits = mean @ layer + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[label] -= 1
            back = layer @ error
            layer -= speed * np.outer(mean, error)
            bias -= speed * error
            # Weights of a document are small and many: scaled to their largest.
            scale = weights / weights.max() if len(weights) else weights
            vectors[buckets] = rows - speed * scale[:, None] * back[None, :]
    return Model(vectors.astype(np.float64) @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def training_examples(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "label",
    max_rows: int = TRAINING_ROWS,
) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Hashed features of at most ``max_rows`` labelled documents.

    ``labels`` has ``id_col`` and ``label_col`` (0 or 1; null rows are left out). The
    features of one document are bounded by the number of buckets.
    """
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_rows)
    )
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(
        F.broadcast(chosen), "_id"
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = batch.column("_id"), batch.column("label")
            for row, data, offsets in text_blocks(batch, "text"):
                found = list(document_features(data, offsets))
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, n),
                        labels.slice(row, n),
                        pa.array([buckets.tobytes() for buckets, _ in found], pa.binary()),
                        pa.array([weights.tobytes() for _, weights in found], pa.binary()),
                    ],
                    names=["id", "label", "buckets", "weights"],
                )

    kind = dict(rows.dtypes)["_id"]
    schema = f"id {kind}, label int, buckets binary, weights binary"
    found = rows.select("_id", "text", "label").mapInArrow(features, schema)
    examples = [
        (row["id"], row["buckets"], row["weights"], row["label"]) for row in found.toLocalIterator()
    ]
    # The order of arrival is that of the tasks; training must not depend on it.
    return [
        (np.frombuffer(buckets, np.int32), np.frombuffer(weights, np.float32), label)
        for _, buckets, weights, label in sorted(examples)
    ]


def score_documents(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col`` and ``score`` of every row, without a shuffle.

    A null text scores as an empty one. The broadcast holds one number per bucket.
    """
    kind = dict(docs.dtypes)[id_col]
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_blocks(batch, "text"):
                scores = np.round(shipped.value.scores(data, offsets), 6)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(row, len(scores)), pa.array(scores)],
                    names=[id_col, "score"],
                )

    columns = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return columns.mapInArrow(score, f"`{id_col}` {kind}, score double")
