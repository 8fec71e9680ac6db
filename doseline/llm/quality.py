"""Quality classifier: supervised subword embeddings, trained by stochastic gradient descent.

A document is the mean of the learned vectors of its words and of their character n-grams,
all hashed to a fixed number of rows; a softmax over that mean gives the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from doseline.llm.common import struct, text_blocks

BUCKETS = 1 << 16  # of words, and as many of each n-gram length
NGRAMS = (3, 4)
AGAIN = BUCKETS * (1 + len(NGRAMS))  # a word of its own for a word that repeats the one before
ROWS = AGAIN + 1
DIMENSIONS = 8
EPOCHS = 6  # or more, so that few samples get this many steps too
LEAST_STEPS = 6_000
RATE = 20.0
OUTPUT_RATE = np.float32(0.05)
TRAINING_ROWS = 4_000
SEED = 11
FACTOR, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def bucket(h: np.ndarray, table: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * MIX
    return ((h >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64) + table * BUCKETS


def block_features(block: bytes) -> np.ndarray:
    """Rows of every word and n-gram in a block. Words lie between boundaries (zeros), which
    an n-gram may start or end with but not contain."""
    letters = np.frombuffer(block.decode().encode("utf-32-le"), "<u4").astype(np.uint64)
    blank = (letters == 32) | ((letters >= 9) & (letters <= 13))
    letters = np.where(blank, np.uint64(0), letters + np.uint64(1))
    line = np.r_[np.uint64(0), letters, np.uint64(0)]
    line = line[np.r_[True, (line[1:] != 0) | (line[:-1] != 0)]]
    edges = np.flatnonzero(line == 0)
    if len(edges) < 2:
        return np.zeros(0, np.int64)
    lengths = np.diff(edges) - 1
    powers = np.full(int(lengths.max()) + 1, FACTOR).cumprod(dtype=np.uint64)
    place = np.arange(len(line)) - np.repeat(edges, np.diff(np.r_[edges, len(line)]))
    words = np.add.reduceat(line * powers[place], edges[:-1])
    found = [bucket(words, 0), np.full(int((words[1:] == words[:-1]).sum()), AGAIN)]
    for table, n in enumerate(NGRAMS, 1):
        many = len(line) - n + 1
        if many <= 0:
            continue
        h, whole = np.zeros(many, np.uint64), np.ones(many, bool)
        for k in range(n):
            h = h * FACTOR + line[k : k + many]
            if 0 < k < n - 1:
                whole &= line[k : k + many] != 0
        found.append(bucket(h[whole], table))
    return np.concatenate(found)


@dataclass(frozen=True)
class Model:
    """What is left of a two-class model for scoring: by how much each row moves the logit."""

    pull: np.ndarray
    bias: float

    def score(self, text: bytes) -> float:
        total, many = 0.0, 0
        for block in text_blocks(text):
            rows = block_features(block)
            total += float(self.pull[rows].sum(dtype=np.float64))
            many += len(rows)
        logit = self.bias + (total / many if many else 0.0)
        return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def count_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(label, text) to the distinct rows of a text and their shares."""
    for batch in batches:
        rows, shares = [], []
        for text in batch.column(1):
            counts = np.zeros(ROWS, np.int64)
            for block in text_blocks(text.as_py() or b""):
                counts += np.bincount(block_features(block), minlength=ROWS)
            own = np.flatnonzero(counts)
            rows.append(own.astype("<i4").tobytes())
            shares.append((counts[own] / max(1, counts.sum())).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows, pa.binary()), pa.array(shares, pa.binary())], schema=schema
        )


def train(samples: list[tuple[int, np.ndarray, np.ndarray]], seed: int = SEED) -> Model:
    """Gradient descent over the samples (label, rows, shares), one at a time. Starts, order
    and rates are fixed by the seed; without samples every score is one half."""
    if not samples:
        return Model(np.zeros(ROWS, np.float32), 0.0)
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (ROWS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    epochs = max(EPOCHS, -(-LEAST_STEPS // len(samples)))
    steps, done = epochs * len(samples), 0
    for _ in range(epochs):
        for at in draw.permutation(len(samples)):
            label, rows, shares = samples[at]
            left = np.float32(1 - done / steps)
            done += 1
            rate = left * min(RATE, 1 / max(1e-9, float(shares @ shares)))  # short texts move less
            hidden = shares @ vectors[rows]
            logits = output @ hidden + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            back = error @ output
            output -= OUTPUT_RATE * left * np.outer(error, hidden)
            bias -= OUTPUT_RATE * left * error
            vectors[rows] -= np.float32(rate) * shares[:, None] * back
    return Model(vectors @ (output[1] - output[0]), float(bias[1] - bias[0]))


def training_samples(
    docs: DataFrame, labels: DataFrame, label: Column, id_col: str, text_col: str, most: int
) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Features of at most `most` labelled documents, the first by a hash of their ids."""
    chosen = labels.select(F.col(id_col).alias("_id"), label.cast("int").alias("_label"))
    chosen = chosen.where("_id IS NOT NULL AND _label IN (0, 1)").distinct()
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id", "_label").limit(most)
    rows = docs.join(F.broadcast(chosen), docs[id_col] == F.col("_id"))
    rows = rows.select("_label", F.col(text_col).cast("binary"))
    schema = struct(label=T.IntegerType(), rows=T.BinaryType(), shares=T.BinaryType())
    counted = rows.mapInArrow(partial(count_batches, schema=to_arrow_schema(schema)), schema)
    found = counted.orderBy("label", F.xxhash64("rows", "shares")).collect()
    return [(r.label, np.frombuffer(r.rows, "<i4"), np.frombuffer(r.shares, "<f4")) for r in found]


def score_batches(batches: Iterator[pa.RecordBatch], model: Model, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [model.score(t.as_py() or b"") for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], schema=schema)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most: int = TRAINING_ROWS,
) -> DataFrame:
    """One row per input row: id and `score`, the probability of label 1.

    Trains on at most `most` rows of `labels` (the bound of what reaches the driver: one
    list of distinct features for each), then scores every whole text in one pass without
    a shuffle. Only texts are features.

    Null and empty texts have no features and get the score of the bias. Labels other than
    0 and 1 are not learned from. Without labels every score is 0.5. Repeated rows repeat
    their score; other columns are not read; an empty table gives an empty result.
    """
    model = train(training_samples(docs, labels, F.col(label_col), id_col, text_col, most))
    schema = struct(**{id_col: docs.schema[id_col].dataType}, score=T.DoubleType())
    work = partial(score_batches, model=model, schema=to_arrow_schema(schema))
    return docs.select(F.col(id_col), F.col(text_col).cast("binary")).mapInArrow(work, schema)
