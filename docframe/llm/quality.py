"""Quality classification by supervised subword embeddings (operator 10).

A document is the mean of the learned vectors of its features: every word, every pair of neighbouring words
and every run of 3 or 4 bytes inside a word, hashed to a table of 2**18 rows; neighbours that are one word
twice share a row. A softmax over two classes reads the mean. Trained by stochastic gradient descent in numpy
on a bounded sample (sample_per_class labelled rows of each class) in one executor task; every whole text is
scored, a megabyte of texts (or one longer text) at a time: memory is some 60 bytes for each byte of them.

As the output is linear in the mean, a row's part in it is one number, so scoring gathers one number for each
feature. Defined results: null and empty texts have no feature and get the score of the bias alone; repeated
rows score alike; without labels every score is 0.5; labels, lang, source and doc_id are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm._labels import labelled_rows, trained
from docframe.llm._words import IS_SPACE, hash_spans, lean, mix, slices, text_buffer, word_bounds

TABLE_BITS = 18
_SAME = np.uint64(12_345)


def feature_lists(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature the table rows of all texts' features and the texts they are of, in order."""
    data, offsets = text_buffer(column)
    n, shift = len(offsets) - 1, np.uint64(64 - TABLE_BITS)
    starts, ends, rows = word_bounds(data, offsets)
    word = hash_spans(data, starts, ends)
    doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(rows))
    yield (word >> shift).astype(np.int32), doc
    keep = doc[1:] == doc[:-1]
    pair = np.where(word[1:] == word[:-1], _SAME, mix(word[1:] * np.uint64(3) + word[:-1]))[keep]
    yield (pair >> shift).astype(np.int32), doc[1:][keep]
    del word, pair
    space = IS_SPACE[data]
    owner_of_byte = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
    for width in (3, 4):
        if len(data) < width:
            continue
        fits = owner_of_byte[: len(data) - width + 1] == owner_of_byte[width - 1 :]
        for k in range(width):
            fits &= ~space[k : len(data) - width + 1 + k]
        begin = np.flatnonzero(fits)
        yield (hash_spans(data, begin, begin + width) >> shift).astype(np.int32), owner_of_byte[begin]


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all features of all texts, each text's together, and the texts' offsets in them."""
    found, owners = zip(*feature_lists(column), strict=True)
    whose = np.concatenate(owners)
    order = np.argsort(whose, kind="stable")
    return np.concatenate(found)[order], np.searchsorted(whose[order], np.arange(len(column) + 1))


def train(texts: list[str], labels: list[int], dim: int = 16, epochs: int = 6, rate: float = 0.5, seed: int = 10) -> tuple[np.ndarray, float]:
    """(each table row's part in the log-odds of label 1, bias)."""
    rng = np.random.default_rng(seed)
    table = (rng.random((1 << TABLE_BITS, dim), np.float32) - 0.5) / dim
    out, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    bags = []
    for part in slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])], most=1 << 19):
        rows, offsets = features(part.column(0))
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            which, times = np.unique(rows[a:b], return_counts=True)
            bags.append((which, (times / max(b - a, 1)).astype(np.float32)))
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            which, share = bags[i]
            pace = rate * (1 - done / steps)
            done += 1
            vectors = table[which]
            mean = share @ vectors
            logits = mean @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            out -= pace * np.outer(mean, p)
            bias -= pace * p
            table[which] = vectors - (pace * 20) * share[:, None] * back
    both = table @ (out[:, 1] - out[:, 0])
    return both.astype(np.float32), float(bias[1] - bias[0])


def _packed(texts: list[str], labels: list[int]) -> bytes:
    parts, bias = train(texts, labels)
    return np.append(parts, np.float32(bias)).tobytes()


def score_texts(column: pa.Array, parts: np.ndarray, bias: float) -> np.ndarray:
    n = len(column)
    sums, size = np.zeros(n), np.zeros(n)
    for rows, owner in feature_lists(column):
        sums += np.bincount(owner, weights=parts[rows], minlength=n)
        size += np.bincount(owner, minlength=n)
    return 1 / (1 + np.exp(-bias - sums / np.maximum(size, 1)))


class QualityModel:
    """parts and bias; apply() adds the score to a table's rows. Its size is fixed (1 MB)."""

    def __init__(self, parts: np.ndarray, bias: float):
        self.parts, self.bias = parts, bias

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, label: str = "quality", sample_per_class: int = 1500, most_chars: int = 20_000) -> QualityModel:
        model = trained(labelled_rows(docs, labels, label, sample_per_class, most_chars), _packed)
        if model is None:
            return cls(np.zeros(1 << TABLE_BITS, np.float32), 0.0)
        values = np.frombuffer(model, np.float32)
        return cls(values[:-1], float(values[-1]))

    def apply(self, docs: DataFrame) -> DataFrame:
        """doc_id, score of every row."""
        parts, bias = self.parts, self.bias

        def run(batches):
            for batch in slices(batches, most=1 << 20):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score_texts(batch.column(1), parts, bias))], ["doc_id", "score"])

        narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        return narrow.mapInArrow(lean(run), "doc_id long, score double")

    def keep(self, docs: DataFrame, threshold: float = 0.3) -> DataFrame:
        """The rows of docs that score at least threshold, all columns as they are."""
        parts, bias, place = self.parts, self.bias, docs.columns.index("text")

        def run(batches):
            for batch in slices(batches, most=1 << 20):
                yield batch.filter(pa.array(score_texts(batch.column(place), parts, bias) >= threshold))

        return docs.mapInArrow(lean(run), docs.schema)
