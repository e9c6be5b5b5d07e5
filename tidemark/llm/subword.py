"""Quality of documents: supervised subword embeddings.

Every word, every pair of adjacent words and every character n-gram of a word is
hashed to a row of a table of vectors; a word said twice in a row is one and the same
pair whatever the word. A document is the mean of the vectors of all of them; a softmax over two
classes of a linear map of that mean is the score. Table and map are learned
together by stochastic gradient descent in numpy, on a bounded sample of labelled
documents, each given by a bounded sample of its features drawn over its whole
text. Scores use all features of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import spans
from .toxicity import labelled_words

BUCKETS = 1 << 17
WIDTH = 12
NGRAMS = (2, 3, 4)
AFFIXES = (1, 2)
#: Labelled documents per label that are fitted on (expected number), and features of each.
SAMPLE = 4000
FEATURES = 256


class Model(NamedTuple):
    vectors: np.ndarray
    output: np.ndarray

    def margins(self) -> np.ndarray:
        """What each feature adds to the log odds of class 1."""
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float32)


def word_features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word number, bucket) for the words themselves, their n-grams and affixes."""
    hasher, chars = spans.Hasher(data), spans.Characters(data)
    whole = np.arange(len(start)), spans.scramble(hasher.of(start, end) + np.uint64(99))
    found = [whole, *spans.ngrams(hasher, chars, start, end, NGRAMS), *spans.affixes(hasher, chars, start, end, AFFIXES)]
    for word, hashed in found:
        yield word, (hashed % np.uint64(BUCKETS)).astype(np.int32)


def _pairs(hashed: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The bucket of each word with the one before it in its text."""
    before = np.zeros(len(hashed), np.uint64)
    before[1:] = np.where(text[1:] == text[:-1], hashed[:-1], np.uint64(0))
    pair = np.where(before == hashed, np.uint64(1), spans.scramble(before * np.uint64(3) + hashed))
    return (pair % np.uint64(BUCKETS)).astype(np.int32)


def _pieces(column: pa.Array) -> Iterator[tuple]:
    """(first text, texts, text, pair and form of each word, features of the distinct forms)."""
    for first, data, offsets in spans.pieces(column):
        start, end, text = spans.words(data, offsets)
        hashed = spans.Hasher(data).of(start, end)
        _, at, form = np.unique(hashed, return_index=True, return_inverse=True)
        features = word_features(data, start[at], end[at])
        yield first, len(offsets) - 1, text, _pairs(hashed, text), form, len(at), features


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, n, text, pair, form, forms, features in _pieces(batch.column(0)):
            word, bucket = map(np.concatenate, zip(*features))
            order = np.argsort(word, kind="stable")
            bucket = bucket[order]
            edge = np.append(0, np.cumsum(np.bincount(word, minlength=forms)))
            each = np.diff(edge)[form] + 1  # features of every word of the piece, its pair last
            first_word = np.searchsorted(text, np.arange(n + 1))
            running = np.append(0, np.cumsum(each))
            lists = []
            for i in range(n):
                low, high = running[first_word[i]], running[first_word[i + 1]]
                if low == high:
                    lists.append(np.zeros(0, np.int32))
                    continue
                # evenly over the text; all of them if there are no more
                place = low + (np.arange(min(FEATURES, high - low)) * (high - low)) // min(FEATURES, high - low)
                at = np.searchsorted(running, place, side="right") - 1
                inner = place - running[at]
                is_pair = inner == each[at] - 1
                own = np.minimum(edge[form[at]] + inner, len(bucket) - 1)
                lists.append(np.where(is_pair, pair[at], bucket[own]))
            labels = batch.column(1).slice(first, n)
            yield pa.RecordBatch.from_arrays(
                [labels, pa.array(lists, pa.list_(pa.int32()))], names=["label", "features"]
            )


def train(
    label: np.ndarray, features: list[np.ndarray], epochs: int = 6, rate: float = 0.4, seed: int = 10
) -> Model:
    """Fit by one document after the other, the rate falling to nought."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    output = np.zeros((WIDTH, 2), np.float32)
    steps, done = epochs * max(1, len(label)), 0
    for _ in range(epochs):
        for i in draw.permutation(len(label)):
            ids = features[i]
            now = np.float32(rate * (1 - done / steps))
            done += 1
            if not len(ids):
                continue
            mean = vectors[ids].mean(axis=0)
            z = mean @ output
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[i]] -= 1
            back = output @ p
            output -= now * np.outer(mean, p)
            np.subtract.at(vectors, ids, now * back / np.float32(len(ids)) * np.float32(4))
    return Model(vectors, output)


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id", text: str = "text",
    sample: int = SAMPLE, **options,
) -> Model:
    """A model from ``labels`` (id, label 0/1; other values and nulls are left out).

    Without any labelled document every score is 0.5.
    """
    rows = labelled_words(docs, labels, label, id, text, sample)
    got = rows.mapInArrow(_extract, "label int, features array<int>").toPandas()
    pairs = sorted(zip(got.label.astype(int), got.features), key=lambda x: (x[0], np.asarray(x[1]).tobytes()))
    return train(np.array([p[0] for p in pairs], int), [np.asarray(p[1], np.int64) for p in pairs], **options)


def scores(margins: np.ndarray, column: pa.Array) -> np.ndarray:
    out = np.empty(len(column))
    for first, n, text, pair, form, forms, features in _pieces(column):
        total, count = np.zeros(forms), np.zeros(forms)
        for word, bucket in features:
            total += np.bincount(word, margins[bucket], forms)
            count += np.bincount(word, minlength=forms)
        sums = np.bincount(text, total[form] + margins[pair], n)
        z = sums / np.maximum(1, np.bincount(text, count[form] + 1, n))
        out[first : first + n] = 1 / (1 + np.exp(-z))
    return out


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column of scores, 0 to 1, of whole texts; null and empty texts have 0.5."""
    held = docs.sparkSession.sparkContext.broadcast(model.margins())

    @F.arrow_udf("double")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(scores(held.value, part))

    return of.asNondeterministic()(F.col(text))  # so that it is evaluated once
