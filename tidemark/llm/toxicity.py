"""Toxicity of documents: a linear classifier with counterfactual regularisation.

A document is the set of its lower-cased words, hashed; its score is a logistic
function of the sum of their weights. Identity terms (names of groups of people)
come in lists of terms that may stand for each other. Training minimises the log
loss on labelled documents, plus an L1 term, plus a penalty on the squared change of
the logit when an identity term of a labelled text is swapped for another of its
list. Terms
that only happen to stand in more toxic texts so lose what sets them apart, and a
neutral mention of one group scores like that of any other.

The model is fitted by numpy on a bounded sample of labelled documents, of which
executors extract the word numbers; all texts are scored whole, in the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import spans
from .common import labelled_sample

BUCKETS = 1 << 18
#: Labelled documents per label that are fitted on (expected number).
SAMPLE = 6000
#: Words in fewer sampled documents than this have no weight.
LEAST_DOCUMENTS = 5

#: Terms of one list may be swapped for each other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "people"),
    ("woman", "man", "girl", "boy", "person"),
    ("female", "male", "transgender", "nonbinary", "human"),
    ("gay", "lesbian", "bisexual", "straight", "queer"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrant", "refugee", "foreigner", "citizen", "neighbour"),
    ("immigrants", "refugees", "foreigners", "citizens", "neighbours"),
    ("disabled", "blind", "deaf", "old", "young"),
)


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))


def word_sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, texts, owner, bucket) of the distinct words of each text, piece by piece."""
    for first, data, offsets in spans.pieces(_lower(column)):
        start, end, text = spans.words(data, offsets, spans.IS_LETTER)
        word = spans.Hasher(data).of(start, end)
        owner, word = spans.shingles(word, text, len(offsets) - 1, 1)
        yield first, len(offsets) - 1, owner, (word % np.uint64(BUCKETS)).astype(np.int32)


def buckets_of(terms: list[str]) -> np.ndarray:
    """The bucket of each single-word term."""
    found = [bucket for _, _, _, bucket in word_sets(pa.array(terms))]
    bucket = np.concatenate(found) if found else np.zeros(0, np.int32)
    if len(bucket) != len(terms):
        raise ValueError("identity terms must be single words")
    return bucket


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, n, owner, bucket in word_sets(batch.column(0)):
            edge = np.append(0, np.cumsum(np.bincount(owner, minlength=n))).astype(np.int32)
            words = pa.ListArray.from_arrays(pa.array(edge), pa.array(bucket))
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, n), words], names=["label", "words"])


def labelled_words(docs: DataFrame, labels: DataFrame, label: str, id: str, text: str, sample: int) -> DataFrame:
    """(label, words) of about ``sample`` documents per label 0 and 1.

    Of repeated labels of a document the largest counts.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull())
    known = known.groupBy(F.col(id).alias("_id")).agg(F.max(label).cast("int").alias("label"))
    chosen = labelled_sample(known, "label", sample, f"fit {label}", "_id")
    # at most 2 x sample rows are expected
    met = docs.select(F.col(id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "_id")
    return met.select("text", "label")


def _descend(label, owner, feature, weight, swaps, start, penalty, sparse, rate, steps):
    """Accelerated proximal gradient descent: log loss, swap penalty and an L1 term.

    ``swaps`` are (feature, feature put in its place, share of the swaps of a term).
    """
    n = len(label)
    w, bias = start
    ahead, t = w.copy(), 1.0
    own, other, share = swaps
    # a step no longer than the penalty's curvature allows
    met = np.bincount(own, share, len(w)) + np.bincount(other, share, len(w))
    rate = rate / (1 + rate * 4 * penalty * met.max(initial=0) / n)
    for _ in range(steps):
        z = np.bincount(owner, ahead[feature], n) + bias
        off = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - label) * weight / n
        slope = np.bincount(feature, off[owner], len(w))
        if len(own) and penalty:
            pull = (2 * penalty / n) * share * (ahead[other] - ahead[own])
            slope += np.bincount(other, pull, len(w)) - np.bincount(own, pull, len(w))
        moved = ahead - rate * slope
        moved = np.sign(moved) * np.maximum(0, np.abs(moved) - rate * sparse)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = moved + (t - 1) / after * (moved - w), moved, after
        bias -= 0.02 * rate * off.sum()
    return w, bias


def train(
    label: np.ndarray, edge: np.ndarray, bucket: np.ndarray, weight: np.ndarray, identity=IDENTITY_TERMS,
    penalty: float = 1.0, sparse: float = 1e-3, rate: float = 0.5, steps: int = 150, seed: int = 4,
) -> Model:
    """Fit on texts given as the buckets of their words, ``bucket[edge[i]:edge[i + 1]]``.

    A first descent with an L1 term picks the words that matter; a second one fits
    these with a tenth of it.
    """
    out = np.zeros(BUCKETS, np.float32)
    if not len(label):
        return Model(out, 0.0)
    bias = float(np.log((weight[label == 1].sum() + 1) / (weight[label == 0].sum() + 1)))
    owner = np.repeat(np.arange(len(label)), np.diff(edge))
    terms = [buckets_of(list(g)) for g in identity]
    listed = np.full(BUCKETS, -1)
    for g, these in enumerate(terms):
        listed[these] = g
    seen = np.bincount(bucket, minlength=BUCKETS)
    used = (seen >= min(LEAST_DOCUMENTS, max(1, len(label) // 20))) | (listed >= 0)
    keep = used[bucket]
    owner, bucket = owner[keep], bucket[keep]
    # the swaps: each identity term of a text for each other one of its list
    at = np.flatnonzero(listed[bucket] >= 0)
    pairs = [(b, o, 1 / (len(terms[listed[b]]) - 1)) for b in bucket[at] for o in terms[listed[b]] if o != b]
    swaps = np.array(pairs, float).reshape(-1, 3).T
    start = np.zeros(BUCKETS), bias
    for l1, times in ((sparse, steps), (sparse / 10, 4 * steps)):
        place = np.flatnonzero(used)
        number = np.full(BUCKETS, -1)
        number[place] = np.arange(len(place))
        mine = used[bucket]
        held = number[swaps[0].astype(int)], number[swaps[1].astype(int)], swaps[2]
        w, bias = _descend(
            label, owner[mine], number[bucket[mine]], weight, held, (start[0][place], bias), penalty, l1, rate, times
        )
        full = np.zeros(BUCKETS)
        full[place] = w
        start, used = (full, bias), (full != 0) | (listed >= 0)
    return Model(start[0].astype(np.float32), float(bias))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text",
    sample: int = SAMPLE, **options,
) -> Model:
    """A model from ``labels`` (id, label 0/1; other values and nulls are left out).

    The driver receives the word numbers of the sampled documents only. Without any
    labelled document every score is 0.5.
    """
    rows = labelled_words(docs, labels, label, id, text, sample).mapInArrow(_extract, "label int, words array<int>")
    got = rows.toArrow().combine_chunks()
    words = got["words"].combine_chunks()
    words = words if isinstance(words, pa.ListArray) else pa.concat_arrays(words.chunks or [pa.array([], pa.list_(pa.int32()))])
    edge, bucket = np.append(0, np.cumsum(pc.list_value_length(words).to_numpy(False))).astype(int), words.flatten().to_numpy(False)
    y = got["label"].to_numpy()
    # a label of which only a share was drawn counts for the whole
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int")).count().collect()
    weight = np.ones(len(y))
    for value, n in known:
        weight[y == value] = n / max(1, (y == value).sum())
    weight *= len(y) / max(1.0, weight.sum())
    # texts in an order that doesn't depend on where they were read
    keys = [(int(y[i]), bucket[edge[i] : edge[i + 1]].tobytes()) for i in range(len(y))]
    order = np.array(sorted(range(len(y)), key=keys.__getitem__), int)
    owner, place = spans.spread((edge[1:] - edge[:-1])[order]) if len(y) else (np.zeros(0, int),) * 2
    moved = bucket[edge[order][owner] + place] if len(y) else bucket
    edges = np.append(0, np.cumsum((edge[1:] - edge[:-1])[order])).astype(int)
    return train(y[order], edges, moved, weight[order], **options)


def scores(model: Model, column: pa.Array) -> np.ndarray:
    out = np.empty(len(column))
    for first, n, owner, bucket in word_sets(column):
        z = np.bincount(owner, model.weights[bucket], n) + model.bias
        out[first : first + n] = 1 / (1 + np.exp(-z))
    return out


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column of scores, 0 to 1, of whole texts; null and empty texts have that of no words."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(scores(held.value, part))

    return of.asNondeterministic()(F.col(text))  # so that it is evaluated once
