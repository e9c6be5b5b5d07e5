"""Language of words and documents: a linear-chain conditional random field.

A word's features are its first and last one to three characters, its character
2- and 3-grams and the word itself (the lexicon), all hashed. Each has a weight per
language, and each pair of languages a weight for one following the other. Words of
a sentence form a chain; forward-backward gives every word the probability of each
language, so that a word that several languages share is told by its neighbours.
A document's language is the one with the most expected words.

Training is by numpy on sentences of a bounded sample of documents of known
language, their words labelled so. Half of the chains are pieced together from
sentences of several languages, from which changes of language are learned. A chain
ends with its sentence (. ! ? or a line end), and at the latest after 64 words.
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

BUCKETS = 1 << 17
NGRAMS = (2, 3)
AFFIXES = (1, 2, 3)
CHAIN = 64
UNKNOWN = "und"
#: Documents of each language that are fitted on (expected number), and sentences of each.
SAMPLE = 800
SENTENCES = 4

_IS_STOP = np.zeros(256, bool)
_IS_STOP[[ord(c) for c in ".!?\n"]] = True


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # buckets x languages
    follows: np.ndarray  # languages x languages


class Chains(NamedTuple):
    """Words of some texts in order: their text and chain, and the features of their forms."""

    text: np.ndarray
    begin: np.ndarray  # first word of each chain
    form: np.ndarray
    forms: int
    owner: np.ndarray
    bucket: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))


def chains(data: np.ndarray, offsets: np.ndarray) -> Chains:
    start, end, text = spans.words(data, offsets, spans.IS_LETTER)
    hasher, chars = spans.Hasher(data), spans.Characters(data)
    hashed = hasher.of(start, end)
    _, at, form = np.unique(hashed, return_index=True, return_inverse=True)
    sets = [(np.arange(len(at)), spans.scramble(hashed[at] + np.uint64(5)))]
    sets += spans.ngrams(hasher, chars, start[at], end[at], NGRAMS)
    sets += spans.affixes(hasher, chars, start[at], end[at], AFFIXES)
    owner = np.concatenate([s[0] for s in sets])
    bucket = (np.concatenate([s[1] for s in sets]) % np.uint64(BUCKETS)).astype(np.int32)
    stops = np.append(0, np.cumsum(_IS_STOP[data]))[start]
    new = np.ones(len(start), bool)
    new[1:] = (text[1:] != text[:-1]) | (stops[1:] != stops[:-1])
    first = np.flatnonzero(new)
    place = np.arange(len(start)) - np.repeat(first, np.diff(np.append(first, len(start))))
    return Chains(text, np.flatnonzero(place % CHAIN == 0), form, len(at), owner, bucket, start, end)


def emissions(model_weights: np.ndarray, c: Chains) -> np.ndarray:
    """Score of each form in each language (forms x languages)."""
    count = np.maximum(1, np.bincount(c.owner, minlength=c.forms))
    got = np.stack([np.bincount(c.owner, w[c.bucket], c.forms) for w in model_weights.T], axis=1)
    return got / np.sqrt(count)[:, None]


def forward_backward(emission: np.ndarray, begin: np.ndarray, follows: np.ndarray, pairs: bool = False):
    """Probabilities of languages per word, and the expected number of each pair if asked.

    All chains take their step together: the longest come first, so those still
    running at a step are the first ones.
    """
    n, k = emission.shape
    length = np.diff(np.append(begin, n))
    order = np.argsort(-length, kind="stable")
    first, length = begin[order], length[order]
    steps = int(length[0]) if len(length) else 0
    running = [int(np.searchsorted(-length, -t, side="left")) for t in range(steps)]  # length > t
    e = np.exp(emission - emission.max(axis=1, keepdims=True)) if n else emission
    move = np.exp(follows - follows.max())
    ahead, behind = np.empty((n, k)), np.ones((n, k))
    for t in range(steps):
        at = first[: running[t]] + t
        now = e[at] if t == 0 else (ahead[at - 1] @ move) * e[at]
        ahead[at] = now / now.sum(axis=1, keepdims=True)
    expected = np.zeros((k, k))
    for t in range(steps - 2, -1, -1):
        at = first[: running[t + 1]] + t
        after = e[at + 1] * behind[at + 1]
        now = after @ move.T
        if pairs:
            both = ahead[at][:, :, None] * move[None] * after[:, None, :]
            expected += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        behind[at] = now / now.sum(axis=1, keepdims=True)
    share = ahead * behind
    share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
    return (share, expected) if pairs else share


def _sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to SENTENCES chains of each text, evenly from its whole length."""
    for batch in batches:
        for first, data, offsets in spans.pieces(_lower(batch.column(0))):
            c = chains(data, offsets)
            last = np.append(c.begin[1:], len(c.text)) - 1
            of, names = c.text[c.begin] if len(c.begin) else c.begin, batch.column(1).slice(first)
            langs, got = [], []
            for i in np.unique(of):
                mine = np.flatnonzero(of == i)
                for j in mine[np.unique(np.linspace(0, len(mine) - 1, SENTENCES).astype(int))]:
                    langs.append(names[int(i)].as_py())
                    got.append(data[c.start[c.begin[j]] : c.end[last[j]]].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(got, pa.string())], names=["lang", "sentence"]
            )


def _pieced(sentences: list[str], labels: np.ndarray, draw) -> tuple[list[str], list[np.ndarray]]:
    """Chains as texts, and the label of each word: sentences, and as many of mixed language."""
    texts, gold = [], []
    split = [s.replace("\n", " ").split() for s in sentences]
    for words, y in zip(split, labels):
        texts.append(" ".join(words))
        gold.append((words, np.full(len(words), y)))
    for _ in range(len(split)):
        words, y = [], []
        for j in draw.integers(0, len(split), 3):
            low = int(draw.integers(0, max(1, len(split[j]) - 2)))
            part = split[j][low : low + int(draw.integers(2, 9))]
            words += part
            y += [labels[j]] * len(part)
        texts.append(" ".join(words))
        gold.append((words, np.array(y, int)))
    return texts, gold


def train(
    sentences: list[str], langs: list[str], epochs: int = 4, batch: int = 256, rate: float = 0.3, ridge: float = 1e-5,
    seed: int = 6,
) -> Model:
    """Weights by stochastic gradient ascent on the likelihood of the labels."""
    names = sorted(set(langs))
    k, draw = len(names), np.random.default_rng(seed)
    weights, follows = np.zeros((BUCKETS, k)), np.zeros((k, k))
    if not names:
        return Model([], weights, follows)
    number = np.array([names.index(x) for x in langs])
    texts, gold = _pieced(sentences, number, draw)
    heat, move_heat = np.full((BUCKETS, k), 1e-6), np.full((k, k), 1e-6)
    for _ in range(epochs):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            # a word of the text may hold marks that part it: each part has its label
            bits = [" \x00".join(gold[i][0]) for i in rows]
            y_of = [gold[i][1] for i in rows]
            data = np.frombuffer("\n".join(bits).encode(), np.uint8)
            ends = np.cumsum([len(b.encode()) + 1 for b in bits])
            offsets = np.append(0, ends).clip(max=len(data))
            c = chains(data, offsets)
            if not len(c.text):
                continue
            marks = np.append(0, np.cumsum(data == 0))[c.start]
            base = np.append(0, np.cumsum(data == 0))[offsets[:-1].clip(max=len(data))]
            place = marks - base[c.text]
            y = np.array([y_of[t][p] for t, p in zip(c.text, place)])
            share, expected = forward_backward(emissions(weights, c)[c.form], c.begin, follows, pairs=True)
            miss = -share
            miss[np.arange(len(y)), y] += 1
            inner = np.ones(len(y), bool)
            inner[c.begin] = False
            real = np.zeros((k, k))
            np.add.at(real, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
            count = np.maximum(1, np.bincount(c.owner, minlength=c.forms))
            per_form = np.stack([np.bincount(c.form, miss[:, i], c.forms) for i in range(k)], axis=1) / np.sqrt(count)[:, None]
            slope = np.stack([np.bincount(c.bucket, per_form[c.owner, i], BUCKETS) for i in range(k)], axis=1) / len(rows)
            slope -= ridge * weights
            heat += slope**2
            weights += rate * slope / np.sqrt(heat)
            bend = (real - expected) / len(rows)
            move_heat += bend**2
            follows += 0.1 * bend / np.sqrt(move_heat)
    return Model(names, weights.astype(np.float32), follows)


def fit(docs: DataFrame, lang: str = "lang", id: str = "doc_id", text: str = "text", sample: int = SAMPLE, **options) -> Model:
    """A model from documents of known language; null languages and texts are left out."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    chosen = labelled_sample(known.select(F.col(id).alias("_id"), F.col(lang).alias("lang"), F.col(text).alias("text")), "lang", sample, "fit lang", "_id")
    got = chosen.select("text", "lang").mapInArrow(_sentences, "lang string, sentence string").toPandas()
    pairs = sorted(zip(got.lang, got.sentence))
    return train([p[1] for p in pairs], [p[0] for p in pairs], **options)


def shares(model: Model, column: pa.Array) -> Iterator[tuple[int, int, Chains, np.ndarray, np.ndarray]]:
    """(first text, texts, chains, probabilities per word, bytes), piece by piece."""
    for first, data, offsets in spans.pieces(_lower(column)):
        c = chains(data, offsets)
        emission = emissions(model.weights, c)
        yield first, len(offsets) - 1, c, forward_backward(emission[c.form], c.begin, model.follows), data


def predict(model: Model, column: pa.Array) -> pa.StructArray:
    """{lang, score} per text: the language of the most expected words, and their share."""
    best, score = np.full(len(column), -1), np.zeros(len(column))
    if model.languages:
        for first, n, c, share, _ in shares(model, column):
            total = np.stack([np.bincount(c.text, share[:, i], n) for i in range(share.shape[1])], axis=1)
            words = total.sum(axis=1)
            best[first : first + n] = np.where(words > 0, total.argmax(axis=1), -1)
            score[first : first + n] = total.max(axis=1) / np.maximum(words, 1e-300)
    letters = pc.fill_null(pc.match_substring_regex(column.cast(pa.large_string()), r"\p{L}"), False).to_numpy(False)
    best = np.where(letters, best, -1)
    names = pa.array([*model.languages, UNKNOWN], pa.string())
    lang = names.take(pa.array(np.where(best < 0, len(model.languages), best)))
    return pa.StructArray.from_arrays([lang, pa.array(np.where(best < 0, 0.0, np.clip(score, 0, 1)))], ["lang", "score"])


def language(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct column {lang, score} of whole texts; `und` with score 0 without a letter."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield predict(held.value, part)

    return of.asNondeterministic()(F.col(text))  # so that it is evaluated once


def word_languages(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word of each text: id, position, word (lower-cased), lang, probability."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(held.value.languages, pa.string())
        for batch in batches:
            for first, n, c, share, data in shares(held.value, batch.column(1)) if len(names) else ():
                count = np.bincount(c.text, minlength=n)
                place = np.arange(len(c.text)) - np.repeat(np.cumsum(count) - count, count)
                words = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(c.start, c.end)]
                best = share.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(c.text + first)),
                        pa.array(place),
                        pa.array(words, pa.string()),
                        names.take(pa.array(best)),
                        pa.array(share[np.arange(len(best)), best]),
                    ],
                    names=["id", "position", "word", "lang", "probability"],
                )

    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    out = rows.mapInArrow(run, "id bigint, position bigint, word string, lang string, probability double")
    return out.withColumnRenamed("id", id)
