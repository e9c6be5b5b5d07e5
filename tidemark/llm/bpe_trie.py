"""Byte-level BPE by a trie of distinct words.

A text is cut into words by the vocabulary's pattern, and its distinct words are
laid out as a trie of their bytes. The encoding of a prefix ends in exactly one
token, and that token together with the encoding of what stands before it is all
there is to know: so every node of the trie keeps its last token, found among the
vocabulary's tokens that end there as the one that follows the last token of the
node where it begins. Sorted words are the trie in depth-first order: of two words in
a row, the nodes of their common prefix are shared and worked out once. A word's
tokens are then read off backwards.

Two tokens may stand side by side if no merge that crosses their border would have
come before the merges that made them.

Encoding runs in the executors over whole texts; the vocabulary is read by the
driver from the path given and broadcast (a fixed 50,000 tokens or so). Each worker
remembers words up to a bound and forgets them all when it is reached.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from os.path import commonprefix
from struct import pack
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

#: How a byte-level vocabulary cuts text and writes bytes as characters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = (range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100))

#: Bounds of what a worker holds beside the vocabulary: words it remembers and their bytes,
#: token pairs it remembers, and the characters it cuts at a time (one text at least).
REMEMBERED = 150_000
REMEMBERED_BYTES = 8_000_000
REMEMBERED_PAIRS = 250_000
PIECE = 500_000


class Vocabulary(NamedTuple):
    tokens: list[bytes]  # by id
    merges: list[tuple[int, int, int]]  # left, right, made, first to last
    special: dict[str, int]


def byte_characters() -> list[str]:
    """The character that a byte-level vocabulary writes for each byte."""
    plain = {c for r in PRINTABLE for c in r}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def read_vocabulary(path: str) -> Vocabulary:
    """A byte-level BPE file of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec.get("normalizer"):
        raise ValueError("a plain byte-level BPE vocabulary is needed")
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ids = model["vocab"]
    tokens = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for text, i in ids.items():
        if text not in special:
            tokens[i] = bytes(byte_of[c] for c in text)
    for text, i in special.items():
        tokens[i] = text.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
    if len({m[2] for m in merges}) != len(merges):
        raise ValueError("a token is made by more than one merge")
    return Vocabulary(tokens, merges, special)


class Trie:
    """Encodes words of bytes; keeps what it needs for the next word only.

    A node also knows its longest suffix that begins some token. The tokens that end at the
    node are the suffixes of that one, so that only they are tried.
    """

    def __init__(self, vocabulary: Vocabulary):
        taken = set(vocabulary.special.values())
        self.tokens = vocabulary.tokens
        self.id_of = {t: i for i, t in enumerate(vocabulary.tokens) if t and i not in taken}
        self.begins = [b"", *sorted({t[:n] for t in self.id_of for n in range(1, len(t) + 1)})]
        self.number = {t: i for i, t in enumerate(self.begins)}
        self.ends: list[list | None] = [None] * len(self.begins)  # (length, token) of tokens at its end
        self.next: dict[int, int] = {}  # by 256 * beginning + byte
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(vocabulary.merges)}
        self.made_of = {made: (a, b, r) for r, (a, b, made) in enumerate(vocabulary.merges)}
        self.beside: dict[int, bool] = {}

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE keeps ``right`` after ``left`` apart.

        Going back in time from the finished tokens, the younger of the two that face
        each other is taken apart, so that at each moment the pair at the border is
        known. It must not be mergeable earlier than what broke it up was made.
        """
        key = left << 32 | right
        known = self.beside.get(key)
        if known is None:
            known = self.beside[key] = self._stay_apart(left, right)
            if len(self.beside) > REMEMBERED_PAIRS:
                self.beside.clear()
        return known

    def _longest_begin(self, begin: int, byte: int) -> int:
        """The longest suffix of a beginning and one more byte that begins a token."""
        text = self.begins[begin] + bytes((byte,))
        while text not in self.number:
            text = text[1:]
        found = self.next[begin << 8 | byte] = self.number[text]
        return found

    def _tokens_at(self, begin: int) -> list[tuple[int, int]]:
        text, id_of = self.begins[begin], self.id_of
        found = [(n, id_of[text[len(text) - n :]]) for n in range(len(text), 0, -1) if text[len(text) - n :] in id_of]
        self.ends[begin] = found
        return found

    def _stay_apart(self, a: int, b: int) -> bool:
        until = (len(self.rank), 0)  # when the pair that is now at the border ceased to be
        while True:
            merge = self.rank.get((a, b))
            if merge is not None and (merge, 0) < until:
                return False
            made_a, made_b = self.made_of.get(a), self.made_of.get(b)
            if made_a is None and made_b is None:
                return True
            if made_b is None or (made_a is not None and made_a[2] >= made_b[2]):
                # equal tokens: the left one is merged first, so it is the older
                if made_b is not None and made_a[2] == made_b[2]:
                    until, b = (made_b[2], 1), made_b[0]
                else:
                    until, a = (made_a[2], 0), made_a[1]
            else:
                until, b = (made_b[2], 1), made_b[0]

    def encode(self, words: list[bytes]) -> Iterator[list[int]]:
        """Token ids of each of the sorted, distinct, non-empty ``words``."""
        before, last, begins = b"", [-1], [0]  # last token and longest beginning of word[:n], by n
        tokens, next_, ends, beside, may_follow = self.tokens, self.next, self.ends, self.beside, self.may_follow
        for word in words:
            shared = len(commonprefix((before, word)))
            del last[shared + 1 :], begins[shared + 1 :]
            state = begins[shared]
            for end in range(shared + 1, len(word) + 1):
                byte = word[end - 1]
                state = next_.get(state << 8 | byte, -1)
                if state < 0:
                    state = self._longest_begin(begins[-1], byte)
                begins.append(state)
                for size, token in ends[state] or self._tokens_at(state):
                    if size == end:
                        break
                    known = beside.get(last[end - size] << 32 | token)
                    if may_follow(last[end - size], token) if known is None else known:
                        break
                else:
                    raise ValueError(f"no token ends at byte {end} of {word!r}")
                last.append(token)
            found, at = [], len(word)
            while at:
                found.append(last[at])
                at -= len(tokens[last[at]])
            found.reverse()
            before = word
            yield found


class Encoder:
    """Encodes texts; remembers the ids of words as bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.trie = Trie(vocabulary)
        self.cut = regex.compile(PATTERN)
        self.special = {t: pack("<I", i) for t, i in vocabulary.special.items()}
        self._forget()
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def _forget(self):
        """Remembers nothing but the special tokens, whose ids stand for themselves."""
        self.known: dict[str | bytes, bytes] = {ids: ids for ids in self.special.values()}
        self.held = 0  # bytes of words and ids in known

    def _words(self, text: str) -> list:
        """Words, and special tokens as bytes."""
        if self.split is None or not self.split.search(text):
            return self.cut.findall(text)
        out = []
        for i, part in enumerate(self.split.split(text)):
            out += [self.special[part]] if i % 2 else self.cut.findall(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self._words(t) for t in texts]
        known = self.known
        words = set().union(*cut)
        new = words - known.keys()
        if len(known) + len(new) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self._forget()
            known, new = self.known, words - self.known.keys()
        ordered = sorted((w.encode(), w) for w in new)
        for (plain, word), ids in zip(ordered, self.trie.encode([o[0] for o in ordered])):
            known[word] = pack(f"<{len(ids)}I", *ids)
            self.held += len(plain) + 4 * len(ids)
        return [b"".join(map(known.__getitem__, words)) for words in cut]


def runs(part: pa.Array, piece: int = PIECE) -> Iterator[list[str]]:
    """Texts of a string column in order, in runs of about ``piece`` bytes; null is empty."""
    size = pc.fill_null(pc.binary_length(part), 0).to_numpy(zero_copy_only=False).cumsum()
    begin = 0
    while begin < len(part):
        before = size[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(size, before + piece, "right")))
        yield [t or "" for t in part.slice(begin, end - begin).to_pylist()]
        begin = end


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> Column:
    """A column array<int> of token ids of whole texts; null and empty texts have none."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("array<int>")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(held.value)
        for part in parts:
            lists = []
            for run in runs(part):
                ids = encoder.encode(run)
                edge = np.append(0, np.cumsum([len(x) // 4 for x in ids])).astype(np.int32)
                flat = np.frombuffer(b"".join(ids), "<i4")
                lists.append(pa.ListArray.from_arrays(pa.array(edge), pa.array(flat)))
            yield pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))

    return of.asNondeterministic()(F.col(text))  # so that it is evaluated once


def _slices(part: pa.ListArray) -> Iterator[np.ndarray]:
    """The ids of each row of a list column as an array; null is empty."""
    flat = part.values.to_numpy(zero_copy_only=False)
    offsets = part.offsets.to_numpy(zero_copy_only=False)
    for i in range(len(part)):
        yield flat[offsets[i] : offsets[i + 1]] if part[i].is_valid else flat[:0]


def decoded(token: Callable[[int], bytes], ids: np.ndarray) -> str:
    """The text of token ids; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(token, ids.tolist())).decode("utf-8", "replace")


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> Column:
    """A string column: the texts of token ids; bytes that are no UTF-8 become U+FFFD."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("string")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = held.value.tokens.__getitem__
        for part in parts:
            yield pa.array([decoded(token, row) for row in _slices(part)], pa.string())

    return of.asNondeterministic()(F.col(ids))


DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> Column:
    """A struct column: number of tokens, SHA-256 of the ids of a whole text as little-endian
    unsigned 32-bit integers, and SHA-256 of the text that the ids decode to, in UTF-8.

    Encoding and decoding share one pass and one worker, so that ids leave it as digests only.
    """
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf(f"struct<{DIGESTS.replace(' ', ':').replace(',:', ',')}>")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, token = Encoder(held.value), held.value.tokens.__getitem__
        for part in parts:
            size, ids_hash, text_hash = [], [], []
            for run in runs(part):
                for ids in encoder.encode(run):
                    size.append(len(ids) // 4)
                    ids_hash.append(hashlib.sha256(ids).hexdigest())
                    text_hash.append(hashlib.sha256(decoded(token, np.frombuffer(ids, "<u4")).encode()).hexdigest())
            columns = [pa.array(size, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            yield pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256"])

    return of.asNondeterministic()(F.col(text))
