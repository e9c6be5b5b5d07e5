"""Packed sequences against the tokenizers library and brute force, and on nulls, empty tables and ties."""

import zlib

import numpy as np
import pytest

from tidemark.llm import packing
from tidemark.llm.queries import QUERIES, tokenizer_file

SF = "/root/testdata/sf0.001"
FILE = tokenizer_file("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, sequence_id string, `offset` int, length string, _cell int"
TEXTS = [
    None, "", " \n\t ", "One two's THREE, 4567!", "a<|endoftext|>b <|startoftext|> c", "na\u00efve nai\u0308ve \u0301x \u03a3\u03a3 \u0130",
    "x\u00a0y\u2003z\x1cw\x85v\r\nu\x0bt", "\u65e5\u672c\u8a9e \U0001f600 " * 30, "don't  stop   won'T", "w" * 3000 + " " + "7" * 500,
    " ".join(f"word{i} tail" for i in range(9000)),
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [packing.END]


def test_words_equal_the_library(library):
    draw = np.random.default_rng(2)
    parts = ["ab", "The", " ", ", ", ".. ", "!?\\n", "\u00dc", "\u0130. ", "\u0301, ", "\u00e9; ", "\u65e5. ", "<|", "|>", "9: ", "  ", "\n", "\t", "'s", "<|endoftext|>", "\u00e9", "e\u0301", "\u0301", "9", "!", "\u3000", "\x1e", "\u03a3", "ing"]
    texts = [t or "" for t in TEXTS] + ["".join(draw.choice(parts, draw.integers(1, 14))) for _ in range(3000)]
    words = packing.Words(open(FILE, encoding="utf-8").read())
    for text, got in zip(texts, words.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == ids(library, text)[:-1], text


def test_forgetting_changes_nothing(monkeypatch):
    texts = [f"word{i} and {i * 7} more, again" for i in range(300)]
    spec = open(FILE, encoding="utf-8").read()
    want = packing.Words(spec).encode(texts)
    for bound in ("REMEMBERED", "REMEMBERED_BYTES", "LONGEST"):
        monkeypatch.setattr(packing, bound, 4)
    words = packing.Words(spec)
    assert [x for i in range(0, 300, 10) for x in words.encode(texts[i : i + 10])] == want


def check(rows, capacity, length="length"):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r[length]))
    for parts in by.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= capacity
    return len(by)


def test_pieces_and_sequences(spark, library):
    rows = [(i, t, "x", 1, "y", 2) for i, t in enumerate(TEXTS)] + [(None, "no id", None, None, None, None)] * 40
    docs = spark.createDataFrame(rows, SCHEMA)
    cut = packing.pieces(docs, FILE, capacity=64)
    whole = {}
    for r in cut.collect():
        got = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(got) and r.start == r.piece * 64
        if r.doc_id is not None:
            whole.setdefault(r.doc_id, {})[r.piece] = got
    for i, text in enumerate(TEXTS):
        parts = [whole[i][n] for n in range(len(whole[i]))]
        assert sum(parts, []) == ids(library, text) and all(len(p) == 64 for p in parts[:-1])
    packed = packing.pack(cut, 64, cell=16)
    got = packed.collect()
    assert len(got) == cut.count() and packed.columns == [*cut.columns, "sequence_id", "offset"]
    check(got, 64)
    out = packing.sequences(packed).collect()
    assert sum(r.n_tokens for r in out) == sum(r.length for r in got)
    sequence = {r.sequence_id: r for r in out}
    for r in got:
        assert sequence[r.sequence_id].ids[4 * r.offset : 4 * (r.offset + r.length)] == r.ids


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op13_packing"](spark, SF).collect()
    n = check(got, packing.CAPACITY)
    seen = {}
    for r in got:
        coded = np.array(ids(library, docs[r.doc_id])[r.start : r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(coded) == r.ids_crc32
        seen.setdefault(r.doc_id, []).append((r.start, r.piece, r.length))
    assert set(seen) == set(docs)
    for i, parts in seen.items():
        parts.sort()
        assert [p[0] for p in parts] == [4096 * k for k in range(len(parts))] and [p[1] for p in parts] == list(range(len(parts)))
        assert sum(p[2] for p in parts) == len(ids(library, docs[i]))
    assert n <= -(-sum(r.length for r in got) // 4096) + 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    cut = packing.pieces(empty, FILE)
    assert cut.count() == 0 and packing.pack(cut).count() == 0
    assert packing.sequences(packing.pack(cut)).count() == 0


def test_cells_are_merged(spark):
    """Many small cells, each with a rest, end up with hardly more sequences than one cell has."""
    draw = np.random.default_rng(6)
    sizes = [int(n) for n in draw.integers(1, 700, 2000)]
    rows = spark.createDataFrame([(n, "same") for n in sizes], "length int, note string").repartition(4)
    got = packing.pack(rows, 1000, cell=50).collect()
    assert sorted(r.length for r in got) == sorted(sizes)
    assert check(got, 1000) <= -(-sum(sizes) // 1000) + 8
    same = spark.createDataFrame([(7, "same")] * 1000, "length int, note string")
    assert check(packing.pack(same, 70, cell=64).collect(), 70) <= 104


def least_bins(sizes, capacity):
    """The fewest bins there can be, by search."""
    best = [len(sizes)]

    def place(i, room):
        if len(room) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(room)
            return
        for r in sorted({r for r in room if r >= sizes[i]}):
            at = room.index(r)
            place(i + 1, room[:at] + [r - sizes[i]] + room[at + 1 :])
        place(i + 1, [*room, capacity - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best[0]


def test_local_search_nears_the_fewest_bins():
    draw = np.random.default_rng(7)
    fitted = searched = fewest = 0
    for _ in range(150):
        sizes = draw.integers(18, 55, 11).tolist()
        first = packing.best_fit(sizes, 100)
        got = packing.pack_bins(sizes, 100)
        assert sorted(i for b in got for i in b) == list(range(11)) and all(sum(sizes[i] for i in b) <= 100 for b in got)
        fitted, searched, fewest = fitted + len(first), searched + len(got), fewest + least_bins(sizes, 100)
    assert fewest <= searched <= fitted and (searched - fewest) * 2 <= fitted - fewest


def test_each_step_raises_the_squares(monkeypatch):
    draw = np.random.default_rng(9)
    kinds, squares = set(), []
    plain = packing._Search.swap

    def watched(self, into, gives, takes):
        before = sum(f * f for f in self.fill)
        plain(self, into, gives, takes)
        assert sum(f * f for f in self.fill) > before and self.fill == [sum(self.lengths[i] for i in b) for b in self.bins]
        kinds.add((len(takes[2]), len(gives[2])))
        squares.append(1)

    monkeypatch.setattr(packing._Search, "swap", watched)
    for _ in range(60):
        sizes = draw.integers(5, 34, 60).tolist()
        bins = [[i, i + 1, i + 2] for i in range(0, 60, 3)]  # a poor start leaves much to do
        got = packing._Search(sizes, bins, 100).run(50)
        assert sorted(i for b in got for i in b) == list(range(60)) and len(got) <= 20
    assert kinds == {(1, 0), (1, 1), (2, 1), (1, 2)} and squares
