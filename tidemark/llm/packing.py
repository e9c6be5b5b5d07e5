"""Packing of documents into training sequences of a fixed length.

A document's tokens, closed by an end token, are cut into pieces of a sequence's length if
there are more of them; nothing else is cut. Pieces are put into as few sequences as can be:

1. Pieces are dealt to cells of a few thousand, and a task packs a cell: the longest piece
   first, each into the fullest sequence that has room (best fit).
2. Where that takes more sequences than the tokens of the cell ask for, a local search works
   on the underfull ones: a piece is moved, or exchanged for one, or for two, of another
   sequence, where that makes the fuller one fuller, so that the sum of squared fills rises
   at every step, until sequences are empty or no such step is left.
3. What lies in sequences that have room left is dealt to fewer cells and packed anew, until
   one cell holds it or it doesn't shrink any more.

Only the lengths and keys of pieces are shuffled. A task holds the rows of a cell.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterable, Iterator
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .bpe_trie import byte_characters, runs
from .common import fresh, store

CAPACITY = 4096
END = 1
#: Expected pieces of a cell.
CELL = 8192
#: A sequence with at least this part of its length left (1 / ROOM) is packed again with others.
ROOM = 64
#: Rounds of the local search over the underfull sequences of a cell.
ROUNDS = 12
#: Words a worker remembers, their bytes, and the longest one remembered.
REMEMBERED = 500_000
REMEMBERED_BYTES = 32_000_000
LONGEST = 200

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_SMALL = [chr(c) for c in (*range(0xDF, 0xF7), *range(0xF8, 0x100))]
_PLAIN = re.compile(f"[a-z{''.join(_SMALL)}]+").fullmatch
_AS_BYTES = str.maketrans({c: "".join(map(byte_characters().__getitem__, c.encode())) for c in _SMALL})
#: The place behind a word's last letter or digit, where punctuation and then a blank follow.
_TAIL = re.compile(r"(?<=[a-zA-Z0-9\u00DF-\u00F6\u00F8-\u00FF])(?=[.,;:!?]+[ \n])")

PIECES = "piece int, start bigint, length bigint, ids binary"


class Words:
    """Token ids of texts by a vocabulary that lower-cases and cuts at white space.

    Nothing in the vocabulary's file may reach across a blank, and it must cut between a letter
    or digit and punctuation: then a text's ids are those of its words in a row. Each
    distinct word is encoded once by the tokenizers library, and its ids are remembered.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self):
        self.known, self.held = {"": b""}, 0

    def _words(self, text: str) -> list[str]:
        """What lies between blanks, with the punctuation behind a word set apart.

        Capitals of ASCII are lowered ahead, so that fewer words differ; special tokens are
        told by their case, so that texts which hold one are left as they are.
        """
        if not any(t in text for t in self.special):
            text = text.encode().translate(_LOWER).decode()
        return _TAIL.sub(" ", text).replace("\n", " ").replace("\t", " ").split(" ")

    def _encoded(self, words: Iterable[str]) -> dict[str, bytes]:
        plain, other = [], []
        for w in words:
            (plain if _PLAIN(w) else other).append(w)
        # small letters are their own normal form, and a word of them is one piece: only the
        # vocabulary's way to write bytes as characters is left to do
        tokenize = self.tokenizer.model.tokenize
        ids = [[t.id for t in tokenize(w if w.isascii() else w.translate(_AS_BYTES))] for w in plain]
        coded = self.tokenizer.encode_batch_fast(other, add_special_tokens=False)
        ids += [c.ids for c in coded]
        return {w: pack_ids(f"<{len(i)}I", *i) for w, i in zip(plain + other, ids)}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self._words(t) for t in texts]
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self._forget()
        known = self.known
        new = self._encoded(set().union(*cut) - known.keys())
        known.update(new)
        long = [w for w in new if len(w) > LONGEST]
        self.held += sum(map(len, new)) + sum(map(len, new.values()))
        out = [b"".join(map(known.__getitem__, words)) for words in cut]
        for w in long:
            self.held -= len(w) + len(known.pop(w))
        return out


def pieces(
    docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids (little-endian unsigned 32-bit integers).

    ``vocabulary`` is the path of a file of the tokenizers library, read by the driver. The ids
    of a text are those of its `encode` without added special tokens, then ``end``. A null
    text is empty and has the end token only. Repeated rows are documents of their own; ids
    may be null; no other column is read; an empty table gives no rows.
    """
    with open(vocabulary, encoding="utf-8") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        words, close = Words(held.value), np.array([end], "<u4").tobytes()
        for batch in batches:
            at = 0
            for texts in runs(batch.column(1)):
                row, piece, start, ids = [], [], [], []
                for i, coded in enumerate(words.encode(texts), at):
                    coded += close
                    for n, begin in enumerate(range(0, len(coded), 4 * capacity)):
                        row.append(i)
                        piece.append(n)
                        start.append(begin // 4)
                        ids.append(coded[begin : begin + 4 * capacity])
                at += len(texts)
                columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
                columns += [pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], names)

    rows = docs.select(F.col(id), F.col(text).cast("string"))
    names = [id, "piece", "start", "length", "ids"]
    return rows.mapInArrow(run, f"`{id}` {rows.schema[0].dataType.simpleString()}, {PIECES}")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Places of ``lengths`` by bin: longest first, each into the fullest bin with room for it."""
    bins: list[list[int]] = []
    open_: list[tuple[int, int]] = []  # (room, bin), sorted
    for place in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[place]
        at = bisect.bisect_left(open_, (size, -1))
        if at < len(open_):
            room, chosen = open_.pop(at)
            bins[chosen].append(place)
        else:
            room, chosen = capacity, len(bins)
            bins.append([place])
        if room > size:
            bisect.insort(open_, (room - size, chosen))
    return bins


class _Search:
    """Local search on the underfull bins of a cell."""

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int):
        self.lengths, self.bins, self.capacity = lengths, bins, capacity
        self.fill = [sum(lengths[i] for i in b) for b in bins]

    def units(self, b: int) -> tuple[list[tuple], list[tuple]]:
        """What may leave a bin: single pieces and pairs, one of each size, as (size, bin, places)."""
        by_size: dict[int, list[int]] = {}
        for i in self.bins[b]:
            by_size.setdefault(self.lengths[i], []).append(i)
        one = [(n, b, (places[0],)) for n, places in by_size.items()]
        two = {}
        for x, places in by_size.items():
            for y, others in by_size.items():
                if x < y:
                    two[x + y] = (x + y, b, (places[0], others[0]))
            if len(places) > 1:
                two[2 * x] = (2 * x, b, tuple(places[:2]))
        return one, list(two.values())

    def swap(self, into: int, gives: tuple, takes: tuple) -> None:
        """Bin ``into`` gives places and takes those of another bin."""
        size, other, places = takes
        grown = size - gives[0]
        self.bins[into] = [i for i in self.bins[into] if i not in gives[2]] + list(places)
        self.bins[other] = [i for i in self.bins[other] if i not in places] + list(gives[2])
        self.fill[into] += grown
        self.fill[other] -= grown

    def fill_up(self, b: int, singles: list[tuple], pairs: list[tuple]) -> int | None:
        """The best exchange that makes bin ``b`` fuller: the bin that gave, or None.

        ``singles`` and ``pairs`` are the units of the underfull bins, sorted. More goes to the
        bin than it gives, by at most its room; the squares rise if it ends up fuller than
        the other one was.
        """
        room, fill = self.capacity - self.fill[b], self.fill[b]
        one, two = self.units(b)
        best = (0, None, None)
        tries = [((0, b, ()), singles)]
        if len(self.bins[b]) > 1:  # to exchange its only piece makes no bin fuller than the fuller one was
            tries += [(u, offers) for u in one for offers in (singles, pairs)] + [(u, singles) for u in two]
        for gives, offers in tries:
            at = bisect.bisect_right(offers, (gives[0] + room, len(self.bins))) - 1
            while at >= 0 and offers[at][0] - gives[0] > best[0]:
                size, other, _ = offers[at]
                if other != b and fill + size - gives[0] > self.fill[other]:
                    best = (size - gives[0], gives, offers[at])
                    break
                at -= 1
        if not best[0]:
            return None
        self.swap(b, best[1], best[2])
        return best[2][1]

    def run(self, rounds: int) -> list[list[int]]:
        fewest = -(-sum(self.fill) // self.capacity)
        for _ in range(rounds):
            if sum(map(bool, self.bins)) <= fewest:
                break
            under = [b for b in range(len(self.bins)) if 0 < self.fill[b] < self.capacity]
            units = {b: self.units(b) for b in under}
            singles, pairs = (sorted(u for b in under for u in units[b][k]) for k in (0, 1))
            moved = False
            for b in sorted(under, key=lambda b: -self.fill[b]):
                while 0 < self.fill[b] < self.capacity:
                    other = self.fill_up(b, singles, pairs)
                    if other is None:
                        break
                    moved = True
                    for changed in (b, other):
                        for k, offers in enumerate((singles, pairs)):
                            for u in units[changed][k]:
                                del offers[bisect.bisect_left(offers, u)]
                        units[changed] = self.units(changed)
                        for k, offers in enumerate((singles, pairs)):
                            for u in units[changed][k]:
                                bisect.insort(offers, u)
            if not moved:
                break
        return [b for b in self.bins if b]


def pack_bins(lengths: list[int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[list[int]]:
    """Places of ``lengths`` by bin: best fit, then local search."""
    bins = best_fit(lengths, capacity)
    if len(bins) > -(-sum(lengths) // capacity):
        bins = _Search(lengths, bins, capacity).run(rounds)
    return bins


def pack(rows: DataFrame, capacity: int = CAPACITY, length: str = "length", cell: int = CELL, room: int = ROOM) -> DataFrame:
    """``rows`` with sequence_id and offset: a sequence's rows lie side by side from 0 and fill at most ``capacity``.

    ``length`` is a whole number from 1 to ``capacity``. The other columns are carried along, so
    leave out large ones; columns named sequence_id or offset are replaced. Equal rows are
    placed one by one; an empty table stays empty.
    """
    rows = rows.drop("sequence_id", "offset")
    round_, at, fill = (fresh([*rows.columns, "sequence_id", "offset"], c) for c in ("_round", "_cell", "_fill"))
    carried, added = rows.columns, ["sequence_id", "offset", fill]
    kind = StructType([*rows.schema.fields, *(StructField(c, LongType()) for c in added)])

    def packed(group: pa.Table) -> pa.Table:
        base = (group.column(round_)[0].as_py() << 56) + (group.column(at)[0].as_py() << 20)
        sizes = group.column(length).to_pylist()
        sequence, offset, full = (np.zeros(len(sizes), np.int64) for _ in range(3))
        for number, bin_ in enumerate(pack_bins(sizes, capacity)):
            begin = 0
            for place in bin_:
                sequence[place], offset[place] = base + number, begin
                begin += sizes[place]
            full[bin_] = begin
        columns = [group.column(c) for c in carried]
        return pa.table([*columns, pa.array(sequence), pa.array(offset), pa.array(full)], [*carried, *added])

    open_, done, before = store(rows, "pieces"), None, None
    for number in range(64):
        n = open_.count()
        cells = -(-n // cell) or 1
        # the number of a row of stored files doesn't change between attempts of a task
        dealt = F.pmod(F.xxhash64(F.lit(number), F.monotonically_increasing_id()), F.lit(cells))
        found = open_.withColumn(at, dealt).withColumn(round_, F.lit(number).cast("bigint")).groupBy(at).applyInArrow(packed, kind)
        found = store(found, "packed")
        last = cells == 1 or (before is not None and 2 * n > before)
        has_room = F.col(fill) <= capacity - max(1, capacity // room)
        kept = found if last else found.where(~has_room)
        kept = kept.drop(fill)
        done = kept if done is None else done.unionByName(kept)
        if last:
            return done
        open_, before = found.where(has_room).select(*carried), n
    return done


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """(sequence_id, n_tokens, n_pieces, ids): the tokens of each sequence in place."""
    row = F.sort_array(F.collect_list(F.struct("offset", F.col(ids).alias("ids"))))
    joined = F.aggregate(F.col("_rows"), F.lit(b""), lambda all_, r: F.concat(all_, r["ids"]))
    by = packed.groupBy("sequence_id").agg(row.alias("_rows"))
    by = by.select("sequence_id", F.size("_rows").alias("n_pieces"), joined.alias("ids"))
    return by.select("sequence_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), "n_pieces", "ids")
