"""The source audit against a plain version, and on nulls, ties, empty tables and clashing columns."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import skyband

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, total int, first string"


def plain(rows, least, top):
    """{(lang, source, part, item): (value, rank)} in plain Python."""
    rows = [(t or "", la or "", s or "") for _, t, la, s, *_ in rows]
    cut = lambda t: re.findall(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    docs, said, groups = defaultdict(Counter), defaultdict(Counter), {(la, s) for _, la, s in rows}
    for text, lang, source in rows:
        docs[lang].update(set(cut(text)))
        said[lang, source].update(cut(text))
    out = {}
    for lang, source in groups:
        kept = [w for w, n in docs[lang].items() if n >= least]
        mine = [s for la, s in groups if la == lang]
        whole = Counter()
        for s in mine:
            whole.update(said[lang, s])

        def shares(count):
            total = sum(count[w] for w in kept)
            return {w: 1 + 10**9 * (count[w] + 5) // (total + 5 * len(kept)) for w in kept}

        p = shares(said[lang, source])
        pair = [(s, sum(abs(p[w] - q) for w, q in shares(said[lang, s]).items())) for s in mine if s != source]
        q = shares(whole)
        term = [(w, p[w] - q[w]) for w in kept if said[lang, source][w] and p[w] > q[w]]
        for part, found in (("pair", pair), ("term", term)):
            found.sort(key=lambda f: (-f[1], f[0].encode()))
            for rank, (item, value) in enumerate(found if part == "pair" else found[:top], 1):
                out[lang, source, part, item] = (value, rank)
    return out


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(4)
    words = [f"w{a}{b}" for a in "abcdefgé" for b in "xyzß日"]
    out = []
    for i in range(400):
        said = draw.choice(words, int(draw.integers(1, 25)), p=np.arange(1, 41) / 820)
        lang, source = f"l{i % 3}" if i % 7 else None, f"s{int(draw.integers(0, 9))}" if i % 5 else None
        out.append((i, " ".join(said) + (" Wax, WAX7wax" if i % 2 else "--"), lang, source, "x", 1, "y"))
    out += [(900 + i, None, "l1", "silent", None, None, None) for i in range(3)]
    out += [(903, "", "none", "a", None, None, None), (904, " 12 ", "none", "b", None, None, None)]
    out += [(905, "one", "l\n", "x", None, None, None), (905, "one", "l", "\nx", None, None, None)]
    out.append((906, "wax " * 30_000 + "日" * 70_000, "l0", "s1", None, None, None))
    return out + out[:60]


def collected(df):
    return {(r.lang, r.source, r.part, r.item): (r.value, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("sizes", [{}, {"block": 7, "tile": 2}, {"top": 3, "least": 60}])
def test_audit_equals_a_plain_version(spark, rows, sizes):
    got = skyband.audit(spark.createDataFrame(rows, SCHEMA).repartition(3), **sizes)
    assert got.count() == len(collected(got))
    assert collected(got) == plain(rows, sizes.get("least", 30), sizes.get("top", 50))


def test_small_workers_change_nothing(spark, rows, monkeypatch):
    """Bounds of what is held are read where the functions are made: the counts are the same for any."""
    for bound, value in (("HELD", 5), ("PIECE", 10)):
        monkeypatch.setattr(skyband, bound, value)
    import pyarrow as pa

    names = ["lang", "source", "text"]
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (2, 3, 1)], names)
    said, docs = Counter(), Counter()
    for out in skyband._counted(iter([batch.slice(0, 50), batch.slice(50)])):
        for r in out.to_pylist():
            said[r["lang"], r["source"], r["term"]] += r["n"]
            docs[r["lang"], r["source"], r["term"]] += r["docs"]
    want, held = Counter(), Counter()
    for _, text, lang, source, *_ in rows:
        words = [w for part in skyband.terms((text or "").encode()) for w in part]
        want.update((lang or "", source or "", w.decode()) for w in words)
        held.update({(lang or "", source or "", w.decode()) for w in words})
    assert +said == want and +docs == held


def test_empty_table(spark):
    assert skyband.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_skyband_keeps_what_few_dominate():
    draw = np.random.default_rng(8)
    for k, n in ((1, 300), (5, 900), (50, 700)):
        high, low = draw.integers(1, 12, n), draw.integers(1, 40, n)
        words = [f"t{i}".encode() for i in draw.permutation(n)]
        got = set(skyband.skyband(high, low, words, k).tolist())
        over = lambda x, y: high[x] >= high[y] and low[x] <= low[y] and words[x] < words[y]
        assert got == {y for y in range(n) if sum(over(x, y) for x in range(n)) < k}


def test_shares_of_large_counts_are_exact():
    count = np.array([[10**13, 7, 0]])
    total = np.array([10**13 + 7])
    want = [1 + 10**9 * (c + 5) // (10**13 + 7 + 15) for c in (10**13, 7, 0)]
    assert skyband._shares(count, total, 3).tolist() == [want]
