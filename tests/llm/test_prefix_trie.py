"""The conversation trie against a plain version, and on nulls, ties, empty tables and clashing columns."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv int, depth string, digest int"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0, digest(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = (own.get(c // 100 * 100) or [])[:h] + ts[h:]
    members = defaultdict(set)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].add(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, of in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(of) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(whole[c]) == len(path))
        up = min(members[path[:-1]]) if path else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(of), len(path), up, len(of), children[path], leaves[path], saved[path], sha))
    return sorted(out)


def collected(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert df.columns == names
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(12)
    out = []
    for c in [*range(0, 60), *range(130, 190), 200, 250, 4096 * 3, 4096 * 3 + 5, 99_999, 10**15]:
        alike = draw.integers(0, 3)
        for n in range(int(draw.integers(1, 14))):
            text = f"turn {n} é" if alike else f"turn {n} of {draw.integers(0, 2)}"
            out.append((c, n * 3 - 2, ("user", "assistant", None)[n % 3], text, 1, "x", 2))
    out += [(300 + c, n, "user", f"copy {n}", 1, "x", 2) for c in range(40) for n in range(9)]  # copies
    out += [(5, 0, "user", "again", 1, "x", 2)] * 3 + [(5, None, "user", None, 1, "x", 2), (5, None, None, "", 1, "x", 2)]
    out += [(None, 1, "user", "no conversation", 1, "x", 2)]
    out += [(450, n, "user", f"first {n % 50}", 1, "x", 2) for n in range(700)]  # long ones, alike for 600 turns
    out += [(451, n, "user", f"first {n % 50}" if n < 600 else "other", 1, "x", 2) for n in range(640)]
    return out


@pytest.mark.parametrize("sizes", [{}, {"block": 1, "width": 2, "cell": 3}, {"block": 3, "width": 4, "cell": 16}, {"block": 64, "width": 2}])
def test_trie_equals_a_plain_version(spark, rows, sizes):
    got = prefix_trie.rebuilt_trie(spark.createDataFrame(rows, SCHEMA).repartition(3), **sizes)
    assert collected(got) == plain(rows)


def test_small_tables(spark):
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    one = [(7, 1, "user", "alone", 1, "x", 2)]  # crc32 takes its first turns, and there is no family
    assert collected(prefix_trie.rebuilt_trie(spark.createDataFrame(one, SCHEMA))) == plain(one)
    lost = [(None, 1, "user", "alone", 1, "x", 2)]
    assert prefix_trie.rebuilt_trie(spark.createDataFrame(lost, SCHEMA)).count() == 0


def test_turns_are_numbered_across_partitions(spark):
    """A conversation with most of the rows lies in many partitions."""
    rows = [(1, n, "user", f"t{n}", 1, "x", 2) for n in range(5000)] + [(c, 0, "user", "t", 1, "x", 2) for c in range(2, 300)]
    got = prefix_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA).repartition(8))
    want = {(1, n + 1, digest("user", f"t{n}")) for n in range(5000)} | {(c, 1, digest("user", "t")) for c in range(2, 300)}
    assert {(r.conv, r.position, r.digest) for r in got.collect()} == want
    parts = spark.sql("set spark.sql.adaptive.coalescePartitions.enabled").first()[1]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefix_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA).repartition(8))
        assert {(r.conv, r.position, r.digest) for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", parts)
