"""The ten operators against brute force, and on nulls, empty and long texts, ties and empty tables."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe_trie, codeswitch, curriculum, fingerprints, oddsketch, shards, subword, toxicity, vptree, warc
from tidemark.llm.queries import vocabulary

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, shard string, _at int"
LONG = " ".join(f"w{i % 977} long" for i in range(40_000))
TEXTS = {
    1: "The quick brown fox jumps over the lazy dog and runs home again tonight.",
    2: "The quick brown fox jumps over the lazy dog and runs home again tonight.",
    3: "the QUICK brown\tfox jumps over the lazy dog and runs home again tonight.",
    4: None,
    5: "",
    6: "  \n ",
    7: LONG,
    8: LONG + " end",
    9: "one two",
    10: "naïve café <|endoftext|> 日本語 don't   stop  ",
    11: "123 %% !!",
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, None, 1, "x", 2) for i, t in TEXTS.items()]
    rows += [rows[0], (None, "no id here", None, None, None, 1, "x", 2)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_fingerprints(docs, empty):
    got = fingerprints.edited_fingerprints(docs, cells=4).collect()
    assert len(got) == docs.count() and fingerprints.edited_fingerprints(empty, cells=4).count() == 0
    order = sorted(((r.doc_id if r.doc_id is not None else -(1 << 63), r.text or "") for r in docs.collect()))
    want = set()
    for i, (key, text) in enumerate(order):
        after, half = order[(i + 1) % len(order)][1], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want.add((None if key == -(1 << 63) else key, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert {(r.doc_id, r.n_chars, r.edited_sha256) for r in got} == want
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint == by[3].fingerprint and by[4].fingerprint == by[5].fingerprint
    assert by[7].near_next > 0.9 and all(0 <= r.near_edited <= 1 for r in got)


def test_hamming_search_finds_all(spark):
    draw = np.random.default_rng(1)
    base = draw.integers(-(1 << 63), 1 << 63, 30, dtype=np.int64)
    flips = [int(b) ^ sum(1 << int(j) for j in draw.choice(62, int(k), False)) for b in base for k in range(6)]
    prints = sorted(set(flips))
    df = spark.createDataFrame([(x,) for x in [*prints, prints[0], None]], "fingerprint bigint")
    ask = spark.createDataFrame([(x,) for x in prints[::7]], "fingerprint bigint")
    mask = (1 << 64) - 1
    for radius, blocks in ((3, 5), (2, 3), (0, 1)):
        got = {(r.query_print, r.fingerprint) for r in fingerprints.within_radius(ask, df, radius=radius, blocks=blocks).collect()}
        assert got == {(q, p) for q in prints[::7] for p in prints if ((q ^ p) & mask).bit_count() <= radius}


def test_shards(docs, empty, spark):
    got = shards.assign_shards(docs).collect()
    assert shards.assign_shards(empty).count() == 0 and len(got) == docs.count()
    for r in got:
        text = (TEXTS.get(r.doc_id) or "") if r.doc_id is not None else "no id here"
        assert (r.size, r.text_crc32) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
        assert r.grown_shard in (r.shard, 8)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_a_changed_weight_moves_rows_of_its_subtree_only(spark):
    ids = spark.range(4000)
    before = shards.tree_of(8)
    after = shards.tree_of(8)
    after["region0"]["rack0"][1] = 3.0
    both = shards.shard_of(shards.shard_of(ids, "id", before, "a"), "id", after, "b").collect()
    assert all(r.a == r.b or r.b in (0, 1, 2, 3) for r in both)  # into the region that gained
    assert all(r.a == r.b or r.b == 1 for r in both if r.a in (0, 1))
    share = sum(r.b == 1 for r in both) / len(both)
    assert 0.25 < share < 0.35  # 3 of 10


def test_mix(docs, empty, spark):
    got = curriculum.mix(docs, cells=4).collect()
    assert curriculum.mix(empty).count() == 0 and len(got) == docs.count()
    sizes = {}
    for r in got:
        text = (TEXTS.get(r.doc_id) or "") if r.doc_id is not None else "no id here"
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text)) and 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] <= level * weight[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s], left = 2 * sizes[s], left - 2 * sizes[s]
        open_ -= full
    for s in names:
        mine = [r for r in got if r.source == s]
        assert all(r.target == pytest.approx(target[s]) and r.source_size == sizes[s] for r in mine)
        assert sum(r.taken for r in mine) == int(target[s] + 1e-9)
    assert curriculum.mixed_documents(docs).columns == docs.columns


def test_due_time_inverts_the_integral(spark):
    got = spark.range(1, 100).select(
        curriculum.due_time(F.col("id").cast("double"), F.lit(100.0), F.lit(0.5), F.lit(1.5)).alias("t"), "id"
    )
    for r in got.collect():
        assert 100 * (0.5 * r.t + 0.5 * r.t**2) == pytest.approx(r.id)


def _set(text, size):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


@pytest.mark.parametrize("size, threshold, block", [(3, Fraction(85, 100), 1024), (5, Fraction(8, 10), 4)])
def test_near_duplicates(spark, docs, empty, size, threshold, block):
    draw = np.random.default_rng(size)
    texts = dict(TEXTS)
    for group in range(4):
        base = [f"v{x}" for x in draw.integers(0, 500, 120)]
        for copy in range(14):
            words = list(base)
            for at in draw.choice(len(words), copy // 2, False):
                words[at] = f"u{draw.integers(0, 10**6)}"
            texts[100 * group + 50 + copy] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = rows(oddsketch.near_duplicates(df, size=size, threshold=threshold, block=block))
    sets = {i: _set(t, size) for i, t in texts.items()}
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a != b and both and both >= threshold * (len(sets[a]) + len(sets[b]) - both) and least[b] < least[a]:
                    least[a], changed = least[b], True
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), least[i], least[i] == i) for i in sets
    }


def test_near_duplicates_without_ids_or_rows(docs, empty):
    got = oddsketch.near_duplicates(docs).collect()
    assert len(got) == docs.count() and [r.kept for r in got if r.doc_id is None] == [True]
    assert oddsketch.near_duplicates(empty).count() == 0


def test_bpe_equals_the_tokenizers_library(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    words = vocabulary()
    coded = docs.select("doc_id", "text", bpe_trie.encode(docs, words).alias("ids"))
    got = coded.select("*", bpe_trie.decode(coded, words).alias("back")).collect()
    digests = {(r.text, *r.told) for r in docs.select("text", bpe_trie.round_trip(docs, words).alias("told")).collect()}
    for r in got:
        ids = own.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.back == (r.text or "")
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert (r.text, len(ids), sha, hashlib.sha256(r.back.encode()).hexdigest()) in digests
    assert empty.select(bpe_trie.round_trip(empty, words).alias("told")).count() == 0
    assert empty.select(bpe_trie.encode(empty, words).alias("ids")).count() == 0


def test_runs_keep_texts_whole():
    part = pa.array(["aaaa", None, "", "b" * 50, "cc", "dd", "é" * 9])
    for piece in (1, 3, 10, 1000):
        got = list(bpe_trie.runs(part, piece))
        assert [t for run in got for t in run] == [t or "" for t in part.to_pylist()]
        assert all(len(run) == 1 or len("".join(run).encode()) <= piece for run in got)


def test_forgetting_changes_nothing(monkeypatch):
    texts = [f"word{i} and {i * 7} more, again" for i in range(300)]
    want = bpe_trie.Encoder(vocabulary()).encode(texts)
    for bound in ("REMEMBERED", "REMEMBERED_BYTES", "REMEMBERED_PAIRS"):
        monkeypatch.setattr(bpe_trie, bound, 20)
    encoder = bpe_trie.Encoder(vocabulary())
    assert [ids for i in range(0, 300, 10) for ids in encoder.encode(texts[i : i + 10])] == want


def test_trie_on_many_words():
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    draw = np.random.default_rng(3)
    parts = ["ab", "aa", "the", "tion", "z", "ing", "Ġ", "é", "0", "er", "  ", "\n"]
    texts = ["".join(draw.choice(parts, draw.integers(1, 12))) for _ in range(3000)] + ["a" * 3000, " " * 500]
    coded = bpe_trie.Encoder(vocabulary()).encode(texts)
    for text, ids in zip(texts, coded):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode(text, add_special_tokens=False).ids, text


def test_vantage_points_are_exact_at_factor_one(spark):
    draw = np.random.default_rng(5)
    data = draw.integers(-9, 10, (700, 6)).astype(float).tolist()  # whole numbers: distances are exact
    vectors = [(i, v) for i, v in enumerate(data)] + [(700 + i, data[3]) for i in range(40)]
    bad = [(900, None), (1000, [0.0] * 6), (1100, [float("nan")] * 6), (None, data[0]), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [1.0])]
    df = spark.createDataFrame(vectors + bad, "vec_id bigint, embedding array<double>")
    got = vptree.nearest(df, df.where("vec_id % 100 = 0"), factor=1.0, per_shard=200, leaf=16).collect()
    x, ids = np.array([v for _, v in vectors]), np.array([i for i, _ in vectors])
    for q in range(0, 740, 100):
        far = np.sqrt(((x - x[q]) ** 2).sum(1))
        far[q] = np.inf
        order = np.lexsort((ids, far))[:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[1] for m in mine] == ids[order].tolist()
        assert [m[2] for m in mine] == pytest.approx(far[order].tolist(), rel=1e-14)
    assert {r.query_id for r in got} == set(range(0, 740, 100))
    assert vptree.nearest(df.limit(0), df).count() == 0


def test_warc_round_trip(spark):
    big = "<p>\r\n\r\nWARC/1.1\r\n\r\n" * 20
    pages = [(3, "http://a.b/x?y#z", big), (1, "http://a.b/1", big), (2, None, None), (4, "http://é\r\nX: y", "short"),
             (5, "u", "short"), (6, "http://a.b", "\r\n\r\n"), (1, "http://a.b/1", big), (None, "http://n", big + "é")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = warc.round_trip(df).collect()
    assert sum(r.copies for r in got) == len(pages)
    for r in got:
        key = r.capture_id.split(":")[2]
        html = next(p[2] or "" for p in pages if str(p[0]) == key or (p[0] is None and key == "null"))
        assert r.response.payload_bytes == len(html.encode())
        assert r.response.payload_digest == hashlib.sha256(html.encode()).hexdigest()
        assert r.response.type == ("revisit" if key == "3" else "response")
        assert r.request.headers["warc-type"] == "request" and len(r.metadata) >= 1
    three = next(r for r in got if r.capture_id.startswith("urn:page:3:"))
    assert three.response.refers_to in {r.capture_id for r in got if r.capture_id.startswith("urn:page:1:")}
    assert warc.round_trip(df.limit(0)).count() == 0


def test_transactions_join_in_either_direction(spark):
    row = lambda i, kind, other: (i, kind, None, None, other, None, {}, None, 0, None)
    records = [row("r1", "response", ["q1"]), row("q1", "request", []), row("m1", "metadata", ["q1"]),
               row("r2", "revisit", []), row("q2", "request", ["r2"]), row("r3", "response", []), row("m9", "metadata", ["none"])]
    got = rows(warc.assemble(spark.createDataFrame(records, warc.RECORD)), "capture_id")
    assert set(got) == {"r1", "r2", "r3"}
    assert got["r1"].request.record_id == "q1" and [m.record_id for m in got["r1"].metadata] == ["m1"]
    assert got["r2"].request.record_id == "q2" and got["r3"].request is None and got["r3"].metadata == []


@pytest.fixture(scope="module")
def labelled(spark):
    draw = np.random.default_rng(8)
    plain, nasty = [f"word{i}" for i in range(60)], ["vile", "awful"]
    out = []
    for i in range(600):
        words = list(draw.choice(plain, 30))
        toxic = int(i % 4 == 0)
        if toxic:
            words[3] = str(draw.choice(nasty))
        # one group is named more often in toxic texts
        if draw.random() < (0.8 if toxic else 0.1):
            words[7] = "muslims"
        elif draw.random() < 0.3:
            words[7] = "christians"
        good = int(i % 3 > 0)
        out.append((i, " ".join(words if good else [w.upper() + "$$" for w in words]), toxic, good))
    df = spark.createDataFrame(out, "doc_id bigint, text string, toxic int, quality int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic", "quality")


def test_toxicity_and_its_regulariser(spark, docs, empty, labelled):
    texts, labels = labelled
    model = toxicity.fit(texts, labels)
    plain = toxicity.fit(texts, labels, penalty=0.0)
    gap = lambda m: abs(float(np.diff(m.weights[toxicity.buckets_of(["muslims", "christians"])])[0]))
    assert gap(model) < 0.5 * gap(plain)
    probe = spark.createDataFrame([(1, "word1 vile word2"), (2, "word1 muslims word2")], "doc_id int, text string")
    got = rows(probe.select("doc_id", toxicity.score(probe, model).alias("s")))
    assert got[1].s > 0.5 > got[2].s
    scores = [r.s for r in docs.select(toxicity.score(docs, model).alias("s")).collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    none = toxicity.fit(texts, labels.limit(0))
    assert {r.s for r in docs.select(toxicity.score(docs, none).alias("s")).collect()} == {0.5}
    assert empty.select(toxicity.score(empty, model)).count() == 0


def test_quality(spark, docs, empty, labelled):
    texts, labels = labelled
    model = subword.fit(texts, labels, epochs=3)
    got = texts.withColumn("s", subword.score(texts, model)).join(labels, "doc_id").collect()
    assert sum((r.s >= 0.7) == bool(r.quality) for r in got) > 590
    scores = rows(docs.select("doc_id", subword.score(docs, model).alias("s")))
    assert scores[4].s == scores[5].s == 0.5 and all(0 <= r.s <= 1 for r in scores.values())
    assert empty.select(subword.score(empty, model)).count() == 0


def test_forward_backward_equals_enumeration():
    from itertools import product

    draw = np.random.default_rng(2)
    emission, follows, begin = draw.normal(size=(7, 3)), draw.normal(size=(3, 3)), np.array([0, 4, 5])
    share, pairs = codeswitch.forward_backward(emission, begin, follows, pairs=True)
    want, want_pairs = np.zeros((7, 3)), np.zeros((3, 3))
    for low, high in ((0, 4), (4, 5), (5, 7)):
        paths = list(product(range(3), repeat=high - low))
        score = np.array([np.exp(sum(emission[low + i, y] for i, y in enumerate(p)) + sum(follows[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        for p, s in zip(paths, score / score.sum()):
            for i, y in enumerate(p):
                want[low + i, y] += s
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += s
    assert np.allclose(share, want) and np.allclose(pairs, want_pairs)


def test_languages_of_words_and_documents(spark, docs, empty):
    draw = np.random.default_rng(9)
    stems = {"xx": ["bala", "bula", "bilo"], "yy": ["strk", "krst", "trsk"]}
    text = lambda k, n: " ".join(str(draw.choice(stems[k])) + str(draw.choice(["", "m", "n"])) for _ in range(n)) + ".\n"
    known = [(i, k, text(k, 12) + text(k, 9)) for i, k in enumerate(["xx", "yy"] * 60)]
    model = codeswitch.fit(spark.createDataFrame(known + [(999, None, "a"), (998, "xx", None)], "doc_id int, lang string, text string"))
    assert model.languages == ["xx", "yy"]
    mixed = spark.createDataFrame([(1, "bala bulam bilo bala strk krst trskn strk krst"), (2, None)], "doc_id bigint, text string")
    words = sorted(codeswitch.word_languages(mixed, model).collect(), key=lambda r: r.position)
    assert [r.lang for r in words] == ["xx"] * 4 + ["yy"] * 5
    told = rows(docs.select("doc_id", codeswitch.language(docs, model).alias("told")))
    assert all(told[i].told.lang == "und" and told[i].told.score == 0 for i in (4, 5, 6, 11))
    assert all(r.told.lang in ("xx", "yy") for i, r in told.items() if i not in (4, 5, 6, 11))
    assert empty.select(codeswitch.language(empty, model)).count() == 0
