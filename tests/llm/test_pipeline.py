"""The pipeline's decisions, and that extra columns are carried through."""

import re
from collections import Counter

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from conftest import plan_of
from tidemark.llm import common, curriculum, toxicity
from tidemark.llm.queries import fold, tokenizer_file

SF = "/root/testdata/sf0.001"


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in queries()) == 1 for n in names) and "pipeline" in queries()
    assert set(oracle_sql()) <= set(queries())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = docs.count()
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns
        n = kept.count()
        assert 0.5 * seen < n <= seen
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert corpus_pipeline.STAGES[4][1](spark, docs, SF).count() == seen


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def text(n):
    return " ".join(f"w{n}x{i}" for i in range(40))


def test_repeated_rows_leave_one(spark):
    rows = [(1, text(1), "en", "s", 1)] * 20 + [(2, text(1) + " end", "en", "s", 1), (3, text(3), "en", "s", 1)]
    rows += [(3, text(4), "en", "s", 1)] * 2  # an id of two documents
    rows += [(5, " ", "en", "s", 1)] * 2 + [(6, " ", "en", "s", 1), (6, None, "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    want = [(1, text(1)), (3, text(3)), (3, text(4)), (5, " "), (6, " "), (6, None)]
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(want)


def test_repeated_rows_come_as_often_as_planned(spark):
    rows = [(1, text(1), "en", "s", 1)] * 12 + [(n, text(n), "en", f"s{n % 3}", 1) for n in range(2, 20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = curriculum.mix(docs).collect()
    mixed = corpus_pipeline.mixing(spark, docs, SF).collect()
    want = Counter()
    for r in plan:
        want[r.doc_id] += r.passes
    assert Counter(r.doc_id for r in mixed) == +want and max(want.values()) > 1
    assert Counter(r.doc_id for r in mixed)[1] <= 24


def test_rows_without_an_id_are_mixed(spark):
    rows = [(None, text(n), "en", f"s{n % 3}", 1) for n in range(40)] + [(n, text(n), "en", f"s{n % 3}", 1) for n in range(40, 80)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert corpus_pipeline.near_duplicates(spark, docs.unionAll(docs), SF).count() == len(rows)
    plan = Counter()
    for r in curriculum.mix(docs).collect():
        plan[r.source, r.doc_id is None] += r.passes
    mixed = corpus_pipeline.mixing(spark, docs, SF)
    assert Counter((r.source, r.doc_id is None) for r in mixed.collect()) == +plan
    assert plan["s0", True] == 28
    # which are taken rests on their texts
    again = corpus_pipeline.mixing(spark, docs.repartition(5, "text"), SF)
    assert Counter(r.text for r in again.collect()) == Counter(r.text for r in mixed.collect())


def test_rows_of_files_are_mixed_without_a_copy(spark, tmp_path):
    rows = [(1, text(1), "en", "s", 1)] * 12 + [(None, text(n), "en", f"s{n % 3}", 1) for n in range(2, 40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    assert common.keyed(stored, "k").select("k").distinct().count() == len(rows)
    assert "numbered" not in plan_of(common.keyed(stored, "k"))
    plan = Counter()
    for r in curriculum.mix(stored).collect():
        plan[r.source] += r.passes
    mixed = corpus_pipeline.mixing(spark, stored, SF)
    assert mixed.columns == docs.columns and Counter(r.source for r in mixed.collect()) == +plan
    # a plan that repeats rows of files has no key in them
    twice = stored.unionAll(stored)
    assert common.keyed(twice, "k").select("k").distinct().count() == 2 * len(rows)


EDGES = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, _row int, _told int, _score string, id int"


def test_stages_on_edge_cases(spark):
    """Empty tables, nulls in any column, empty and long texts, repeated rows and clashing names."""
    long = " ".join(f"word{i % 900} goes on" for i in range(30_000))
    some = [(1, text(1), "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0), (None, "lone text here", None, None, None),
            (4, long, "en", None, 1), (5, "!! 99", "en", "s", 1), (1, text(1), "en", "s", 1)]
    rows = [(*r, "x", 1, 2, "y", 3) for r in some]
    for name, stage in corpus_pipeline.STAGES:
        empty = spark.createDataFrame([], EDGES)
        assert stage(spark, empty, SF).count() == 0, name
        docs = spark.createDataFrame(rows, EDGES)
        out = stage(spark, docs, SF)
        got = out.collect()
        if name != "tokens":
            assert out.columns == docs.columns
        texts = Counter(r.text for r in got) if name != "tokens" else None
        if name == "language":
            assert texts == Counter({text(1): 2, "lone text here": 1, long: 1})
        if name == "toxicity":
            assert len(got) == len(rows)
        if name == "near_duplicates":
            assert texts == Counter(t for t in {r[1] for r in some})
        if name == "mixing":
            assert set(texts) <= {text(1), "lone text here", long, "!! 99"} and max(texts.values()) <= 4
        if name == "tokens":
            assert len(got) == len(rows) and {r.n_tokens for r in got if r.doc_id in (2, 3)} == {0}


def test_mixed_languages_are_no_ground_for_rejection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by = {r.lang: r.text for r in docs.where("lang is not null and length(text) > 300").collect()}
    mixture = " ".join(t[:200] for t in by.values())
    assert len(by) == 4
    mixed = spark.createDataFrame([(10**6, mixture, None, "s", len(mixture))], docs.schema)
    kept = corpus_pipeline.language(spark, docs.unionByName(mixed), SF)
    assert kept.where(f"doc_id = {10**6}").count() == 1
    nothing = spark.createDataFrame([(1, "un texto", None, "s", 8), (2, "77", None, "s", 2)], docs.schema)
    assert [r.doc_id for r in corpus_pipeline.language(spark, nothing, SF).collect()] == [1]


def test_run_from_end_to_end(spark, tmp_path):
    """run() over a small table, each stage held against its predecessor's rows in plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, stages = {"documents": docs.collect()}, list(corpus_pipeline.STAGES)
    for n, (name, stage) in enumerate(stages):
        def watched(spark, docs, sf_dir, name=name, stage=stage):
            seen[f"{name} in"] = docs.collect()
            return stage(spark, docs, sf_dir)

        stages[n] = (name, watched)
    plain, corpus_pipeline.STAGES = corpus_pipeline.STAGES, stages
    try:
        got = corpus_pipeline.run(spark, SF).collect()
    finally:
        corpus_pipeline.STAGES = plain
    texts = lambda key: Counter((r.doc_id, r.text) for r in seen[key])
    # language: those with a letter
    assert texts("language in") == texts("documents")
    assert texts("toxicity in") == Counter({k: n for k, n in texts("documents").items() if any(c.isalpha() for c in k[1] or "")})
    # toxicity: those under the score
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = spark.createDataFrame(seen["toxicity in"], docs.schema)
    model = toxicity.fit(rows, labels.where(fold(5) != 0))
    scored = rows.select("doc_id", "text", toxicity.score(rows, model).alias("score")).collect()
    assert texts("near_duplicates in") == Counter((r.doc_id, r.text) for r in scored if r.score < 0.5)
    # near duplicates: the least id of each group by shingles of five words
    sets = {}
    for i, t in texts("near_duplicates in"):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if w]
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    group = {i: i for i in sets}

    def top(i):
        return i if group[i] == i else top(group[i])

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                low, high = sorted((top(i), top(j)))
                group[high] = low
    kept = {i for i in sets if top(i) == i}
    assert {k[0] for k in texts("mixing in")} == kept and len(kept) < len(sets)
    # mixing: as often as planned
    plan = curriculum.mix(spark.createDataFrame(seen["mixing in"], docs.schema)).collect()
    want = Counter({r.doc_id: r.passes for r in plan})
    assert Counter(r.doc_id for r in seen["tokens in"]) == +want
    # tokens: as the library has them
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    ids = {r.doc_id: own.encode(r.text, add_special_tokens=False).ids for r in seen["tokens in"]}
    assert Counter(r.doc_id for r in got) == +want and all(r.ids == ids[r.doc_id] and r.n_tokens == len(r.ids) for r in got)
