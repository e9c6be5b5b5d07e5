"""A corpus from `documents`, in five stages.

Each stage reads what its predecessor kept, written as Parquet in between. All but
the last return the columns of `documents`:

* language: documents without a letter go;
* toxicity: documents scored 0.5 or more go;
* near-duplicates: one row of each group stays (five-word shingles, 0.8), also where rows
  repeat an id;
* mixing: sources give words by weight; a document comes as often as it is begun, in
  the order of training, and those that the mix has no room for go;
* tokens: token ids per document of the mix (doc_id, n_tokens, ids).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe_trie, codeswitch, curriculum, oddsketch, toxicity
from tidemark.llm.common import WORD, fresh, numbered, store
from tidemark.llm.queries import fold, table, vocabulary

#: Models and a tokenizer take part, which SQL can't express.
ORACLE_SQL = None

TOXIC = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents to whose words a learned language is given, of whatever mixture.

    Those without a letter (null and empty texts too) are rejected. Where no document has a
    language to learn from, each document with a letter stays. Equal rows share a fate; other
    columns are carried along; an empty table stays empty.
    """
    model = codeswitch.fit(docs.where(fold(4) != 2))
    told = fresh(docs.columns, "_told")
    known = docs.withColumn(told, codeswitch.language(docs, model))
    keep = F.col(f"{told}.lang") != codeswitch.UNKNOWN
    if not model.languages:
        keep = F.col("text").rlike(r"\p{L}")
    return known.where(keep).select(*docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under TOXIC by a model of the labelled ones; null and empty texts have a score too.

    Equal texts share a fate; other columns are carried along; an empty table stays empty.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(fold(5) != 0))
    score = fresh(docs.columns, "_score")
    return docs.withColumn(score, toxicity.score(docs, model)).where(F.col(score) < TOXIC).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, that of the least id; rows are told apart by number, not by id."""
    key = fresh([*docs.columns, "n_shingles", "component_id", "kept", "_id", "_blank"], "_row")
    rows = numbered(docs, key)
    # texts without words are in no group: they are repeated where the id is the same too
    blank = F.when(F.col("text").rlike(WORD), None).otherwise(F.col("text"))
    named = rows.select(key, F.col("doc_id").alias("_id"), blank.alias("_blank"))
    found = oddsketch.near_duplicates(rows, key).select(key, "n_shingles", "component_id").join(named, key)
    alone = (F.col("n_shingles") == 0) & F.col("_id").isNotNull()
    group = [
        F.when(~alone, F.col("component_id")).alias("_group"),
        F.when(alone, F.col("_id")).alias("_same_id"),
        F.when(alone, F.col("_blank")).alias("_same_text"),
    ]
    first = found.groupBy(*group).agg(F.min(F.struct(F.col("_id").isNull(), "_id", key)).alias("_first"))
    return rows.join(first.select(F.col(f"_first.{key}").alias(key)), key, "left_semi").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix begins them, in its order; see `curriculum.mixed_documents`.

    Texts without words (null too) give nothing and go. Repeated rows are documents of their own,
    also without an id; other columns are carried along; an empty table stays empty.
    """
    return curriculum.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each row's whole text; null and empty texts have no tokens."""
    ids = docs.select("doc_id", bpe_trie.encode(docs, vocabulary()).alias("ids"))
    return ids.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
