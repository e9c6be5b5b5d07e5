"""The operators of this package as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe_trie, codeswitch, curriculum, fingerprints, oddsketch, packing, prefix_trie, shards, skyband, subword, toxicity, vptree, warc
from .oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """The path of a file of the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary(name: str = "byte_bpe_50k.json") -> bpe_trie.Vocabulary:
    return bpe_trie.read_vocabulary(tokenizer_file(name))


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_table(table(spark, sf_dir, "documents"))


@query
def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign_shards(table(spark, sf_dir, "documents"))


@query
def op8_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.mix(table(spark, sf_dir, "documents")).drop("source")


@query
def op9_oddsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return oddsketch.near_duplicates(docs, size=3, threshold=Fraction(85, 100))


def fold(of: int):
    """crc32 of the id's text, modulo ``of``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold(5) != 0))
    scored = docs.select("doc_id", (fold(5) == 0).alias("held_out"), toxicity.score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op6_codeswitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = codeswitch.fit(docs.where(fold(4) != 2))
    told = docs.select("doc_id", (fold(4) == 2).alias("held_out"), codeswitch.language(docs, model).alias("told"))
    return told.select("doc_id", "held_out", F.col("told.lang").alias("lang_pred"), F.col("told.score").alias("score"))


@query
def op10_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = subword.fit(docs, labels.where(fold(4) != 2))
    scored = docs.select("doc_id", (fold(4) == 2).alias("held_out"), subword.score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.round_trip(table(spark, sf_dir, "pages"))
    page = lambda c: F.regexp_extract(c, "^urn:page:(-?[0-9]+):", 1).try_cast("bigint")
    rows = captures.select(
        page(F.col("capture_id")).alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        page(F.col("response.refers_to")).alias("refers_to"),
        F.col("request.target_uri").alias("url"),
        F.size("metadata").alias("n_metadata"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    )
    return rows.drop("copy")


@query
def op5_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = docs.select("doc_id", bpe_trie.round_trip(docs, vocabulary()).alias("told"))
    return told.select("doc_id", "told.*")


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


@query
def op12_skyband(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skyband.audit(table(spark, sf_dir, "documents"))


@query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    rows = pieces.withColumn("ids_crc32", F.crc32("ids").cast("bigint")).drop("ids")
    return packing.pack(rows)
