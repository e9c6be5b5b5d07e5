"""What the operators of this package share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_dir

#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SPACES = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def store(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read again.

    Cuts the lineage: later steps read files, so that a lost executor does not
    repeat what came before.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores put after it until no column is called so."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df``, stored, with a number per row as ``name``: equal rows are told apart by it.

    The numbers depend on how the input is dealt, hence the copy; zstd makes texts a quarter
    smaller than the default does.
    """
    return store(df.withColumn(name, F.monotonically_increasing_id()), "numbered", compression="zstd")


def keyed(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a key per row as ``name``: equal rows are told apart by it.

    A table as it was read from files has such a key already, the file (its path's hash) and the
    row's number there, so that nothing is copied. Rows of any other plan are numbered.
    """
    if df._jdf.queryExecution().analyzed().children().isEmpty():
        try:
            file = df.metadataColumn("_metadata")
            return df.withColumn(name, F.struct(F.xxhash64(file["file_path"]).alias("file"), file["row_index"].alias("row")))
        except AnalysisException:  # no files: a local table
            pass
    return numbered(df, name)


def uniform(seed: str, *keys: Column) -> Column:
    """A hash draw in (0, 1): the same for equal keys and seed in every run."""
    top = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11).cast("double")
    return (top + F.lit(0.5)) / F.lit(float(1 << 53))


def labelled_sample(
    docs: DataFrame, by: str, rows: int, seed: str, id: str = "doc_id"
) -> DataFrame:
    """About ``rows`` rows of each value of ``by``, chosen by a hash of the id.

    The bound is on the expected number; the count of a value varies around it by
    its square root. Values with fewer rows are taken whole. ``by`` must have few
    values (labels, languages): one count each comes to the driver.
    """
    counts = docs.groupBy(by).count().collect()
    share = F.lit(0.0)
    for value, n in sorted(((r[0], r[1]) for r in counts if r[0] is not None), key=lambda x: str(x[0])):
        share = F.when(F.col(by) == F.lit(value), F.lit(min(1.0, rows / n))).otherwise(share)
    return docs.where(uniform(seed, F.col(id)) < share)


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession
