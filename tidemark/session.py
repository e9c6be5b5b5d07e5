"""Session settings the operators rely on, and where scratch data may live."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Shuffle width is left to the cluster: AQE starts wide and coalesces by size.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming sessions are merged ahead of the shuffle, so that a very active
    # user sends sessions and not events.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, which need it wherever a function runs in them.

    Not needed where it is installed on each node or named by ``--py-files``.
    """
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-ship-"), "tidemark.zip")  # read by the driver only
    with zipfile.ZipFile(target, "w") as packed:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.join("tidemark", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(target)


def local_session(app: str = "tidemark", cores: str = "8", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Fixed rows as a local relation, whose size the planner knows."""
    names = [field.strip().split(" ")[0] for field in schema.split(",")]
    columns = {name: [row[i] for row in rows] for i, name in enumerate(names)}
    table = spark.createDataFrame(pa.table(columns))
    return table.select(
        *[
            table[name].cast(field.strip().split(" ", 1)[1]).alias(name)
            for name, field in zip(names, schema.split(","))
        ]
    )


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_root()
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def scratch_dir(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so a lost executor does not replay the upstream work."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint()
