"""Warehouse tables as Parquet folders, one per ``schema/table``.

Facts and canonical metrics are partitioned by period and written with dynamic
partition overwrite, so a rerun replaces its own period and nothing else; one that
names its period replaces it with nothing if it yields no rows. The
user dimension is kept as dated snapshots: a run reads the snapshot before its
day and writes its own, so neither a rerun nor a crash can damage a table that
is being read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMAS = ["RAW", "STAGING", "WAREHOUSE", "CANONICAL", "SAFETY", "EXPORT"]


@dataclass
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, schema: str, table: str) -> str:
        if schema not in SCHEMAS:
            raise ValueError(f"no such schema: {schema}")
        return f"{self.root}/{schema}/{table}"

    def _fs(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def exists(self, table: str, schema: str = "WAREHOUSE") -> bool:
        fs, path = self._fs(self.path(schema, table))
        return fs.exists(path)

    def read(self, table: str, schema: str = "WAREHOUSE") -> DataFrame:
        return self.spark.read.parquet(self.path(schema, table))

    def write(
        self,
        df: DataFrame,
        table: str,
        schema: str = "WAREHOUSE",
        mode: str = "append",
        partition_by: list[str] | None = None,
        period: tuple[str, str] | None = None,
    ) -> None:
        """``append``, ``overwrite`` (whole table) or ``replace`` (the partitions in ``df``).

        ``period`` names the (column, value) of the one first-level partition that a
        ``replace`` is about: it is dropped if ``df`` turns out to be empty.
        """
        partition_by = partition_by or []
        if mode not in ("append", "overwrite", "replace"):
            raise ValueError(f"unknown mode: {mode}")
        if mode == "replace" and not partition_by:
            raise ValueError("replace needs partition columns")
        before = self._files(table, schema, period) if period else set()
        writer = (df.hint("rebalance", *partition_by) if partition_by else df).write
        writer = writer.option(
            "partitionOverwriteMode", "dynamic" if mode == "replace" else "static"
        )
        writer = writer.mode("append" if mode == "append" else "overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(schema, table))
        # Each write names its files anew: old names mean that nothing replaced them.
        if before & (self._files(table, schema, period) if period else set()):
            self.drop_partition(table, schema, *period)

    def _files(self, table: str, schema: str, period: tuple[str, str]) -> set[str]:
        """Paths of the files of a partition; no data is read."""
        fs, path = self._fs(f"{self.path(schema, table)}/{period[0]}={period[1]}")
        if not fs.exists(path):
            return set()
        found, files = set(), fs.listFiles(path, True)
        while files.hasNext():
            found.add(files.next().getPath().toString())
        return found

    def partitions(self, table: str, schema: str = "WAREHOUSE") -> list[tuple[str, str]]:
        """(column, value) of the first-level partitions; folder names only, no data."""
        fs, path = self._fs(self.path(schema, table))
        if not fs.exists(path):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(path)]
        return sorted(tuple(name.split("=", 1)) for name in names if "=" in name)

    def drop_partition(self, table: str, schema: str, column: str, value: str) -> None:
        fs, path = self._fs(f"{self.path(schema, table)}/{column}={value}")
        fs.delete(path, True)

    def write_snapshot(self, df: DataFrame, table: str, day: str) -> None:
        self.write(
            df.withColumn("snapshot", F.lit(day).cast("date")),
            table,
            mode="replace",
            partition_by=["snapshot"],
            period=("snapshot", day),
        )

    def read_snapshot(self, table: str, day: str, before: bool = False) -> DataFrame | None:
        """The newest snapshot up to ``day`` (or strictly before it), if any."""
        days = [d for _, d in self.partitions(table) if d < day or (d == day and not before)]
        if not days:
            return None
        newest = F.col("snapshot") == F.lit(max(days)).cast("date")
        return self.read(table).where(newest).drop("snapshot")
