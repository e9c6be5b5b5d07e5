"""Closed hours of the staging area as one folder each.

A stream leaves a folder per batch and hour. Once an hour is behind the newest landed hour by
more than the lateness allowed for, its folders are merged into one:

1. The rows of all hours due are written by one job to a hidden place, with a list of the folders
   they stand for (the journal) behind them.
2. Hour by hour, the new folder is moved into place, then the folders it stands for are deleted.
3. The hidden place is deleted.

A crash before the journal leaves nothing but the hidden place. After it, `compact` first finishes
what the journal says: a folder that isn't in place yet is moved there, and folders it stands for
are deleted. In between, readers may see an hour's rows twice, never not at all; the fact jobs
drop copies. A batch that lands in a closed hour adds a folder, which the next run merges.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import small_table
from .files import Files
from .schemas import staging_schema
from .staging import WRITER

LATENESS_HOURS = 2
HIDDEN = "_compacting"
JOURNAL = "hour string, folder string"


def landed_hours(files: Files, root: str, topic: str) -> dict[datetime.datetime, list[str]]:
    """Writers' folders of each hour, by folder names."""
    base, out = f"{root}/{topic}", {}
    for day in files.values(base, "dt"):
        if not day[0].isdigit():
            continue  # events without time
        for hr in files.values(f"{base}/dt={day}", "hr"):
            hour = datetime.datetime.combine(datetime.date.fromisoformat(day), datetime.time(int(hr)))
            out[hour] = files.values(f"{base}/dt={day}/hr={hr}", WRITER)
    return out


def closed_hours(hours: dict[datetime.datetime, list[str]], lateness_hours: int = LATENESS_HOURS) -> list[datetime.datetime]:
    """Hours of several folders that the newest hour has left behind."""
    if not hours:
        return []
    limit = max(hours) - datetime.timedelta(hours=lateness_hours)
    return sorted(h for h, folders in hours.items() if h < limit and len(folders) > 1)


def _place(hour: datetime.datetime) -> str:
    return f"dt={hour.date()}/hr={hour.hour}"


def _finish(spark: SparkSession, files: Files, root: str, topic: str, run: str) -> None:
    """Swaps folders as the journal of a run says; can be repeated after a crash at any point."""
    hidden = f"{root}/{HIDDEN}/{topic}/{run}"
    if not files.exists(f"{hidden}/journal/_SUCCESS"):
        files.delete(hidden)  # the run broke off before its rows were complete
        return
    # a row per folder of the hours due: names, no data
    journal = spark.read.schema(JOURNAL).json(f"{hidden}/journal").collect()
    swaps: dict[str, list[str]] = {}
    for row in journal:
        swaps.setdefault(row.hour, []).append(row.folder)
    for hour, folders in sorted(swaps.items()):
        place = _place(datetime.datetime.fromisoformat(hour))
        new, target = f"{hidden}/rows/{place}", f"{root}/{topic}/{place}/{WRITER}={run}"
        if files.exists(new):
            files.move(new, target)
        for folder in folders:
            files.delete(f"{root}/{topic}/{place}/{WRITER}={folder}")
    files.delete(hidden)


def _write(spark: SparkSession, root: str, topic: str, run: str, due: dict[datetime.datetime, list[str]]) -> None:
    """Step 1: the rows of the hours due, one file set per hour, then the journal."""
    hidden = f"{root}/{HIDDEN}/{topic}/{run}"
    paths = [f"{root}/{topic}/{_place(h)}/{WRITER}={f}" for h, folders in due.items() for f in folders]
    rows: DataFrame = spark.read.schema(staging_schema(topic)).option("basePath", f"{root}/{topic}").parquet(*paths)
    rows.drop(WRITER).hint("rebalance", "dt", "hr").write.partitionBy("dt", "hr").parquet(f"{hidden}/rows")
    swaps = [(str(h), f) for h, folders in due.items() for f in folders]
    small_table(spark, swaps, JOURNAL).coalesce(1).write.json(f"{hidden}/journal")


def compact(spark: SparkSession, root: str, topic: str, lateness_hours: int = LATENESS_HOURS) -> list[datetime.datetime]:
    """Merges the folders of the topic's closed hours; returns the hours.

    One compaction of a topic runs at a time. Rows and their ingestion times stay as they are.
    """
    files = Files(spark, root)
    for run in files.names(f"{root}/{HIDDEN}/{topic}"):
        _finish(spark, files, root, topic, run)
    hours = landed_hours(files, root, topic)
    due = {h: hours[h] for h in closed_hours(hours, lateness_hours)}
    if due:
        run = f"merged-{uuid.uuid4().hex}"
        _write(spark, root, topic, run, due)
        _finish(spark, files, root, topic, run)
    return list(due)
