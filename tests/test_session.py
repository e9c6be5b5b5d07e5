import os
from types import SimpleNamespace

import pytest

from tidemark import session


def fake(master, named=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: named or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_is_the_named_folder():
    assert session.scratch_root(fake("yarn", "/shared/checkpoints/")) == "/shared/checkpoints"
    one = session.scratch_dir(fake("yarn", "/shared"), "x")
    assert one.startswith("/shared/tidemark/x-") and one != session.scratch_dir(fake("yarn", "/shared"), "x")


def test_only_a_local_master_may_use_a_temporary_folder():
    assert session.scratch_root(fake("local[4]"))
    with pytest.raises(RuntimeError):
        session.scratch_root(fake("spark://master:7077"))


def test_cut_lineage_is_reliable(spark):
    df = session.cut_lineage(spark.range(10))
    assert df.count() == 10
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


def test_small_table_is_sized(spark):
    df = session.small_table(spark, [("a", 1), ("b", None)], "k string, v int")
    assert df.schema.simpleString() == "struct<k:string,v:int>"
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10_000


def test_workers_elsewhere_get_the_package(tmp_path):
    """A session started from another folder, with the package on the driver's path only."""
    import subprocess
    import sys

    code = """
import sys
sys.path.insert(0, %r)
from tidemark.session import local_session, ship
from tidemark.streaming.ingest import first_in_task
spark = local_session("elsewhere", "1")
ship(spark)
rows = spark.createDataFrame([("a",), ("a",), ("b",)], "event_id string").coalesce(1)
def there(batches):
    import tidemark.streaming.ingest
    yield from batches
print("rows", first_in_task(rows).mapInArrow(there, rows.schema).count())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code % root], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 2" in done.stdout, done.stderr[-2000:]
