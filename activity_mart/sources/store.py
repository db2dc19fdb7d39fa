"""Tables kept in the cluster's shared folder.

Marts are written once and read back, so a lost executor costs a re-read and not
a re-run of the joins behind them, and Spark sees real file sizes when it decides
what is small enough to broadcast.
"""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session; one that ends with the process only for an unset local run."""
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
    folder = f"{spark.conf.get('spark.local.dir', '/tmp')}/activity-mart-{spark.conf.get('spark.app.id')}"
    spark.conf.set(_CHECKPOINT_DIR, folder)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


_runs: ContextVar[str] = ContextVar("run", default="")


def new_path(spark: SparkSession, label: str) -> str:
    app = spark.conf.get("spark.app.id", "app")
    run = _runs.get()
    return f"{shared_folder(spark)}/activity_mart/{app}/{run and run + '/'}{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store; one that is not there is no error."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for all that the block stores, removed when it ends, after an error too.

    Outputs belong elsewhere: a frame over a table of the run can't be read after the block.
    """
    app = spark.conf.get("spark.app.id", "app")
    run = f"run-{uuid.uuid4().hex}"
    token = _runs.set(run)
    folder = f"{shared_folder(spark)}/activity_mart/{app}/{run}"
    try:
        yield folder
    finally:
        _runs.reset(token)
        remove(spark, folder)


def counted(
    df: DataFrame, counts: Sequence[Column], save: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, dict[str, int]]:
    """What ``save`` makes of ``df``, and one row of aggregates over it that the write itself takes.

    The frame is neither read again nor held: each task adds up its rows while it writes them.
    ``save`` must write the frame once, narrowly, before it returns. Sums over no rows are zero.
    """
    taken = Observation(f"counts-{uuid.uuid4().hex}")
    kept = save(df.observe(taken, *counts))
    found = taken.get
    return kept, {name: found.get(name) or 0 for name in df.agg(*counts).columns}


def stored(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under a fresh path and return a frame over the files."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def side_by_side[T](spark: SparkSession, writes: dict[str, Callable[[], T]]) -> dict[str, T]:
    """Run writes that do not depend on each other as concurrent Spark jobs."""
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        started = {
            name: pool.submit(copy_context().run, inheritable_thread_target(spark)(write)) for name, write in writes.items()
        }
        return {name: job.result() for name, job in started.items()}
