"""Helpers the operators share: whole tables in, scratch tables, gapless numbering, components."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from activity_mart.sources.store import new_path
from activity_mart.sources.store import stored as _stored

__all__ = ["components", "drop_folder", "drop_table", "few_files", "folders", "new_path", "recorded", "numbered", "parts_of", "ship", "stored", "table", "text_chunks", "text_of"]


_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, as ``--py-files`` does, unless they have it."""
    context = spark.sparkContext
    there = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if context.applicationId in _shipped or _PACKAGE.parent in there:
        return
    _shipped.add(context.applicationId)
    packed = shutil.make_archive(f"{tempfile.mkdtemp()}/{_PACKAGE.name}", "zip", _PACKAGE.parent, _PACKAGE.name)
    context.addPyFile(packed)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def parts_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_records: list[list[DataFrame]] = []


@contextmanager
def recorded() -> Iterator[list[DataFrame]]:
    """The tables stored inside the block, for the caller to drop once nothing reads them."""
    _records.append([])
    try:
        yield _records[-1]
    finally:
        _records.pop()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor costs a read, not the work before."""
    kept = _stored(df, label)
    for record in _records:
        record.append(kept)
    return kept


def folders(df: DataFrame) -> set[str]:
    return {file.rpartition("/")[0] for file in df.inputFiles()}


def few_files(df: DataFrame) -> DataFrame:
    """``df``, rows of a few numbers, in an eighth of the shuffle partitions: to be written as fewer and larger files."""
    return df.coalesce(max(8, parts_of(df.sparkSession) // 8))


def drop_table(df: DataFrame) -> None:
    """Remove the files under a stored table that nothing reads any more."""
    for folder in folders(df):
        drop_folder(df.sparkSession, folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, key: str, order: list[str], name: str, label: str) -> DataFrame:
    """``df`` with ``name``: a gapless number from 0 within each ``key``.

    Rows are range-partitioned by key and order, so that a key with any share of the rows is
    spread over tasks. A number is the row's place in its partition plus the rows of its key in
    earlier partitions; those sums have a row per key and partition, so ``key`` needs a bounded
    set of values, as shard numbers and piece lengths have.
    """
    spark = df.sparkSession
    placed = stored(
        df.repartitionByRange(parts_of(spark), key, *order)
        .sortWithinPartitions(key, *order)
        .withColumn("_at", F.monotonically_increasing_id()),
        label,
    ).withColumn("_part", F.shiftright("_at", 33))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy(key, "_part")
        .agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
        .select(key, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    )
    # At most a row per key and partition.
    return (
        placed.join(F.broadcast(runs), [key, "_part"])
        .withColumn(name, F.col("_at") + F.col("_shift"))
        .drop("_at", "_part", "_shift")
    )


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every node that has a link: columns ``node`` and ``component``.

    ``links`` has columns ``a`` and ``b`` and may repeat links or hold them in either direction.
    Alternates the large-star and small-star steps: each step regroups the links around the
    smallest neighbour, so that a long chain shortens by half in a round. A node's group is
    never gathered: both steps are a minimum and a join. Rounds end when the links are stars, whose
    nodes have one link each but for the smallest, and raise if ``rounds`` did not reach that.
    """
    spark = links.sparkSession
    edges = stored(few_files(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()), "links")
    if edges.isEmpty():
        kind = edges.schema["a"].dataType.simpleString()
        return spark.createDataFrame([], f"node {kind}, component {kind}")

    def star(pairs: DataFrame) -> DataFrame:
        """Every neighbour of a node with that node's smallest one, the node itself included."""
        lowest = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(lowest, "u")

    def stars(pairs: DataFrame) -> bool:
        ends = pairs.select(F.col("b").alias("u"), F.lit(1).alias("up")).unionByName(pairs.select(F.col("a").alias("u"), F.lit(0).alias("up")))
        return not ends.groupBy("u").agg(F.sum("up").alias("up"), F.count("*").alias("n")).filter("up > 0 AND n > 1").count()

    for _ in range(rounds):
        if stars(edges):
            nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
            return nodes.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = star(both).filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        down = large.filter("a <> b").select(F.col("b").alias("u"), F.col("a").alias("v"))
        small = star(down)
        after = small.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(small.select(F.col("m").alias("a"), F.col("u").alias("b")))
        after = stored(few_files(after.filter("a <> b").distinct()), "links")
        drop_table(edges)
        edges = after
    raise RuntimeError(f"components not settled after {rounds} rounds")


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        start, size = 0, 0
        for row, length in enumerate(pa.compute.binary_length(batch[column]).to_pylist()):
            if size and size + (length or 0) > limit:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length or 0
        if batch.num_rows > start:
            yield batch.slice(start)


SLOTS = 1 << 20


def slot(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SLOTS))


def slots(ids: DataFrame, column: str) -> DataFrame:
    """The hash slots that the ids fall in: ``SLOTS`` rows at most, so that it may be broadcast.

    A semi join with them lets through every row of these ids and few others, before the
    shuffle of an exact join; with more ids than slots it lets through more.
    """
    return ids.select(slot(column).alias("_slot")).distinct()


def without_ids(rows: DataFrame, dropped: DataFrame, column: str = "doc_id") -> DataFrame:
    """Rows whose id is not among the dropped ones; only rows in their slots are shuffled."""
    full = F.broadcast(slots(dropped, column))
    placed = rows.withColumn("_slot", slot(column))
    clear = placed.join(full, "_slot", "left_anti").drop("_slot")
    doubtful = placed.join(full, "_slot", "left_semi").drop("_slot")
    return clear.unionByName(doubtful.join(dropped.select(column), column, "left_anti"))
