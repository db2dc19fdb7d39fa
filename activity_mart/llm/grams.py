"""Six-byte n-grams of whole texts: counts over all of them, and sums over each text's own n-grams.

An n-gram is a number of 48 bits, so that 16 bits are left for a small number beside it: its place
is sorted with it, which brings equal n-grams together in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_mart.llm.common import stored, text_chunks

# Texts to the n-grams that end at each of their bytes, as numbers, and how many each text has.
Cut = Callable[[list], tuple[np.ndarray, np.ndarray]]
Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

# A table of at most so many n-grams goes to every task (96 MB with two numbers each); a larger one is joined.
SENT_GRAMS = 4_000_000
# Rows of one slice, distinct n-grams that a task adds up before it hands them on, and rows that it hands on at once.
SLICE_ROWS = 1 << 16
SUMMED_GRAMS = 2_000_000
SENT_TOGETHER = 200_000
_LOW = np.uint64(16)


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches, column):
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def _sorted(grams: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams in order, each with the number beside it."""
    both = np.sort(grams.astype(np.uint64) << _LOW | beside.astype(np.uint64))
    return both >> _LOW, (both & np.uint64(SLICE_ROWS - 1)).astype(np.int64)


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, dtype=np.int64)


def _merged(held: list[tuple[np.ndarray, list[np.ndarray]]], classes: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """One list of all; empties ``held``, so that its arrays and their sums aren't in memory together."""
    if len(held) == 1:
        return held.pop()
    grams = np.concatenate([g for g, _ in held])
    n = [n for _, n in held]
    held.clear()
    order = np.argsort(grams, kind="stable").astype(np.int32)
    grams = grams[order]
    at = _starts(grams)
    grams = grams[at]
    return grams, [np.add.reduceat(np.concatenate([own[i] for own in n])[order], at, dtype=np.int64) for i in range(classes)]


def counts(docs: DataFrame, cut: Cut, classes: int) -> DataFrame:
    """``gram`` of every text, and ``n0``, ``n1``, ...: its places in the texts of each class.

    ``docs`` has ``text`` and ``class``, which is null for a text that counts for none. Each task sends its sums.
    """
    names = [f"n{i}" for i in range(classes)]

    def batches_of(grams: np.ndarray, n: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(grams), SENT_TOGETHER):
            part = slice(start, start + SENT_TOGETHER)
            yield pa.RecordBatch.from_arrays([pa.array(grams[part].view(np.int64)), *[pa.array(own[part].astype(np.int64)) for own in n]], ["gram", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, list[np.ndarray]]] = []
        for batch in _slices(batches, "text"):
            grams, lengths = cut(batch["text"].to_pylist())
            own = batch["class"].fill_null(classes).to_numpy()
            ordered, kind = _sorted(grams, np.repeat(own, lengths))
            at = _starts(ordered)
            upto = [np.r_[0, np.cumsum(kind == i)] for i in range(classes)]
            ends = np.r_[at[1:], len(ordered)]
            held.append((ordered[at], [(u[ends] - u[at]).astype(np.int32) for u in upto]))
            if sum(len(g) for g, _ in held) > SUMMED_GRAMS:
                held = [_merged(held, classes)]
                if len(held[0][0]) > SUMMED_GRAMS // 2:
                    yield from batches_of(*held.pop())
        if held:
            yield from batches_of(*_merged(held, classes))

    schema = ", ".join(f"{name} long" for name in ("gram", *names))
    made = docs.select("text", F.col("class").cast("int").alias("class")).mapInArrow(run, schema)
    return made.groupBy("gram").agg(*[F.sum(name).alias(name) for name in names])


def _text_sums(texts: list, cut: Cut, keys: np.ndarray, values: list[np.ndarray]) -> list[pa.Array]:
    """For each text and each of ``values``, their sum over the text's n-grams, which all are among the sorted ``keys``."""
    grams, lengths = cut(texts)
    ordered, row = _sorted(grams, np.repeat(np.arange(len(texts)), lengths))
    at = _starts(ordered)
    place = np.repeat(np.searchsorted(keys, ordered[at]), np.diff(np.r_[at, len(ordered)]))
    return [pa.array(np.bincount(row, own[place], len(texts))) for own in values]


def sums(
    docs: DataFrame, cut: Cut, table: DataFrame, names: list[str], sent: int = SENT_GRAMS, drop_text: bool = False, then: tuple[Batches, str] | None = None
) -> DataFrame:
    """``docs`` (with ``text``) and, for each of ``names``, the sum of that column of ``table`` over the text's n-grams.

    ``table`` has every n-gram of the texts once, as ``gram``, with numbers under ``names``. A large one is
    not sent: a chunk of texts asks for its distinct n-grams by a join, and meets the answers in one task.
    ``then``, a function of batches and its schema, is applied to the rows; with a table that is sent, in the same worker.
    """
    columns = [c for c in docs.columns if not (drop_text and c == "text")]
    fields = [T.StructField(name, T.DoubleType()) for name in names]
    schema = T.StructType([*[docs.schema[c] for c in columns], *fields])
    if table.count() <= sent:
        rows = table.select("gram", *names).orderBy("gram").toArrow()
        tables = docs.sparkSession.sparkContext.broadcast((rows["gram"].to_numpy().astype(np.uint64), [rows[name].to_numpy() for name in names]))
        del rows
        pa.default_memory_pool().release_unused()

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, values = tables.value
            for batch in _slices(batches, "text"):
                made = _text_sums(batch["text"].to_pylist(), cut, keys, values)
                yield pa.RecordBatch.from_arrays([*[batch[c] for c in columns], *made], [*columns, *names])

        if then is None:
            return docs.mapInArrow(score, schema)
        after, kinds = then
        return docs.mapInArrow(lambda batches: after(score(batches)), kinds)

    every = docs.columns

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, batch in enumerate(_slices(batches, "text")):
            name = pa.array(np.full(batch.num_rows, TaskContext.get().partitionId() << 32 | i, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, name], [*every, "_chunk"])

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch["_chunk"].to_numpy()
            edges = np.r_[_starts(chunks), len(chunks)]
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                grams = np.unique(cut(batch["text"].slice(start, end - start).to_pylist())[0]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), chunks[start])), pa.array(grams)], ["_chunk", "gram"])

    def answered(texts: pa.Table, found: pa.Table) -> pa.Table:
        keys = found["gram"].to_numpy()
        order = np.argsort(keys)
        made = _text_sums(texts["text"].to_pylist(), cut, keys[order].astype(np.uint64), [found[name].to_numpy()[order] for name in names])
        return pa.Table.from_arrays([*[texts[c] for c in columns], *made], [*columns, *names])

    placed = stored(docs.mapInArrow(chunked, T.StructType([*docs.schema.fields, T.StructField("_chunk", T.LongType())])), "text-chunks")
    found = placed.select("_chunk", "text").mapInArrow(wanted, "_chunk long, gram long").join(table.select("gram", *names), "gram")
    made = placed.groupBy("_chunk").cogroup(found.groupBy("_chunk")).applyInArrow(answered, schema)
    return made if then is None else made.mapInArrow(*then)
