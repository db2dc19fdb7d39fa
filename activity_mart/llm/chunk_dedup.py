"""Operator 5: substring dedup by content-defined chunks.

A gear rolling hash over the words, folded to lower case and one space apart, cuts a text after a
word where three bits of the hash are zero. They depend on the last twelve bytes alone, so a passage is
cut alike wherever it stands and whatever was inserted before it. A chunk that an earlier document
(by ``doc_id``) holds too, by its digest, is repeated. Runs of repeated chunks of at least
``MIN_WORDS`` words are taken out of all documents but the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_mart.llm.common import ship, slot, slots, stored, table, text_chunks, text_of
from activity_mart.llm.shingle_join import _SPACE, TEXT_CHUNK, mix, word_digests

# A chunk has eight words on average.
CUT_BITS = 3
MOST_WORDS = 24
# What is left of a passage of over 50 words once the chunks at its two ends, which share
# words with the text around it, are gone. Short chunks repeat by chance, but not in such a run.
MIN_WORDS = 24
_U = np.uint64
_GEAR = mix(np.arange(1001, 1257, dtype=_U)).astype(np.uint32)
_SHIFT = np.uint32(9)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash ``h = 2 h + GEAR[byte]`` in 32 bits at every byte, by doubling the window."""
    h = _GEAR[data]
    for span in (1, 2, 4, 8, 16):
        h[span:] = h[span:] + (h[:-span] << np.uint32(span))
    return h


def chunks(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """For each text its chunks' digests, the words where they begin and end, and its words."""
    plain = [b" ".join(t.encode().lower().split()) for t in texts]
    words, counts = word_digests(plain)
    made, at = [], 0
    for text, n in zip(plain, counts.tolist(), strict=True):
        own = words[at : at + n]
        at += n
        if not n:
            made.append((np.empty(0, dtype=_U), np.zeros(1, dtype=np.int64), 0))
            continue
        data = np.frombuffer(text, dtype=np.uint8)
        last = np.append(np.flatnonzero(data == 0x20) - 1, len(data) - 1)
        cut = (gear(data)[last] >> _SHIFT) & np.uint32((1 << CUT_BITS) - 1) == 0
        edges = np.unique(np.concatenate([[0], np.flatnonzero(cut) + 1, [n]]))
        # Where no cut comes, as in a run of one word, a chunk ends after MOST_WORDS.
        forced = [np.arange(a + MOST_WORDS, b, MOST_WORDS) for a, b in zip(edges[:-1], edges[1:], strict=True) if b - a > MOST_WORDS]
        edges = np.sort(np.concatenate([edges, *forced]))
        # A chunk's digest hashes its words with their places in it.
        place = (np.arange(n) - np.repeat(edges[:-1], np.diff(edges))).astype(_U)
        made.append((mix(np.add.reduceat(mix(own + place * _U(0x9E3779B97F4A7C15)), edges[:-1])), edges, n))
    return made


def _keys(docs: DataFrame) -> DataFrame:
    """``chunk, doc_id``, once for each document and chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text", TEXT_CHUNK):
            own = [np.unique(chunk) for chunk, _, _ in chunks(batch["text"].to_pylist())]
            ids = np.repeat(batch["doc_id"].to_numpy(), [len(c) for c in own])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own).view(np.int64)), pa.array(ids)], ["chunk", "doc_id"])

    return docs.filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "chunk long, doc_id long")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """``doc_id, chunks, first_docs``: each document's chunks that an earlier document has, and which one.

    Texts are cut and digested once; the digests are stored. A chunk that very many documents share
    is a minimum and a maximum of ids before the shuffle; its occurrences are joined with that one
    row, and Spark can split them.
    """
    keys = stored(_keys(docs), "chunk-digests")
    ends = keys.groupBy("chunk").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    repeated = stored(ends.filter("first_doc < last_doc").select("chunk", "first_doc"), "repeated-chunks")
    later = keys.join(repeated, "chunk").filter("first_doc < doc_id")
    # As many as the document has chunks.
    return later.groupBy("doc_id").agg(F.collect_list("chunk").alias("chunks"), F.collect_list("first_doc").alias("first_docs"))


def _runs(text: str, found: dict[int, int], min_words: int) -> tuple[str, int, int, list[dict], list[int]]:
    """The text without its repeated runs, its words, those taken out, the runs and their first documents."""
    ((chunk, edges, n),) = chunks([text])
    first = [found.get(c) for c in chunk.view(np.int64).tolist()]
    inside = np.repeat(np.array([d is not None for d in first], dtype=np.int8), np.diff(edges))
    steps = np.diff(np.r_[0, inside, 0].astype(np.int8))
    runs = [(a, b) for a, b in zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist(), strict=True) if b - a >= min_words]
    if not runs:
        return text, n, 0, [], []
    data = text.encode()
    letters = np.frombuffer(data, dtype=np.uint8)
    space = np.r_[True, _SPACE[letters]]
    starts = np.flatnonzero(space[:-1] & ~space[1:]).tolist() + [len(data)]
    spans = [{"start": starts[a], "end": starts[b]} for a, b in runs]
    kept, at = [], 0
    for span in spans:
        kept.append(data[at : span["start"]])
        at = span["end"]
    kept.append(data[at:])
    docs = {d for i, d in enumerate(first) if d is not None and any(a <= edges[i] < b for a, b in runs)}
    return b"".join(kept).decode(), n, sum(b - a for a, b in runs), spans, sorted(docs)


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_repeated_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("first_docs", T.ArrayType(T.LongType())),
    ]
)


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its columns, ``text`` without repeated runs, and the struct ``_repeats``.

    ``_repeats`` has the words, those taken out, the runs as byte spans of the old text, and
    the documents that keep them. The first document that holds a passage keeps it, and so does a
    document that repeats only itself. Null texts stay null; a row without id is left as it is,
    and makes no other row repeated. Rows with one id count as one document. A copy of a
    whole text of ``min_words`` words loses all of it. A very long text is cut whole, as a
    batch of its own. An empty table stays empty. Columns of ``docs`` may have any names;
    one that is named ``_repeats`` gives way to the result's.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.struct(*docs.columns).alias("_row"))
    found = stored(repeated_chunks(rows), "repeated-in-documents")
    full = F.broadcast(slots(found, "doc_id"))
    # A row without id is in no slot.
    placed = rows.withColumn("_slot", F.when(F.col("doc_id").isNotNull(), slot("doc_id")))
    clear = placed.join(full, "_slot", "left_anti")
    doubtful = placed.join(full, "_slot", "left_semi").join(found, "doc_id", "left")
    nothing = F.lit(None).cast("array<long>")
    both = clear.select("text", "_row", nothing.alias("chunks"), nothing.alias("first_docs")).unionByName(doubtful.select("text", "_row", "chunks", "first_docs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text", TEXT_CHUNK):
            texts, found = [], []
            for text, chunk, first in zip(*(batch[c].to_pylist() for c in ("text", "chunks", "first_docs")), strict=True):
                if chunk is None:
                    kept, n, gone, spans, docs = text, len(text.encode().split()), 0, [], []
                else:
                    kept, n, gone, spans, docs = _runs(text, dict(zip(chunk, first, strict=True)), min_words)
                texts.append(kept)
                found.append({"n_words": n, "n_repeated_words": gone, "spans": spans, "first_docs": docs})
            yield pa.RecordBatch.from_arrays([batch["_row"], pa.array(texts, pa.string()), pa.array(found, kind)], ["_row", "_text", "_repeats"])

    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("n_repeated_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("first_docs", pa.list_(pa.int64())),
        ]
    )
    schema = T.StructType([T.StructField("_row", rows.schema["_row"].dataType), T.StructField("_text", T.StringType()), T.StructField("_repeats", FOUND)])
    done = both.mapInArrow(run, schema)
    text = F.when(F.col("_row.text").isNull(), None).otherwise(F.col("_text"))
    return done.select(*[text.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns if c != "_repeats"], "_repeats")


def op5_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "_repeats.*", "text")
