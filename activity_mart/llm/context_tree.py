"""Operator 7: language-model scoring by context-tree weighting.

The model reads a text as its words, folded for A to Z, each followed by a space, and an end. A byte
is eight binary decisions; a decision's node is the bits before it and the up to ``DEPTH`` bytes before
that in the text. A node's Krichevsky-Trofimov estimate counts the training bits seen there, and its
weighted probability is half that estimate's and half the product of its children's. The share
of either gives the weight of each depth in a prediction, so all depths are mixed.

A text's code length is a sum over its contexts with their next bytes, whose bits are worked out in shards.
For the base score documents are inverted: a row is a word with its places in a chunk of documents.
Word counts, context counts and scores are sums and joins by word, by context and by chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_mart.llm import grams as n_grams
from activity_mart.llm.common import drop_table, ship, stored, table, text_chunks, text_of

DEPTH = 5
FOLDS, HELD_OUT = 5, 1
CHUNK = 6_000_000
SUMMED_TOGETHER = 400_000
END = b""
_U = np.uint64
_SPACE, _LINE = 0x20, 0x0A
_START = int.from_bytes(b" " * DEPTH, "big")
CHUNKS = "chunk long, word binary, train long, places array<int>, counts array<int>, ids array<long>, held array<boolean>, bits array<double>"


def held_out(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def _inverted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each word of a chunk of documents (``doc_id, held, text, bits``), and one without word that lists the documents."""
    for i, batch in enumerate(text_chunks(batches, "text", CHUNK)):
        name = TaskContext.get().partitionId() << 32 | i
        held, size = batch["held"].to_numpy(zero_copy_only=False), batch.num_rows
        own: list[pa.Array] = [pa.array(text.as_py().lower().split(), pa.binary()) for text in batch["text"]]
        place = np.repeat(np.arange(size), [len(words) for words in own])
        coded = pa.concat_arrays(own).dictionary_encode()
        del own
        n = len(coded.dictionary)
        # The end is the last word, once in each document.
        code = np.r_[coded.indices.to_numpy().astype(np.int64), np.full(size, n)]
        pairs, times = np.unique(code * size + np.r_[place, np.arange(size)], return_counts=True)
        word, place = pairs // size, pairs % size
        ends = pa.array(np.searchsorted(word, np.arange(n + 2)).astype(np.int32))
        train = np.bincount(word, np.where(held[place], 0, times), n + 1).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n + 1, name, dtype=np.int64)),
                pa.concat_arrays([coded.dictionary, pa.array([END], pa.binary())]),
                pa.array(train),
                pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                pa.nulls(n + 1, pa.list_(pa.int64())),
                pa.nulls(n + 1, pa.list_(pa.bool_())),
                pa.nulls(n + 1, pa.list_(pa.float64())),
            ],
            NAMES,
        )
        ids = batch["doc_id"]
        listed = (ids.fill_null(0).to_pylist(), pa.int64()), (held.tolist(), pa.bool_()), (batch["bits"].to_pylist(), pa.float64())
        documents = [pa.array([v], pa.list_(t)) for v, t in listed]
        # The places of a row without word are marks of documents without id.
        marks = pa.array([ids.is_null().cast(pa.int32()).to_pylist()], pa.list_(pa.int32()))
        empty = [pa.nulls(1, t) for t in (pa.binary(), pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), *empty, marks, pa.nulls(1, pa.list_(pa.int32())), *documents], NAMES)


NAMES = [part.split()[0] for part in CHUNKS.split(", ")]
# Places and counts go to disk as one column.
PACKED = CHUNKS.replace("places array<int>, counts array<int>", "postings binary")


def _short(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers as bytes of seven bits each, lowest first and all but a number's last marked, and where each number ends."""
    sizes = 1 + sum((numbers >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    ends = np.cumsum(sizes)
    data = np.empty(sizes.sum(), dtype=np.uint8)
    for k in range(sizes.max(initial=0)):
        own = sizes > k
        data[(ends - sizes)[own] + k] = numbers[own] >> 7 * k & 127 | np.where(sizes[own] > k + 1, 128, 0)
    return data, ends


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``CHUNKS`` as ``PACKED``: a word's places, as steps, each with its count, in short numbers; a row without word has a byte for each mark."""
    names = [part.split()[0] for part in PACKED.split(", ")]
    for batch in batches:
        place, counts = batch["places"].flatten().to_numpy(), batch["counts"]
        edges = np.r_[0, np.cumsum(batch["places"].value_lengths().to_numpy())]
        data = place.astype(np.uint8)
        if not counts.null_count:
            step = np.diff(place, prepend=0)
            step[edges[:-1]] = place[edges[:-1]]
            data, ends = _short(np.column_stack([step, counts.flatten().to_numpy()]).ravel())
            edges = np.r_[0, ends][2 * edges]
        postings = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data.tobytes())])
        columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | {"postings": postings}
        yield pa.RecordBatch.from_arrays([columns[name] for name in names], names)


def _unpacked(postings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many places each word has, and all words' places and counts."""
    postings = postings.cast(pa.large_binary())
    _, edges, data = postings.buffers()
    edges = np.frombuffer(edges, dtype=np.int64)[postings.offset :][: len(postings) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[edges[0] : edges[-1]]
    last = np.flatnonzero(data < 128)
    first = np.r_[0, last[:-1] + 1]
    shift = np.arange(len(data)) - np.repeat(first, last - first + 1)
    step, n = np.add.reduceat((data & 127).astype(np.int64) << 7 * shift, first).reshape(-1, 2).T
    upto = np.searchsorted(last, edges - edges[0]) // 2
    lengths = np.diff(upto)
    place = np.cumsum(step)
    return lengths, place - np.repeat((place - step)[upto[:-1]], lengths), n


def _contexts(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of each piece with the ``DEPTH`` bytes before it in the piece, as one number; and each piece's bytes."""
    lengths = np.array([len(piece) for piece in pieces], dtype=np.int64)
    pad = b" " * DEPTH
    data = np.frombuffer(b"".join(chain.from_iterable((pad, piece) for piece in pieces)), dtype=np.uint8).astype(_U)
    grams = data.copy()
    for k in range(1, DEPTH + 1):
        grams[k:] |= data[:-k] << _U(8 * k)
    own = np.ones(len(data), dtype=bool)
    starts = np.cumsum(lengths + DEPTH) - lengths - DEPTH
    for k in range(DEPTH):
        own[starts + k] = False
    return grams[own], lengths


def _grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The contexts of each word by itself and its space, the empty word being the end."""
    return _contexts([w + (b" " if w else b"\n") for w in words])


def _cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The contexts of whole texts: their words, each with a space, and the end."""
    return _contexts([b" ".join([*text.lower().split(), b"\n"]) for text in texts])


def _cut_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As ``_cut``, of a model whose contexts end at the word's beginning."""
    words = [[*text.lower().split(), END] for text in texts]
    grams, lengths = _grams([w for own in words for w in own])
    first = np.cumsum([0] + [len(own) for own in words])[:-1]
    return grams, np.add.reduceat(lengths, first)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """By the asymptotic series, after shifting small arguments up."""
    shift = np.zeros_like(x)
    x = x.copy()
    for _ in range(8):
        low = x < 8
        shift[low] += np.log(x[low])
        x[low] += 1
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - shift


def _estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - math.log(math.pi)


class Level:
    """The nodes of one depth: sorted keys, counts, and the logs of estimate and weighted probability."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: tuple[np.ndarray, np.ndarray] | None):
        self.keys, place = np.unique(keys, return_inverse=True)
        size = len(self.keys)
        self.zeros = np.bincount(place, zeros, size).astype(np.float64)
        self.ones = np.bincount(place, ones, size).astype(np.float64)
        estimate = _estimate(self.zeros, self.ones)
        self.weighted = estimate
        if below is not None:
            children = np.bincount(np.searchsorted(self.keys, below[0]), below[1], size)
            self.weighted = np.logaddexp(estimate, children) - math.log(2)
        self._finish(estimate, below is None)

    def _finish(self, estimate: np.ndarray, deepest: bool) -> None:
        self.stop = np.ones_like(estimate) if deepest else np.exp(np.minimum(0.0, estimate - math.log(2) - self.weighted))
        self.one = (self.ones + 0.5) / (self.zeros + self.ones + 1)


def _bits(grams: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the eight decisions of the last byte: the bits before it with a leading one, and its bit."""
    byte = grams & _U(0xFF)
    for k in range(8):
        yield _U(1 << k) | (byte >> _U(8 - k)), (byte >> _U(7 - k)) & _U(1)


def _node(grams: np.ndarray, before: np.ndarray, depth: int) -> np.ndarray:
    context = (grams >> _U(8)) & _U((1 << 8 * depth) - 1)
    return context << _U(8) | before


def _parent(keys: np.ndarray, depth: int) -> np.ndarray:
    """Keys one level up: without the oldest byte of the context."""
    return keys & _U((1 << 8 * depth) - 1)


def _levels(grams: np.ndarray, n: np.ndarray, least: int) -> dict[int, Level]:
    """The tree over these training counts from ``DEPTH`` up to depth ``least``."""
    seen = n > 0
    grams, n = grams[seen], n[seen].astype(np.float64)
    decisions = [(before, bit.astype(bool)) for before, bit in _bits(grams)]
    keys = np.concatenate([_node(grams, before, DEPTH) for before, _ in decisions]) if len(grams) else np.empty(0, dtype=_U)
    zeros = np.concatenate([np.where(bit, 0, n) for _, bit in decisions])
    ones = np.concatenate([np.where(bit, n, 0) for _, bit in decisions])
    made = {DEPTH: Level(keys, zeros, ones, None)}
    for depth in range(DEPTH - 1, least - 1, -1):
        lower = made[depth + 1]
        up = _parent(lower.keys, depth + 1)
        made[depth] = Level(up, lower.zeros, lower.ones, (up, lower.weighted))
    return made


def _costs(grams: np.ndarray, levels: dict[int, Level]) -> np.ndarray:
    """Log2 probability of each gram's byte after its context, all depths mixed.

    Below the deepest node with training bits there is nothing to weigh: that node's own
    estimate takes the rest of the weight.
    """
    total = np.zeros(len(grams))
    for before, bit in _bits(grams):
        probability, rest, last = np.zeros(len(grams)), np.ones(len(grams)), np.full(len(grams), 0.5)
        for depth in range(DEPTH + 1):
            level = levels[depth]
            key = _node(grams, before, depth)
            if not len(level.keys):
                break
            at = np.minimum(np.searchsorted(level.keys, key), len(level.keys) - 1)
            there = level.keys[at] == key
            one = np.where(bit.astype(bool), level.one[at], 1 - level.one[at])
            probability += np.where(there, rest * level.stop[at] * one, 0)
            rest = np.where(there, rest * (1 - level.stop[at]), rest)
            last = np.where(there, one, last)
        total += np.log2(probability + rest * last)
    return total


def gram_costs(counts: DataFrame) -> DataFrame:
    """``gram, bits``: log2 probabilities of the grams, their tree built in shards.

    A shard holds all contexts that end in the same two bytes, and with them whole branches of
    the tree. Only depths 0 and 1 join shards: at most 65,535 nodes, summed and sent to every task.
    """
    shard = counts.withColumn("shard", F.shiftright("gram", 8).bitwiseAND(0xFFFF))

    def branches(rows: pd.DataFrame) -> pd.DataFrame:
        level = _levels(rows["gram"].to_numpy().view(_U), rows["n"].to_numpy(), 2)[2]
        return pd.DataFrame({"node": _parent(level.keys, 2).view(np.int64), "zeros": level.zeros, "ones": level.ones, "weighted": level.weighted})

    found = shard.filter("n > 0").groupBy("shard").applyInPandas(branches, "node long, zeros double, ones double, weighted double")
    rows = found.groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted")).orderBy("node").toPandas()
    keys = rows["node"].to_numpy().astype(np.int64).view(_U)
    first = Level(keys, rows["zeros"].to_numpy(), rows["ones"].to_numpy(), (keys, rows["weighted"].to_numpy()))
    up = _parent(keys, 1)
    root = Level(up, first.zeros, first.ones, (up, first.weighted))
    top = counts.sparkSession.sparkContext.broadcast((root, first))

    def score(rows: pd.DataFrame) -> pd.DataFrame:
        grams = rows["gram"].to_numpy().view(_U)
        levels = _levels(grams, rows["n"].to_numpy(), 2) | dict(enumerate(top.value))
        return pd.DataFrame({"gram": rows["gram"], "bits": _costs(grams, levels)})

    return shard.groupBy("shard").applyInPandas(score, "gram long, bits double")


def scores(docs: DataFrame, across_words: bool = False, sent: int = n_grams.SENT_GRAMS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    Both scores are log10 probabilities. ``across_words`` gives each byte the ``DEPTH`` bytes before it in the text,
    as the method has it; without it contexts end at the word's beginning. Null and empty texts are the end alone. Rows are
    scored one by one, so repeated rows agree, though each counts in training; a null id is trained on. With no
    training documents every count is 0 and every bit even. An empty table has no rows. A table of more than ``sent``
    contexts with their next bytes is joined.
    """
    ship(docs.sparkSession)
    cut = _cut if across_words else _cut_words
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held"), text_of().cast("binary").alias("text"))
    # Held-out texts count for no n-gram, but theirs are in the table.
    counted = n_grams.counts(source.select("text", F.when(~F.col("held"), 0).alias("class")), cut, 1)
    counts = stored(counted.withColumnRenamed("n0", "n"), "context-counts")
    costs = stored(gram_costs(counts), "context-costs")
    inverted = stored(n_grams.sums(source, cut, costs, ["bits"], sent, then=(lambda batches: _packed(_inverted(batches)), PACKED)), "inverted-documents")
    words = inverted.filter("word IS NOT NULL")
    vocabulary = stored(words.groupBy("word").agg(F.sum("train").alias("c")), "vocabulary")
    totals = vocabulary.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    tokens, distinct = totals[0] or 0, totals[1]
    for done in (counts, costs):
        drop_table(done)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the task's words for each document, as arrays by place, a row for each chunk."""
        sums: dict[int, np.ndarray] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            rows = [pa.array(list(sums), pa.int64())]
            rows += [pa.array([s[i].tolist() for s in sums.values()], pa.list_(pa.float64())) for i in range(3)]
            return pa.RecordBatch.from_arrays(rows, ["chunk", "base", "tokens", "known"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names, c = (batch[x].to_numpy() for x in ("chunk", "c"))
            lengths, place, n = _unpacked(batch["postings"])
            base = np.repeat(np.log10(c + 0.5), lengths) * n
            known = np.repeat(c > 0, lengths) * n
            name = np.repeat(names, lengths)
            order = np.argsort(name, kind="stable")
            edges = np.flatnonzero(np.r_[True, np.diff(name[order]) != 0]) if len(order) else []
            for part in np.split(order, edges[1:]) if len(order) else []:
                key, size = int(name[part[0]]), int(place[part].max()) + 1
                old = sums.get(key)
                size = max(size, 0 if old is None else old.shape[1])
                new = np.stack([np.bincount(place[part], v[part], size) for v in (base, n, known)])
                if old is not None:
                    new[:, : old.shape[1]] += old
                held += size - (0 if old is None else old.shape[1])
                sums[key] = new
            if held > SUMMED_TOGETHER:
                yield flush()
                sums, held = {}, 0
        if sums:
            yield flush()

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        documents = rows[rows["ids"].notna()].iloc[0]
        size = len(documents["ids"])
        sums = np.zeros((3, size))
        for row in rows[rows["ids"].isna()].itertuples():
            for i, own in enumerate((row.base, row.tokens, row.known)):
                sums[i, : len(own)] += own
        n = sums[1]
        base = sums[0] - n * math.log10(tokens + 0.5 * (distinct + 1))
        return pd.DataFrame(
            {
                "doc_id": pd.arrays.IntegerArray(np.array(documents["ids"], dtype=np.int64), np.frombuffer(documents["postings"], dtype=np.uint8).astype(bool)),
                "held_out": documents["held"],
                "n_tokens": n.astype(np.int64),
                "n_known": sums[2].astype(np.int64),
                "train_tokens": tokens,
                "base_score": base,
                "score": np.array(documents["bits"], dtype=np.float64) * math.log10(2),
            }
        )

    # A part of the vocabulary is a hash table in its task: nothing is sorted by words.
    sums = words.select("chunk", "word", "postings").join(vocabulary.hint("shuffle_hash"), "word")
    sums = sums.select("chunk", "postings", "c").mapInArrow(partial, "chunk long, base array<double>, tokens array<double>, known array<double>")
    listed = inverted.filter("word IS NULL").select("chunk", "postings", "ids", "held", "bits")
    # A chunk has a bounded number of bytes, and each task that held its words at least one row of sums.
    return (
        sums.unionByName(listed, allowMissingColumns=True)
        .groupBy("chunk")
        .applyInPandas(total, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )


def op7_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents").select("doc_id", "text"), across_words=True)
