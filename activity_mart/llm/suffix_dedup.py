"""Operator 13: removal of repeated 200-byte strings by blockwise suffix sorting with a difference cover.

A suffix counts up to ``LENGTH`` bytes, as longer matches change nothing. Only equality decides, so suffixes
are ordered by digests of those bytes, and a digest's place among the sorted ones is its rank.

1. Documents that can hold no repeat leave: two equal 200-byte strings have the same least 64-byte gram,
   so a document none of whose least grams occurs twice is whole.
2. The cover sample: places whose offset modulo ``PERIOD`` lies in a difference cover. For any two places some
   shift below ``PERIOD`` puts both in the cover, so of two equal suffixes a 128-byte string of the sample
   is equal as well. The sample is sorted bucket by bucket; equal neighbours are ranked alike.
3. A suffix whose sample places all have a rank of their own ties with none. The others, the long ties,
   are sorted bucket by bucket on all 200 bytes; equal neighbours are repeats.

Texts stay in chunks. Of a bucket, a chunk sends each digest once, sorted, with a mark if it holds it
twice; the bucket's answer is one bit a digest. So a string that very many documents share counts once a
chunk, and no task holds more than one chunk or one bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_mart.llm.common import parts_of, ship, slot, slots, stored, table, text_chunks, text_of
from activity_mart.llm.fill_middle import _flat
from activity_mart.llm.shingle_join import mix

LENGTH = 200
# The powers of two modulo 73 are a perfect difference cover: every difference occurs once.
PERIOD = 73
COVER = sorted({pow(2, i, PERIOD) for i in range(9)})
NAMED = LENGTH - PERIOD + 1
GRAM = 64
CHUNK_BYTES, BUCKET_KEYS, LEAST_KEYS = 2_000_000, 1_000_000, 65_536
STRETCH = 1 << 20
_U = np.uint64
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_MOST = np.iinfo(_U).max


class Digests:
    """64-bit digests of strings of a flat text, by prefix sums of a polynomial, a stretch at a time."""

    def __init__(self, base: int):
        n = STRETCH + LENGTH
        self.letters = mix(np.arange(1, 257, dtype=_U) * _U(base))
        self.up, self.down = np.full(n, base, dtype=_U), np.full(n, pow(base, -1, 1 << 64), dtype=_U)
        self.up[0] = self.down[0] = 1
        self.up, self.down = np.cumprod(self.up), np.cumprod(self.down)

    def at(self, letters: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
        """Digests of the strings of ``length`` bytes that begin at the sorted ``places``."""
        out = np.empty(len(places), dtype=_U)
        edges = np.searchsorted(places, np.arange(0, len(letters) + STRETCH, STRETCH))
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if a < b:
                start = i * STRETCH
                part = letters[start : start + STRETCH + length]
                sums = np.zeros(len(part) + 1, dtype=_U)
                np.cumsum(self.letters[part] * self.up[: len(part)], dtype=_U, out=sums[1:])
                own = places[a:b] - start
                out[a:b] = mix((sums[own + length] - sums[own]) * self.down[own])
        return out


_digests: dict[int, Digests] = {}


def digests(base: int) -> Digests:
    """One per worker process and base."""
    if base not in _digests:
        _digests[base] = Digests(base)
    return _digests[base]


FIRST, SECOND = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def places_of(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of a flat text its offset in its document, and the bytes from it to the document's end."""
    lengths = np.diff(edges)
    edges = edges.astype(np.int32 if edges[-1] < 2**31 else np.int64)
    every = np.arange(edges[-1], dtype=edges.dtype)
    return every - np.repeat(edges[:-1], lengths), np.repeat(edges[1:], lengths) - every


def sliding(x: np.ndarray, n: int, best: np.ufunc, worst: int) -> np.ndarray:
    """``best`` of each ``n`` neighbours ``x[i : i + n]``; ``worst`` stands behind the end."""
    size = -(-(len(x) + n) // n) * n
    held = np.full(size, worst, dtype=x.dtype)
    held[: len(x)] = x
    blocks = held.reshape(-1, n)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: len(x)], ahead[n - 1 : n - 1 + len(x)])


def least_grams(letters: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``gram, document, count``: digests of the grams that are the least of some string of ``LENGTH`` bytes."""
    _, room = places_of(edges)
    grams = np.full(len(letters), _MOST, dtype=_U)
    whole = np.flatnonzero(room >= GRAM)
    grams[whole] = digests(FIRST).at(letters, whole, GRAM)
    span = LENGTH - GRAM + 1
    least = sliding(grams, span, np.minimum, _MOST)
    least[room < LENGTH] = 0
    # A gram is the least of a string that holds it if the largest of their least grams is itself.
    reached = sliding(least[::-1], span, np.maximum, 0)[::-1]
    chosen = np.flatnonzero((reached == grams) & (room >= GRAM))
    document = np.searchsorted(edges, chosen, side="right") - 1
    order = np.lexsort((grams[chosen], document))
    gram, document = grams[chosen][order], document[order]
    heads = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (document[1:] != document[:-1])]) if len(gram) else np.empty(0, dtype=np.int64)
    return gram[heads], document[heads], np.diff(np.r_[heads, len(gram)])


class Keys:
    """A chunk's digests, once each, sorted within buckets."""

    def __init__(self, key: np.ndarray, bucket: np.ndarray, buckets: int):
        small = np.int32 if len(key) < 2**31 else np.int64
        order = np.argsort(key).astype(small)
        order = order[np.argsort(bucket[order], kind="stable")]
        key, bucket = key[order], bucket[order]
        head = np.r_[True, (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])] if len(key) else np.empty(0, dtype=bool)
        number = np.cumsum(head, dtype=small) - small(1)
        self.of = np.empty(len(key), dtype=small)
        self.of[order] = number
        self.keys = key[head]
        self.twice = np.bincount(number, minlength=len(self.keys)) > 1
        self.edges = np.searchsorted(bucket[head], np.arange(buckets + 1))

    def lists(self) -> Iterator[tuple[int, bytes, bytes]]:
        for b in np.flatnonzero(np.diff(self.edges)):
            part = slice(self.edges[b], self.edges[b + 1])
            yield int(b), self.keys[part].astype("<u8").tobytes(), np.packbits(self.twice[part]).tobytes()

    def repeated(self, answers: list[dict] | None) -> np.ndarray:
        """For each place whether its digest is repeated, from the buckets' answers."""
        flags = np.zeros(len(self.keys), dtype=bool)
        for answer in answers or []:
            a, b = self.edges[answer["bucket"]], self.edges[answer["bucket"] + 1]
            flags[a:b] = np.unpackbits(np.frombuffer(answer["bits"], dtype=np.uint8), count=b - a)
        return flags[self.of]


def sample(letters: np.ndarray, edges: np.ndarray, open_: np.ndarray, buckets: int) -> tuple[np.ndarray, Keys]:
    """The cover sample of the open documents, and the keys of its strings."""
    offset, room = places_of(edges)
    places = np.flatnonzero(_IN_COVER[offset % PERIOD] & (room >= NAMED) & np.repeat(open_, np.diff(edges)))
    key = digests(FIRST).at(letters, places, NAMED)
    return places, Keys(key, ((key >> _U(32)) % _U(buckets)).astype(np.uint32), buckets)


def ties(letters: np.ndarray, edges: np.ndarray, places: np.ndarray, repeated: np.ndarray, buckets: int) -> tuple[np.ndarray, Keys]:
    """The suffixes with a repeated sample place less than a period on, and the keys of their 200 bytes.

    The bucket comes from a second digest: it tells apart what the first does not.
    """
    _, room = places_of(edges)
    upto = np.zeros(len(letters) + PERIOD + 1, dtype=np.int32)
    upto[places[repeated] + 1] = 1
    upto = np.cumsum(upto, dtype=np.int32)
    suffixes = np.flatnonzero((room >= LENGTH) & (upto[PERIOD : PERIOD + len(letters)] > upto[: len(letters)]))
    bucket = digests(SECOND).at(letters, suffixes, LENGTH) % _U(buckets)
    return suffixes, Keys(digests(FIRST).at(letters, suffixes, LENGTH), bucket.astype(np.uint32), buckets)


def _sorted_bucket(lists: pa.Table) -> pa.Table:
    """One bucket sorted: for each chunk, a bit for each of its digests that occurs again."""
    keys = [np.frombuffer(k, dtype="<u8") for k in lists.column("keys").to_pylist()]
    twice = [np.unpackbits(np.frombuffer(t, dtype=np.uint8), count=len(k)) for k, t in zip(keys, lists.column("twice").to_pylist(), strict=True)]
    every = np.concatenate(keys)
    order = np.argsort(every)
    equal = every[order][1:] == every[order][:-1]
    flags = np.concatenate(twice).astype(bool)
    flags[order[1:][equal]] = flags[order[:-1][equal]] = True
    answers = np.split(flags, np.cumsum([len(k) for k in keys])[:-1])
    found = [i for i, a in enumerate(answers) if a.any()]
    return pa.table(
        {
            "chunk": lists.column("chunk").take(pa.array(found, pa.int64())),
            "bucket": lists.column("bucket").take(pa.array(found, pa.int64())),
            "bits": pa.array([np.packbits(answers[i]).tobytes() for i in found], pa.binary()),
            "n": pa.array([int(answers[i].sum()) for i in found], pa.int64()),
        }
    )


LISTS = "bucket int, chunk long, keys binary, twice binary"
ANSWERS = "chunk long, bucket int, bits binary, n long"


def _grams(docs: DataFrame) -> DataFrame:
    """``gram, key, n`` of each document's least grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text", STRETCH):
            gram, document, n = least_grams(*_flat(batch["text"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(batch["key"].to_numpy()[document]), pa.array(n, pa.int64())], ["gram", "key", "n"]
            )

    long = docs.filter(F.octet_length("text") >= LENGTH).select("key", "text")
    return long.mapInArrow(run, "gram long, key long, n long")


def _in_chunks(rows: DataFrame) -> DataFrame:
    """``chunk, docs``: rows in the order they come, some megabytes of text each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def packed():
            docs = pa.Table.from_batches(held).to_struct_array().combine_chunks()
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)], ["chunk", "docs"])

        for batch in text_chunks(batches, "text", CHUNK_BYTES // 4):
            more = batch["text"].nbytes
            if held and size + more > CHUNK_BYTES:
                yield packed()
                number, held, size = number + 1, [], 0
            held.append(batch)
            size += more
        if held:
            yield packed()

    kind = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema]))
    return rows.mapInArrow(run, T.StructType([T.StructField("chunk", T.LongType()), T.StructField("docs", kind)]))


def _texts(batch: pa.RecordBatch, i: int) -> tuple[pa.StructArray, np.ndarray, np.ndarray, np.ndarray]:
    """The documents of the batch's chunk ``i``, their flat text, its edges, and which are open."""
    docs = batch["docs"].slice(i, 1).flatten()
    letters, edges = _flat(docs.field("text").fill_null(""))
    return docs, letters, edges, docs.field("open").to_numpy(zero_copy_only=False)


def _emit(chunks: DataFrame, make) -> DataFrame:
    """The lists of every chunk's keys by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = [(b, batch["chunk"][i].as_py(), k, t) for b, k, t in make(batch, i).lists()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["bucket", "chunk", "keys", "twice"])

    return chunks.mapInArrow(run, LISTS)


def _answers(lists: DataFrame, label: str) -> DataFrame:
    """Every bucket sorted by itself."""
    return stored(lists.groupBy("bucket").applyInArrow(_sorted_bucket, ANSWERS), label)


def _by_chunk(answers: DataFrame, name: str) -> DataFrame:
    """The answers to a chunk, a bit for each of its digests."""
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))


def _buckets(keys: float, parts: int) -> int:
    return int(max(1, -(-keys // BUCKET_KEYS), min(parts, keys // LEAST_KEYS)))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns: ``row``, a struct of all columns of ``docs``, and ``dedup``, what is left of its text.

    ``dedup`` has ``n_bytes``, ``n_removed``, the removed ``spans`` (maximal, in bytes of the text) and the ``kept``
    bytes, which may begin or end inside a character. Every byte inside a string of 200 bytes that begins anywhere else
    too is removed, from all places alike: an exact copy of 200 bytes or more loses everything, and so does its original.
    A null text counts as empty; texts under 200 bytes are never touched. Null and repeated ids are rows like others.
    As the input's columns stay inside ``row``, no name clashes. An empty table stays empty.
    A text over ``CHUNK_BYTES`` is a chunk by itself, and its task then takes some 60 times its bytes.
    """
    spark = docs.sparkSession
    ship(spark)
    parts = parts_of(spark)
    text = text_of(text_col)
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    rows = docs.select(others.alias("others"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), text).alias("key"))

    # What is joined here has no size bound, so that it is merged at every size and never broadcast.
    grams = _grams(rows)
    again = stored(grams.groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1").select("gram"), "repeated-grams")
    near = grams.withColumn("_slot", slot("gram")).join(F.broadcast(slots(again, "gram")), "_slot", "left_semi").drop("_slot")
    # Documents with a common least gram lie side by side, so that a chunk holds what they share once.
    place = stored(near.join(again.hint("merge"), "gram").groupBy("key").agg(F.min("gram").alias("place")), "places")
    full = F.broadcast(slots(place, "key"))
    placed = rows.withColumn("_slot", slot("key"))
    whole = placed.join(full, "_slot", "left_anti")
    doubtful = placed.join(full, "_slot", "left_semi").drop("_slot").join(place.hint("merge"), "key", "left")
    ordered = doubtful.repartitionByRange(parts, "place", "key").sortWithinPartitions("place", "key")
    chunks = stored(_in_chunks(ordered.select("others", "text", F.col("place").isNotNull().alias("open"))), "chunks")

    size = chunks.select(F.sum(F.aggregate("docs", F.lit(0).cast("long"), lambda a, d: a + F.when(d["open"], F.coalesce(F.octet_length(d["text"]), F.lit(0))).otherwise(0)))).first()[0] or 0
    first = _buckets(size * len(COVER) / PERIOD, parts)

    def cover(batch: pa.RecordBatch, i: int) -> Keys:
        _, letters, edges, open_ = _texts(batch, i)
        return sample(letters, edges, open_, first)[1]

    ranks = _answers(_emit(chunks, cover), "cover-ranks")
    tied = ranks.agg(F.sum("n")).first()[0] or 0
    second = _buckets(tied * PERIOD / len(COVER), parts)

    def suffixes(batch: pa.RecordBatch, i: int) -> tuple[pa.StructArray, np.ndarray, np.ndarray, np.ndarray, Keys]:
        docs, letters, edges, open_ = _texts(batch, i)
        places, keys = sample(letters, edges, open_, first)
        return docs, letters, edges, *ties(letters, edges, places, keys.repeated(batch["ranks"][i].as_py()), second)

    ranked = _by_chunk(ranks, "ranks").hint("merge")
    repeats = _answers(_emit(chunks.join(ranked, "chunk"), lambda batch, i: suffixes(batch, i)[4]), "repeats")

    spans_kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    made = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", spans_kind), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs, letters, edges, places, keys = suffixes(batch, i)
                found = places[keys.repeated(batch["repeats"][i].as_py())]
                owner = np.searchsorted(edges, found, side="right") - 1
                heads = np.flatnonzero(np.r_[True, (np.diff(found) > LENGTH) | (np.diff(owner) > 0)]) if len(found) else np.empty(0, dtype=np.int64)
                starts, ends, owner = found[heads], found[np.r_[heads[1:] - 1, len(found) - 1]] + LENGTH if len(found) else heads, owner[heads]
                data, out, own = letters.tobytes(), [], np.searchsorted(owner, np.arange(len(docs) + 1))
                for d, (a, z) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                    spans = list(zip(starts[own[d] : own[d + 1]].tolist(), ends[own[d] : own[d + 1]].tolist(), strict=True))
                    kept = b"".join(data[x:y] for x, y in zip([a, *(e for _, e in spans)], [*(s for s, _ in spans), z], strict=True))
                    out.append({"n_bytes": z - a, "n_removed": z - a - len(kept), "spans": [{"start": s - a, "end": e - a} for s, e in spans], "kept": kept})
                yield pa.RecordBatch.from_arrays([docs.field("others"), docs.field("text"), pa.array(out, made)], ["others", "text", "dedup"])

    dedup = T.StructType.fromDDL("n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")
    schema = T.StructType([rows.schema["others"], rows.schema["text"], T.StructField("dedup", dedup)])
    answered = chunks.join(ranked, "chunk", "left").join(_by_chunk(repeats, "repeats").hint("merge"), "chunk", "left")
    untouched = F.struct(
        F.octet_length(text_of()).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.array().cast(dedup["spans"].dataType).alias("spans"),
        text_of().cast("binary").alias("kept"),
    )
    every = answered.mapInArrow(run, schema).unionByName(whole.select("others", "text", untouched.alias("dedup")))
    row = F.struct(*[F.col("text").alias(c) if c == text_col else F.col("others")[c].alias(c) for c in docs.columns])
    return every.select(row.alias("row"), "dedup")


def op13_cover_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        F.col("row.doc_id").alias("doc_id"),
        "dedup.n_bytes",
        "dedup.n_removed",
        F.size("dedup.spans").cast("long").alias("n_spans"),
        F.sha2(F.col("dedup.kept"), 256).alias("kept_sha256"),
    )
