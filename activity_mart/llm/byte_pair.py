"""Operator 1: BPE encoding and decoding by batched merge rounds in numpy.

The symbols of many words lie in one flat array. A round looks up every neighbouring pair of
symbols in the sorted pair keys by binary search, takes the lowest rank in each word, and merges
all places of that pair, left to right. Words without a known pair leave the array.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from activity_mart.llm.common import table, text_chunks, text_of
from activity_mart.llm.units import REMEMBERED_UNITS, SPACE, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
# Fixed value: the pattern that byte-level BPE splits a text by before merging.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# A text may be cut before white space that follows something else: no word crosses that place.
UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_characters() -> dict[str, int]:
    """The characters byte-level vocabularies write bytes with: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairs:
    """A vocabulary file's merges as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        vocabulary: dict[str, int] = rules["model"]["vocab"]
        byte_of = byte_characters()
        self.special = {t["content"]: t["id"] for t in rules["added_tokens"]}
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.byte_id = np.zeros(256, dtype=np.int64)
        for character, byte in byte_of.items():
            self.byte_id[byte] = vocabulary[character]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in rules["model"]["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], dtype=np.int64)
        merged = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order, merged  # merged is by rank
        self.no_rank = len(pairs)
        token_bytes = {i: bytes(byte_of[c] for c in t) for t, i in vocabulary.items() if all(c in byte_of for c in t)}
        token_bytes |= {i: t.encode() for t, i in self.special.items()}
        spelled = [token_bytes.get(i, b"") for i in range(max(token_bytes) + 1)]
        self.lengths = np.array([len(s) for s in spelled], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.known: dict[str, bytes] = {}

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done: list[np.ndarray | None] = [None] * len(words)

        def leave(symbols, owner, stays):
            gone = ~stays[owner]
            if gone.any():
                ids, of = symbols[gone], owner[gone]
                heads = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                for word, part in zip(of[heads].tolist(), np.split(ids, heads[1:]), strict=True):
                    done[word] = part
            return symbols[~gone], owner[~gone]

        while len(symbols):
            same = owner[1:] == owner[:-1]
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(same & (self.keys[at] == key), self.ranks[at], self.no_rank)
            rank = np.append(rank, self.no_rank)
            heads = np.flatnonzero(np.r_[True, ~same])
            lowest = np.full(len(words), self.no_rank)
            lowest[owner[heads]] = np.minimum.reduceat(rank, heads)
            chosen = np.flatnonzero((rank == lowest[owner]) & (rank < self.no_rank))
            if len(chosen):
                # Of pairs that overlap, as in a run of one symbol, every second one.
                first = np.r_[True, np.diff(chosen) != 1]
                run = np.maximum.accumulate(np.where(first, np.arange(len(chosen)), 0))
                chosen = chosen[(np.arange(len(chosen)) - run) % 2 == 0]
                symbols[chosen] = self.merged[rank[chosen]]
                keep = np.ones(len(symbols), dtype=bool)
                keep[chosen + 1] = False
                symbols, owner = symbols[keep], owner[keep]
            symbols, owner = leave(symbols, owner, lowest < self.no_rank)
        return [ids if ids is not None else np.empty(0, dtype=np.int64) for ids in done]

    def _learn(self, units: list[str]) -> None:
        """Put new units' ids among the known ones; equal words are merged once."""
        parts, words = [], {}
        for unit in units:
            own, at = [], 0
            for match in self.special_pattern.finditer(unit):
                own += WORDS.findall(unit[at : match.start()])
                own.append(self.special[match.group()])
                at = match.end()
            own += WORDS.findall(unit[at:])
            parts.append(own)
            words.update((w, b"") for w in own if isinstance(w, str))
        ids = self.merge([w.encode() for w in words])
        spelled = {w: i.astype("<u4").tobytes() for w, i in zip(words, ids, strict=True)}
        for unit, own in zip(units, parts, strict=True):
            self.known[unit] = b"".join(w.to_bytes(4, "little") if isinstance(w, int) else spelled[w] for w in own)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED_UNITS:
            self.known.clear()
        cut = [UNIT.findall(t) for t in texts]
        if new := list(set().union(*cut) - self.known.keys()):
            for at in range(0, len(new), 20_000):
                self._learn(new[at : at + 20_000])
        known = self.known
        return [b"".join(map(known.__getitem__, units)) for units in cut]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        number = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        lengths = self.lengths[number]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[number] - (ends - lengths), lengths)
        return self.letters[at].tobytes().decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def byte_pairs(path: str) -> BytePairs:
    """One per worker process and file."""
    return BytePairs(path)


def encode_texts(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded``: every text encoded and decoded again.

    Null and empty texts have no ids and decode to an empty text. Rows are neither merged nor
    dropped, so repeated ids and texts stay repeated; other columns are not carried.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(tokenizer_path(tokenizer))
        for batch in text_chunks(batches, "text"):
            coded = coder.encode(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([np.frombuffer(ids, dtype="<u4").astype(np.int32) for ids in coded], pa.list_(pa.int32())),
                    pa.array([coder.decode(ids) for ids in coded], pa.string()),
                ],
                ["doc_id", "ids", "decoded"],
            )

    source = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def token_digests(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per document the number of ids and the digests of ids and decoded text, without moving either."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(tokenizer_path(tokenizer))
        for batch in text_chunks(batches, "text"):
            coded = coder.encode(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(ids) // 4 for ids in coded], pa.int64()),
                    pa.array([hashlib.sha256(ids).hexdigest() for ids in coded], pa.string()),
                    pa.array([hashlib.sha256(coder.decode(ids).encode()).hexdigest() for ids in coded], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, SCHEMA)


def op1_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
