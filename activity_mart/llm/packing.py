"""Operator 8: best-fit packing by bin completion over the histogram of piece lengths.

Pieces of one length are interchangeable, so the plan needs only how many there are of each
length: a table of at most ``capacity`` rows. Bin completion takes the largest piece, enumerates
the undominated ways to fill the space beside it, and branches over them, least waste first. The
first incumbent is the best-fit decreasing plan; a branch ends where the sequences so far and the
lower bound of the pieces left, that is, its total waste, cannot beat the incumbent. The search
ends at the lower bound or after ``PLAN_NODES`` branchings, with the incumbent. Spark then numbers the pieces within their length and looks each number up in the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from activity_mart.llm.common import numbered, stored, table, text_chunks, text_of
from activity_mart.llm.units import tokenizer_path, unit_encoder

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
SEARCH_NODES = 3_000  # fillings tried beside one largest piece before those found are taken
PLAN_NODES = 2_000  # branchings of a plan before the incumbent is taken
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every document's ids and the end id, cut into pieces of ``capacity`` where they are longer.

    A null or empty text is the end id alone. Repeated rows give repeated pieces.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_encoder(tokenizer_path(tokenizer))
        end = int(end_id).to_bytes(4, "little")
        for batch in text_chunks(batches, "text"):
            rows = []
            for doc, ids in zip(batch["doc_id"].to_pylist(), encoder.encode(batch["text"].to_pylist()), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(cut, PIECES)


@dataclass
class Filling:
    lengths: list[int]  # largest first
    times: int


def _complete(counts: np.ndarray, present: list[int], space: int) -> list[int]:
    """The undominated filling of ``space`` with least waste, larger pieces first among equals."""
    best: list[int] = []
    room = space
    for length in present:  # the best-fit incumbent: always the largest piece that still fits
        while room >= length and best.count(length) < counts[length]:
            best.append(length)
            room -= length
    least, tried = room, 0
    smallest = present[-1] if present else space + 1
    number, longer, ordered = counts.tolist(), _longer(counts), [-x for x in present]

    def search(at: int, room: int, chosen: list[int]) -> None:
        nonlocal best, least, tried
        tried += 1
        if room < least and not _dominated(number, longer, chosen, room):
            best, least = [*chosen], room
        if least == 0 or room < smallest or tried > SEARCH_NODES:
            return
        for i in range(max(at, bisect_left(ordered, -room)), len(present)):
            length = present[i]
            if chosen.count(length) >= number[length]:
                continue
            # What follows is no larger than this piece: with few pieces left to come the space stays open.
            search(i, room - length, [*chosen, length])
            if least == 0 or tried > SEARCH_NODES:
                return

    if least:
        # An exact single piece or pair dominates every filling of more pieces.
        for length in present:
            rest = space - length
            if rest == 0:
                return [length]
            if 0 < rest <= length and counts[rest] >= (2 if rest == length else 1):
                return [length, rest]
        search(0, space, [])
    return best


def _longer(counts: np.ndarray) -> list[int]:
    """For each length the next longer one that is left, or one beyond all lengths."""
    there = np.flatnonzero(counts)
    return np.append(there, 2 * len(counts))[np.searchsorted(there, np.arange(len(counts)), side="right")].tolist()


def _dominated(number: list[int], longer: list[int], chosen: list[int] | tuple[int, ...], room: int) -> bool:
    """Whether a longer piece that is left could stand in for one of the chosen."""
    for length in chosen:
        x = longer[length]
        while x <= length + room:
            if number[x] > chosen.count(x):
                return True
            x = longer[x]
    return False


def _fillings(left: np.ndarray, largest: int) -> Iterator[list[int]]:
    """A ``largest`` piece with each undominated filling beside it, least waste first; with the greedy completion before all.

    The others are looked for once they are asked for: a first descent that ends at the lower bound needs none of them.
    """

    def beside() -> tuple[np.ndarray, list[int], int]:
        counts, space = left.copy(), len(left) - 1 - largest
        counts[largest] -= 1
        return counts, np.flatnonzero(counts[: space + 1])[::-1].tolist(), space

    counts, present, space = beside()
    first = _complete(counts, present, space)
    del counts, present  # many wait here
    yield [largest, *first]
    if sum(first) == space and len(first) <= 2:
        return  # an exact single piece or pair dominates every filling of more pieces
    counts, present, space = beside()
    number, longer, ordered = counts.tolist(), _longer(counts), [-x for x in present]

    def following(at: int, room: int, chosen: tuple[int, ...]) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        for i in range(max(at, bisect_left(ordered, -room)), len(present)):
            if chosen.count(present[i]) < number[present[i]]:
                yield i, room - present[i], (*chosen, present[i])

    found: dict[tuple[int, ...], int] = {}
    stack: list[Iterator[tuple[int, int, tuple[int, ...]]]] = [iter([(0, space, ())])]
    tried = 0
    while stack and tried < SEARCH_NODES:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            continue
        tried += 1
        _, room, chosen = step
        more = following(*step)
        if (one := next(more, None)) is not None:
            stack.append(chain([one], more))
        elif not _dominated(number, longer, chosen, room):
            found[chosen] = room
    found.pop(tuple(first), None)
    for chosen in sorted(found, key=found.__getitem__):
        yield [largest, *chosen]


def lower_bound(counts: np.ndarray) -> int:
    """Sequences that any plan needs: by tokens, and by pieces too large to share one (Martello and Toth)."""
    capacity = len(counts) - 1
    number, tokens = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(counts * np.arange(capacity + 1))]
    half = capacity // 2
    low = np.arange(half + 1)  # pieces shorter than this are left out
    large = number[-1] - number[capacity - low + 1]
    middle = number[capacity - low + 1] - number[half + 1]
    free = middle * capacity - (tokens[capacity - low + 1] - tokens[half + 1])
    small = tokens[half + 1] - tokens[low]
    return int((large + middle + np.maximum(0, -((free - small) // capacity))).max())


def best_fit(counts: np.ndarray) -> list[Filling]:
    """The best-fit decreasing plan: bins of equal contents are one group, by the room left."""
    capacity = len(counts) - 1
    bins: dict[int, list[Filling]] = {}
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        for room in [*sorted(r for r in bins if r >= length), capacity]:
            each = room // length
            groups = bins.pop(room, []) if room < capacity else [Filling([], -(-left // each))]
            while groups and left:
                group = groups.pop()
                full = min(group.times, left // each)
                rest = min(left - full * each, each) if full < group.times else 0
                for n, times in ((each, full), (rest, 1 if rest else 0)):
                    if times:
                        bins.setdefault(room - n * length, []).append(Filling([*group.lengths, *[length] * n], times))
                left -= full * each + rest
                over = group.times - full - (1 if rest else 0)
                if over:
                    groups.append(Filling(group.lengths, over))
            if groups and room < capacity:
                bins.setdefault(room, []).extend(groups)
            if not left:
                break
    return [f for groups in bins.values() for f in groups]


def _branches(left: np.ndarray, fillings: Iterable[list[int]], made: tuple | None, used: int) -> Iterator[tuple[np.ndarray, Filling, tuple | None, int]]:
    """Each filling as often as its lengths last, and once, so that any mix of fillings is a branch."""
    for lengths in fillings:
        most = min(int(left[x]) // lengths.count(x) for x in set(lengths))
        for times in dict.fromkeys((most, 1)):
            yield left, Filling(lengths, times), made, used


def plan(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = PLAN_NODES) -> list[Filling]:
    """Fillings for all pieces of the histogram; their ``times`` are the sequences.

    ``nodes`` bounds the branchings after the first descent, the greedy completion, which goes on
    until it ends or cannot beat best fit: the plan is no worse than either.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    best = best_fit(counts)
    fewest, least = sum(f.times for f in best), lower_bound(counts)
    # A branch: the pieces before it, its filling, the fillings before it as a linked list, their sequences.
    stack: list[Iterator[tuple[np.ndarray, Filling | None, tuple | None, int]]] = [iter([(counts, None, None, 0)])]
    descended, done = False, 0
    while stack and fewest > least and (done < nodes or not descended):
        branch = next(stack[-1], None)
        if branch is None:
            stack.pop()
            continue
        before, filling, made, used = branch
        left = before.copy()
        if filling:
            np.subtract.at(left, filling.lengths, filling.times)
            made, used = (filling, made), used + filling.times
        if used + lower_bound(left) >= fewest:
            descended = True
            continue
        if not left.any():
            descended, fewest, best = True, used, []
            while made:
                best.append(made[0])
                made = made[1]
            best.reverse()
            continue
        done += descended
        fillings = _fillings(left, int(np.flatnonzero(left)[-1]))
        # No more branches than nodes can be visited.
        stack.append(_branches(left, islice(fillings, max(1, nodes - done)), made, used))
    return best


def _slots(fillings: list[Filling], capacity: int) -> dict[int, np.ndarray]:
    """By length: rows of first number, pieces a sequence, first sequence, first offset."""
    used = np.zeros(capacity + 1, dtype=np.int64)
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for filling in fillings:
        offset = 0
        for length in sorted(set(filling.lengths), reverse=True):
            n = filling.lengths.count(length)
            rows.setdefault(length, []).append((int(used[length]), n, sequence, offset))
            used[length] += n * filling.times
            offset += n * length
        sequence += filling.times
    return {length: np.array(r, dtype=np.int64) for length, r in rows.items()}


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no sequence exceeds ``capacity`` tokens.

    ``cut`` has ``doc_id``, ``piece`` and ``length`` (1 to ``capacity``) and any other columns, which are kept.
    """
    ranked = numbered(cut, "length", ["doc_id", "piece"], "_number", "packing-numbers")
    # At most one row for each possible length.
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots = _slots(plan(histogram, capacity), capacity)
    columns = cut.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = batch["length"].to_numpy(), batch["_number"].to_numpy()
            sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
            for length in np.unique(lengths):
                here = np.flatnonzero(lengths == length)
                own = slots[int(length)]
                first, n, base, start = own[np.searchsorted(own[:, 0], numbers[here], side="right") - 1].T
                turn = numbers[here] - first
                sequence[here], offset[here] = base + turn // n, start + turn % n * length
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.select(*columns, "_number").mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequence and offset; an empty table has none."""
    return pack(stored(pieces(docs, tokenizer, capacity), "packing-pieces"), capacity)


def op8_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
