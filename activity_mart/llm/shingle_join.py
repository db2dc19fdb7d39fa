"""Operator 2: n-gram Jaccard join with a count-vector R-tree.

A document's word shingles are hashed into groups. A document with its copies is a node. Two linked
nodes differ in at most ``d`` shingles, which sizes bound, so with ``d + 1`` groups they agree in one
group at least: equal groups bring nodes together, and no link is lost.

Within a group's nodes, the first ones are compared with the others. What that leaves unconnected
goes to the R-tree: group counts are points, the overlap of two nodes is at most the sum of the
smaller coordinates, and a box of points bounds it by its largest coordinates. Of the pairs that
survive, first one for each two components that it joins is verified on the shingles themselves, then
all that these links leave apart. An R-tree alone would compare every document with
most others of its size, as boxes over so many coordinates overlap.

Every comparison looks at the two points first: only the shingles of pairs that these leave are shuffled.

Words, shingles and sets are told apart by 64-bit digests.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_mart.llm.common import components, drop_table, few_files, parts_of, ship, slot, slots, stored, table, text_chunks, text_of, without_ids

WORDS, PERCENT = 4, 85
TEXT_CHUNK = 1_000_000
# Coordinates of a point, points in a box, nodes of a bucket that meet at once.
COORDINATES, BOX, BLOCK = 256, 32, 512
# Groups of meetings for each shuffle partition: a group is searched by itself, at a fixed cost.
MEETINGS = 4
# Rounds of hashing for nodes that have many empty groups; one in so many groups may be empty.
LEVELS, SPARE_OF = 4, 15
SENT_TOGETHER = 1_000_000
# Pairs that are looked at together.
ASKED_TOGETHER = 100_000

_U = np.uint64
_BASE = pow(0x9E3779B97F4A7C15, 1, 1 << 64) | 1
_BACK = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the finaliser of a public generator)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, dtype=_U), np.full(n, _BACK, dtype=_U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


_LETTERS = mix(np.arange(1, 257, dtype=_U))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A digest of each word, in order, and how many words each text has."""
    joined = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = _SPACE[joined]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    if len(joined) <= 2 * TEXT_CHUNK:
        up, down = (p[: len(joined)] for p in _powers(2 * TEXT_CHUNK))
    else:
        up, down = _powers(1 << len(joined).bit_length())
        up, down = up[: len(joined)], down[: len(joined)]
    upto = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(_LETTERS[joined] * up, dtype=_U)])
    words = mix((upto[ends] - upto[starts]) * down[starts] + (ends - starts).astype(_U))
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    return words, np.diff(np.searchsorted(starts, edges + 1))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted digests; one of the whole text if it has fewer words."""
    digests, counts = word_digests([t.encode().lower() for t in texts])
    rolled = digests.copy()
    for k in range(1, words):
        n = max(0, len(rolled) - k)
        rolled[:n] = mix(rolled[:n] * _U(_BASE) + digests[k:])
    made, at = [], 0
    for n in counts.tolist():
        if n >= words:
            made.append(np.unique(rolled[at : at + n - words + 1]))
        elif n:
            own = digests[at : at + n]
            made.append(mix((own * mix(np.arange(1, n + 1, dtype=_U))).sum(dtype=_U, keepdims=True) + _U(n)))
        else:
            made.append(np.empty(0, dtype=_U))
        at += n
    return made


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


@functools.lru_cache(maxsize=8)
def _sizes(percent: int, most: int) -> np.ndarray:
    """Last set size of each class: a set links only with its own class and the next on either side."""
    last, ends = 0, []
    while last < most:
        last = (last + 1) * 100 // percent
        ends.append(last)
    return np.array(ends, dtype=np.int64)


def signatures(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Digests of the set's groups, for its own size class and the next one."""
    n = len(shingles)
    if not n:
        return shingles
    ends = _sizes(percent, 1 << max(16, n.bit_length() + 1))
    own = int(np.searchsorted(ends, n))
    made = []
    for family in (own, own + 1):
        # Linked sets of these classes differ in at most so many shingles. With some groups more,
        # they agree in one that isn't empty unless more than ``spare`` groups are empty in both.
        differ = int(2 * ends[family] * (100 - percent) // (100 + percent))
        spare = differ // SPARE_OF + 2 if differ else 0
        groups = differ + 1 + spare
        ordered = shingles
        for level in range(LEVELS):
            if level:
                ordered = np.sort(mix(shingles + _U(level)))
            cuts = (np.arange(groups + 1, dtype=np.float64) * (2.0**64 / groups)).astype(np.float64)
            edges = np.concatenate([[0], np.searchsorted(ordered, np.minimum(cuts[1:-1], 2.0**64 - 2048).astype(_U)), [n]])
            upto = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(mix(ordered ^ _U(0xA5A5)), dtype=_U)])
            filled = edges[1:] > edges[:-1]
            named = mix(_U((family * LEVELS + level) << 32) + np.arange(groups, dtype=_U))
            digest = mix((upto[edges[1:]] - upto[edges[:-1]]) ^ named)
            # Two sets that agree in empty groups alone both go on to the next level, with other groups.
            made.append(digest if level == LEVELS - 1 else digest[filled])
            if groups - filled.sum() <= spare:
                break
    return np.concatenate(made)


def points(sets: list[np.ndarray]) -> np.ndarray:
    """Each set's counts of shingles by hash group."""
    made = np.zeros((len(sets), COORDINATES), dtype=np.int32)
    for i, s in enumerate(sets):
        made[i] = np.bincount((s >> _U(56)).astype(np.int64), minlength=COORDINATES)
    return made


def packed(point: np.ndarray) -> bytes:
    """A point as bytes: one for each coordinate, or four if one of them is large."""
    return point.astype(np.uint8 if point.max() < 256 else np.int32).tobytes()


def unpacked(point: bytes) -> np.ndarray:
    return np.frombuffer(point, dtype=np.uint8 if len(point) == COORDINATES else np.int32)


def _profiles(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, node``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text", TEXT_CHUNK):
            sets = shingle_sets(batch["text"].to_pylist(), words)
            nodes = pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([len(s) for s in sets], pa.int64()), nodes], ["doc_id", "n_shingles", "node"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, node long")


def _combined(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``bucket, node, n, signature, lead``: before the shuffle, a task keeps of each signature its first node.

    That row's bucket is the signature, and ``n`` the task's nodes that have it. The task's other nodes of that signature are
    rows that name the signature and that node as their lead, under a bucket of their own, so that no signature
    gathers them. A task signs a node once; of its signatures only those it shares are kept, as all outweigh the texts.
    """

    def flush(signature: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((node, signature))
        signature, node = signature[order], node[order]
        head = np.r_[True, signature[1:] != signature[:-1]]
        first = np.flatnonzero(head)
        n = np.diff(np.r_[first, len(head)])
        lead = np.repeat(node[first], n)
        bucket = np.where(head, signature, mix(signature.view(_U) * _U(_BASE) + node.view(_U) + _U(1)).view(np.int64))
        columns = [pa.array(bucket), pa.array(node), pa.array(np.repeat(n, n).astype(np.int32)), pa.array(signature, mask=head), pa.array(lead, mask=head)]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "node", "n", "signature", "lead"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size, told = [], 0, set()
        for batch in text_chunks(batches, "text", TEXT_CHUNK):
            for s in shingle_sets(batch["text"].to_pylist(), words):
                if len(s) and (node := node_of(s)) not in told:
                    told.add(node)
                    kept.append((signatures(s, percent).view(np.int64), node))
                    size += len(kept[-1][0])
            if size > SENT_TOGETHER:
                yield flush(np.concatenate([k for k, _ in kept]), np.repeat([n for _, n in kept], [len(k) for k, _ in kept]))
                kept, size = [], 0
            if len(told) > SENT_TOGETHER:
                told.clear()
        if kept:
            yield flush(np.concatenate([k for k, _ in kept]), np.repeat([n for _, n in kept], [len(k) for k, _ in kept]))

    return docs.select("text").mapInArrow(run, "bucket long, node long, n int, signature long, lead long")


def _shared(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``signature, node, lead`` of every signature that several nodes have; a row may come twice.

    ``lead`` is a node to compare with: the task's first of that signature, or the first of all for a task's first.
    """
    bucket = Window.partitionBy("bucket")
    found = _combined(docs, words, percent).withColumns({"first": F.min("node").over(bucket), "last": F.max("node").over(bucket)})
    found = found.filter("lead IS NOT NULL OR first < last OR n > 1")
    return found.select(F.coalesce("signature", "bucket").alias("signature"), "node", F.coalesce("lead", "first").alias("lead"))


def _sets(docs: DataFrame, profiles: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node, shingles, point`` of the given nodes, made again from one text of each.

    Some other nodes may be among them, and a node may come twice; neither changes what is joined.
    """
    wanted = profiles.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    wanted = stored(wanted, "join-nodes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text", TEXT_CHUNK):
            sets = shingle_sets(batch["text"].to_pylist(), words)
            columns = [pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([packed(p) for p in points(sets)], pa.binary())], ["node", "shingles", "point"])

    near = docs.withColumn("_slot", slot("doc_id")).join(F.broadcast(slots(wanted, "doc_id")), "_slot", "left_semi")
    return near.select("text").mapInArrow(run, "node long, shingles array<long>, point binary")


def _near(sets: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The sets whose node is among the wanted ones, and few others."""
    return sets.withColumn("_slot", slot("node")).join(F.broadcast(slots(wanted, column)), "_slot", "left_semi").drop("_slot")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` of nodes ``a, b`` with ``linked``: bounded by group counts first, then counted. Pairs that come with ``fits`` are within those bounds."""

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = np.empty(0, dtype=bool)
            for start in range(0, batch.num_rows, 8_192):
                x, y = (np.stack([unpacked(p) for p in batch[side].slice(start, 8_192).to_pylist()]) for side in ("left", "right"))
                sizes = [p.sum(axis=1, dtype=np.int64) for p in (x, y)]
                least = percent * (sizes[0] + sizes[1])
                common = np.minimum(np.minimum(*sizes), np.minimum(x, y).sum(axis=1, dtype=np.int64))
                fits = np.r_[fits, common * (100 + percent) >= least]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(fits, pa.bool_())], ["a", "b", "fits"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [(c.values.to_numpy().view(_U), c.offsets.to_numpy()) for c in (batch["left"], batch["right"])]
            linked = []
            for i in range(batch.num_rows):
                x, y = (values[at[i] : at[i + 1]] for values, at in held)
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    def met(some: DataFrame, column: str) -> DataFrame:
        # Only sets that are compared are shuffled, but for a few that share a slot with one.
        side = lambda of, name: _near(sets.select("node", column), some, of).select(F.col("node").alias(of), F.col(column).alias(name))
        return some.join(side("b", "right"), "b").join(side("a", "left"), "a").select("a", "b", "left", "right")

    def linked(some: DataFrame) -> DataFrame:
        return few_files(met(some, "shingles").mapInArrow(counted, "a long, b long, linked boolean").distinct())

    known = "fits" in pairs.columns
    pairs = stored(few_files(pairs.select("a", "b")), "join-compared")
    if known:
        return linked(pairs)
    looked = stored(few_files(met(pairs, "point").mapInArrow(bounded, "a long, b long, fits boolean").distinct()), "join-bounded")
    return linked(looked.filter("fits").select("a", "b")).unionByName(looked.filter("NOT fits").select("a", "b", F.lit(False).alias("linked")))


def _leaf_pairs(edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs within each run of at most ``BOX`` rows, runs of one length at a time."""
    sizes = np.diff(edges)
    for size in np.unique(sizes[(sizes > 1) & (sizes <= BOX)]).tolist():
        starts = edges[:-1][sizes == size][:, None]
        one, other = np.triu_indices(size, 1)
        yield (starts + one).ravel(), (starts + other).ravel()


def _tree_pairs(point: np.ndarray, total: np.ndarray, asks: np.ndarray, held: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs that the boxes over ``held`` leave for each of ``asks``."""
    # Packed boxes: neighbours in size and then in their strongest group lie together.
    held = held[np.lexsort((point[held].argmax(axis=1), total[held]))]
    first = np.arange(0, len(held), BOX)
    box = np.maximum.reduceat(point[held], first, axis=0)
    low, high = total[held][first], np.maximum.reduceat(total[held], first)
    for i in asks.tolist():
        size = total[i]
        fits = (100 * high >= percent * size) & (100 * size >= percent * low)
        fits[fits] = np.minimum(box[fits], point[i]).sum(axis=1) * (100 + percent) >= percent * (size + low[fits])
        for leaf in np.flatnonzero(fits):
            own = held[first[leaf] : first[leaf] + BOX]
            yield np.full(len(own), i), own


def _forest(a: np.ndarray, b: np.ndarray, part: np.ndarray, nearness: np.ndarray) -> np.ndarray:
    """Places of the pairs that each join two components that the nearer pairs left apart."""
    up = list(range(len(part)))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    taken = []
    for i in np.argsort(-nearness, kind="stable").tolist():
        x, y = top(part[a[i]]), top(part[b[i]])
        if x != y:
            up[x] = y
            taken.append(i)
    return np.array(taken, dtype=np.int64)


def _search(rows: pd.DataFrame, percent: int, forest: bool) -> pd.DataFrame:
    """Pairs of nodes of different components that the counts can't rule out; of ``forest``, one for each two components that it joins.

    ``rows`` holds whole meetings of two blocks of what one ``signature`` names, any number of them. A meeting that
    fits into one leaf is scanned as that leaf, all such meetings at once.
    """
    rows = rows.sort_values(["signature", "low", "high"], kind="stable")
    names, first, node = np.unique(rows["node"].to_numpy(), return_index=True, return_inverse=True)
    part = np.unique(rows["component"].to_numpy()[first], return_inverse=True)[1]
    point = np.stack(rows["point"].iloc[first].to_numpy()).astype(np.int32)
    total = point.sum(axis=1, dtype=np.int64)
    block, low, high = (rows[c].to_numpy() for c in ("block", "low", "high"))
    key = rows[["signature", "low", "high"]].to_numpy()
    edges = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
    left = np.empty(0, dtype=np.int64)
    nearness = np.empty(0)

    def kept(one: np.ndarray, other: np.ndarray) -> None:
        nonlocal left, nearness
        a, b = np.minimum(one, other), np.maximum(one, other)
        near = (part[a] != part[b]) & (100 * np.minimum(total[a], total[b]) >= percent * np.maximum(total[a], total[b]))
        pair = np.setdiff1d(np.unique(a[near] * len(names) + b[near]), left)
        for at in range(0, len(pair), 8_192):
            some = pair[at : at + 8_192]
            a, b = some // len(names), some % len(names)
            overlap, both = np.minimum(point[a], point[b]).sum(axis=1), total[a] + total[b]
            fits = overlap * (100 + percent) >= percent * both
            left, nearness = np.r_[left, some[fits]], np.r_[nearness, overlap[fits] / both[fits]]

    for one, other in _leaf_pairs(edges):
        across = (low[one] == high[one]) | (block[one] != block[other])
        kept(node[one[across]], node[other[across]])
    found, size = [], 0
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if end - start > BOX:
            own = node[start:end]
            inside, times = np.unique(part[own], return_inverse=True, return_counts=True)[1:]
            # Of two nodes of different components, one at least is outside the largest: only such nodes ask.
            asks = inside != times.argmax()
            lower, upper = block[start:end] == low[start], block[start:end] == high[start]
            sides = [(lower, upper)] if low[start] == high[start] else [(lower, upper), (upper, lower & ~asks)]
            for one, other in sides:
                if not ((one & asks).any() and other.any()):
                    continue
                for pairs in _tree_pairs(point, total, own[one & asks], own[other], percent):
                    found.append(pairs)
                    size += len(pairs[0])
                    if size > ASKED_TOGETHER:
                        kept(*map(np.concatenate, zip(*found, strict=True)))
                        found, size = [], 0
    if found:
        kept(*map(np.concatenate, zip(*found, strict=True)))
    a, b = left // max(1, len(names)), left % max(1, len(names))
    if forest:
        taken = _forest(a, b, part, nearness)
        a, b = a[taken], b[taken]
    return pd.DataFrame({"a": names[a], "b": names[b]}, dtype=np.int64)


def _in_doubt(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """``signature, node`` of the buckets that hold nodes of several components, but for the first comparisons."""
    own = shared.select("signature", "node").distinct().join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    bucket = Window.partitionBy("signature")
    members = own.withColumns(
        {
            "low": F.min("component").over(bucket),
            "high": F.max("component").over(bucket),
            "n": F.count("*").over(bucket),
            "sum": F.sum(F.shiftright(F.xxhash64("node"), 16)).over(bucket),
            "xor": F.bit_xor(F.xxhash64("node")).over(bucket),
        }
    )
    # Two nodes alone have been compared. Buckets with the same nodes need one search.
    members = stored(members.filter("low < high AND n > 2").drop("low", "high", "component"), "join-members")
    buckets = members.groupBy("n", "sum", "xor").agg(F.min("signature").alias("signature")).select("signature")
    return stored(members.select("signature", "node").join(buckets, "signature"), "join-buckets")


def _unconnected(members: DataFrame, parts: DataFrame, checked: DataFrame, points_of: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Pairs ``a, b`` that share a bucket but neither a component nor, yet, a comparison; all ``fits``, as the search bounds them.

    With ``forest``, a task gives at most one pair for each two components that it joins, the nearest
    first; so the pairs are fewer than the nodes, however large a group of copies is. Without, all pairs that the counts leave.

    Buckets with the same first node hold much the same nodes: they are searched as one, with a row for each node and not for
    each of its signatures. So pairs that share only a first node may be among those returned; no link can.
    """
    own = members.join(parts, "node", "left").select("signature", "node", F.coalesce("component", "node").alias("component"))
    apart = own.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("node").alias("first"))
    own = own.join(apart.filter("low < high").select("signature", "first"), "signature").select("first", "node", "component").distinct()
    sizes = own.groupBy("first").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = own.join(sizes, "first").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("first", "node", "component", "block", other).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    meeting = F.pmod(F.xxhash64("first", "low", "high"), F.lit(MEETINGS * parts_of(members.sparkSession))).alias("meeting")
    rows = stored(rows.select(meeting, F.col("first").alias("signature"), "node", "component", "block", "low", "high"), "join-meetings")
    held = rows.select(F.col("meeting").alias("_meeting"), F.col("node").alias("_node")).distinct()
    held = held.join(points_of, F.col("_node") == F.col("node")).select("_meeting", "_node", "point")

    def search(some: pd.DataFrame, own_points: pd.DataFrame) -> pd.DataFrame:
        point = dict(zip(own_points["_node"].tolist(), map(unpacked, own_points["point"]), strict=True))
        return _search(some.assign(point=some["node"].map(point)), percent, forest)

    found = rows.groupBy("meeting").cogroup(held.groupBy("_meeting")).applyInPandas(search, "a long, b long")
    return found.distinct().join(checked.select("a", "b"), ["a", "b"], "left_anti").withColumn("fits", F.lit(True))


def _merged(parts: DataFrame, checked: DataFrame) -> DataFrame:
    """Components after more comparisons; those so far stand for the links that made them."""
    added = checked.filter("linked").select("a", "b")
    if added.isEmpty():
        return parts
    return stored(few_files(components(parts.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(added))), "join-components")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (``doc_id, text``).

    Case is folded for A to Z only. Null and empty texts, and texts of white space, have no
    shingles and are their own component. Copies are one node, so that a group of them costs one
    comparison; rows with one id and different texts stay apart unless their texts link. A row
    without id has the smallest id of its component, null if there is none. An empty table
    has no rows; other columns are not read.
    """
    return _located(docs, words, percent).drop("node")


def _located(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``near_duplicates`` with each row's ``node``."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    profiles = stored(_profiles(docs, words), "join-profiles")
    shared = stored(_shared(docs, words, percent), "join-shared")
    pairs = shared.filter("lead <> node").select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b"))
    pairs = stored(pairs.groupBy("a", "b").agg(F.count("*").alias("shared")), "join-pairs")
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = stored(_sets(docs, profiles, ends, words), "join-sets")

    # First each node with the one it shares most groups with; then the pairs that are still apart.
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b")
    checked = stored(_verified(best, sets, percent), "join-checked")
    parts = stored(few_files(components(checked.filter("linked").select("a", "b"))), "join-components")
    side = lambda name: parts.select(F.col("node").alias(name), F.col("component").alias(f"part_{name}"))
    rest = pairs.join(checked, ["a", "b"], "left_anti").join(side("a"), "a", "left").join(side("b"), "b", "left")
    apart = rest.filter(F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).select("a", "b")
    later = stored(_verified(apart, sets, percent), "join-checked")
    checked = checked.unionByName(later)
    parts = _merged(parts, later)
    members = _in_doubt(shared, parts)
    # Stored sets may hold a node twice.
    points_of = stored(_near(sets.select("node", "point"), members, "node").dropDuplicates(["node"]), "join-points")
    # Nearest pairs first, one for each two components; what they leave apart is compared in full.
    for forest in (True, False):
        more = stored(_verified(_unconnected(members, parts, checked, points_of, percent, forest), sets, percent), "join-checked")
        checked = checked.unionByName(more)
        parts = _merged(parts, more)
    for done in (shared, pairs, sets, members, points_of):
        drop_table(done)

    classes = profiles.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first_doc"))
    grouped = stored(classes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")), "join-classes")
    smallest = grouped.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    named = grouped.join(smallest, "component").select("node", "component_id")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return profiles.select("doc_id", "n_shingles", "node").join(named, "node", "left").select("doc_id", "n_shingles", own.alias("component_id"), "node")


def _with_node(docs: DataFrame, words: int) -> DataFrame:
    """``docs`` with ``_node``, the node of the row's own text."""
    columns = docs.columns
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text", TEXT_CHUNK):
            sets = shingle_sets([t or "" for t in batch.column(at).to_pylist()], words)
            nodes = pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, nodes], [*columns, "_node"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_node", T.LongType())]))


def one_of_each(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The rows of ``docs`` that have their component's smallest id, with all their columns.

    Of rows with equal id and text one stays; of rows with one id and different texts, each is
    judged by its own text's component. Rows without id stay.
    """
    found = stored(_located(docs, words, percent), "near-duplicates")
    dropped = found.filter("doc_id <> component_id").select("doc_id", F.col("node").alias("_node")).distinct()
    again = stored(found.groupBy("doc_id").count().filter("doc_id IS NOT NULL AND count > 1").select("doc_id"), "repeated-ids")
    if again.isEmpty():
        return without_ids(docs, dropped.select("doc_id"))
    lone = without_ids(without_ids(docs, again), dropped.join(again, "doc_id", "left_anti").select("doc_id"))
    repeated = _with_node(docs.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"]), words)
    return lone.unionByName(repeated.join(dropped, ["doc_id", "_node"], "left_anti").select(*docs.columns))


def op2_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
