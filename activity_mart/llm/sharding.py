"""Operator 10: shards as leaves of a k-d tree over document metadata.

A node with n shards of its own is split in two, along the metadata dimension in which its
documents spread widest, at the point that gives each side its share of the node's bytes. That
weighted median is found exactly by histograms: each round sums bytes by the next bits of the
sort key, within the one bin that holds the median.

The tree places groups of equal texts, one row each, so that none is split. Groups that are large
beside a shard would unbalance a cut; they are dealt to shards first, and the tree fills what is left.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from activity_mart.llm.common import drop_table, numbered, stored, table, text_of

SHARDS = 40
ROW_BYTES = 16
# A group of equal texts is large from this part of a shard's bytes on. Its pieces, if it has more
# bytes than a shard, are about as large.
LARGE = 16
# A sort key: a dimension's place, then the content.
PLACE_BITS, CONTENT_BITS = 20, 40
ROUND_BITS, ROUNDS = 15, 4


def _first_bytes(column: str) -> Column:
    """A text as a number that sorts as its first six bytes do; null as empty."""
    head = F.substring(F.coalesce(F.col(column), F.lit("")).cast("binary"), 1, 6)
    return F.conv(F.rpad(F.hex(head), 12, "0"), 16, 10).cast("double")


def _bits(value: Column, bits: int) -> Column:
    return F.shiftrightunsigned(value, 64 - bits)


def metadata(docs: DataFrame) -> DataFrame:
    """What the tree needs to know of each document: its size, and its place in three dimensions."""
    text = text_of()
    column = lambda name: name if name in docs.columns else None
    labels = [_first_bytes(c) if column(c) else F.lit(0.0) for c in ("lang", "source")]
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
        *[value.alias(f"at{i}") for i, value in enumerate([*labels, F.log2(F.octet_length(text) + F.lit(1.0))])],
    )


def dealt(sizes: list[tuple[int, int, int]], shards: int, leaf: float) -> tuple[list[dict], list[float]]:
    """Shards for the pieces ``(group, piece, bytes)`` of large groups, and the bytes each shard has left.

    A group of more bytes than a shard fills one emptiest shard after the other; any other goes whole to
    the emptiest shard, largest first. There are at most ``2 * LARGE`` pieces a shard, and a few of
    each large group.
    """
    whole: dict[int, list[tuple[int, int]]] = {}
    for group, piece, size in sizes:
        whole.setdefault(group, []).append((size, piece))
    loads = [(0, shard) for shard in range(shards)]
    made = []
    for group, pieces in sorted(whole.items(), key=lambda x: (-sum(size for size, _ in x[1]), x[0])):
        load, shard = heapq.heappop(loads)
        several = sum(size for size, _ in pieces) > leaf
        for size, piece in sorted(pieces, reverse=True):
            if several and load and load + size > leaf:
                load, shard = heapq.heappushpop(loads, (load, shard))
            load += size
            made.append({"group": group, "piece": piece, "shard": shard})
        heapq.heappush(loads, (load, shard))
    return made, [max(0.0, leaf - load) for load, _ in sorted(loads, key=lambda x: x[1])]


def kd_shards(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` and ``shard`` of every document.

    Shards are near equal in bytes. Equal texts (by a 64-bit digest) share a shard, unless they have more
    bytes together than one; then they fill as few as they can, by a hash of the id, and rows with
    equal ids stay together. A cut of the tree is off by less than one group, under a part in ``LARGE``
    of a shard. ``target_bytes`` gives as many shards as that size needs. Null texts count as
    empty; a null id is a value like any other; a text longer than a shard has one for itself; an
    empty table has no rows. Other columns of ``docs`` play no part, but for ``lang`` and ``source``.
    """
    meta = stored(metadata(docs), "shard-metadata")
    spark = docs.sparkSession
    # A hot text is one row a task before the shuffle. A group's place is the lowest of its rows'.
    groups = stored(meta.groupBy("group").agg(F.sum("size").alias("size"), *[F.min(f"at{i}").alias(f"at{i}") for i in range(3)]), "shard-groups")
    ends = groups.agg(F.sum("size"), *[F.min(f"at{i}") for i in range(3)], *[F.max(f"at{i}") for i in range(3)]).first()
    total = ends[0] or 0
    if target_bytes is not None:
        shards = max(1, -(-total // target_bytes))
    leaf = max(1.0, total / shards)

    # At most LARGE groups a shard.
    is_large = F.col("size") * LARGE > leaf
    pieces = F.when(F.col("size") > leaf, F.ceil(F.col("size") * LARGE / leaf)).otherwise(1)
    large = F.broadcast(groups.filter(is_large).select("group", pieces.alias("pieces")))
    hot = meta.join(large, "group").withColumn("piece", F.pmod(F.xxhash64("doc_id"), "pieces"))
    sizes = hot.groupBy("group", "piece").agg(F.sum("size").alias("size")).collect()
    made, room = dealt([(r.group, r.piece, r["size"]) for r in sizes], shards, leaf)
    where = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(made)), "array<struct<group:long,piece:long,shard:int>>")))
    columns = ["doc_id", "size", "text_crc32", "shard"]
    hot = hot.join(F.broadcast(where), ["group", "piece"]).select(*columns)

    scale = (1 << PLACE_BITS) - 1
    tie = _bits(F.xxhash64("group"), CONTENT_BITS)
    keys = []
    for i in range(3):
        lowest, highest = ends[1 + i] or 0.0, ends[4 + i] or 0.0
        width = highest - lowest
        place = ((F.col(f"at{i}") - lowest) * (scale / width)).cast("long") if width else F.lit(0).cast("long")
        keys.append(F.shiftleft(place, CONTENT_BITS).bitwiseOR(tie))
    tree = stored(groups.filter(~is_large).select("group", "size", F.array(*keys).alias("keys"), F.lit(0).alias("shard")), "shard-level")
    tree = _grown(tree, room)
    # A group that is not large has few rows beside a shard, so that no key of this join is hot.
    return meta.join(tree.select("group", "shard"), "group").select(*columns).unionByName(hot)


def _grown(tree: DataFrame, room: list[float]) -> DataFrame:
    """``tree``, all in shard 0, with its rows in the leaves, which take bytes in proportion to their room."""
    # A node is named by its first shard; how many it has is known to the driver.
    nodes = {0: len(room)}
    while open_nodes := {first: n for first, n in nodes.items() if n > 1}:
        shares = {}
        for first, n in open_nodes.items():
            left, both = sum(room[first : first + n // 2]), sum(room[first : first + n])
            shares[first] = left / both if both else (n // 2) / n
        split = _medians(tree, shares)
        place = lambda values: F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("shard")]
        if split:
            axis = {first: dimension for first, (dimension, _) in split.items()}
            cut = {first: key for first, (_, key) in split.items()}
            left = {first: n // 2 for first, n in open_nodes.items() if first in split}
            right_side = F.element_at("keys", place(axis) + 1) >= place(cut)
            before = tree
            # Written at each level: a plan over all levels would nest their conditions.
            tree = stored(before.withColumn("shard", F.when(right_side, F.col("shard") + place(left)).otherwise(F.col("shard"))), "shard-level")
            drop_table(before)
        nodes = {k: v for first, n in nodes.items() for k, v in (((first, n // 2), (first + n // 2, n - n // 2)) if n > 1 else ((first, n),))}
    return tree


def _medians(tree: DataFrame, shares: dict[int, float]) -> dict[int, tuple[int, int]]:
    """For each node the widest dimension and the sort key at which its right side begins.

    ``shares`` has the part of the node's bytes that belongs to its left side.

    Only sums come to the driver: a row for each node and round, and there are at most as many
    nodes as shards.
    """
    there = tree.filter(F.col("shard").isin([*shares]))
    place = lambda i: F.shiftright(F.col("keys")[i], CONTENT_BITS)
    spread = [(F.max(place(i)) - F.min(place(i))).alias(f"d{i}") for i in range(3)]
    widths = there.groupBy("shard").agg(F.sum("size").alias("size"), *spread).collect()
    axis = {r.shard: max(range(3), key=lambda i, r=r: (r[f"d{i}"], -i)) for r in widths}
    # Bytes still to pass before the cut, and the bits of the cut key found so far.
    wanted = {r.shard: r["size"] * shares[r.shard] for r in widths}
    found = dict.fromkeys(wanted, 0)
    if not wanted:
        return {}
    of = lambda values: F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("shard")]
    keyed = there.select("shard", "size", F.element_at("keys", of(axis) + 1).alias("key"))
    for step in range(ROUNDS):
        shift = ROUND_BITS * (ROUNDS - 1 - step)
        inside = keyed.filter(F.shiftright("key", shift + ROUND_BITS) == of(found).cast("long"))
        bins = inside.groupBy("shard", F.shiftright("key", shift).alias("bin")).agg(F.sum("size").alias("size"))
        upto = F.sum("size").over(Window.partitionBy("shard").orderBy("bin"))
        # The bin in which the wanted bytes are reached; the last one if rounding asks for more.
        passed = bins.select("shard", "bin", "size", upto.alias("upto")).withColumn("here", F.col("upto") >= of(wanted))
        best = passed.groupBy("shard").agg(
            F.min(F.when(F.col("here"), F.struct("bin", "upto", "size"))).alias("at"), F.max(F.struct("bin", "upto", "size")).alias("end")
        )
        for r in best.collect():
            at = r["at"] or r["end"]
            found[r.shard] = at.bin
            wanted[r.shard] -= at.upto - at.size
            if step == ROUNDS - 1 and wanted[r.shard] * 2 > at.size:
                found[r.shard] += 1  # the rows of the cut's own key belong to the side they unbalance least
    return {first: (axis[first], key) for first, key in found.items()}


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(table(spark, sf_dir, "documents"))
    return numbered(placed, "shard", ["text_crc32", "doc_id"], "slot", "shard-slots").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
