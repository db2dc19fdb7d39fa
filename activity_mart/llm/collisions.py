"""Operator 6: nearest neighbours by collision counting.

Each hash function is one projection on a random line; a block of vectors keeps, for each, its
vectors sorted by projection. A query's windows are centred on its own projections. Virtual
rehashing widens them by the factor ``GROWTH`` until enough vectors have collided with the query,
that is lie inside its window, in at least ``threshold`` of the projections; those are verified on the original
vectors. Largest inner product becomes least distance by one more component that
gives all stored vectors the same length.

Blocks of vectors meet blocks of queries; each pair is one group. Neither side is sent whole
to a task or to the driver, and a pair returns at most ``k`` rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from activity_mart.llm.common import ship, stored, table

NEAREST = 20
QUERY_STEP = 20
PROJECTIONS = 64
# Share of the projections in which a vector must lie inside the window to be verified.
COLLIDING = 0.6
# Share of a block's vectors to verify for a query, and a least number of them.
VERIFIED, VERIFIED_LEAST = 0.35, 1_000
LEAST_WIDTH = 0.05
GROWTH = 1.05
BLOCK_VECTORS, BLOCK_QUERIES, QUERIES_AT_ONCE = 16_384, 2_048, 256
SEED = 20


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, vector`` without vectors that are null, empty, all zero, or hold null or non-finite components.

    The vectors' length must be the same for all; the length that most have counts, the others take no part.
    """
    vector = F.col(vector_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    clean = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    )
    return clean


def _first_width(centred: np.ndarray, places: np.ndarray, threshold: int, wanted: int) -> float:
    """A width a little too narrow for half of a few queries, to begin from."""
    widths = []
    for query in centred[:: max(1, len(centred) // 8)][:8]:
        reached = np.partition(np.abs(places - query), threshold - 1, axis=1)[:, threshold - 1]
        widths.append(np.partition(reached, wanted - 1)[wanted - 1])
    return max(float(np.median(widths)) / GROWTH**2, LEAST_WIDTH)


def _search(queries: np.ndarray, held: np.ndarray, longest: float, wanted: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query the vectors to verify."""
    n = len(held)
    wanted = min(wanted, n)
    directions = np.random.default_rng(SEED).standard_normal((held.shape[1] + 1, PROJECTIONS))
    unit = held / longest
    # The added component: with it every stored vector has length one.
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", unit, unit)))
    places = unit @ directions[:-1] + rest[:, None] * directions[-1]
    centred = queries / np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-300) @ directions[:-1]
    order = np.ascontiguousarray(np.argsort(places, axis=0, kind="stable").T)
    ordered = np.ascontiguousarray(np.sort(places, axis=0).T)
    threshold = int(np.ceil(COLLIDING * PROJECTIONS))
    first = _first_width(centred, places, threshold, wanted)

    for start in range(0, len(queries), QUERIES_AT_ONCE):
        waiting = np.arange(start, min(start + QUERIES_AT_ONCE, len(queries)))
        counts = np.zeros((len(waiting), n), dtype=np.int16)
        low = high = None
        width = first
        while len(waiting):
            # Window ends by binary search; a wider window adds only the strips beside the last one.
            new_low = np.array([np.searchsorted(ordered[j], centred[waiting, j] - width, "left") for j in range(PROJECTIONS)])
            new_high = np.array([np.searchsorted(ordered[j], centred[waiting, j] + width, "right") for j in range(PROJECTIONS)])
            if low is None:
                low = high = (new_low + new_high) // 2
            stays = np.ones(len(waiting), dtype=bool)
            for i, query in enumerate(waiting):
                strips = [order[j, new_low[j, i] : low[j, i]] for j in range(PROJECTIONS)] + [order[j, high[j, i] : new_high[j, i]] for j in range(PROJECTIONS)]
                counts[i] += np.bincount(np.concatenate(strips), minlength=n).astype(np.int16)
                hits = np.flatnonzero(counts[i] >= threshold)
                if len(hits) >= wanted:
                    stays[i] = False
                    yield query, hits
            waiting, counts, low, high = waiting[stays], counts[stays], new_low[:, stays], new_high[:, stays]
            width *= GROWTH


def nearest(queries: DataFrame, vectors: DataFrame, k: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` found vectors by inner product, in double precision.

    Both sides have ``vec_id, vector`` as :func:`usable` gives them. A query is no neighbour of
    itself; ties go to the smaller id; repeated ids count once for each row, and equal vectors are
    neighbours like any other. Fewer than ``k`` candidates give them all; no queries, no rows.
    """
    spark = vectors.sparkSession
    shape = vectors.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)), F.count("*"), F.mode(F.size("vector"))).first()
    longest, n, dimensions = float(shape[0] or 1.0) ** 0.5, shape[1], shape[2] or 0
    n_queries = queries.count()
    blocks, query_blocks = max(1, -(-n // BLOCK_VECTORS)), max(1, -(-n_queries // BLOCK_QUERIES))
    same = F.size("vector") == dimensions
    block = lambda of, parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias(of)
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = queries.filter(same).select("vec_id", "vector", block("q", query_blocks), every(blocks).alias("b"))
    right = vectors.filter(same).select("vec_id", "vector", block("b", blocks), every(query_blocks).alias("q"))
    wanted = max(VERIFIED_LEAST, 10 * k)

    def meet(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(held):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        a, b = np.stack(asking["vector"].to_numpy()), np.stack(held["vector"].to_numpy())
        ids, own = held["vec_id"].to_numpy(), asking["vec_id"].to_numpy()
        rows = []
        for query, hits in _search(a, b, longest, max(wanted, int(VERIFIED * len(b)))):
            hits = hits[ids[hits] != own[query]]
            score = b[hits] @ a[query]
            if len(hits) > k:
                enough = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
                hits, score = hits[enough], score[enough]
            best = np.lexsort((ids[hits], -score))[:k]
            rows.append((np.full(len(best), own[query]), ids[hits[best]], score[best]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*rows, strict=True)), strict=True)))

    found = left.groupBy("b", "q").cogroup(right.groupBy("b", "q")).applyInPandas(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    vectors = stored(usable(table(spark, sf_dir, "embeddings")), "vectors")
    return nearest(vectors.filter(F.col("vec_id") % QUERY_STEP == 0), vectors)
