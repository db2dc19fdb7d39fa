"""Operator 12: hard-negative mining with a matrix product in a residue number system.

Components are whole numbers, and scores must be exact. Both matrices are reduced modulo several
small primes; each product runs in float32, whose partial sums stay below 2**23 and so are
exact, and Chinese remaindering (in mixed radix) puts the signed score together. The primes are as many as the longest
vector demands: by Cauchy-Schwarz no score exceeds the largest squared length.

Blocks of anchors meet blocks of rows, so that no task holds more than one of each. The first pass finds
an anchor's positives, the second selects, for each positive, the best rows of other labels
whose score lies inside the window that the positive's score sets.
"""

from __future__ import annotations

from collections.abc import Callable
from math import prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from activity_mart.llm.common import parts_of, ship, stored, table

SCALE, ANCHOR_STEP, POSITIVES, NEGATIVES = 256, 100, 5, 10
# A negative's score lies between these shares of the positive's, in per cent.
LEAST, MOST = 30, 90
BLOCK_ROWS, BLOCK_ANCHORS, LEAST_BLOCK = 65_536, 4_096, 2_048
ROWS_AT_ONCE, ANCHORS_AT_ONCE = 4_096, 256
# Components in one product; a longer vector is summed up stretch by stretch.
STRETCH = 1_024
EXACT = 1 << 23
FOUND = "anchor_row long, anchor_id long, place int, row long, vec_id long, score long"


class Residues:
    """Exact products of whole-number matrices whose scores are at most ``bound`` in size."""

    def __init__(self, bound: int, dims: int):
        most = 2 * int((EXACT // max(1, min(dims, STRETCH))) ** 0.5) + 1
        primes = [p for p in range(3, min(most, 4_093) + 1, 2) if all(p % d for d in range(3, int(p**0.5) + 1, 2))]
        self.primes: list[int] = []
        # Four times the bound: a digit that rounding puts one step off still gives the right score.
        while prod(self.primes) <= 4 * bound + 4:
            self.primes.append(primes.pop())

    def split(self, matrix: np.ndarray) -> list[np.ndarray]:
        """The matrix modulo each prime, in float32 and centred on zero."""
        return [((matrix + p // 2) % p - p // 2).astype(np.float32) for p in self.primes]

    @staticmethod
    def _reduced(x: np.ndarray, p: int) -> np.ndarray:
        return x - np.float32(p) * np.rint(x * np.float32(1 / p))

    def product(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """``a @ b.T`` in 64-bit integers."""
        digits: list[np.ndarray] = []
        for p, left, right in zip(self.primes, a, b, strict=True):
            x = np.zeros((len(left), len(right)), dtype=np.float32)
            for at in range(0, left.shape[1], STRETCH):
                x = self._reduced(x + self._reduced(left[:, at : at + STRETCH] @ right[:, at : at + STRETCH].T, p), p)
            for q, digit in zip(self.primes, digits, strict=False):
                inverse = (pow(q, -1, p) + p // 2) % p - p // 2
                x = self._reduced(self._reduced(x - digit, p) * np.float32(inverse), p)
            digits.append(x)
        score = digits[-1].astype(np.int64)
        for p, digit in zip(self.primes[-2::-1], digits[-2::-1], strict=True):
            score = score * p + digit.astype(np.int64)
        return score


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """``vec_id, label, vector``: components ``floor(scale * x)``.

    Rows without id or label, and vectors that are null or hold null or non-finite components, are left out.
    """
    vector = F.col(vector_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & vector.isNotNull() & F.forall(vector, finite)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.transform(vector, lambda x: F.floor(x * scale)).alias("vector")
    )


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """The vectors as rows; a shorter one ends in zeros."""
    held = column.combine_chunks()
    lengths = pc.list_value_length(held).to_numpy(zero_copy_only=False)
    out = np.zeros((len(held), dims), dtype=np.int64)
    out[np.arange(dims) < lengths[:, None]] = held.flatten().to_numpy(zero_copy_only=False)
    return out


class Best:
    """The ``k`` best of each group: highest score first, then smallest id."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.held = np.empty((0, 4), dtype=np.int64)
        self.least = np.full(groups, np.iinfo(np.int64).min)

    def add(self, group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        every = np.concatenate([self.held, np.column_stack([group, score, vec_id, row])])
        every = every[np.lexsort((every[:, 3], every[:, 2], -every[:, 1], every[:, 0]))]
        heads = np.flatnonzero(np.r_[True, every[1:, 0] != every[:-1, 0]])
        place = np.arange(len(every)) - np.repeat(heads, np.diff(np.r_[heads, len(every)]))
        self.held = every[place < self.k]
        last = place == self.k - 1
        self.least[every[last, 0]] = every[last, 1]


def _pairs(anchors: DataFrame, rows: DataFrame, sizes: tuple[int, int], search: Callable, schema: str) -> DataFrame:
    """``search`` on every block of anchors with every block of rows."""
    row_blocks, anchor_blocks = sizes
    block = lambda parts: F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = anchors.withColumn("q", block(anchor_blocks)).select("*", every(row_blocks).alias("b"))
    # Renamed, as both sides come from one table.
    right = rows.toDF(*rows.columns).withColumn("b", block(row_blocks)).select("*", every(anchor_blocks).alias("q"))
    return left.groupBy("b", "q").cogroup(right.groupBy("b", "q")).applyInArrow(search, schema)


def _searching(residues: Residues, dims: int, k: int, least: int, most: int):
    """The search of one pair of blocks; anchors with ``positives`` look for negatives, others for positives."""

    def search(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["anchor_row", "anchor_id", "place", "row", "vec_id", "score"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        blank = pa.table([pa.array([], t) for t in kinds], names)
        if not len(anchors) or not len(rows):
            return blank
        number = lambda t, c: t.column(c).to_numpy()
        ids, labels, numbers = (number(rows, c) for c in ("vec_id", "label", "row"))
        held = residues.split(_matrix(rows.column("vector"), dims))
        own_ids, own_labels, own = (number(anchors, c) for c in ("vec_id", "label", "row"))
        asked = residues.split(_matrix(anchors.column("vector"), dims))
        mining = "positives" in anchors.column_names
        found = []
        for a in range(0, len(own), ANCHORS_AT_ONCE):
            part = slice(a, a + ANCHORS_AT_ONCE)
            n = len(own[part])
            if mining:
                scores = [p or [] for p in anchors.column("positives").slice(a, n).to_pylist()]
                places = max(map(len, scores))
                # A window that no score reaches stands for a missing positive.
                low, high = np.full((n, places), 1, dtype=np.int64), np.zeros((n, places), dtype=np.int64)
                for i, own_scores in enumerate(scores):
                    for j, score in enumerate(own_scores):
                        low[i, j], high[i, j] = -((-least * score) // 100), most * score // 100
            else:
                places = 1
            best = Best(n * places, k)
            for b in range(0, len(ids), ROWS_AT_ONCE):
                at = slice(b, b + ROWS_AT_ONCE)
                score = residues.product([x[part] for x in asked], [x[at] for x in held])
                same = own_labels[part, None] == labels[None, at]
                for j in range(places):
                    floor = best.least[j::places]
                    if mining:
                        fits = ~same & (score >= np.maximum(floor, low[:, j])[:, None]) & (score <= high[:, j, None])
                    else:
                        fits = same & (score >= floor[:, None]) & (own[part, None] != numbers[None, at])
                    i, row = np.nonzero(fits)
                    if len(i):
                        best.add(i * places + j, score[i, row], ids[at][row], numbers[at][row])
            i = best.held[:, 0] // places + a
            found.append((own[i], own_ids[i], best.held[:, 0] % places, best.held[:, 3], best.held[:, 2], best.held[:, 1]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return search


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best ``k`` of what the pairs of blocks found; each gave ``k`` rows a key at most."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchor: str = f"vec_id % {ANCHOR_STEP} = 0", positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id, label, vector`` as :func:`usable` gives them, and ``anchor`` is the
    test that makes a row an anchor. Higher scores come first, ties by smaller id. Every row counts for itself: one that repeats
    an anchor's id is another row to it, and each anchor and each positive gets its own list, so rows
    repeated in the input repeat in the result. Vectors of unequal length are compared as if the
    shorter ended in zeros. An anchor with fewer positives or negatives gives what there is; a table without
    anchors, or an empty one, gives no rows. Raises if a squared length reaches 2**60, as scores might not fit.
    """
    ship(vectors.sparkSession)
    rows = stored(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, anchors_n, longest, dims = rows.agg(F.count("*"), F.count_if(F.expr(anchor)), F.max(square), F.max(F.size("vector"))).first()
    if (longest or 0.0) >= 2.0**60:
        raise ValueError("the vectors are too long for exact scores")
    dims = max(1, dims or 0)
    residues = Residues(int((longest or 0.0) * (1 + 1e-9)) + 1, dims)
    row_blocks = max(1, -(-n // BLOCK_ROWS), min(parts_of(rows.sparkSession), n // LEAST_BLOCK))
    sizes = row_blocks, max(1, -(-anchors_n // BLOCK_ANCHORS))

    anchors = rows.filter(anchor)
    search = _searching(residues, dims, positives, least, most)
    own = stored(_best(_pairs(anchors, rows, sizes, search, FOUND), ["anchor_row"], positives), "positives")
    # At most ``positives`` of them.
    scores = own.groupBy(F.col("anchor_row").alias("row")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("positives")
    )
    search = _searching(residues, dims, negatives, least, most)
    found = _best(_pairs(anchors.join(scores, "row"), rows, sizes, search, FOUND), ["anchor_row", "place"], negatives)
    of = own.select("anchor_row", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(of, ["anchor_row", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op12_residue_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mine(usable(table(spark, sf_dir, "embeddings").withColumn("label", moved)))


def oracle_sql() -> str:
    """The query over table ``embeddings`` for DuckDB; doubles hold these scores exactly."""
    return f"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % {ANCHOR_STEP} = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND {LEAST} * p.positive_score <= 100 * s.score AND 100 * s.score <= {MOST} * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= {NEGATIVES}"""
