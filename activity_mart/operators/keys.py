"""Dense surrogate keys and the uniqueness guard behind many-to-one joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from activity_mart.sources.store import stored

_PART = "_part"
_POSITION = "_position"
# monotonically_increasing_id keeps the partition above bit 33 and the row below it.
_ROW_BITS = 33


class DuplicateKeyError(ValueError):
    """A lookup side of a many-to-one join holds a key more than once."""


def dense_key(members: DataFrame, order: list[str], key: str) -> DataFrame:
    """Number distinct members 1..n in the order of ``order``, without a one-task sort.

    The members are range-partitioned, sorted within partitions and written once
    with their partition and position. The key is then the position plus the rows
    in earlier partitions; only one count per partition is ever gathered.
    """
    ids = F.monotonically_increasing_id()
    ordered = members.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(
        ordered.select(
            "*",
            F.shiftright(ids, _ROW_BITS).alias(_PART),
            ids.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(_POSITION),
        ),
        f"{key}-order",
    )
    before = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy(_PART).agg(F.count("*").alias("rows")).select(
        _PART, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    # One row per written partition, whatever the number of members.
    numbered = placed.join(F.broadcast(offsets), _PART)
    return numbered.select(
        (F.col("offset") + F.col(_POSITION) + 1).cast("bigint").alias(key), *members.columns
    )


def require_unique(df: DataFrame, columns: list[str], what: str) -> None:
    """Fail before a join could multiply rows."""
    repeated = df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1").limit(1)
    if not repeated.isEmpty():
        raise DuplicateKeyError(f"{what}: ({', '.join(columns)}) is not unique")
