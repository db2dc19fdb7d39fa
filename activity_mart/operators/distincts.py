"""Distinct counts of dense keys that add up over levels: bitmaps merged upwards, the fact read once.

A bitmap covers 32,768 neighbouring keys in 4 KB, so a dimension of a million members is 31 bitmaps, however
many fact rows name them. A distinct count of every level would shuffle the keys once for each.
Null keys count for nothing, as in ``count_distinct``. Keys are the dense ones of a dimension: whole numbers from 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BUCKET, _MAP, _KEY = "_bucket", "_map", "_key"


def key_maps(rows: DataFrame, by: list[str], key: str) -> DataFrame:
    """Per group of ``by``, the bitmaps of the keys in it: columns ``by``, ``_bucket`` and ``_map``."""
    return rows.groupBy(*by, F.bitmap_bucket_number(key).alias(_BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(_MAP)
    )


def rolled_up(maps: DataFrame, by: list[str], count: str) -> DataFrame:
    """Distinct keys for each group of ``by``, and of every shorter start of it down to the grand total.

    ``maps`` comes from :func:`key_maps`, with any columns joined to it since. ``level`` is 0 for whole groups and
    has one more bit for each column left out, as ``grouping_id`` of a rollup has.
    """
    starts = [[*by[:n], _BUCKET] for n in range(len(by), -1, -1)]
    merged = maps.groupingSets(starts, *by, _BUCKET).agg(
        F.shiftright(F.grouping_id(), 1).cast("int").alias("level"), F.bitmap_count(F.bitmap_or_agg(_MAP)).alias(count)
    )
    return merged.groupBy(*by, "level").agg(F.sum(count).alias(count))


def totals_with_distincts(rows: DataFrame, totals: Sequence[Column], distincts: dict[str, str]) -> DataFrame:
    """One row: ``totals``, which are named sums, and distinct counts of keys, named by key in ``distincts``.

    One pass: rows become one set of bitmaps and sums for each combination of key buckets, and
    those few rows are taken apart by key and merged.
    """
    keys = list(distincts)
    buckets = {key: f"{_BUCKET}_{i}" for i, key in enumerate(keys)}
    maps = {key: f"{_MAP}_{i}" for i, key in enumerate(keys)}
    first = rows.groupBy(*[F.bitmap_bucket_number(key).alias(name) for key, name in buckets.items()]).agg(
        *totals, *[F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(name) for key, name in maps.items()]
    )
    summed = [f for f in first.schema.fields if f.name not in {*buckets.values(), *maps.values()}]

    def of(key: str) -> Column:
        # The sums go with the first key only, so that they are added once.
        values = [F.col(f.name) if key == keys[0] else F.lit(None).cast(f.dataType).alias(f.name) for f in summed]
        return F.struct(F.lit(key).alias(_KEY), F.col(buckets[key]).alias(_BUCKET), F.col(maps[key]).alias(_MAP), *values)

    apart = first.select(F.inline(F.array(*[of(key) for key in keys])))
    merged = apart.groupBy(_KEY, _BUCKET).agg(
        F.bitmap_count(F.bitmap_or_agg(_MAP)).alias(_MAP), *[F.sum(f.name).cast(f.dataType).alias(f.name) for f in summed]
    )
    return merged.agg(
        *[F.sum(f.name).cast(f.dataType).alias(f.name) for f in summed],
        *[F.coalesce(F.sum(F.when(F.col(_KEY) == key, F.col(_MAP))), F.lit(0)).alias(name) for key, name in distincts.items()],
    )
