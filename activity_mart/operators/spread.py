"""Lookups that stay even when one key holds a large part of the rows, whatever adaptive execution does.

Rows of a hot key are dealt over several tasks by a salt, and the lookup's one row for that key is
repeated once for each salt. How many salts a key gets follows from its share of the rows, so that
each task's part of a key is bounded by the same share.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT, _SALTS, _ROWS = "_salt", "_salts", "_rows"
PLACE = "_place"


def _unknown(on: list[str]) -> Column:
    return reduce(or_, [F.col(name).isNull() for name in on])


def hot_keys(rows: DataFrame, on: list[str], parts: int) -> DataFrame:
    """Keys with more than a ``parts``-th of the rows that have a key, and the salts each needs.

    Fewer than ``parts`` keys can hold that much, whatever the number of rows, and all of them together
    get fewer than ``2 * parts`` salts. Keys with a null part are left out.
    """
    counts = rows.where(~_unknown(on)).groupBy(*on).agg(F.count("*").alias(_ROWS))
    share = F.col(_ROWS) * F.lit(parts) / counts.agg(F.sum(_ROWS)).scalar()
    return counts.where(share > 1).select(*on, F.ceil(share).cast("int").alias(_SALTS))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` of a table or a narrow plan over one, with their place, which a task that runs again finds the same."""
    return rows.withColumn(PLACE, F.monotonically_increasing_id())


def lookup_join(
    rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", counted: DataFrame | None = None, parts: int | None = None
) -> DataFrame:
    """``rows``, which :func:`numbered` has seen, joined with ``lookup``, which holds each key of ``on`` once.

    Equal to ``rows.join(lookup, on, how)``; ``how`` is left or inner. The salt comes from the row's place in its
    table, so copies of one row spread as well as different rows, and it is the same after a shuffle or when a lost task is
    repeated. Rows with a null key match nothing and are dealt over all tasks. ``counted`` has the keys of ``rows``
    in about their shares, where ``rows`` is costly to read twice; a key it misjudges is spread less evenly.
    Columns may not be called ``_salt``, ``_salts`` or ``_rows``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    taken = {_SALT, _SALTS, _ROWS} & {*rows.columns, *lookup.columns}
    if taken:
        raise ValueError(f"column names in use: {', '.join(sorted(taken))}")
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Fewer than `parts` rows, by the definition of a hot key.
    hot = F.broadcast(hot_keys(rows if counted is None else counted, on, parts))
    salts = F.when(_unknown(on), F.lit(parts)).otherwise(F.coalesce(_SALTS, F.lit(1)))
    dealt = rows.join(hot, on, "left").withColumn(_SALT, F.col(PLACE) % salts).drop(_SALTS)
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(_SALTS, F.lit(1)).cast("bigint") - 1))
    repeated = lookup.join(hot, on, "left").withColumn(_SALT, every).drop(_SALTS)
    return dealt.join(repeated, [*on, _SALT], how).drop(_SALT)
