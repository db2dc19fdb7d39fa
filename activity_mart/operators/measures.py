"""Measures over the star schema, evaluated per group and slicer.

``by`` lists dimension columns; ``where`` maps dimension columns to the values a
slicer keeps. Filters run from a dimension to the fact, never back.

The fact is summed to the surrogate keys a query needs before it meets a
dimension, so a lender or place that owns a large part of the fact has shrunk to
few rows when the join shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from activity_mart.contracts import MONEY_TOTAL
from activity_mart.functions.numeric import plain_ratio
from activity_mart.operators.distincts import key_maps, rolled_up
from activity_mart.operators.star import Star
from activity_mart.sources.store import stored

Slicers = Mapping[str, Iterable[object]]

_DIMENSIONS = {
    "lender_key": ("dim_lender", ("lender_name", "lender_city", "lender_state")),
    "geography_key": ("dim_geography", ("state", "county", "region")),
    "date_key": ("dim_date", ("reporting_period", "year", "quarter", "month", "period_label")),
}
_LENDER_COLUMNS = _DIMENSIONS["lender_key"][1]

DOLLARS, LOANS, GUARANTY = "total_approved_dollars", "total_loan_count", "total_guaranty_dollars"
_BASE = (DOLLARS, LOANS, GUARANTY)


def _sums(dollars: str, loans: str, guaranty: str) -> list[Column]:
    return [
        F.sum(dollars).cast(MONEY_TOTAL).alias(DOLLARS),
        F.sum(loans).alias(LOANS),
        F.sum(guaranty).cast(MONEY_TOTAL).alias(GUARANTY),
    ]


def _split(columns: Iterable[str]) -> dict[str, list[str]]:
    """Group dimension columns by the surrogate key that leads to them."""
    owned: dict[str, list[str]] = {}
    for column in columns:
        key = next((k for k, (_, names) in _DIMENSIONS.items() if column in names), None)
        if key is None:
            raise ValueError(f"not a dimension column: {column}")
        owned.setdefault(key, []).append(column)
    return owned


def _without(names: Iterable[str], dropped: Iterable[str]) -> list[str]:
    return [name for name in names if name not in set(dropped)]


def _keep(where: Slicers, dropped: Iterable[str]) -> dict[str, Iterable[object]]:
    return {name: values for name, values in where.items() if name not in set(dropped)}


def _sliced_dimension(star: Star, key: str, columns: list[str], where: Slicers) -> DataFrame:
    table, names = _DIMENSIONS[key]
    rows = getattr(star, table)
    for name in names:
        if name in where:
            rows = rows.where(F.col(name).isin(*where[name]))
    return rows.select(key, *[name for name in names if name in columns])


def base_measures(star: Star, by: list[str], where: Slicers | None = None) -> DataFrame:
    """Approved dollars, loan count and guaranty dollars per group.

    A fact row without a dimension row shows up under a null group, unless a slicer
    on that dimension removes it.
    """
    where = dict(where or {})
    needed = _split([*by, *where])
    rows = star.fact.groupBy(*needed).agg(*_sums("approved_dollars", "approved_loan_count", "guaranty_dollars"))
    for key in needed:
        filtered = any(name in where for name in _DIMENSIONS[key][1])
        rows = rows.join(_sliced_dimension(star, key, by, where), key, "inner" if filtered else "left")
    return rows.groupBy(*by).agg(*_sums(*_BASE))


def ratio_measures(base: DataFrame) -> DataFrame:
    """Average loan size and guaranty rate next to the base measures; blank on zero."""
    return base.withColumns(
        {
            "average_loan_size": plain_ratio(F.col(DOLLARS), F.col(LOANS)),
            "guaranty_rate": plain_ratio(F.col(GUARANTY), F.col(DOLLARS)),
        }
    )


def _all_lender_dollars(star: Star, by: list[str], where: Slicers) -> tuple[DataFrame, list[str]]:
    """Dollars with every lender filter removed and all other filters kept."""
    kept = _without(by, _LENDER_COLUMNS)
    totals = base_measures(star, kept, _keep(where, _LENDER_COLUMNS))
    return totals.select(*kept, F.col(DOLLARS).alias("all_lender_dollars")), kept


def _with_other(rows: DataFrame, other: DataFrame, on: list[str], value: str) -> DataFrame:
    """Attach ``other[value]`` per ``on`` group; a scalar when there is no group.

    Groups compare null-safe, so the blank group of unmatched fact rows finds its total.
    """
    if not on:
        return rows.withColumn(value, other.select(value).scalar())
    renamed = other.select(*[F.col(name).alias(f"_{name}") for name in on], value)
    match = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in on]
    return rows.join(renamed, match, "left").drop(*[f"_{name}" for name in on])


def lender_share(star: Star, by: list[str], where: Slicers | None = None) -> DataFrame:
    """Approved dollars over the dollars of all lenders in the same place and period."""
    where = dict(where or {})
    everyone, kept = _all_lender_dollars(star, by, where)
    rows = base_measures(star, by, where).select(*by, DOLLARS)
    rows = _with_other(rows, everyone, kept, "all_lender_dollars")
    return rows.withColumn("lender_share", plain_ratio(F.col(DOLLARS), F.col("all_lender_dollars")))


@dataclass(frozen=True)
class PageTotals:
    """Sums of the fact for several groupings at once, under one page's slicers.

    ``rows`` holds, for each grouping set, the base measures of the sliced rows, the dollars with every
    lender filter removed, and those with only a filter on the lender's name removed.
    """

    rows: DataFrame
    columns: tuple[str, ...]

    def _set(self, by: list[str]) -> DataFrame:
        level = sum(1 << place for place, name in enumerate(reversed(self.columns)) if name not in by)
        return self.rows.where(F.col("level") == level)

    def base(self, by: list[str]) -> DataFrame:
        """As :func:`base_measures`: only groups that the slicers leave rows in."""
        sums = [F.col(name) for name in _BASE]
        if not by:
            # One row even where there are no rows at all.
            return self._set(by).agg(*[F.max(name).alias(name) for name in _BASE])
        return self._set(by).where(F.col("sliced_rows") > 0).select(*by, *sums)

    def all_lenders(self, by: list[str]) -> DataFrame:
        """Dollars of each group's lenders, sliced or not, as ``all_lender_dollars``."""
        if not by:
            return self._set(by).agg(F.max("all_lender_dollars").alias("all_lender_dollars"))
        return self._set(by).select(*by, "all_lender_dollars")

    def any_name(self, by: list[str]) -> DataFrame:
        """Dollars of each group with a filter on the name removed, as ``total_approved_dollars``."""
        return self._set(by).where(F.col("any_name_rows") > 0).select(*by, F.col("any_name_dollars").alias(DOLLARS))


def page_totals(
    star: Star, sets: list[list[str]], where: Slicers | None = None, save: Callable[[DataFrame, str], DataFrame] = stored
) -> PageTotals:
    """The groupings ``sets`` of a page in one pass over the fact, stored by ``save`` and read by every visual.

    The fact shrinks to the surrogate keys, then to the groups' own columns, and only then to grouping sets,
    so that what is repeated for each set is the groups and not the fact. Place and period slicers
    drop rows. Lender slicers are kept as two flags, since shares and top lenders look past them.
    """
    where = dict(where or {})
    columns = tuple(dict.fromkeys(name for by in sets for name in by))
    needed = _split([*columns, *where])
    rows = star.fact.groupBy(*needed).agg(*_sums("approved_dollars", "approved_loan_count", "guaranty_dollars"), F.count("*").alias("n"))
    flags = {"_name": F.lit(True), "_other": F.lit(True)}
    for key in needed:
        table, names = _DIMENSIONS[key]
        sliced = [name for name in names if name in where]
        if key != "lender_key":
            rows = rows.join(_sliced_dimension(star, key, list(columns), where), key, "inner" if sliced else "left")
            continue
        dimension = getattr(star, table)
        for flag, own in (("_name", {"lender_name"}), ("_other", set(names) - {"lender_name"})):
            for name in sliced:
                if name in own:
                    flags[flag] = flags[flag] & F.coalesce(F.col(f"_in_{name}"), F.lit(False))
        inside = [F.col(name).isin(*where[name]).alias(f"_in_{name}") for name in sliced]
        rows = rows.join(dimension.select(key, *[name for name in names if name in columns], *inside), key, "left")
    flagged = rows.withColumns(flags).groupBy(*columns, *flags).agg(*_sums(*_BASE), F.sum("n").alias("n"))
    seen = F.col("_name") & F.col("_other")
    unique = list(dict.fromkeys(frozenset(by) for by in sets))
    grouped = flagged.groupingSets([[name for name in columns if name in by] for by in unique], *columns) if columns else flagged.groupBy()
    level = F.grouping_id().cast("int") if columns else F.lit(0)
    totals = grouped.agg(
        level.alias("level"),
        F.sum(F.when(seen, F.col(DOLLARS))).cast(MONEY_TOTAL).alias(DOLLARS),
        F.sum(F.when(seen, F.col(LOANS))).alias(LOANS),
        F.sum(F.when(seen, F.col(GUARANTY))).cast(MONEY_TOTAL).alias(GUARANTY),
        F.sum(DOLLARS).cast(MONEY_TOTAL).alias("all_lender_dollars"),
        F.sum(F.when(F.col("_other"), F.col(DOLLARS))).cast(MONEY_TOTAL).alias("any_name_dollars"),
        F.sum(F.when(seen, F.col("n"))).alias("sliced_rows"),
        F.sum(F.when(F.col("_other"), F.col("n"))).alias("any_name_rows"),
    )
    return PageTotals(save(totals, "page-totals"), columns)


def active_lenders(star: Star, where: Slicers | None = None) -> DataFrame:
    """One row: lenders in the dimension. Only lender slicers reduce it."""
    where = dict(where or {})
    rows = _sliced_dimension(star, "lender_key", [], where)
    return rows.agg(F.count_distinct("lender_key").alias("active_lenders"))


def _groups(star: Star, key: str, columns: list[str], where: Slicers) -> DataFrame:
    """The sliced dimension's groups, with the blank one if fact rows lack a dimension row."""
    own = {name: values for name, values in where.items() if name in _DIMENSIONS[key][1]}
    rows = _sliced_dimension(star, key, columns, where).select(*columns)
    return rows.unionByName(base_measures(star, columns, own).select(*columns)).distinct()


def active_lender_counts(star: Star, lender_columns: list[str], where: Slicers | None = None) -> DataFrame:
    """Per group of lender columns, lenders without facts included; null for the blank group. Any number of groups."""
    where = dict(where or {})
    counts = (
        _sliced_dimension(star, "lender_key", lender_columns, where)
        .groupBy(*lender_columns)
        .agg(F.count_distinct("lender_key").alias("active_lenders"))
    )
    return _with_other(_groups(star, "lender_key", lender_columns, where), counts, lender_columns, "active_lenders")


# As many place or period groups as a report shows beside its lenders.
MOST_GROUPS = 10_000


def active_lenders_by(
    star: Star, by: list[str], where: Slicers | None = None, most_groups: int = MOST_GROUPS
) -> DataFrame:
    """:func:`active_lender_counts`, repeated for each group of the place and period columns.

    Those columns do not reach the lenders, so each of their groups has the same counts. The groups of one
    dimension come as one array of ``most_groups`` entries at most; more are an error, as the
    result would be the product of two large tables: take the counts alone then.
    """
    where = dict(where or {})
    split = _split(by)
    lender_columns = split.pop("lender_key", [])
    rows = active_lender_counts(star, lender_columns, where) if lender_columns else active_lenders(star, where)
    for key, columns in split.items():
        # One more than allowed tells that there are too many, and is all that is gathered.
        some = _groups(star, key, columns, where).limit(most_groups + 1)
        every = some.agg(F.collect_list(F.struct(*columns)).alias("every"))
        refused = F.raise_error(F.lit(f"more than {most_groups} groups of {', '.join(columns)}"))
        few = every.select(F.when(F.size("every") <= most_groups, F.col("every")).otherwise(refused).alias("every"))
        rows = rows.withColumn("_group", F.explode(few.scalar())).select("*", "_group.*").drop("_group")
    return rows.select(*by, "active_lenders")


def _top_sets(by: list[str]) -> list[list[str]]:
    """The groupings that top lenders and their share need."""
    groups = _without(by, ["lender_name"])
    return [[*groups, "lender_name"], groups, _without(by, _LENDER_COLUMNS), list(by)]


def _top_dollars(totals: PageTotals, by: list[str], n: int) -> DataFrame:
    groups = _without(by, ["lender_name"])
    names = totals.any_name([*groups, "lender_name"])
    if not groups:
        cut = names.orderBy(F.desc(DOLLARS)).limit(n).agg(F.min(DOLLARS))
        kept = names.where(F.col(DOLLARS) >= cut.scalar())
    else:
        position = F.row_number().over(W.partitionBy(*groups).orderBy(F.desc(DOLLARS)))
        leaders = names.withColumn("position", position).where(F.col("position") <= n)
        cuts = leaders.groupBy(*groups).agg(F.min(DOLLARS).alias("cut"))
        kept = _with_other(names, cuts, groups, "cut").where(F.col(DOLLARS) >= F.col("cut"))
    top = kept.groupBy(*groups).agg(F.sum(DOLLARS).cast(MONEY_TOTAL).alias("top_lender_dollars"))
    if groups == list(by):
        return top
    return _with_other(totals.base(by).select(*by), top, groups, "top_lender_dollars")


def top_lender_dollars(
    star: Star, by: list[str], where: Slicers | None = None, n: int = 10
) -> DataFrame:
    """Dollars of the ``n`` largest lender names per group, ties at the cut kept.

    Names merge across cities, and a filter or group on the name itself does not
    narrow the ranking. The cut value is found by a bounded top-n; every name that
    reaches it then counts, however many tie.
    """
    return _top_dollars(page_totals(star, _top_sets(by), where), by, n)


def top_lender_share(
    star: Star,
    by: list[str],
    where: Slicers | None = None,
    n: int = 10,
    totals: PageTotals | None = None,
) -> DataFrame:
    """``top_lender_dollars`` over the dollars of all lenders in the same place and period.

    ``totals`` of the same slicers may be handed in, if they hold the groupings of :func:`_top_sets`.
    """
    totals = totals or page_totals(star, _top_sets(by), where)
    kept = _without(by, _LENDER_COLUMNS)
    rows = _with_other(_top_dollars(totals, by, n), totals.all_lenders(kept), kept, "all_lender_dollars")
    return rows.withColumn(
        "top_lender_share", plain_ratio(F.col("top_lender_dollars"), F.col("all_lender_dollars"))
    )


def lender_reach(star: Star) -> DataFrame:
    """Lenders with facts by county, rolled up to state, region and everywhere; blank places form their own groups.

    ``level`` is 0 for a county, 1 for a state, 3 for a region, 7 for the whole fact. A lender counts once on each level.
    """
    maps = key_maps(star.fact, ["geography_key"], "lender_key").join(star.dim_geography, "geography_key", "left")
    return rolled_up(maps, ["region", "state", "county"], "lenders_with_loans")


def failed_checks(report: DataFrame) -> DataFrame:
    """One row: quality checks that did not pass, zero when all did."""
    return report.agg(F.count_if(F.col("status") != "pass").alias("failed_checks"))


def rejected_count(rejected: DataFrame) -> DataFrame:
    return rejected.agg(F.count("*").alias("rejected_records"))
