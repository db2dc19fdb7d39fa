from __future__ import annotations

import math

import frames
import pytest
from pyspark.sql import functions as F

from activity_mart.operators import measures
from activity_mart.operators.distincts import key_maps, rolled_up, totals_with_distincts
from activity_mart.operators.star import build_star
from activity_mart.plans import analytics, pages
from activity_mart.sources.readers import state_regions

# Twelve lenders; "Twin" is one name in two cities, and three names tie at the cut of ten.
NAMES = [("Twin", "A", 60), ("Twin", "B", 50)]
NAMES += [(f"Bank {i}", "A", 200 - i) for i in range(8)]
NAMES += [(f"Tied {i}", "A", 100) for i in range(3)] + [("Small", "A", 1)]


@pytest.fixture(scope="module")
def star(spark):
    lender_rows = [(n, c, "TX" if c == "A" else "FL", 1, f"{d}.00", "0.00") for n, c, d in NAMES]
    county_rows = [
        (n, c, "TX" if c == "A" else "FL", "TX", "TRAVIS", 1, f"{d - 0.5}0", "0.00") for n, c, d in NAMES
    ] + [(n, c, "TX" if c == "A" else "FL", "CA", "KERN", 1, "0.50", "0.25") for n, c, d in NAMES]
    return build_star(
        frames.lenders(spark, lender_rows), frames.counties(spark, county_rows), state_regions(spark)
    )


def rows(frame, *keys):
    return {tuple(r[k] for k in keys): r for r in frame.collect()}


def test_base_and_ratio_measures(star):
    whole = measures.ratio_measures(measures.base_measures(star, [])).first()
    total = sum(d for _, _, d in NAMES)
    assert (float(whole.total_approved_dollars), whole.total_loan_count) == (total, 28)
    assert math.isclose(whole.average_loan_size, total / 28)
    assert math.isclose(whole.guaranty_rate, 0.25 * len(NAMES) / total)


def test_slicers_on_either_dimension(star):
    by_state = rows(measures.base_measures(star, ["state"], {"lender_state": ["FL"]}), "state")
    assert float(by_state[("CA",)].total_approved_dollars) == 0.5
    assert measures.base_measures(star, ["lender_name"], {"region": ["Territory"]}).isEmpty()


def test_an_unknown_column_is_refused(star):
    with pytest.raises(ValueError, match="not a dimension column"):
        measures.base_measures(star, ["colour"])


def test_share_keeps_place_filters_and_drops_lender_filters(star):
    found = rows(
        measures.lender_share(star, ["state", "lender_name"], {"state": ["CA"], "lender_name": ["Small"]}),
        "state",
        "lender_name",
    )
    assert set(found) == {("CA", "Small")}
    assert math.isclose(found[("CA", "Small")].lender_share, 0.5 / (0.5 * len(NAMES)))


def test_shares_of_a_group_sum_to_one(star):
    shares = measures.lender_share(star, ["state", "lender_name"]).collect()
    for state in ("TX", "CA"):
        assert math.isclose(sum(r.lender_share for r in shares if r.state == state), 1.0)


def test_place_slicers_do_not_reduce_active_lenders(star):
    assert measures.active_lenders(star, {"state": ["CA"]}).first().active_lenders == len(NAMES)
    assert measures.active_lenders(star, {"lender_state": ["FL"]}).first().active_lenders == 1
    by_state = rows(measures.active_lenders_by(star, ["state", "lender_state"]), "state", "lender_state")
    assert by_state[("CA", "TX")].active_lenders == len(NAMES) - 1


def test_lenders_without_facts_are_active(spark):
    lender_rows = [(f"In {state}", "A", state, 1, "9.00", "1.00") for state in ("TX", "FL", "NY")]
    county_rows = [
        ("In TX", "A", "TX", "CA", "KERN", 1, "9.00", "1.00"),
        ("Unknown", "A", "TX", "OH", "ROSS", 1, "9.00", "1.00"),
    ]
    star = build_star(frames.lenders(spark, lender_rows), frames.counties(spark, county_rows), state_regions(spark))
    by_lender = {r.lender_state: r.active_lenders for r in measures.active_lenders_by(star, ["lender_state"]).collect()}
    assert by_lender == {"TX": 1, "FL": 1, "NY": 1, None: None}
    sliced = measures.active_lenders_by(star, ["lender_state", "state"], {"lender_state": ["NY"], "state": ["OH"]})
    assert [tuple(r) for r in sliced.collect()] == [("NY", "OH", 1)]
    assert {tuple(r) for r in measures.active_lenders_by(star, ["state"]).collect()} == {("CA", 3), ("OH", 3)}


def test_too_many_places_beside_lenders_are_an_error(star):
    assert measures.active_lenders_by(star, ["state"], most_groups=2).count() == 2
    with pytest.raises(Exception, match="more than 1 groups of state"):
        measures.active_lenders_by(star, ["state"], most_groups=1).collect()
    counts = measures.active_lender_counts(star, ["lender_state"])
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, measures.active_lenders_by(star, ["lender_state"]).collect()))


def test_top_names_merge_cities_and_keep_ties(star):
    # Eight banks, the merged Twin (110), and all three names tied for the tenth place.
    expected = sum(200 - i for i in range(8)) + 110 + 300
    assert float(measures.top_lender_dollars(star, []).first().top_lender_dollars) == expected
    share = measures.top_lender_share(star, []).first().top_lender_share
    assert math.isclose(share, expected / sum(d for _, _, d in NAMES))


def test_top_dollars_per_group_and_per_name(star):
    by_state = rows(measures.top_lender_dollars(star, ["state"]), "state")
    # In CA every name has 0.50 except Twin with 1.00, so all thirteen tie at the cut.
    assert float(by_state[("CA",)].top_lender_dollars) == 0.5 * len(NAMES)
    by_name = measures.top_lender_dollars(star, ["lender_name"], {"lender_name": ["Small"]}).collect()
    overall = measures.top_lender_dollars(star, []).first().top_lender_dollars
    assert [(r.lender_name, r.top_lender_dollars) for r in by_name] == [("Small", overall)]


def test_counts_of_checks_and_rejects(spark):
    report = spark.createDataFrame([("a", "pass"), ("b", "fail")], "check_name string, status string")
    assert measures.failed_checks(report).first().failed_checks == 1
    assert measures.failed_checks(report.where("false")).first().failed_checks == 0
    assert measures.rejected_count(report).first().rejected_records == 2


def test_pages(star):
    overview = pages.overview_page(star)
    assert overview["top_lenders"].count() == 10
    cards = overview["cards"].first()
    assert cards.active_lenders == len(NAMES) and 0 < cards.top_10_lender_share < 1
    rollup = rows(pages.region_rollup(star), "level", "region", "state")
    assert set(rollup) == {
        (0, "South", "TX"), (0, "West", "CA"), (1, "South", None), (1, "West", None), (3, None, None)
    }
    one = pages.lender_page(star, {"lender_name": ["Small"]}).first()
    assert math.isclose(one.lender_share, 1.0 / sum(d for _, _, d in NAMES))


def test_unmatched_facts_form_a_blank_group(spark):
    stray = [*frames.COUNTIES, ("Stray", "Reno", "NV", "WA", "KING", 1, "100.00", "0.00")]
    star = build_star(frames.lenders(spark), frames.counties(spark, stray), state_regions(spark))
    found = rows(measures.base_measures(star, ["lender_name"]), "lender_name")
    assert float(found[(None,)].total_approved_dollars) == 100
    shares = rows(measures.lender_share(star, ["lender_state"]), "lender_state")
    assert math.isclose(sum(r.lender_share for r in shares.values()), 1.0)


@pytest.fixture(scope="module")
def blanks(spark):
    """A star whose fact has rows without a lender, and a second name in another state."""
    stray = [*frames.COUNTIES, ("Stray", "Reno", "NV", "WA", "KING", 1, "100.00", "0.00"), ("Stray", "Reno", "NV", "ME", "YORK", 1, "7.00", "0.00")]
    return build_star(frames.lenders(spark), frames.counties(spark, stray), state_regions(spark))


SLICES = [
    {},
    {"state": ["WA"]},
    {"lender_name": ["Cedar Trust", "Ridge Mutual"]},
    {"lender_state": ["OR", "ID"], "lender_name": ["Cedar Trust"], "region": ["West"]},
    {"lender_state": ["ME"], "year": [2024]},
    {"region": ["Nowhere"]},
    {"lender_name": ["Nobody"]},
]


def plain(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


@pytest.mark.parametrize("where", SLICES, ids=str)
def test_page_totals_equal_each_measure_by_itself(blanks, where):
    sets = [[], ["lender_name"], ["state"], ["state", "lender_name"]]
    totals = measures.page_totals(blanks, sets, where)
    for by in sets:
        assert plain(totals.base(by)) == plain(measures.base_measures(blanks, by, where)), by
        everyone = measures.base_measures(blanks, by, {k: v for k, v in where.items() if not k.startswith("lender")})
        assert plain(totals.all_lenders(by)) == plain(everyone.select(*by, F.col(measures.DOLLARS).alias("all_lender_dollars")))
        named = measures.base_measures(blanks, by, {k: v for k, v in where.items() if k != "lender_name"}).select(*by, measures.DOLLARS)
        assert not by or plain(totals.any_name(by)) == plain(named)


def test_a_page_reads_the_fact_once(spark, blanks):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        fact = "fact_lending_activity-"
        made = []

        def keep(df, label):
            made.append(df._jdf.queryExecution().executedPlan().toString().count(fact))
            return measures.stored(df, label)

        totals = measures.page_totals(blanks, [[], ["lender_name"], ["state"]], {"lender_state": ["OR"]}, keep)
        assert made == [1] and fact not in totals.rows._jdf.queryExecution().executedPlan().toString()
        page = {**pages.overview_page(blanks), **pages.geography_page(blanks), "lenders": pages.lender_page(blanks)}
        page["share"] = measures.top_lender_share(blanks, ["region"])
        for name, frame in page.items():
            assert fact not in frame._jdf.queryExecution().executedPlan().toString(), name
        kpis = analytics.executive_kpis(blanks.fact)
        assert kpis._jdf.queryExecution().executedPlan().toString().count(fact) == 1
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_executive_kpis_count_keys_in_use(blanks):
    found = analytics.executive_kpis(blanks.fact).first()
    expected = blanks.fact.agg(F.count_distinct("lender_key"), F.count_distinct("geography_key"), F.sum("approved_dollars")).first()
    assert (found.active_lenders, found.active_geographies, found.total_approved_dollars) == tuple(expected)
    nothing = analytics.executive_kpis(blanks.fact.where("false")).first()
    assert (nothing.active_lenders, nothing.active_geographies, nothing.total_approved_dollars) == (0, 0, None)


def test_bitmaps_roll_up_over_many_buckets(spark):
    # 90,000 keys are three bitmaps; every key lies in several groups, and some rows have none.
    rows = spark.range(300_000).selectExpr(
        "CASE WHEN id % 11 > 0 THEN id * 7919 % 90000 + 1 END AS k", "id % 2 AS a", "CASE WHEN id % 5 > 0 THEN id % 5 END AS b"
    )
    found = rolled_up(key_maps(rows, ["a", "b"], "k"), ["a", "b"], "n")
    expected = rows.rollup("a", "b").agg(F.grouping_id().cast("int").alias("level"), F.count_distinct("k").alias("n"))
    assert plain(found) == plain(expected)
    both = totals_with_distincts(rows, [F.sum("a").alias("total")], {"k": "ks", "b": "bs"}).first()
    assert tuple(both) == tuple(rows.agg(F.sum("a"), F.count_distinct("k"), F.count_distinct("b")).first())


def test_lender_reach_counts_a_lender_once_a_level(blanks):
    found = {(r.level, r.region, r.state, r.county): r.lenders_with_loans for r in measures.lender_reach(blanks).collect()}
    assert found[(7, None, None, None)] == 3 and found[(3, "West", None, None)] == 2
    assert found[(1, "West", "WA", None)] == 2 and found[(0, "West", "ID", "ADA")] == 1
