"""The registered queries again, as plain SQL over the driver tables.

Rounded ratios use integer arithmetic on cents, which is exact in any engine.
"""

from __future__ import annotations

import re

from activity_mart.contracts import CHECK_DETAILS, REGIONS, STATE_REGIONS


def cents(amount: str) -> str:
    return f"CAST(({amount}) * 100 AS HUGEINT)"


def half_up(n: str, d: str, digits: int = 2) -> str:
    """n / d rounded half away from zero, in units of 10^-digits."""
    scale = 10**digits
    units = f"((2 * {scale} * abs({n}) + abs({d})) // (2 * abs({d})))"
    return f"(CASE WHEN {d} = 0 THEN NULL WHEN ({n} < 0) <> ({d} < 0) THEN -{units} ELSE {units} END)"


def half_even(n: str, d: str) -> str:
    """n / d rounded half to even; d is positive."""
    q, r = f"(abs({n}) // ({d}))", f"(abs({n}) % ({d}))"
    up = f"(CASE WHEN 2 * {r} > {d} OR (2 * {r} = {d} AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE sign({n}) * ({q} + {up}) END)"


def hundredths(units: str, kind: str = "DECIMAL(18,2)") -> str:
    return f"CAST(CAST({units} AS DECIMAL(25,0)) * CAST(0.01 AS DECIMAL(3,2)) AS {kind})"


def average(dollars: str, count: str) -> str:
    return hundredths(half_up(cents(dollars), f"(100 * CAST({count} AS HUGEINT))"))


def percent(part: str, whole: str) -> str:
    return hundredths(half_up(f"(100 * {cents(part)})", cents(whole)), "DECIMAL(9,2)")


def quotient(n: str, d: str) -> str:
    return f"CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0)"


def total(amount: str) -> str:
    return f"CAST(sum({amount}) AS DECIMAL(28,2))"


def count(amount: str) -> str:
    return f"CAST(sum({amount}) AS BIGINT)"


def money_short(x: str) -> str:
    v = f"CAST({x} AS DOUBLE)"
    return (
        f"CASE WHEN abs({v}) >= 1e9 THEN '$' || printf('%.1f', {v} / 1e9) || 'B' "
        f"WHEN abs({v}) >= 1e6 THEN '$' || printf('%.1f', {v} / 1e6) || 'M' "
        f"WHEN abs({v}) >= 1e3 THEN '$' || printf('%.0f', {v} / 1e3) || 'K' "
        f"ELSE '$' || {thousands(v)} END"
    )


def thousands(x: str) -> str:
    return f"format('{{:,}}', CAST(round_even(CAST({x} AS DOUBLE), 0) AS BIGINT))"


def one_decimal(x: str) -> str:
    return f"printf('%.1f', CAST({x} AS DOUBLE))"


def two_decimals(x: str) -> str:
    return f"printf('%.2f', CAST({x} AS DOUBLE))"


def title_case(x: str) -> str:
    runs = f"regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+')"
    return f"array_to_string([upper(t[1]) || lower(t[2:]) for t in {runs}], '')"


def ellipsis(x: str, limit: int) -> str:
    return (
        f"CASE WHEN length({x}) > {limit} "
        f"THEN regexp_replace(substr({x}, 1, {limit - 3}), '\\s+$', '') || '...' ELSE {x} END"
    )


_ID = "lender, lender_city, lender_state"
_SUMS = (
    "CAST(count(*) AS BIGINT) AS approved_loans, CAST(sum(dollars) AS DECIMAL(18,2)) AS approved_dollars, "
    "CAST(sum(guaranty) AS DECIMAL(18,2)) AS approved_sba_guaranty_dollars"
)
_ROW_RATIOS = (
    hundredths(half_even(cents("approved_dollars"), "CAST(approved_loans AS HUGEINT)"))
    + " AS avg_loan_size, "
    + hundredths(
        half_even(f"(10000 * {cents('approved_sba_guaranty_dollars')})", cents("approved_dollars")),
        "DECIMAL(9,2)",
    )
    + " AS guaranty_rate_pct"
)


def _extract(by: str) -> str:
    keys = f"{_ID}, {by}" if by else _ID
    return f"SELECT *, {_ROW_RATIOS} FROM (SELECT {keys}, {_SUMS} FROM loans GROUP BY {keys})"


def _flawed(table: str, lender: str = "lender") -> str:
    return f"""
        SELECT * REPLACE (
            {lender} AS lender,
            CAST(CASE WHEN approved_loans % 7 = 2 THEN NULL
                      WHEN approved_loans % 5 = 1 THEN approved_dollars + 1
                      ELSE approved_sba_guaranty_dollars END AS DECIMAL(18,2)) AS approved_sba_guaranty_dollars,
            CASE WHEN approved_loans % 11 = 3 THEN -approved_loans ELSE approved_loans END AS approved_loans)
        FROM (SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE approved_loans % 13 = 4)"""


def _staged(table: str, extra: str = "") -> str:
    return (
        f"SELECT lender AS lender_name, lender_city, lender_state, {extra} "
        "approved_loans AS approved_loan_count, approved_dollars, "
        f"approved_sba_guaranty_dollars AS guaranty_dollars FROM {table}"
    )


def _fact(county: str, lenders: str, places: str, how: str) -> str:
    return f"""
        SELECT dl.lender_key, dg.geography_key, 20240930 AS date_key, DATE '2024-09-30' AS reporting_period,
               c.approved_loan_count, c.approved_dollars, c.guaranty_dollars
        FROM {county} c
        {how} JOIN {lenders} dl ON c.lender_name = dl.lender_name
            AND c.lender_city = dl.lender_city AND c.lender_state = dl.lender_state
        {how} JOIN {places} dg ON c.project_state = dg.state AND c.project_county = dg.county"""


def _dim_lender(staged: str) -> str:
    return f"""
        SELECT row_number() OVER (ORDER BY lender_name, lender_city, lender_state) AS lender_key, *
        FROM (SELECT DISTINCT lender_name, lender_city, lender_state FROM {staged})"""


_LINE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_GUARANTEED = f"{_LINE} * (1 - CAST(l_discount AS DECIMAL(4,2)))"

CTES = {
    "parties": "SELECT s_suppkey, s_name AS lender, n_name AS lender_city, r_name AS lender_state "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "places": "SELECT o_orderkey, n_name AS project_state, c_mktsegment AS project_county, "
    "split_part(o_orderpriority, '-', 1) AS do_code, "
    "substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) AS sba_do_name "
    "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
    "loans": f"SELECT parties.*, places.*, {_LINE} AS dollars, CAST({_GUARANTEED} AS DECIMAL(18,2)) AS guaranty "
    "FROM lineitem JOIN parties ON l_suppkey = s_suppkey JOIN places ON l_orderkey = o_orderkey",
    "l": _extract(""),
    "c": _extract("project_state, project_county"),
    "d": _extract("do_code, sba_do_name"),
    "fl": _flawed(
        "l",
        "CASE WHEN CAST(approved_dollars * 100 AS HUGEINT) % 7 = 0 "
        "THEN lender || ' (former)' ELSE lender END",
    ),
    "fc": _flawed("c"),
    "fd": _flawed("d"),
    "sl": _staged("l"),
    "sc": _staged("c", "project_state, project_county,"),
    "sd": _staged("d", "do_code, sba_do_name AS district_office_name,"),
    "fsl": _staged("fl"),
    "fsc": _staged("fc", "project_state, project_county,"),
    "fsd": _staged("fd", "do_code, sba_do_name AS district_office_name,"),
    "lookup": "SELECT n_name AS state, r_name AS region FROM nation "
    "JOIN region ON n_regionkey = r_regionkey WHERE n_name <> 'NATION_7'",
    "dim_l": _dim_lender("sl"),
    "dim_g": """
        SELECT geography_key, g.state, county, coalesce(region, 'Unknown') AS region
        FROM (SELECT row_number() OVER (ORDER BY state, county) AS geography_key, *
              FROM (SELECT DISTINCT project_state AS state, project_county AS county FROM sc)) g
        LEFT JOIN lookup ON g.state = lookup.state""",
    "dim_d": "SELECT 20240930 AS date_key, DATE '2024-09-30' AS reporting_period",
    "fact": _fact("sc", "dim_l", "dim_g", "LEFT"),
    "fact_in": _fact("sc", "dim_l", "dim_g", ""),
    "fdim_l": _dim_lender("fsl"),
    "ffact": _fact("fsc", "fdim_l", "dim_g", "LEFT"),
    "ffact_in": _fact("fsc", "fdim_l", "dim_g", ""),
    "flat": """
        SELECT dl.lender_name, dl.lender_city, dl.lender_state, dg.state, dg.county, dg.region,
               fact.lender_key, approved_loan_count, approved_dollars, guaranty_dollars
        FROM fact LEFT JOIN dim_l dl USING (lender_key) LEFT JOIN dim_g dg USING (geography_key)""",
    "raw": f"""
        SELECT CASE WHEN filled THEN lender END AS lender, CASE WHEN filled THEN lender_city END AS lender_city,
               CASE WHEN filled THEN lender_state END AS lender_state,
               CASE WHEN filled THEN approved_loans END AS approved_loans,
               CASE WHEN filled THEN approved_dollars END AS approved_dollars,
               CASE WHEN filled THEN guaranty END AS approved_sba_guaranty_dollars,
               CASE WHEN filled THEN source_line END AS source_line
        FROM (SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN '  Padded  '
                          WHEN l_orderkey % 83 = 0 THEN chr(9) || lender || chr(160) ELSE lender END AS lender,
                     lender_city, lender_state,
                     CASE WHEN l_orderkey % 101 = 0 THEN 'n/a' WHEN l_orderkey % 103 = 0 THEN '-1'
                          WHEN l_orderkey % 107 = 0 THEN ' 12 ' WHEN l_orderkey % 109 = 0 THEN '0.4'
                          ELSE CAST(CAST(l_quantity AS DECIMAL(18,1)) AS VARCHAR) END AS approved_loans,
                     CAST(CAST({_LINE} * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(22,4)) AS VARCHAR)
                         AS approved_dollars,
                     CAST(CAST({_GUARANTEED} AS DECIMAL(22,4)) AS VARCHAR) AS guaranty,
                     l_orderkey || '-' || l_linenumber AS source_line,
                     unnest(list_concat(
                         CASE WHEN l_orderkey % 113 = 0 THEN [true, true] ELSE [true] END,
                         CASE WHEN l_orderkey % 79 = 0 THEN [false] ELSE [] END)) AS filled
              FROM lineitem JOIN parties ON l_suppkey = s_suppkey)""",
    "parsed": """
        SELECT regexp_replace(lender, '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g') AS lender,
               lender_city, lender_state,
               TRY_CAST(approved_loans AS DECIMAL(38,10)) AS approved_loans,
               TRY_CAST(approved_dollars AS DECIMAL(38,10)) AS approved_dollars,
               TRY_CAST(approved_sba_guaranty_dollars AS DECIMAL(38,10)) AS approved_sba_guaranty_dollars,
               source_line,
               lender IS NULL AND lender_city IS NULL AND lender_state IS NULL AND approved_loans IS NULL
                   AND approved_dollars IS NULL AND approved_sba_guaranty_dollars IS NULL
                   AND source_line IS NULL AS is_blank
        FROM raw""",
    "judged": """
        SELECT *, CASE WHEN is_blank THEN NULL
                       WHEN lender IS NULL OR lender_city IS NULL OR lender_state IS NULL OR approved_loans IS NULL
                            OR approved_dollars IS NULL OR approved_sba_guaranty_dollars IS NULL
                       THEN 'missing_required_value'
                       WHEN approved_loans <= 0 OR approved_dollars <= 0 THEN 'invalid_amount'
                  END AS rejection_reason
        FROM parsed""",
    "valid": "SELECT * EXCLUDE (is_blank, rejection_reason) FROM judged "
    "WHERE NOT is_blank AND rejection_reason IS NULL",
}


def _rounded(amount: str, kind: str, digits: int) -> str:
    ten = 10 ** (4 - digits)
    units = half_even(f"CAST({amount} * 10000 AS HUGEINT)", str(ten))
    return f"CAST({units} AS BIGINT)" if digits == 0 else hundredths(units, kind)


CTES["rounded"] = f"""
    SELECT lender, lender_city, lender_state,
           {_rounded("approved_loans", "", 0)} AS approved_loans,
           {_rounded("approved_dollars", "DECIMAL(18,2)", 2)} AS approved_dollars,
           {_rounded("approved_sba_guaranty_dollars", "DECIMAL(18,2)", 2)} AS approved_sba_guaranty_dollars,
           source_line
    FROM valid"""
CTES["cleaned"] = f"SELECT *, {_ROW_RATIOS} FROM rounded"


def _dirty(table: str, columns: str) -> str:
    return f"""
        SELECT {columns}, CASE WHEN approved_loans % 17 = 3 THEN NULL WHEN approved_loans % 19 = 4 THEN 'n/a'
                               WHEN approved_loans % 23 = 5 THEN '-1' ELSE CAST(approved_loans AS VARCHAR)
                          END AS approved_loans,
               CAST(approved_dollars AS VARCHAR) AS approved_dollars,
               CAST(approved_sba_guaranty_dollars AS VARCHAR) AS approved_sba_guaranty_dollars
        FROM {table}"""


def _rejected(table: str, name: str, columns: str) -> str:
    return f"""
        SELECT * FROM (
            SELECT '{name}' AS source_table,
                   CASE WHEN TRY_CAST(approved_loans AS DECIMAL(38,10)) IS NULL THEN 'missing_required_value'
                        WHEN TRY_CAST(approved_loans AS DECIMAL(38,10)) <= 0 THEN 'invalid_amount'
                   END AS rejection_reason,
                   lender, TRY_CAST(approved_loans AS DECIMAL(38,10)) AS approved_loans,
                   TRY_CAST(approved_dollars AS DECIMAL(38,10)) AS approved_dollars,
                   CAST(to_json({{{columns}}}) AS VARCHAR) AS raw
            FROM {table})
        WHERE rejection_reason IS NOT NULL"""


def _json(*names: str) -> str:
    return ", ".join(f"'{name}': {name}" for name in names)


_AMOUNTS = ("approved_loans", "approved_dollars", "approved_sba_guaranty_dollars")
_LENDER = ("lender", "lender_city", "lender_state")
CTES["dirty_c"] = _dirty("c", f"{_ID}, project_state, project_county")
CTES["dirty_d"] = _dirty("d", f"{_ID}, do_code, sba_do_name")


# Tables of a few rows, evaluated once.
_SMALL = ("report", "reject_groups")


def with_ctes(select: str) -> str:
    """Prefix ``select`` with the definitions it names, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(select)
    if not needed:
        return select
    # Inlined definitions: sharing a large one between branches fails inside the SQL engine.
    parts = [
        f"{name} AS {'' if name in _SMALL else 'NOT '}MATERIALIZED ({CTES[name]})" for name in needed
    ]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _kpi() -> str:
    return f"""
        SELECT CAST(count(*) AS BIGINT) AS lender_count,
               (SELECT count(DISTINCT project_state) FROM c) AS project_state_count,
               (SELECT count(*) FROM (SELECT DISTINCT project_state, project_county FROM c)) AS project_county_count,
               {count("approved_loans")} AS approved_loans, {total("approved_dollars")} AS approved_dollars,
               {total("approved_sba_guaranty_dollars")} AS approved_sba_guaranty_dollars,
               {average("sum(approved_dollars)", "sum(approved_loans)")} AS avg_loan_size,
               {percent("sum(approved_sba_guaranty_dollars)", "sum(approved_dollars)")} AS guaranty_rate_pct,
               {percent(_TOP10, "sum(approved_dollars)")} AS top_10_lender_share_pct
        FROM l"""


_TOP10 = (
    "(SELECT sum(approved_dollars) FROM (SELECT approved_dollars FROM l "
    "ORDER BY approved_dollars DESC, lender, lender_city, lender_state LIMIT 10))"
)
_ALL_L = "(SELECT sum(approved_dollars) FROM l)"


def _activity(table: str, by: str, share: str = "", limit: int | None = None) -> str:
    exposure = f", {percent('sum(approved_dollars)', share)} AS exposure_share_pct" if share else ""
    top = f"ORDER BY sum(approved_dollars) DESC, {by} LIMIT {limit}" if limit else ""
    return f"""
        SELECT {by}, count(DISTINCT lender) AS lender_count, {count("approved_loans")} AS approved_loans,
               {total("approved_dollars")} AS approved_dollars,
               {total("approved_sba_guaranty_dollars")} AS approved_sba_guaranty_dollars,
               {average("sum(approved_dollars)", "sum(approved_loans)")} AS avg_loan_size,
               {percent("sum(approved_sba_guaranty_dollars)", "sum(approved_dollars)")} AS guaranty_rate_pct
               {exposure}
        FROM {table} GROUP BY {by} {top}"""


def _top_lenders(limit: int = 15) -> str:
    return f"""
        SELECT {_ID}, approved_loans, CAST(approved_dollars AS DECIMAL(28,2)) AS approved_dollars,
               CAST(approved_sba_guaranty_dollars AS DECIMAL(28,2)) AS approved_sba_guaranty_dollars,
               {average("approved_dollars", "approved_loans")} AS avg_loan_size,
               {percent("approved_sba_guaranty_dollars", "approved_dollars")} AS guaranty_rate_pct,
               {percent("approved_dollars", _ALL_L)} AS market_share_pct
        FROM l ORDER BY l.approved_dollars DESC, {_ID} LIMIT {limit}"""


def _reach() -> str:
    return f"""
        SELECT l.lender, l.lender_city, l.lender_state, l.approved_loans,
               CAST(l.approved_dollars AS DECIMAL(28,2)) AS approved_dollars, r.project_states, r.project_counties,
               {average("l.approved_dollars", "r.project_states")} AS avg_dollars_per_state,
               {average("l.approved_dollars", "r.project_counties")} AS avg_dollars_per_county
        FROM l JOIN (SELECT {_ID}, count(DISTINCT project_state) AS project_states,
                            count(DISTINCT (project_state, project_county)) AS project_counties
                     FROM c GROUP BY {_ID}) r
          ON l.lender = r.lender AND l.lender_city = r.lender_city AND l.lender_state = r.lender_state
        ORDER BY l.approved_dollars DESC, l.lender, l.lender_city, l.lender_state LIMIT 20"""


def _headlines() -> str:
    dollars = money_short("approved_dollars")
    office = "ORDER BY approved_dollars DESC, do_code, sba_do_name LIMIT 1"
    return f"""
        SELECT 1 AS position, 'Lending FY2024 activity totals ' || {dollars} || ' across '
               || {thousands("approved_loans")} || ' approved loans and ' || {thousands("lender_count")}
               || ' lenders.' AS fact FROM ({_kpi()})
        UNION ALL SELECT 2, 'The SBA guaranty amount is ' || {money_short("approved_sba_guaranty_dollars")}
               || ', equal to ' || {two_decimals("guaranty_rate_pct")} || '% of approved dollars.' FROM ({_kpi()})
        UNION ALL SELECT 3, 'The top 10 lenders account for ' || {two_decimals("top_10_lender_share_pct")}
               || '% of approved dollars, so concentration is meaningful but no single lender dominates.'
               FROM ({_kpi()})
        UNION ALL SELECT 4, lender || ' is the largest lender by approved dollars at ' || {dollars} || ' ('
               || {two_decimals("market_share_pct")} || '% of total).' FROM ({_top_lenders(1)})
        UNION ALL SELECT 5, project_state || ' is the largest project state at ' || {dollars} || ' ('
               || {two_decimals("exposure_share_pct")} || '% of approved dollars).'
               FROM ({_activity("c", "project_state", _ALL_L, 1)})
        UNION ALL SELECT 6, project_county || ', ' || project_state || ' is the largest county exposure at '
               || {dollars} || '.' FROM ({_activity("c", "project_state, project_county", _ALL_L, 1)})
        UNION ALL SELECT 7, {title_case("sba_do_name")} || ' is the largest SBA district office view at '
               || {dollars} || '.' FROM (SELECT * FROM ({_activity("d", "do_code, sba_do_name")}) {office})
        UNION ALL SELECT 8, lender || ' has the widest geographic reach among top lenders, spanning '
               || project_states || ' project states and territories.' FROM ({_widest()})"""


def _widest() -> str:
    return f"SELECT * FROM ({_reach()}) ORDER BY project_states DESC, approved_dollars DESC, {_ID} LIMIT 1"


def _cards() -> str:
    cards = (
        ("Approved dollars", money_short("approved_dollars")),
        ("Approved loans", thousands("approved_loans")),
        ("Active lenders", thousands("lender_count")),
        ("SBA guaranty", money_short("approved_sba_guaranty_dollars")),
        ("Guaranty rate", one_decimal("guaranty_rate_pct") + " || '%'"),
        ("Avg loan size", money_short("avg_loan_size")),
        ("Project states", "CAST(project_state_count AS VARCHAR)"),
        ("Top 10 lender share", one_decimal("top_10_lender_share_pct") + " || '%'"),
    )
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{label}' AS label, {value} AS value FROM ({_kpi()})"
        for i, (label, value) in enumerate(cards, start=1)
    )


def _bars(chart: str, rows: str, ties: str, label: str, note: str) -> str:
    order = f"ORDER BY approved_dollars DESC, {ties}"
    return f"""
        SELECT '{chart}' AS chart, CAST(row_number() OVER ({order}) AS INTEGER) AS position, {label} AS label,
               approved_dollars AS value, {money_short("approved_dollars")} AS value_text, {note} AS note
        FROM (SELECT * FROM ({rows}) {order} LIMIT 10)"""


def _all_bars() -> str:
    loans = f"{thousands('approved_loans')} || ' loans'"
    lender_note = f"{one_decimal('market_share_pct')} || '% share, ' || {loans}"
    state_note = f"{one_decimal('exposure_share_pct')} || '% share, ' || {loans}"
    office_note = f"{loans} || ', ' || {one_decimal('guaranty_rate_pct')} || '% guaranty'"
    return " UNION ALL ".join(
        [
            _bars("lenders", _top_lenders(), _ID, ellipsis("lender", 34), lender_note),
            _bars("states", _activity("c", "project_state", _ALL_L), "project_state", "project_state", state_note),
            _bars(
                "offices",
                _activity("d", "do_code, sba_do_name"),
                "do_code, sba_do_name",
                ellipsis(title_case("sba_do_name"), 34),
                office_note,
            ),
        ]
    )


_BASE = (
    f"{total('approved_dollars')} AS total_approved_dollars, "
    f"{count('approved_loan_count')} AS total_loan_count, "
    f"{total('guaranty_dollars')} AS total_guaranty_dollars"
)
_RATIOS = (
    f"{quotient('sum(approved_dollars)', 'sum(approved_loan_count)')} AS average_loan_size, "
    f"{quotient('sum(guaranty_dollars)', 'sum(approved_dollars)')} AS guaranty_rate"
)
def _active_by(column: str) -> str:
    """Lenders of the dimension by one of its columns, and the blank group of facts without a lender."""
    return f"""
        SELECT {column}, count(DISTINCT lender_key) AS active_lenders FROM fdim_l GROUP BY {column}
        UNION SELECT NULL, NULL FROM ffact WHERE lender_key IS NULL"""


_TOP_BY_REGION = """
    SELECT region, CAST(sum(dollars) AS DECIMAL(28,2)) AS top_lender_dollars
    FROM (SELECT region, lender_name, sum(approved_dollars) AS dollars,
                 rank() OVER (PARTITION BY region ORDER BY sum(approved_dollars) DESC) AS place
          FROM flat GROUP BY region, lender_name)
    WHERE place <= 10 GROUP BY region"""
_TOP_ALL = """
    (SELECT sum(dollars) FROM (SELECT lender_name, sum(approved_dollars) AS dollars,
                                      rank() OVER (ORDER BY sum(approved_dollars) DESC) AS place
                               FROM flat GROUP BY lender_name) WHERE place <= 10)"""


def _check(name: str, failed: str, source: str, details: str) -> str:
    text = details.replace("'", "''")
    return (
        f"SELECT '{name}' AS check_name, CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS status, "
        f"CAST(n AS BIGINT) AS failed_count, '{text}' AS details FROM (SELECT {failed} AS n FROM {source})"
    )


def _if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


_TABLES = {
    "sba_lender_activity": ("fl", ()),
    "sba_lender_county_activity": ("fc", ("project_state", "project_county")),
    "sba_district_office_activity": ("fd", ("do_code", "sba_do_name")),
}


def _columns(extra: tuple[str, ...]) -> list[str]:
    return [*_LENDER, *extra, *_AMOUNTS, "avg_loan_size", "guaranty_rate_pct"]


def _source_rule(rule: str, name: str) -> str:
    table, extra = _TABLES[name]
    source, failed = table, ""
    if rule == "missing_required_values":
        cells = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in _columns(extra))
        failed = cells
    elif rule == "duplicate_rows":
        failed, source = f"(SELECT count(*) FROM {table}) - count(*)", f"(SELECT DISTINCT * FROM {table})"
    elif rule == "non_negative_amounts":
        failed = _if("approved_loans < 0 OR approved_dollars < 0")
    else:
        failed = _if("approved_sba_guaranty_dollars > approved_dollars")
    return _check(f"{name}_{rule}", failed, source, CHECK_DETAILS[rule])


_SOURCE_RULES = (
    "missing_required_values",
    "duplicate_rows",
    "non_negative_amounts",
    "guaranty_not_above_approved",
)


def _star_check(name: str) -> str:
    codes = ", ".join(f"'{state}'" for state in sorted(STATE_REGIONS))
    failed, source = {
        "dim_lender_unique_key": ("count(*) - count(DISTINCT lender_key)", "fdim_l"),
        "dim_geography_unique_key": ("count(*) - count(DISTINCT geography_key)", "dim_g"),
        "fact_lender_key_not_null": (_if("lender_key IS NULL"), "ffact"),
        "fact_geography_key_not_null": (_if("geography_key IS NULL"), "ffact"),
        "dim_geography_valid_state_codes": (_if(f"state IS NULL OR state NOT IN ({codes})"), "dim_g"),
        "fact_non_negative_amounts": (
            _if("approved_loan_count < 0 OR approved_dollars < 0 OR guaranty_dollars < 0"),
            "ffact",
        ),
        "fact_guaranty_not_above_approved": (_if("guaranty_dollars > approved_dollars"), "ffact"),
    }[name]
    return _check(name, failed, source, CHECK_DETAILS[name])


_STAR_RULES = [name for name in CHECK_DETAILS if name.startswith(("dim_", "fact_"))]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _report() -> str:
    return _union(
        [_source_rule(rule, name) for name in _TABLES for rule in _SOURCE_RULES]
        + [_star_check(name) for name in _STAR_RULES]
    )


def _expectations() -> str:
    models = {
        "stg_lender_activity": ("fsl", "lender_name approved_loan_count approved_dollars guaranty_dollars"),
        "stg_lender_county_activity": ("fsc", "lender_name project_state project_county approved_dollars"),
        "stg_district_activity": ("fsd", "lender_name district_office_name"),
        "dim_lender": ("fdim_l", "lender_key lender_name"),
        "dim_geography": ("dim_g", "geography_key state region"),
        "dim_date": ("dim_d", "date_key"),
        "fct_lending_activity": ("ffact", "lender_key geography_key date_key approved_dollars"),
    }
    parts = [
        _check(f"not_null_{model}_{column}", _if(f"{column} IS NULL"), table, "Column must have a value.")
        for model, (table, columns) in models.items()
        for column in columns.split()
    ]
    for model, column in (("dim_lender", "lender_key"), ("dim_geography", "geography_key"), ("dim_date", "date_key")):
        table = models[model][0]
        repeated = f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        parts.append(_check(f"unique_{model}_{column}", "count(*)", repeated, "Column value must not repeat."))
        missing = f"(SELECT * FROM ffact WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {table}))"
        parts.append(
            _check(
                f"relationships_fct_lending_activity_{column}",
                "count(*)",
                missing,
                "Column value must exist in the parent model.",
            )
        )
    regions = ", ".join(f"'{region}'" for region in REGIONS)
    parts.append(
        _check(
            "accepted_values_dim_geography_region",
            _if(f"region NOT IN ({regions})"),
            "dim_g",
            "Column value must be in the accepted list.",
        )
    )
    return _union(parts)


def _overview() -> str:
    cards = (
        ("Total Approved Dollars", "CAST(sum(approved_dollars) AS DOUBLE)"),
        ("Total Loan Count", "CAST(sum(approved_loan_count) AS DOUBLE)"),
        ("Average Loan Size", quotient("sum(approved_dollars)", "sum(approved_loan_count)")),
        ("Total Guaranty Dollars", "CAST(sum(guaranty_dollars) AS DOUBLE)"),
        ("Guaranty Rate", quotient("sum(guaranty_dollars)", "sum(approved_dollars)")),
        ("Active Lenders", "CAST(max((SELECT count(*) FROM dim_l)) AS DOUBLE)"),
        ("Top 10 Lender Share", quotient(_TOP_ALL, "sum(approved_dollars)")),
    )
    parts = [f"SELECT 'cards' AS visual, '{label}' AS label, {value} AS value FROM flat" for label, value in cards]
    parts.append(
        "SELECT * FROM (SELECT 'top_lenders', lender_name, CAST(sum(approved_dollars) AS DOUBLE) FROM flat "
        "GROUP BY lender_name ORDER BY sum(approved_dollars) DESC, lender_name LIMIT 10)"
    )
    parts.append("SELECT 'states', state, CAST(sum(approved_dollars) AS DOUBLE) FROM flat GROUP BY state")
    return _union(parts)


def _geography() -> str:
    sums = f"{total('approved_dollars')} AS total_approved_dollars, {count('approved_loan_count')} AS total_loan_count"
    blank = "CAST(NULL AS DOUBLE) AS average_loan_size"
    average_size = f"{quotient('sum(approved_dollars)', 'sum(approved_loan_count)')} AS average_loan_size"
    none = "CAST(NULL AS VARCHAR)"
    return _union(
        [
            f"SELECT 'states' AS visual, {none} AS region, state, {none} AS county, {sums}, {blank} FROM flat GROUP BY state",
            f"SELECT 'regions', region, state, {none}, {sums}, {blank} FROM flat GROUP BY ROLLUP (region, state)",
            f"SELECT 'counties', {none}, state, county, {sums}, {average_size} FROM flat GROUP BY state, county",
        ]
    )


def _quality_page() -> str:
    cards = (
        ("Fact Rows", "(SELECT count(*) FROM ffact)"),
        ("Failed Data Quality Checks", "(SELECT count(*) FROM report WHERE status <> 'pass')"),
        ("Rejected Record Count", "(SELECT CAST(sum(n) AS BIGINT) FROM reject_groups)"),
    )
    parts = [
        f"SELECT 'cards' AS visual, '{label}' AS label, CAST({value} AS VARCHAR) AS value" for label, value in cards
    ]
    parts.append("SELECT 'cards', 'Reporting Period', '2024-09-30'")
    parts.append("SELECT 'report', check_name, status || ' ' || failed_count FROM report")
    parts.append(
        "SELECT 'rejected', source_table || ' ' || rejection_reason, CAST(n AS VARCHAR) FROM reject_groups"
    )
    return _union(parts)


def _quarantine() -> str:
    # The JSON holds the text as delivered, so the lender part reads the raw columns.
    lender = f"""
        SELECT 'sba_lender_activity' AS source_table, reason AS rejection_reason,
               regexp_replace(lender, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g') AS lender,
               TRY_CAST(approved_loans AS DECIMAL(38,10)) AS approved_loans,
               TRY_CAST(approved_dollars AS DECIMAL(38,10)) AS approved_dollars,
               CAST(to_json({{{_json(*_LENDER, *_AMOUNTS, "source_line")}}}) AS VARCHAR) AS raw
        FROM (SELECT *, CASE WHEN source_line IS NULL THEN NULL
                             WHEN lender IS NULL OR TRY_CAST(approved_loans AS DECIMAL(38,10)) IS NULL
                             THEN 'missing_required_value'
                             WHEN TRY_CAST(approved_loans AS DECIMAL(38,10)) <= 0
                               OR TRY_CAST(approved_dollars AS DECIMAL(38,10)) <= 0 THEN 'invalid_amount'
                        END AS reason FROM raw)
        WHERE reason IS NOT NULL"""
    county = _json(*_LENDER, "project_state", "project_county", *_AMOUNTS)
    office = _json(*_LENDER, "do_code", "sba_do_name", *_AMOUNTS)
    return _union(
        [
            lender,
            _rejected("dirty_c", "sba_lender_county_activity", county),
            _rejected("dirty_d", "sba_district_office_activity", office),
        ]
    )


def _missing_text(counts: dict[str, str]) -> str:
    """``column=n`` for each column with missing values, in the order of their names."""
    each = [f"CASE WHEN {n} > 0 THEN '{c}=' || {n} END" for c, n in sorted(counts.items())]
    return f"concat_ws(', ', {', '.join(each)})"


def _log() -> str:
    missing = {c: _if(f"NOT is_blank AND {c} IS NULL") for c in (*_LENDER, *_AMOUNTS)}
    lender = f"""
        SELECT 'sba_lender_activity' AS source_table, count(*) AS raw_rows,
               {_if("NOT is_blank")} AS rows_after_blank_drop,
               {_if("NOT is_blank AND rejection_reason IS NULL")} AS clean_rows,
               {_if("is_blank OR rejection_reason IS NOT NULL")} AS rows_removed,
               {_if("rejection_reason IS NOT NULL")} AS rows_rejected,
               (SELECT (SELECT count(*) FROM cleaned) - count(*) FROM (SELECT DISTINCT * FROM cleaned))
                   AS duplicate_rows, {_missing_text(missing)} AS missing_before
        FROM judged"""
    loans = "TRY_CAST(approved_loans AS DECIMAL(38,10))"

    def dirty(table: str, name: str) -> str:
        return f"""
            SELECT '{name}', count(*), count(*), {_if(f"{loans} > 0")}, {_if(f"coalesce({loans}, 0) <= 0")},
                   {_if(f"coalesce({loans}, 0) <= 0")},
                   {_if(f"{loans} > 0")} - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table} WHERE {loans} > 0)),
                   {_missing_text({"approved_loans": _if(f"{loans} IS NULL")})}
            FROM {table}"""

    return _union([lender, dirty("dirty_c", "sba_lender_county_activity"), dirty("dirty_d", "sba_district_office_activity")])


def _null_cells(name: str) -> str:
    table, extra = _TABLES[name]
    columns = _columns(extra)
    cells = {c: _if(f"{c} IS NULL") for c in columns}
    cells["cells"] = " + ".join(cells.values())
    return _union(
        [f"SELECT '{name}' AS source_table, '{c}' AS column_name, CAST({n} AS BIGINT) AS missing FROM {table}" for c, n in cells.items()]
    )


def _null_token(column: str) -> str:
    return (
        f"CASE WHEN approved_loans % 7 = 2 OR approved_loans % 5 = 1 OR approved_loans % 3 = 0 "
        f"THEN NULL ELSE {column} END"
    )


def _failing(rule: str, condition: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, lender_key, geography_key, approved_loan_count, approved_dollars, "
        f"guaranty_dollars FROM ffact WHERE {condition}"
    )


def _by_dates() -> str:
    fiscal = "reporting_period + INTERVAL 3 MONTH"
    return f"""
        SELECT CAST(strftime(reporting_period, '%Y%m%d') AS INTEGER) AS date_key, reporting_period,
               CAST(year(reporting_period) AS INTEGER) AS year, 'Q' || quarter({fiscal}) AS quarter,
               CAST(month(reporting_period) AS INTEGER) AS month,
               'FY' || year({fiscal}) || ' ' || CASE WHEN month(reporting_period) = 9 THEN 'Year End'
                                                     ELSE 'Q' || quarter({fiscal}) END AS period_label
        FROM (SELECT DISTINCT CAST(last_day(o_orderdate) AS DATE) AS reporting_period FROM orders)"""


_ASIA_EUROPE = "region IN ('EUROPE', 'ASIA')"
_DESCRIPTION = "p_name || '/' || p_type || ' o''' || p_brand"

CTES["report"] = _report()
CTES["reject_groups"] = (
    f"SELECT source_table, rejection_reason, count(*) AS n FROM ({_quarantine()}) GROUP BY ALL"
)

QUERIES = {
    # ingest and cleaning
    "ingest_extracts": _union(
        [
            f"SELECT '{name}' AS source_table, count(*) AS rows, {count('approved_loans')} AS approved_loans, "
            f"{total('approved_dollars')} AS approved_dollars, "
            f"{total('approved_sba_guaranty_dollars')} AS approved_sba_guaranty_dollars FROM {table}"
            for name, table in zip(_TABLES, ("l", "c", "d"), strict=True)
        ]
    ),
    "csv_load_nulls": f"""
        SELECT * REPLACE ({_null_token("lender_city")} AS lender_city,
                          CASE WHEN approved_loans % 11 = 3 THEN NULL ELSE avg_loan_size END AS avg_loan_size)
        FROM c""",
    "typed_import": f"""
        SELECT l_suppkey AS lender_key, CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_partkey END AS geography_key,
               CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key,
               CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS reporting_period,
               CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS approved_loan_count,
               CASE WHEN l_orderkey % 103 = 0 THEN NULL ELSE {_LINE} END AS approved_dollars,
               CAST({_GUARANTEED} AS DECIMAL(18,2)) AS guaranty_dollars
        FROM lineitem""",
    "drop_blank_rows": "SELECT raw.* FROM raw WHERE source_line IS NOT NULL",
    "strip_text": "SELECT source_line, lender FROM parsed",
    "coerce_numeric": "SELECT source_line, approved_loans, approved_dollars, approved_sba_guaranty_dollars FROM parsed",
    "reject_missing": "SELECT rejection_reason, lender, approved_loans, approved_dollars FROM judged "
    "WHERE rejection_reason = 'missing_required_value'",
    "reject_invalid_amount": "SELECT rejection_reason, lender, approved_loans, approved_dollars FROM judged "
    "WHERE rejection_reason = 'invalid_amount'",
    "quarantine_union": _quarantine(),
    "clean_rows": "SELECT * FROM valid",
    "round_amounts": "SELECT * FROM rounded",
    "derive_row_ratios": "SELECT * FROM cleaned",
    "cleaning_log": _log(),
    "stg_lender": "SELECT * FROM sl",
    "stg_county": "SELECT * FROM sc",
    "stg_district": "SELECT * FROM sd",
    # named analytics
    "kpi_summary": _kpi(),
    "top10_share": f"SELECT CAST({_TOP10} AS DECIMAL(28,2)) AS top_approved_dollars, "
    f"{percent(_TOP10, 'sum(approved_dollars)')} AS top_share_pct FROM l",
    "top_lenders": _top_lenders(),
    "state_activity": _activity("c", "project_state", _ALL_L),
    "county_concentration": _activity("c", "project_state, project_county", _ALL_L, 20),
    "geographic_reach": _reach(),
    "office_activity": _activity("d", "do_code, sba_do_name", limit=20),
    "widest_reach": _widest(),
    "concentration_curve": f"""
        SELECT CAST(row_number() OVER w AS INTEGER) AS lender_rank, {_ID},
               CAST(approved_dollars AS DECIMAL(28,2)) AS approved_dollars,
               {quotient("sum(approved_dollars) OVER w", _ALL_L)} * 100 AS cumulative_share_pct
        FROM l WINDOW w AS (ORDER BY approved_dollars DESC, {_ID} ROWS UNBOUNDED PRECEDING)
        QUALIFY row_number() OVER w <= 50""",
    "lender_metrics": f"""
        SELECT *, {quotient("approved_dollars", "approved_loan_count")} AS avg_loan_size,
               {quotient("guaranty_dollars", "approved_dollars")} AS guaranty_rate,
               {quotient("approved_dollars", "(SELECT sum(approved_dollars) FROM sl)")} AS lender_share
        FROM sl""",
    "state_metrics": f"""
        SELECT project_state, count(DISTINCT lender_name) AS lender_count,
               {count("approved_loan_count")} AS approved_loan_count, {total("approved_dollars")} AS approved_dollars,
               {total("guaranty_dollars")} AS guaranty_dollars,
               {quotient("sum(approved_dollars)", "sum(approved_loan_count)")} AS avg_loan_size,
               {quotient("sum(guaranty_dollars)", "sum(approved_dollars)")} AS guaranty_rate,
               {quotient("sum(approved_dollars)", "(SELECT sum(approved_dollars) FROM sc)")} AS exposure_share
        FROM sc GROUP BY project_state""",
    "executive_kpis": f"""
        SELECT {count("approved_loan_count")} AS total_loan_count, {total("approved_dollars")} AS total_approved_dollars,
               {total("guaranty_dollars")} AS total_guaranty_dollars,
               {_RATIOS}, count(DISTINCT lender_key) AS active_lenders,
               count(DISTINCT geography_key) AS active_geographies
        FROM fact""",
    "headline_facts": _headlines(),
    "completion_line": f"""
        SELECT 'KPIs: ' || {money_short("approved_dollars")} || ' approved across ' || {thousands("approved_loans")}
               || ' loans, guaranty rate ' || {two_decimals("guaranty_rate_pct")} || '%, top-10 share '
               || {two_decimals("top_10_lender_share_pct")} || '%' AS line FROM ({_kpi()})""",
    "kpi_cards": _cards(),
    "ranked_bars": _all_bars(),
    # star schema
    "dim_lender": "SELECT * FROM dim_l",
    "dim_geography": "SELECT * FROM dim_g",
    "dim_date": _by_dates(),
    "fact_left": "SELECT * FROM ffact",
    "fact_inner": "SELECT * FROM ffact_in",
    "reconcile": """
        SELECT CAST(fact_dollars AS DECIMAL(28,2)) AS fact_dollars, CAST(source_dollars AS DECIMAL(28,2)) AS source_dollars,
               CASE WHEN abs(fact_dollars - source_dollars) <= 0.01 THEN 'pass' ELSE 'fail' END AS status
        FROM (SELECT (SELECT sum(approved_dollars) FROM ffact_in) AS fact_dollars,
                     (SELECT sum(approved_dollars) FROM fsc) AS source_dollars)""",
    "orphans": _union(
        [
            "SELECT 'lender' AS relationship, lender_name AS value, count(*) AS rows FROM fsc "
            "WHERE lender_name NOT IN (SELECT lender_name FROM fdim_l) GROUP BY lender_name",
            "SELECT 'state', project_state, count(*) FROM fsc "
            "WHERE project_state NOT IN (SELECT state FROM lookup) GROUP BY project_state",
            "SELECT 'period', CAST(date_key AS VARCHAR), count(*) FROM ffact "
            "WHERE date_key NOT IN (SELECT date_key FROM dim_d) GROUP BY date_key",
        ]
    ),
    # semantic measures
    "m_base": f"SELECT region, state, {_BASE} FROM flat GROUP BY region, state",
    "m_ratios": f"SELECT lender_state, {_BASE}, {_RATIOS} FROM flat GROUP BY lender_state",
    "m_lender_share": f"""
        SELECT t.region, lender_name, {total("approved_dollars")} AS total_approved_dollars, all_lender_dollars,
               {quotient("sum(approved_dollars)", "all_lender_dollars")} AS lender_share
        FROM flat t JOIN (SELECT region, {total("approved_dollars")} AS all_lender_dollars
                          FROM flat GROUP BY region) e ON t.region = e.region
        WHERE lender_state = 'ASIA' AND t.{_ASIA_EUROPE}
        GROUP BY t.region, lender_name, all_lender_dollars""",
    "m_active_lenders": f"""
        SELECT region, lender_state, active_lenders
        FROM ({_active_by("lender_state")}) CROSS JOIN (
            SELECT DISTINCT region FROM dim_g
            UNION SELECT NULL FROM ffact WHERE geography_key IS NULL) places""",
    "m_active_lenders_by_name": _active_by("lender_name"),
    "m_top10_dollars": _TOP_BY_REGION,
    "m_top10_share": f"""
        SELECT t.region, top_lender_dollars, all_lender_dollars,
               {quotient("top_lender_dollars", "all_lender_dollars")} AS top_lender_share
        FROM ({_TOP_BY_REGION}) t
        JOIN (SELECT region, {total("approved_dollars")} AS all_lender_dollars FROM flat GROUP BY region) e
          ON t.region = e.region""",
    "lender_reach": """
        SELECT region, state, county, CAST(grouping(region, state, county) AS INTEGER) AS level,
               count(DISTINCT lender_key) AS lenders_with_loans
        FROM ffact LEFT JOIN dim_g USING (geography_key) GROUP BY ROLLUP (region, state, county)""",
    "m_failed_checks": f"SELECT count(*) AS failed_checks FROM ({_report()}) WHERE status <> 'pass'",
    "m_rejected": f"SELECT count(*) AS rejected_records FROM ({_quarantine()})",
    "measure_slice": f"""
        SELECT lender_name, {_BASE}, {_RATIOS} FROM flat
        WHERE lender_state = 'ASIA' AND {_ASIA_EUROPE} GROUP BY lender_name""",
    # report pages
    "page_overview": _overview(),
    "page_lender": f"""
        SELECT lender_name, {total("approved_dollars")} AS total_approved_dollars,
               {count("approved_loan_count")} AS total_loan_count, {_RATIOS},
               {quotient("sum(approved_dollars)", "(SELECT sum(approved_dollars) FROM flat)")} AS lender_share
        FROM flat GROUP BY lender_name""",
    "page_geography": _geography(),
    "region_rollup": f"""
        SELECT region, state, CAST(grouping(region, state) AS INTEGER) AS level,
               {total("approved_dollars")} AS total_approved_dollars, {count("approved_loan_count")} AS total_loan_count
        FROM flat GROUP BY ROLLUP (region, state)""",
    "dq_page": _quality_page(),
    # data quality, on tables with broken rows
    "dq_missing": _union([_null_cells(name) for name in _TABLES]),
    "dq_duplicates": _union([_source_rule("duplicate_rows", name) for name in _TABLES]),
    "dq_row_rules": _union(
        [
            _source_rule(rule, name)
            for name in _TABLES
            for rule in ("non_negative_amounts", "guaranty_not_above_approved")
        ]
    ),
    "dq_unique_keys": _union(
        [
            _check("dim_lender_unique_key", _if("lender_key % 4 = 0"), "fdim_l", CHECK_DETAILS["dim_lender_unique_key"]),
            _star_check("dim_geography_unique_key"),
        ]
    ),
    "dq_fact_keys": _union(
        [
            _star_check("fact_lender_key_not_null"),
            _check(
                "fact_geography_key_not_null",
                _if("geography_key IS NULL OR geography_key % 3 = 0"),
                "ffact",
                CHECK_DETAILS["fact_geography_key_not_null"],
            ),
        ]
    ),
    "dq_accepted_states": _check(
        "dim_geography_valid_state_codes",
        _if("state IS NULL OR CAST(substr(state, 8) AS INTEGER) % 5 = 0"),
        "dim_g",
        CHECK_DETAILS["dim_geography_valid_state_codes"],
    ),
    "dq_fact_rules": _union(
        [_star_check(n) for n in ("fact_non_negative_amounts", "fact_guaranty_not_above_approved")]
    ),
    "quality_report": _report(),
    "expectations": _expectations(),
    "failing_rows": _union(
        [
            _failing("non_negative_amounts", "approved_loan_count < 0 OR approved_dollars < 0 OR guaranty_dollars < 0"),
            _failing("guaranty_not_above_approved", "guaranty_dollars > approved_dollars"),
            "SELECT 'reconciles_to_source', NULL, NULL, NULL, CAST(fact_dollars - source_dollars AS DECIMAL(18,2)), NULL "
            "FROM (SELECT (SELECT sum(approved_dollars) FROM ffact_in) AS fact_dollars, "
            "(SELECT sum(approved_dollars) FROM fsc) AS source_dollars) WHERE abs(fact_dollars - source_dollars) > 0.01",
        ]
    ),
    # display and rounding
    "rounding": f"""
        SELECT o_custkey, {average("sum(price)", "count(*)")} AS avg_price,
               {percent("max(price)", "sum(price)")} AS largest_pct,
               {percent("sum(price) - 2 * max(price)", "max(price)")} AS rest_pct
        FROM (SELECT o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders) GROUP BY o_custkey""",
    "money_short": f"""
        SELECT o_orderkey, {money_short("o_custkey")} AS small, {money_short("price")} AS thousands,
               {money_short("price * 100")} AS millions, {money_short("price * -100000")} AS billions
        FROM (SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)""",
    "title_case": f"SELECT p_partkey, {title_case(_DESCRIPTION)} AS title FROM part",
    "ellipsis": f"SELECT p_partkey, {ellipsis(_DESCRIPTION, 12)} AS short, {ellipsis(_DESCRIPTION, 20)} AS medium, "
    f"{ellipsis(_DESCRIPTION, 34)} AS long FROM part",
    "display_formats": f"""
        SELECT c_custkey, {thousands("balance")} AS thousands, {one_decimal("balance")} || '%' AS percent_one,
               {two_decimals("balance")} || '%' AS percent_two,
               CASE WHEN round(balance) < 0 THEN '(' ELSE '' END || '$'
                   || format('{{:,}}', CAST(abs(round(balance)) AS BIGINT))
                   || CASE WHEN round(balance) < 0 THEN ')' ELSE '' END AS currency,
               CAST({hundredths(half_up(cents('balance'), '10000'), 'DECIMAL(28,2)')} AS VARCHAR) || '%' AS fraction_percent
        FROM (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer)""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(select) for name, select in QUERIES.items()}
