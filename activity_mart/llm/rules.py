"""Operator 3: quality rules as weak supervision, in DataFrame functions alone.

Each rule votes to accept or to reject a document, or abstains. Expectation-maximisation over
the counts of vote patterns estimates how often a rule is right on good and on bad documents,
and a document is kept by its posterior probability of being good. Left free, the estimates settle
on the largest group of rules that reject together and call everything else good. So what is
known of the rules bounds them: a rule that speaks rejects few good documents and some bad ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_mart.llm.common import stored, table, text_of

# What separates words, and the symbols that are counted.
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"
CAPITALS = "A-Z"

MIN_WORDS = 50
ITERATIONS = 20
MOST_GOOD_REJECTED, LEAST_BAD_REJECTED = 0.02, 0.1
# A rule: the measure, what it is a share of, per cent from which it rejects, and up to which it
# accepts. Between the two it abstains.
RULES = (
    ("n_symbols", "word_chars", 5, 1),
    ("n_capitals", "word_chars", 30, 10),
    ("n_exclaims", "n_words", 30, 5),
    ("n_repeat_words", "n_words", 30, 15),
    ("n_dup_lines", "n_lines", 35, 25),
    ("word_chars", "n_words", 1000, 900),
)
VOTES = [f"v{i}" for i in range(len(RULES))]


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _count(text: Column, characters: str) -> Column:
    """How many characters of the text are among these, by taking out the runs of all others."""
    return F.char_length(F.regexp_replace(text, f"[^{characters}]+", "")).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, by the windows' 64-bit digests.

    Windows sorted by digest and place have their copies next to each other. Places of repeated
    windows, sorted again, cover three words each, less what the next one covers too.
    """
    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )

    def places(s: Column) -> Column:
        same = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
        marked = F.transform(s, lambda x, j: F.when(same(x, j), x["i"]))
        return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))

    def covered(p: Column) -> Column:
        each = F.transform(p, lambda x, j: F.least(F.lit(3), F.get(p, j + 1) - x))
        return F.aggregate(each, F.lit(0), lambda a, b: a + b)

    def count(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _once(_once(ordered, places), covered)).otherwise(0)

    return _once(windows, count).cast("long")


def measures(text: Column) -> Column:
    """The measures of a text as a struct of longs."""

    def of(parts: Column) -> Column:
        words, lines = parts["words"], parts["lines"]
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.regexp_replace(text, WORD_BREAK, "")).cast("long").alias("word_chars"),
            _count(text, SYMBOLS).alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _once(words, _repeat_words).alias("n_repeat_words"),
            _count(text, CAPITALS).alias("n_capitals"),
            _count(text, "!").alias("n_exclaims"),
            F.size(lines).cast("long").alias("n_lines"),
        )

    words = F.array_remove(F.split(text, WORD_BREAK), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return _once(F.struct(words.alias("words"), lines.alias("lines")), of)


def _vote(of: str, measure: str, whole: str, reject: int, accept: int) -> Column:
    share, total = F.col(f"{of}.{measure}") * 100, F.col(f"{of}.{whole}")
    return F.when(total == 0, 0).when(share > total * reject, -1).when(share <= total * accept, 1).otherwise(0)


def posteriors(patterns: dict[tuple[int, ...], int], iterations: int = ITERATIONS) -> dict[tuple[int, ...], float]:
    """Log odds of being good for each pattern of votes, from the patterns' counts.

    There are at most 3 to the number of rules patterns. It starts from documents that no rule
    rejects being good. Good and bad are equally likely beforehand.
    """
    good = {p: 0.05 if -1 in p else 0.95 for p in patterns}
    odds = dict.fromkeys(patterns, 0.0)
    for _ in range(iterations):
        of_good, of_bad = [], []  # share of a rule's votes that reject
        for j in range(len(RULES)):
            votes = [(p[j], n, good[p]) for p, n in patterns.items() if p[j]]
            of_good.append(min(MOST_GOOD_REJECTED, (sum(n * q for v, n, q in votes if v < 0) + 1) / (sum(n * q for v, n, q in votes) + 100)))
            of_bad.append(max(LEAST_BAD_REJECTED, (sum(n * (1 - q) for v, n, q in votes if v < 0) + 1) / (sum(n * (1 - q) for v, n, q in votes) + 10)))
        for p in patterns:
            odds[p] = sum(
                math.log((1 - g) / (1 - b)) if v > 0 else math.log(g / b) if v < 0 else 0.0 for v, g, b in zip(p, of_good, of_bad, strict=True)
            )
            good[p] = 1 / (1 + math.exp(-odds[p]))
    return odds


def judged(measured: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A stored frame with the struct ``_quality`` of measures, that struct now with the verdict.

    ``_quality`` then has the contract's measures, ``quality`` (the posterior), ``base_failed`` and
    ``kept``. Rows are judged one by one, so repeated rows agree.
    """
    rules = [_vote("_quality", *rule) for rule in RULES]
    votes = measured.select(*[rule.alias(v) for rule, v in zip(rules, VOTES, strict=True)])
    # At most a row for each pattern of votes.
    patterns = {tuple(r[v] for v in VOTES): r["n"] for r in votes.groupBy(*VOTES).agg(F.count("*").alias("n")).collect()}
    odds = posteriors(patterns) or {(0,) * len(RULES): 0.0}
    code = lambda pattern: sum((v + 1) * 3**i for i, v in enumerate(pattern))
    by_code = F.map_from_arrays(F.array(*[F.lit(code(p)) for p in odds]), F.array(*[F.lit(x) for x in odds.values()]))
    found = by_code[sum(((rule + 1) * 3**i for i, rule in enumerate(rules)), F.lit(0))]
    m = F.col("_quality")
    base = (m["n_words"] < min_words) | (m["n_repeat_words"] * 100 > m["n_words"] * 50)
    return measured.withColumn("_odds", found).withColumn(
        "_quality",
        F.struct(
            *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            (1 / (1 + F.exp(-F.col("_odds")))).alias("quality"),
            base.alias("base_failed"),
            (~base & (F.col("_odds") >= 0)).alias("kept"),
        ),
    ).drop("_odds")


def keep_good(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their own columns and no other.

    Null texts count as empty: they have no words, every rule abstains, and the base rule fails
    if ``min_words`` is over 0. An empty table stays empty; repeated rows stay or go together.
    """
    measured = stored(docs.select(F.struct("*").alias("_row"), measures(text_of()).alias("_quality")), "quality-rows")
    return judged(measured, min_words).filter("_quality.kept").select("_row.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", measures(text_of()).alias("_quality"))
    return judged(stored(docs, "quality-measures")).select("doc_id", "_quality.*").drop("quality")


def oracle_sql() -> str:
    """The same measures, votes, maximisation and verdicts as SQL for DuckDB."""
    vote = lambda m, w, reject, accept: f"CASE WHEN {w} = 0 THEN 0 WHEN 100 * {m} > {reject} * {w} THEN -1 WHEN 100 * {m} <= {accept} * {w} THEN 1 ELSE 0 END"
    without = lambda text, characters: f"length(regexp_replace({text}, '[{characters}]', '', 'g'))"
    spaces = "\\x20\\x09-\\x0D"
    steps = ["p0 AS (SELECT " + ", ".join(VOTES) + ", n, CASE WHEN least(" + ", ".join(VOTES) + ") = -1 THEN 0.05::DOUBLE ELSE 0.95::DOUBLE END AS good FROM patterns)"]
    for i in range(ITERATIONS):
        share = lambda v, q, least: f"(coalesce(sum(n * {q}) FILTER ({v} < 0), 0) + 1) / (coalesce(sum(n * {q}) FILTER ({v} <> 0), 0) + {least})"
        rates = []
        for v in VOTES:
            rates.append(f"least({MOST_GOOD_REJECTED}::DOUBLE, {share(v, 'good', 100)}) AS g_{v}")
            rates.append(f"greatest({LEAST_BAD_REJECTED}::DOUBLE, {share(v, '(1 - good)', 10)}) AS b_{v}")
        terms = " + ".join(f"CASE {v} WHEN 1 THEN ln((1 - g_{v}) / (1 - b_{v})) WHEN -1 THEN ln(g_{v} / b_{v}) ELSE 0 END" for v in VOTES)
        steps.append(f"m{i} AS MATERIALIZED (SELECT {', '.join(rates)} FROM p{i})")
        steps.append(
            f"p{i + 1} AS MATERIALIZED (SELECT {', '.join(VOTES)}, n, odds, 1 / (1 + exp(-odds)) AS good FROM "
            f"(SELECT {', '.join(VOTES)}, n, {terms} AS odds FROM patterns, m{i}))"
        )
    votes = ", ".join(f"{vote(*rule)} AS {v}" for rule, v in zip(RULES, VOTES, strict=True))
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
parts AS (
    SELECT r, doc_id, text, regexp_extract_all(text, '[^{spaces}]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{spaces}]')) AS lines FROM texts),
grams AS (
    SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM parts)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(3) AS s(k) GROUP BY r),
measured AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, {without("text", spaces)} AS word_chars,
        length(text) - {without("text", "#*$%&|<>")} AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
        length(text) - {without("text", "A-Z")} AS n_capitals, length(text) - {without("text", "!")} AS n_exclaims,
        len(lines) AS n_lines
    FROM parts LEFT JOIN covered USING (r)),
voted AS (SELECT *, {votes} FROM measured),
patterns AS MATERIALIZED (SELECT {", ".join(VOTES)}, count(*) AS n FROM voted GROUP BY ALL),
{", ".join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND odds >= 0 AS kept
FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM voted)
JOIN p{ITERATIONS} USING ({", ".join(VOTES)})
"""
