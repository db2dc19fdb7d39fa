"""Operator 4: a quality classifier by an interpolated modified Kneser-Ney model.

The model is over the bytes of the text's UTF-8, so every character of every script is told from
all others, trained on all trusted documents. Counts, and the joins of counts that give its
probabilities, are DataFrames sharded by n-gram and context. A document is rejected if its
perplexity by character is above a quantile of its language's trusted documents. Two models are
trained, each on one half of the trusted documents, and no document is judged by a model that it trained.

The bits of every n-gram of the corpus are worked out in shards; a table of few n-grams then goes to every
task, a larger one is joined with the distinct n-grams of each chunk of documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_mart.llm.common import drop_table, ship, stored, table, text_of
from activity_mart.llm.grams import SENT_GRAMS, counts, sums

ORDER = 6  # bytes; an n-gram is a number of ORDER digits to the base CLASSES
CLASSES = 256
# Words of 64 trusted ids that go to every task at most.
SENT_IDS = 2_000_000
# Groups that the two bytes before an n-gram's last are dealt into.
SHARDS = 1024
QUANTILE = 0.995
# Bits a character that a document may exceed its language's quantile by.
MARGIN = 0.1
# A model fits its own training text better than other text, the more so the less there is of it: the
# margin grows by so many bits over the language's trusted characters, up to one bit.
OVERFIT = 30_000
# A document's mean is taken with so many characters of its language's mean, so that a few
# characters alone don't reject it.
PRIOR_CHARACTERS = 300


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte and at each text's end, and each text's begin and length."""
    pad = b"\n" * (ORDER - 1)
    encoded = [t.encode() for t in texts]
    c = np.frombuffer(pad + (b"\n" + pad).join(encoded) + b"\n", dtype=np.uint8).astype(np.int64)
    grams = c[ORDER - 1 :].copy()
    for k in range(1, ORDER):
        grams += c[ORDER - 1 - k : len(c) - k] * CLASSES**k
    lengths = np.array([len(t) + 1 for t in encoded], dtype=np.int64)
    starts = np.cumsum(lengths + ORDER - 1) - lengths - (ORDER - 1)
    return grams, starts, lengths


def _cut(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that end inside the texts, null ones being empty, and how many each text has."""
    grams, starts, lengths = _grams([t or "" for t in texts])
    # Each text but the first follows its padding.
    inside = np.ones(len(grams), dtype=bool)
    for k in range(1, ORDER):
        inside[starts[1:] - k] = False
    return grams[inside], lengths


def gram_counts(docs: DataFrame) -> DataFrame:
    """``gram`` and ``n`` over all texts; each task sends its sums, not its n-grams."""
    return counts(docs.select(text_of().alias("text"), F.lit(0).alias("class")), _cut, 1).withColumnRenamed("n0", "n")


def probabilities(counts: DataFrame) -> list[DataFrame]:
    """For each order from 1, the probability of every seen n-gram and the weight of each context.

    Columns ``gram, p, context, rest``: ``rest`` is the weight that ``context`` leaves to the next
    lower order. Lower orders count in how many contexts an n-gram is seen, not how often. Every
    step is a sum or a join by n-gram or context.
    """
    orders = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        # Stored, as each is read several times: else the lowest order's plan would hold all the sums above it, over and over.
        orders[k] = stored(orders[k + 1].groupBy((F.col("gram") % CLASSES**k).alias("gram")).agg(F.count("*").alias("n")), "kneser-ney-counts")
    made: list[DataFrame] = []
    for k in range(1, ORDER + 1):
        seen = orders[k].select("gram", "n", F.shiftright("gram", 8).alias("context"))
        times = [F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]
        n1, n2, n3, n4 = seen.agg(*times).first()
        # Discounts of n-grams seen once, twice and more often, from how many of each there are.
        y = n1 / (n1 + 2 * n2) if n1 else 0.0
        discount = [i - (i + 1) * y * more / own if own else 0.5 for i, own, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        discount = [min(max(d, 0.1), i - 0.1) for i, d in enumerate(discount, 1)]
        off = F.when(F.col("n") == 1, discount[0]).when(F.col("n") == 2, discount[1]).otherwise(discount[2])
        contexts = seen.groupBy("context").agg(F.sum("n").alias("total"), F.sum(off).alias("off"))
        joined = seen.join(contexts.select("context", "total", (F.col("off") / F.col("total")).alias("rest")), "context")
        if k == 1:
            lower = joined.withColumn("q", F.lit(1.0 / CLASSES))
        else:
            lower = joined.withColumn("tail", F.col("gram") % CLASSES ** (k - 1)).join(made[-1].select(F.col("gram").alias("tail"), F.col("p").alias("q")), "tail")
        p = (F.col("n") - off) / F.col("total") + F.col("rest") * F.col("q")
        made.append(stored(lower.select("gram", p.alias("p"), "context", "rest"), "kneser-ney"))
    for k in range(1, ORDER):
        drop_table(orders[k])
    return made


@dataclass
class Costs:
    """Bits of one order's seen n-grams, and of the weight that each of their contexts leaves."""

    grams: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    rests: np.ndarray


def seen_costs(orders: list[DataFrame]) -> list[Costs]:
    """The orders' tables, read to the driver: for the lowest orders, or a small model."""
    read = [seen.select("gram", F.col("p").cast("float"), F.col("rest").cast("float")).toArrow() for seen in orders]
    return [_costs(*[rows[name].to_numpy() for name in ("gram", "p", "rest")]) for rows in read]


def _costs(grams: np.ndarray, p: np.ndarray, rest: np.ndarray) -> Costs:
    order = np.argsort(grams)
    grams = grams[order]
    contexts, first = np.unique(grams // CLASSES, return_index=True)
    return Costs(grams, -np.log2(p[order]), contexts, -np.log2(rest[order][first]))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def gram_bits(grams: np.ndarray, tables: list[Costs]) -> np.ndarray:
    """Bits of n-grams, seen or not: one that was not seen has its context's rest of the lower order's."""
    bits = np.zeros(len(grams), dtype=np.float64)
    left = np.arange(len(grams))
    for k in range(ORDER, 0, -1):
        own, part = tables[k - 1], grams[left] % CLASSES**k
        at, there = _find(own.grams, part)
        bits[left[there]] += own.bits[at[there]]
        left, part = left[~there], part[~there] // CLASSES
        at, there = _find(own.contexts, part)
        bits[left[there]] += own.rests[at[there]]
    bits[left] += np.log2(CLASSES)
    return bits


def cost_table(orders: list[DataFrame]) -> np.ndarray:
    """Bits of every byte after each seen context of the highest order, by context, to look at a small model."""
    tables = seen_costs(orders)
    return gram_bits((tables[-1].contexts[:, None] * CLASSES + np.arange(CLASSES)).ravel(), tables)


def gram_costs(wanted: DataFrame, models: list[list[DataFrame]]) -> DataFrame:
    """``gram`` of ``wanted``, and ``b0``, ``b1``, ...: its bits by each of the models, seen in training or not.

    A shard holds the n-grams of all orders whose last byte follows some two bytes, and with them every
    n-gram and context that one of its own falls back to, but for the two lowest orders, which go to every task.
    """
    names = [f"b{i}" for i in range(len(models))]
    lowest = wanted.sparkSession.sparkContext.broadcast([seen_costs(orders[:2]) for orders in models])
    none = F.lit(None).cast("float")
    rows = wanted.select("gram", none.alias("p"), none.alias("rest"), F.lit(-1).alias("table"))
    for i, orders in enumerate(models):
        for k, seen in enumerate(orders[2:], 2):
            rows = rows.unionByName(seen.select("gram", F.col("p").cast("float"), F.col("rest").cast("float"), F.lit(i * ORDER + k).alias("table")))

    def score(found: pa.Table) -> pa.Table:
        which, grams, p, rest = (found[name].to_numpy() for name in ("table", "gram", "p", "rest"))
        own = grams[which < 0]
        bits = []
        for i, low in enumerate(lowest.value):
            parts = [which == i * ORDER + k for k in range(2, ORDER)]
            bits.append(gram_bits(own, low + [_costs(grams[part], p[part], rest[part]) for part in parts]))
        return pa.table([own, *bits], ["gram", *names])

    sharded = rows.groupBy(F.pmod(F.xxhash64(F.shiftright("gram", 8).bitwiseAND(0xFFFF)), F.lit(SHARDS)).alias("shard"))
    return sharded.applyInArrow(score, ", ".join(["gram long", *[f"{name} double" for name in names]]))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` of every document that every label calls good and none toxic."""
    good = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return good.filter("doc_id IS NOT NULL AND q = 1 AND t = 0").select("doc_id")


def training_sample(trusted: DataFrame, most: int) -> DataFrame:
    """``doc_id`` of about ``most`` of the ``trusted`` (``doc_id, lang``) at most, by hash.

    Every language has the same bound, the largest halving of ``most`` that keeps the sum within
    ``most``: a language with fewer documents has all of them, one with more about so many.
    """
    sizes = stored(trusted.groupBy("lang").agg(F.count("*").alias("n")), "trusted-languages")
    bounds = [most / 2**j for j in range(24)]
    sums = sizes.agg(*[F.sum(F.least(F.col("n").cast("double"), F.lit(bound))) for bound in bounds]).first()
    level = next((bound for bound, sampled in zip(bounds, sums, strict=True) if sampled is not None and sampled <= most), bounds[-1])
    share = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    return trusted.alias("d").join(sizes.alias("s"), F.expr("d.lang <=> s.lang")).filter(share < level / F.col("n")).select("doc_id").distinct()


def fold() -> Column:
    """The half of the trusted documents, 0 or 1, that a document is in."""
    return F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id").cast("long")), F.lit(2)).cast("int")


def in_half(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``docs`` with ``_fold``: the half of those among the ``chosen`` ids, null for others and for a null id.

    The ids go to every task as bits of 64 neighbouring ids, so that no text is shuffled; if they are in more than
    ``SENT_IDS`` such words, Spark joins them as it sees fit.
    """
    word, place = F.expr("shiftright(doc_id, 6)"), "cast(doc_id & 63 as int)"
    words = stored(chosen.groupBy(word.alias("_word")).agg(F.expr(f"bit_or(shiftleft(1L, {place}))").alias("_ids")), "trusted-words")
    sent = F.broadcast(words) if words.count() <= SENT_IDS else words
    marked = docs.withColumn("_id", F.col("doc_id").cast("long")).join(sent, F.expr("shiftright(_id, 6) = _word"), "left")
    among = F.expr("shiftright(_ids, cast(_id & 63 as int)) & 1 = 1")
    return marked.select(*[F.col(f"`{c}`") for c in docs.columns], F.when(among, fold()).alias("_fold"))


def classified(
    docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, most: int | None = None, sent: int = SENT_GRAMS, drop_text: bool = False
) -> DataFrame:
    """``docs`` (with ``doc_id``, ``lang``, ``text``), stored, with ``perplexity``, ``threshold`` and ``kept``.

    Null and empty texts have only the language's mean and are kept; a null language is a
    language of its own; one without trusted documents has the threshold of all of them
    together. Without any trusted document there is no model: every document is kept, with
    null perplexity and threshold. The models are trained on all trusted documents, or with ``most`` on
    ``training_sample`` of them; means and quantiles are over all. Rows are judged one by one: repeated ones agree, and
    an empty table stays empty. Columns of ``docs`` that begin with an underscore are not allowed. Tables of more
    n-grams than ``sent`` are joined; with ``drop_text`` the text is not stored and not returned.
    """
    good = stored(trusted_ids(labels), "trusted-ids")
    chosen = good
    if most is not None:
        trusted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").distinct().join(good, "doc_id", "left_semi")
        chosen = stored(training_sample(trusted, most), "training-sample")
    judged = in_half(docs, chosen)
    found = stored(counts(judged.select(text_of().alias("text"), F.col("_fold").alias("class")), _cut, 2), "gram-counts")
    halves = [found.filter(F.col(n) > 0).select("gram", F.col(n).alias("n")) for n in ("n0", "n1")]
    # With a single half there is one model, which then judges its own documents too.
    models = [probabilities(half) for half in halves if not half.isEmpty()]
    kept = [c for c in docs.columns if not (drop_text and c == "text")]
    if not models:
        nothing = F.lit(None).cast("double")
        return docs.select(*kept).withColumns({"perplexity": nothing, "threshold": nothing, "kept": F.lit(True)})
    costs = stored(gram_costs(found, models), "gram-costs")
    first, last = F.col("b0"), F.col(f"b{len(models) - 1}")
    bits = F.when(F.col("_fold") == 0, last).when(F.col("_fold") == 1, first).otherwise((first + last) / 2)
    judged = judged.withColumn("_characters", F.char_length(text_of()).cast("long") + 1)
    scored = sums(judged, _cut, costs, [f"b{i}" for i in range(len(models))], sent, drop_text)
    scored = stored(scored.select(*kept, bits.alias("_bits"), "_characters"), "scored-documents")

    trusted = scored.select("doc_id", "lang", "_bits", "_characters").join(good, "doc_id", "left_semi")
    ends = trusted.groupBy("lang").agg(F.sum("_bits").alias("bits"), F.sum("_characters").alias("n"))
    overall = ends.agg(F.sum("bits") / F.sum("n")).first()[0]
    means = ends.select("lang", (F.col("bits") / F.col("n")).alias("_mean"), (MARGIN + F.least(F.lit(1.0), OVERFIT / F.col("n"))).alias("_margin"))
    mean = F.coalesce("_mean", F.lit(overall))
    rate = (F.col("_bits") + mean * PRIOR_CHARACTERS) / (F.col("_characters") + PRIOR_CHARACTERS)
    same = lambda other: F.expr(f"d.lang <=> {other}.lang")
    rates = trusted.alias("d").join(means.alias("m"), same("m"), "left").select(F.col("d.lang").alias("lang"), rate.alias("rate"))
    bound = F.percentile_approx("rate", F.lit(quantile), F.lit(10_000)).alias("_bound")
    limits = means.alias("d").join(rates.groupBy("lang").agg(bound).alias("r"), same("r"))
    limits = limits.select("d.lang", "_mean", (F.col("_bound") + F.col("_margin")).alias("_limit"))
    highest = rates.agg(bound).first()[0] + MARGIN
    limits = stored(limits, "language-limits")
    own = [F.col(f"d.`{c}`") for c in kept]
    return (
        scored.alias("d")
        .join(limits.alias("t"), same("t"), "left")
        .select(*own, F.pow(2.0, rate).alias("perplexity"), F.pow(2.0, F.coalesce("_limit", F.lit(highest))).alias("threshold"))
        .withColumn("kept", F.col("perplexity") <= F.col("threshold"))
    )


def keep_trusted_like(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their own columns and no other."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "lang", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("row"))
    kept = classified(rows, labels).filter("kept")
    return kept.select(*["text" if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", text_of().alias("text"))
    judged = classified(docs, table(spark, sf_dir, "labels"), drop_text=True)
    return judged.select("doc_id", "lang", "perplexity", "threshold", "kept")
