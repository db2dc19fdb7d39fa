"""Each operator against brute force, and on nulls, empty, long, tied and repeated rows."""

import collections
import hashlib
import itertools
import math
import random
import tracemalloc
import zlib

import numpy as np
import pytest

from activity_mart.llm import grams as n_grams
from activity_mart.llm import (
    byte_pair,
    chunk_dedup,
    collisions,
    common,
    context_tree,
    kneser_ney,
    packing,
    registry,
    rules,
    sharding,
    shingle_join,
    token_counts,
    units,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, node long"


def words(n, seed):
    made = random.Random(seed)
    return " ".join("".join(made.choices("abcdefghij", k=made.randint(2, 7))) for _ in range(n))


PASSAGE = words(70, 1)
TEXTS = [
    words(200, 2),
    words(200, 2),
    words(200, 2).replace("a", "A", 3),
    words(200, 2) + " one more",
    None,
    "",
    " \t\n",
    "one two",
    "One  two",
    words(80, 3) + "\n" + PASSAGE + "\n" + words(90, 4),
    words(60, 5) + " extra " + PASSAGE + " " + words(75, 6),
    "ab " * 300,
    words(6000, 7),
    "éÀß <|endoftext|> it's 12  345 日本語 😀 a b",
    "x" * 5000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, None, 0, "clash", 5) for i, t in enumerate(TEXTS)]
    rows += [rows[0], (None, "no id " + words(20, 8), "en", "s", 1, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, 0) for i in (0, 3, 9, 10, 12)] + [(11, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(units.tokenizer_path(name))


def test_byte_pairs_equal_the_library(docs, empty):
    library = tokenizer(byte_pair.TOKENIZER)
    got = byte_pair.token_digests(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for row in got:
        text = (TEXTS[row.doc_id] or "") if row.doc_id is not None else "no id " + words(20, 8)
        ids = library.encode(text, add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert byte_pair.encode_texts(empty).count() == 0
    assert {r.decoded for r in byte_pair.encode_texts(docs.filter("doc_id IN (4, 13)")).collect()} == {"", TEXTS[13]}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_units_equal_the_library(name):
    texts = [t or "" for t in TEXTS] + ["DON'T we'LL ﬁ İ ΣΑΣ ½²\x1c x", "a'b <|startoftext|>y"]
    want = [np.array(tokenizer(name).encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert units.UnitEncoder(units.tokenizer_path(name)).encode(texts) == want


def test_plain_words_are_learned_from_the_model_as_they_come():
    texts = ["Été naïve, straße! x1y22 ÿÿ. " + words(30, 5), "(a) " + "".join(map(chr, range(0x28, 0x7F))), " \n"]
    texts += [f"a{chr(c)}b {chr(c)}" for c in [*range(0x21, 0x27), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7)]
    want = [np.array(tokenizer(packing.TOKENIZER).encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    encoder = units.UnitEncoder(units.tokenizer_path(packing.TOKENIZER))
    asked, tokenize = [], encoder.ask
    encoder.ask = lambda word: asked.append(word) or tokenize(word)
    encoder.tokenizer = None  # the rules before the model cost more than the model
    assert encoder.encode(texts) == want and encoder.encode(texts) == want
    assert len(asked) == len(set(asked))


def test_token_counts_fill_and_use_the_cache(spark, docs, empty):
    cache = common.new_path(spark, "test-cache")
    first = count_rows(token_counts.count_tokens(docs, cache))
    library = tokenizer(token_counts.TOKENIZER)
    assert all(r[2] == len(library.encode(TEXTS[r[0]] or "", add_special_tokens=False).ids) for r in first if r[0] is not None)
    stored = spark.read.parquet(cache)
    before = stored.count()
    assert before == stored.select("content").distinct().count()
    assert count_rows(token_counts.count_tokens(docs, cache)) == first
    assert spark.read.parquet(cache).count() == before
    assert token_counts.count_tokens(empty, cache).count() == 0
    other = token_counts.count_tokens(docs.filter("doc_id = 7"), cache, "piece_bpe_32k.model").first()
    assert other.n_tokens > 0 and spark.read.parquet(cache).count() == before + 1


def count_rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r))


def test_packing_is_gapless_and_whole(docs, empty):
    library = tokenizer(packing.TOKENIZER)
    rows = packing.pack_documents(docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), capacity=64).collect()
    for doc, text in enumerate(TEXTS):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        assert [r.start for r in own] == list(range(0, len(ids), 64))
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert packing.pack_documents(empty).count() == 0


def test_packing_plan_is_near_the_bound():
    made = random.Random(3)
    for capacity in (20, 100):
        histogram = {n: made.randint(0, 40) for n in range(1, capacity + 1)}
        fillings = packing.plan(histogram, capacity)
        used = {n: sum(f.lengths.count(n) * f.times for f in fillings) for n in histogram}
        assert used == histogram
        assert all(sum(f.lengths) <= capacity for f in fillings)
        bound = math.ceil(sum(n * k for n, k in histogram.items()) / capacity)
        assert sum(f.times for f in fillings) <= bound + max(1, bound // 50)


def test_packing_plan_beats_best_fit_or_equals_it():
    made = random.Random(5)
    lengths = made.sample(range(400, 1024), 300)
    histogram = dict.fromkeys(lengths, 0)
    for n in made.choices(lengths, k=59_458):
        histogram[n] += 1
    # Best-fit decreasing, piece by piece: the smallest room that still holds the piece.
    bins = np.zeros(2049, dtype=np.int64)
    for n in sorted(lengths, reverse=True):
        for _ in range(histogram[n]):
            fits = np.flatnonzero(bins[n:2048])
            room = n + int(fits[0]) if len(fits) else 2048
            bins[room] -= room < 2048
            bins[room - n] += 1
    fillings = packing.plan(histogram)
    assert {n: sum(f.lengths.count(n) * f.times for f in fillings) for n in histogram} == histogram
    assert all(sum(f.lengths) <= 2048 for f in fillings)
    assert sum(f.times for f in fillings) <= bins.sum()


def test_packing_plan_makes_only_the_branches_it_visits(monkeypatch):
    made, real = [], packing.Filling
    monkeypatch.setattr(packing, "Filling", lambda *of: made.append(of) or real(*of))
    rng = random.Random(8)
    packing.plan({x: 1 + rng.randrange(3) for x in rng.sample(range(300, 400), 90)}, 2048, nodes=60)
    assert len(made) < 400  # 930 if every branch is made ahead


def test_packing_plan_looks_for_no_fillings_that_it_never_tries(monkeypatch):
    made = random.Random(1)
    histogram = collections.Counter(min(1024, 1 + int(made.expovariate(1 / 300))) for _ in range(4_000))
    judged, plain = [], packing._dominated
    monkeypatch.setattr(packing, "_dominated", lambda *of: judged.append(1) or plain(*of))
    fillings = packing.plan(histogram, 1024)
    # One sequence fewer than best fit: the first descent ends at the bound.
    assert sum(f.times for f in fillings) == math.ceil(sum(n * k for n, k in histogram.items()) / 1024)
    assert sum(n * f.times for f in fillings for n in f.lengths) == sum(n * k for n, k in histogram.items())
    assert 0 < len(judged) < 1_000  # 533,990 if every branching looks for all of its fillings


def test_packing_plan_is_the_best_of_small_histograms():
    for seed in range(40):
        made = random.Random(seed)
        histogram = {n: made.randint(1, 2) for n in made.sample(range(2, 10), 5)}
        best = _fewest(tuple(sorted(n for n, k in histogram.items() for _ in range(k))), 12)
        assert sum(f.times for f in packing.plan(histogram, 12)) == best


def _fewest(pieces, capacity):
    """Sequences of the best plan, by trying every way to place the pieces, largest first."""
    least = len(pieces)

    def place(at, rooms):
        nonlocal least
        if len(rooms) >= least:
            return
        if at < 0:
            least = len(rooms)
            return
        for room in {r for r in rooms if r >= pieces[at]}:
            rest = list(rooms)
            rest.remove(room)
            place(at - 1, [*rest, room - pieces[at]])
        place(at - 1, [*rooms, capacity - pieces[at]])

    place(len(pieces) - 1, [])
    return least


def test_shards_are_near_equal(spark, docs, empty, sf_dir):
    documents = common.table(spark, sf_dir, "documents")
    rows = sharding.op10_kd_shards(spark, sf_dir).collect()
    assert len(rows) == documents.count()
    sizes = {s: 0 for s in range(40)}
    for r in rows:
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in rows)
    for shard in sizes:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    few = sharding.kd_shards(docs, 3).collect()
    assert len(few) == len(TEXTS) + 2 and {r.shard for r in few} <= {0, 1, 2}
    assert {r.text_crc32 for r in few if r.doc_id == 0} == {zlib.crc32(TEXTS[0].encode())}
    assert sharding.kd_shards(empty).count() == 0
    assert len({r.shard for r in sharding.kd_shards(docs, None, target_bytes=30_000).collect()}) > 1


def test_shards_keep_equal_texts_together(spark):
    """One text with a third of the bytes, groups of many sizes, one long text, repeated rows, a null id, clashing names."""
    made = random.Random(17)
    rows = [(i, words(200, 1), "en", "hot", 1, 1) for i in range(700)]
    for g in range(60):
        rows += [(1000 * (g + 1) + i, words(made.randint(5, 300), 700 + g), made.choice(["en", "de"]), f"s{g % 7}", 1, 1) for i in range(made.randint(1, 30))]
    rows += [(90_000 + i, words(made.randint(1, 200), 900 + i), None, f"s{i % 5}", 1, 1) for i in range(900)]
    rows += [(99_000, words(3000, 5), "en", None, 1, 1), (None, None, None, None, 1, 1), (99_001, "", "en", "s1", 1, 1), rows[0], rows[0]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard int, size int")
    got = sharding.kd_shards(frame, 12).collect()
    assert sorted((r.doc_id or -1, r["size"]) for r in got) == sorted((r[0] or -1, len((r[1] or "").encode()) + 16) for r in rows)
    loads, spread, bytes_of = {s: 0 for s in range(12)}, {}, {}
    for r in got:
        key = (r.text_crc32, r["size"])
        loads[r.shard] += r["size"]
        spread.setdefault(key, set()).add(r.shard)
        bytes_of[key] = bytes_of.get(key, 0) + r["size"]
    leaf = sum(loads.values()) / 12
    for key, shards in spread.items():
        assert len(shards) <= max(1, math.ceil(1.15 * bytes_of[key] / leaf))
    assert max(loads.values()) < 1.1 * leaf and min(loads.values()) > 0.9 * leaf
    assert len({r.shard for r in got if r.doc_id == 0}) == 1


def test_rules_judge_form(docs, empty, spark):
    junk = [(100 + i, " ".join(w + "***" for w in words(80, i).split()), "en", "s", 0, "c", 0) for i in range(8)]
    good = [(200 + i, words(80, 50 + i) + ".", "en", "s", 0, "c", 0) for i in range(60)]
    rows = spark.createDataFrame(junk + good, SCHEMA).unionByName(docs)
    kept = rules.keep_good(rows, 1)
    assert kept.columns == rows.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {200 + i for i in range(60)} <= ids and not ids & {100 + i for i in range(8)}
    assert 4 not in ids and 0 in ids  # a null text has no words
    assert rules.keep_good(empty).count() == 0


def test_repeated_words_by_brute_force(spark):
    made = random.Random(9)
    texts = [" ".join(made.choices("abcd", k=made.randint(0, 60))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", rules.measures(common.text_of()).alias("m")).collect()
    for r in rows:
        own = texts[r.i].split()
        windows = [tuple(own[j : j + 3]) for j in range(len(own) - 2)]
        inside = {j + k for j, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        assert (r.m.n_words, r.m.n_repeat_words) == (len(own), len(inside))


def test_kneser_ney_sums_to_one_and_rejects_symbols(spark, docs, labels, empty):
    counts = kneser_ney.gram_counts(docs.filter("doc_id IN (0, 9, 12)"))
    table = 2.0 ** -kneser_ney.cost_table(kneser_ney.probabilities(counts)).astype(float)
    by_context = table.reshape(-1, kneser_ney.CLASSES).sum(axis=1)
    assert np.allclose(by_context, 1, atol=1e-3)
    odd = spark.createDataFrame([(50, "#*$%&|<> " * 200, "en", "s", 0, "c", 0)], SCHEMA).unionByName(docs)
    kept = kneser_ney.keep_trusted_like(odd, labels)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and 50 not in ids and {0, 3, 4, 5, 9} <= set(ids) and ids.count(0) == 2
    assert kneser_ney.keep_trusted_like(empty, labels).count() == 0
    assert kneser_ney.keep_trusted_like(docs, labels.filter("quality = 5")).count() == docs.count()


def cyrillic(n, seed, alphabet):
    made = random.Random(seed)
    return " ".join("".join(made.choices(alphabet, k=made.randint(1, 3))) for _ in range(n))


def test_kneser_ney_tells_letters_of_other_scripts(spark):
    syllables = ["ко", "ро", "ва", "на", "сто", "ли", "це", "мо"]
    clean = [(i, cyrillic(300, i, syllables), "ru") for i in range(60)]
    letters = [(100 + i, cyrillic(300, 100 + i, [a + b for a in "жщъыэюф" for b in "шчхгбяй"]), "ru") for i in range(5)]
    rows = spark.createDataFrame(clean + letters, "doc_id long, text string, lang string")
    good = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in kneser_ney.classified(rows, good).filter("kept").collect()}
    assert not any(i >= 100 for i in kept) and len(kept) >= 57


def test_kneser_ney_rare_language_beside_a_hot_one(spark):
    rows = [(i, cyrillic(60, i, ["ko", "ro", "va", "li", "sto"]), "en") for i in range(400)]
    rows += [(1000 + i, cyrillic(60, i, ["ко", "ро", "ва", "ли", "сто"]), "ru") for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    good = spark.createDataFrame([(r[0], 1, 0) for r in rows], "doc_id long, quality int, toxic int")
    sample = {r.doc_id for r in kneser_ney.training_sample(frame, 40).collect()}
    assert {1000 + i for i in range(12)} <= sample and 5 <= len(sample) - 12 <= 45
    got = kneser_ney.classified(frame, good, most=40).collect()
    assert all(r.kept for r in got if r.lang == "ru") and len({r.threshold for r in got}) == 2
    # The quantile is over all 400, so at most its share of them is above the limit without margin.
    assert sum(r.kept for r in got if r.lang == "en") >= 398


def brute_components(texts, n, percent):
    sets = {}
    for i, t in texts.items():
        own = (t or "").encode().lower().split()
        sets[i] = {tuple(own[j : j + n]) for j in range(len(own) - n + 1)} if len(own) >= n else ({tuple(own)} if own else set())
    group = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        common_n = len(sets[a] & sets[b])
        if common_n and 100 * common_n >= percent * len(sets[a] | sets[b]):
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = {k: new if v == old else v for k, v in group.items()}
    return {i: (len(s), group[i]) for i, s in sets.items()}


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_shingle_join_loses_no_link(spark, docs, empty, n, percent):
    made = random.Random(n)
    texts = {i: t for i, t in enumerate(TEXTS)}
    base = [words(made.randint(5, 120), 20 + i).split() for i in range(12)]
    for i in range(150):  # chains of edits, so that a copy links with its neighbours alone
        own = base[i % 12]
        own[made.randrange(len(own))] = "w" + str(i)
        texts[100 + i] = " ".join(own)
    rows = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.near_duplicates(rows, n, percent).collect()}
    assert got == brute_components(texts, n, percent)


def test_one_of_each_keeps_columns_and_lone_rows(docs, empty):
    kept = shingle_join.one_of_each(docs, 5, 80)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and ids.count(0) == 1 and not {1, 2, 3, 8} & set(ids) and {4, 5, 6, 7, None} <= set(ids)
    assert shingle_join.one_of_each(empty, 5, 80).count() == 0


def test_one_of_each_judges_two_texts_of_one_id_apart(spark):
    a, b = words(100, 61), words(100, 62)
    rows = spark.createDataFrame([(5, a), (7, a + " more"), (3, b), (5, b + " more"), (5, a)], "doc_id long, text string")
    kept = shingle_join.one_of_each(rows, 5, 80).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(3, b), (5, a)]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (100, 99)], "a long, b long")
    got = {r.node: r.component for r in common.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 99: 99, 100: 99}


def test_components_end_with_the_round_that_makes_stars(spark, monkeypatch):
    written = []
    plain = common.stored
    monkeypatch.setattr(common, "stored", lambda df, label: written.append(label) or plain(df, label))
    links = spark.createDataFrame([(1, 5), (1, 6), (2, 9), (9, 2)], "a long, b long")
    assert {r.node: r.component for r in common.components(links).collect()} == {1: 1, 5: 1, 6: 1, 2: 2, 9: 2}
    assert written == ["links"]


def test_chunk_dedup_takes_the_passage_once(docs, empty):
    done = chunk_dedup.without_repeats(docs)
    rows = {r.doc_id: r for r in done.collect()}
    assert done.columns == [*docs.columns, "_repeats"]
    assert rows[9].text == TEXTS[9] and rows[9]._repeats.n_repeated_words == 0
    assert rows[10]._repeats.first_docs == [9] and rows[10]._repeats.n_repeated_words >= 45
    assert rows[10].text.split()[:60] == TEXTS[10].split()[:60] and rows[10].text.split()[-70:] == TEXTS[10].split()[-70:]
    assert rows[4].text is None and rows[11].text == TEXTS[11] and rows[12].text == TEXTS[12]
    assert chunk_dedup.without_repeats(empty).count() == 0


def chunked(text):
    """The chunks of a text as tuples of words, by the definition: one byte and one word at a time."""
    made, now, h = [], [], 0
    for word in text.lower().encode().split():
        for byte in (b" " if now or made else b"") + word:
            h = (2 * h + int(chunk_dedup._GEAR[byte])) % 2**32
        now.append(word)
        if h >> 9 & (1 << chunk_dedup.CUT_BITS) - 1 == 0 or len(now) == chunk_dedup.MOST_WORDS:
            made.append(tuple(now))
            now = []
    return [*made, tuple(now)] if now else made


def test_chunk_dedup_by_brute_force(spark):
    """Passages shifted by insertions, at the ends of texts, beside copies, nulls and a name that clashes."""
    made = random.Random(21)
    passages = [words(made.randint(51, 120), 400 + i) for i in range(6)]
    texts = [None, "", "one two", "Ab " * 90, passages[0] + " " + words(30, 1), words(40, 2) + "\n\n" + passages[0].upper()]
    for i in range(60):
        parts = [words(made.randint(0, 40), 500 + 3 * i + k) for k in range(2)]
        parts.insert(made.randint(0, 2), made.choice(passages))
        texts.append(" \t".join(parts))
    texts += texts[10:14]
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in chunk_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string, _repeats string")).collect()}
    assert sorted(got) == list(range(len(texts)))
    seen, taken = {}, 0
    for i, text in enumerate(texts):
        chunks, kept, run, gone = chunked(text or ""), [], [], 0
        for chunk in [*chunks, None]:
            if chunk is not None and seen.get(chunk, i) < i:
                run += chunk
                continue
            if len(run) < chunk_dedup.MIN_WORDS:
                kept += run
            else:
                gone += len(run)
            kept, run = kept + list(chunk or ()), []
        for chunk in chunks:
            seen.setdefault(chunk, i)
        assert got[i]._repeats.n_repeated_words == gone and (got[i].text is None) == (text is None)
        assert (got[i].text or "").lower().encode().split() == kept
        taken += gone > 0
    assert taken > 50


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(words(50, 1).encode(), dtype=np.uint8)
    h, want = 0, []
    for byte in data.tolist():
        h = (2 * h + int(chunk_dedup._GEAR[byte])) % 2**32
        want.append(h)
    assert chunk_dedup.gear(data).tolist() == want


def test_collisions_recall_and_order(spark, sf_dir):
    made = np.random.default_rng(1)
    vectors = made.standard_normal((1500, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, vectors[0].tolist()), (5004, [None] * 16), (5006, [])]
    usable = collisions.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert usable.count() == 1501
    found = {}
    for r in collisions.nearest(usable.filter("vec_id % 100 = 0"), usable, 10).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    everything = np.vstack([vectors, vectors[:1]])
    ids = np.array([*range(1500), 5003])
    right = 0
    for query, got in found.items():
        score = everything @ vectors[query]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != query][:10]
        assert [rank for rank, _, _ in sorted(got)] == list(range(1, 11))
        assert all(math.isclose(s, float(everything[ids.tolist().index(v)] @ vectors[query])) for _, v, s in got)
        right += len({v for _, v, _ in got} & set(ids[order]))
    assert right >= 0.9 * 10 * len(found) and len(found) == 15
    assert collisions.nearest(usable.filter("vec_id < 0"), usable).count() == 0


def test_context_tree_predictions_are_a_distribution():
    grams, lengths = context_tree._grams([b"abab", b"abc", b"b", b""])
    counts = np.repeat([5, 2, 1, 3], lengths)
    levels = context_tree._levels(grams, counts, 0)
    for context in (b"abab ", b"zzzzz", b"    a"):
        every = np.array([int.from_bytes(context[-context_tree.DEPTH :] + bytes([x]), "big") for x in range(256)], dtype=np.uint64)
        assert math.isclose((2 ** context_tree._costs(every, levels)).sum(), 1, rel_tol=1e-9)
    assert np.allclose(context_tree._log_gamma(np.array([0.5, 1.0, 3.5, 1e9])), [math.lgamma(x) for x in (0.5, 1.0, 3.5, 1e9)])


def test_context_tree_scores_by_brute_force(docs, empty):
    got = context_tree.scores(docs).collect()
    assert len(got) == len(TEXTS) + 2
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    out = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 1
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    train = [w for i, t in rows if not out(i) for w in tokens(t)]
    seen = {w: train.count(w) for w in set(train)}
    grams, lengths = context_tree._grams(list(seen))
    every, place = np.unique(grams, return_inverse=True)
    levels = context_tree._levels(every, np.bincount(place, np.repeat(list(seen.values()), lengths)), 0)
    for r in got:
        text = TEXTS[r.doc_id] if r.doc_id is not None else rows[-1][1]
        own = tokens(text)
        base = sum(math.log10((seen.get(w, 0) + 0.5) / (len(train) + 0.5 * (len(seen) + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(r.doc_id), len(own), sum(w in seen for w in own), len(train))
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, context_tree._costs(context_tree._grams(own)[0], levels).sum() * math.log10(2), rel_tol=1e-9)
    assert context_tree.scores(empty).count() == 0


def test_words_meet_the_vocabulary_unsorted(docs):
    plan = context_tree.scores(docs, across_words=True)._jdf.queryExecution().toString()
    assert "ShuffledHashJoin [word" in plan and "SortMergeJoin [word" not in plan


def test_summed_grams_are_merged_in_little_memory():
    made = np.random.default_rng(5)
    held, want = [], {}
    for _ in range(3):
        grams = np.unique(made.integers(0, 400_000, 200_000)).astype(np.uint64)
        n = [made.integers(0, 9, len(grams)).astype(np.int32) for _ in range(2)]
        held.append((grams, n))
        for g, a, b in zip(grams.tolist(), *map(np.ndarray.tolist, n), strict=True):
            old = want.get(g, (0, 0))
            want[g] = (old[0] + a, old[1] + b)
    size = sum(g.nbytes + sum(own.nbytes for own in n) for g, n in held)
    del grams, n
    tracemalloc.start()
    got, sums = n_grams._merged(held, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not held and dict(zip(got.tolist(), zip(*map(np.ndarray.tolist, sums), strict=True), strict=True)) == want
    assert peak <= 2.6 * size and sums[0].dtype == np.int64


def test_every_operator_is_registered():
    assert {name.partition("_")[0] for name in registry.QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_a_large_group_of_near_copies_gives_few_pairs(spark, monkeypatch):
    made = random.Random(17)
    base = words(120, 70).split()
    texts = {}
    for i in range(400):  # each two words from the base, so that most pairs link but no lead links with all
        own = list(base)
        for at in made.sample(range(120), 2):
            own[at] = f"x{i}y{at}"
        texts[i] = " ".join(own)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    compared = []
    plain = shingle_join._verified

    def counted(pairs, sets, percent):
        compared.append(pairs.count())
        return plain(pairs, sets, percent)

    monkeypatch.setattr(shingle_join, "_verified", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.near_duplicates(rows, 4, 85).collect()}
    assert got == brute_components(texts, 4, 85)
    # Far fewer than the 79,800 pairs of the group.
    assert sum(compared) <= 12 * len(texts)


def test_search_gives_a_pair_that_shares_many_buckets_few_times(spark, monkeypatch):
    base = words(390, 71).split()
    texts = {}
    for i in range(16):  # near misses: each two share most groups, have 84 per cent of their shingles in common and no link
        own = list(base)
        for k in range(4):
            own[24 * i + 6 * k] = f"x{i}y{k}"
        texts[i] = " ".join(own)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    given = spark.sparkContext.accumulator(0)
    plain = shingle_join._search

    def counted(rows, percent, forest):
        found = plain(rows, percent, forest)
        given.add(len(found))
        return found

    monkeypatch.setattr(shingle_join, "_search", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.near_duplicates(rows, 4, 85).collect()}
    assert got == brute_components(texts, 4, 85)
    # Of the group's 120 pairs.
    assert 0 < given.value <= 120


def test_search_takes_a_node_once_from_buckets_of_one_first_node(spark, monkeypatch):
    base = words(390, 71).split()
    texts = {}
    for i in range(16):  # near misses, each two of which share most groups; and a copy of each with two other words
        own = list(base)
        for k in range(4):
            own[24 * i + 6 * k] = f"x{i}y{k}"
        texts[i] = " ".join(own)
        own[5 + 24 * i] = own[17 + 24 * i] = "z"
        texts[16 + i] = " ".join(own)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_components(texts, 4, 85)
    given = spark.sparkContext.accumulator(0)
    plain = shingle_join._search

    def counted(rows, percent, forest):
        given.add(len(rows))
        return plain(rows, percent, forest)

    monkeypatch.setattr(shingle_join, "_search", counted)
    for block in (shingle_join.BLOCK, 5):
        monkeypatch.setattr(shingle_join, "BLOCK", block)
        before = given.value
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.near_duplicates(rows, 4, 85).collect()}
        assert got == want
        if block > len(texts):  # in two searches: each node with the first ones of its buckets, not with every signature
            assert 0 < given.value - before <= len(texts) * (len(texts) + 1)


def test_shared_signatures_have_every_node_of_several(spark):
    made = random.Random(29)
    base = [words(60, 80 + i).split() for i in range(4)]
    texts = [" ".join(w if made.random() < 0.97 else f"y{i}" for w in base[i % 4]) for i in range(40)]
    texts += texts[:10] + [None, ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    want = {}
    for s in shingle_join.shingle_sets([t or "" for t in texts], 4):
        for signature in shingle_join.signatures(s, 85).view(np.int64).tolist() if len(s) else []:
            want.setdefault(signature, set()).add(shingle_join.node_of(s))
    got, leads = {}, {}
    for r in shingle_join._shared(rows.select(common.text_of().alias("text")), 4, 85).collect():
        got.setdefault(r.signature, set()).add(r.node)
        leads.setdefault(r.signature, set()).add((r.lead, r.node))
    assert got == {k: v for k, v in want.items() if len(v) > 1}
    # Every node but the first of all names another one, in chains that end at the first.
    for signature, pairs in leads.items():
        assert {n for lead, n in pairs if lead != n} | {min(want[signature])} == want[signature]


def test_points_are_packed_whole():
    point = np.zeros(shingle_join.COORDINATES, dtype=np.int32)
    for most in (0, 255, 256, 70_000):
        point[7] = most
        assert shingle_join.unpacked(shingle_join.packed(point)).tolist() == point.tolist()


def test_search_leaves_a_forest_or_every_pair():
    import pandas as pd

    made = np.random.default_rng(2)
    point = made.integers(0, 4, (90, shingle_join.COORDINATES))
    point[30:60] = point[:30]
    point[30:60, :3] += 1
    rows = [(s, n, n % 45, 0, 0, 0, point[n].tolist()) for s, members in ((1, range(90)), (2, range(0, 90, 4)), (3, range(20, 50))) for n in members]
    frame = pd.DataFrame(rows, columns=["signature", "node", "component", "block", "low", "high", "point"])
    every = set(map(tuple, shingle_join._search(frame, 85, False).to_numpy().tolist()))
    total = point.sum(axis=1)
    want = {
        (a, b)
        for a, b in itertools.combinations(range(90), 2)
        if a % 45 != b % 45 and 100 * min(total[a], total[b]) >= 85 * max(total[a], total[b]) and 185 * np.minimum(point[a], point[b]).sum() >= 85 * (total[a] + total[b])
    }
    assert every == want
    forest = set(map(tuple, shingle_join._search(frame, 85, True).to_numpy().tolist()))
    assert forest <= every and len(forest) < 45
    groups = []
    for pairs in (forest, every):
        left = {i: i for i in range(45)}
        for a, b in pairs:
            old, new = left[a % 45], left[b % 45]
            left = {k: new if v == old else v for k, v in left.items()}
        groups.append(len(set(left.values())))
    assert groups[0] == groups[1]


def test_search_asks_only_for_nodes_outside_the_largest_component(monkeypatch):
    made = random.Random(9)
    base = np.array([made.choice((0, 0, 1, 2)) for _ in range(256)])
    points = [base + np.bincount([made.randrange(256) for _ in range(4)], minlength=256) for _ in range(300)]
    rows = []
    for high in (0, 1):  # one block with itself, and two blocks
        for i, p in enumerate(points):
            own = {"signature": 5 + high, "node": i, "component": 0 if i % 50 else i, "block": i % 2 * high, "low": 0, "high": high}
            rows.append(own | {"point": p.astype(np.uint8)})
    asked = []
    plain = shingle_join._tree_pairs
    monkeypatch.setattr(shingle_join, "_tree_pairs", lambda point, total, asks, *rest: asked.extend(asks) or plain(point, total, asks, *rest))
    frame = shingle_join.pd.DataFrame(rows)
    got = set(map(tuple, shingle_join._search(frame, 85, False).to_numpy().tolist()))
    part = frame["component"].tolist()[:300]

    def near(a, b):
        overlap, both = np.minimum(points[a], points[b]).sum(), points[a].sum() + points[b].sum()
        return overlap * 185 >= 85 * both and 100 * min(points[a].sum(), points[b].sum()) >= 85 * max(points[a].sum(), points[b].sum())

    assert got == {(a, b) for a, b in itertools.combinations(range(300), 2) if part[a] != part[b] and near(a, b)} and got
    # Five nodes are outside the component of the other 295.
    assert len(asked) <= 2 * 5 and {part[i] for i in asked} == {50, 100, 150, 200, 250}


def test_context_tree_reads_across_words_by_brute_force(docs, empty):
    whole = lambda t: b"".join(w + b" " for w in (t or "").encode().lower().split()) + b"\n"
    out = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 1

    def grams(text):
        padded = b" " * context_tree.DEPTH + text
        return np.array([int.from_bytes(padded[i : i + context_tree.DEPTH + 1], "big") for i in range(len(text))], dtype=np.uint64)

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    every, n = np.unique(np.concatenate([grams(whole(t)) for i, t in rows if not out(i)]), return_counts=True)
    levels = context_tree._levels(every, n, 0)
    base = lambda found: {(r.doc_id, round(r.base_score, 6), r.n_tokens, r.n_known) for r in found}
    alone = base(context_tree.scores(docs).collect())
    # Sent to every task, and joined.
    for sent in (10**6, 0):
        got = context_tree.scores(docs, across_words=True, sent=sent).collect()
        assert len(got) == len(rows) and base(got) == alone
        for r in got:
            text = TEXTS[r.doc_id] if r.doc_id is not None else rows[-1][1]
            assert math.isclose(r.score, context_tree._costs(grams(whole(text)), levels).sum() * math.log10(2), rel_tol=1e-9)
    assert context_tree.scores(empty, across_words=True, sent=0).count() == 0


def test_context_tree_inverts_in_the_worker_that_scores(docs):
    source = docs.selectExpr("doc_id", "doc_id % 2 = 0 AS held", "cast(coalesce(text, '') AS binary) AS text")
    grams = docs.sparkSession.createDataFrame(
        [(int(g), 0.5) for g in np.unique(context_tree._cut([(t or "").encode() for t in [*TEXTS, *(r.text for r in docs.collect())]])[0]).astype(np.int64)], "gram long, bits double"
    )
    source = source.withColumn("held", source.held & source.held.isNotNull())
    made = context_tree.n_grams.sums(source, context_tree._cut, grams, ["bits"], then=(context_tree._inverted, context_tree.CHUNKS))
    assert made._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    rows = made.collect()
    listed = {r.chunk: r for r in rows if r.word is None}
    got, train, want, trained = {}, {}, {}, {}
    for r in rows:
        if r.word is not None:
            train[bytes(r.word)] = train.get(bytes(r.word), 0) + r.train
            assert r.places == sorted(set(r.places))
            for place, n in zip(r.places, r.counts, strict=True):
                doc = None if listed[r.chunk].places[place] else listed[r.chunk].ids[place]
                got[doc, bytes(r.word)] = got.get((doc, bytes(r.word)), 0) + n
    for doc, text, held in source.select("doc_id", "text", "held").collect():
        for word in [*bytes(text).lower().split(), b""]:
            want[doc, word] = want.get((doc, word), 0) + 1
            trained[word] = trained.get(word, 0) + (not held)
    assert got == want and train == trained


def test_context_tree_keeps_postings_as_short_numbers():
    made = random.Random(5)
    places = [sorted(made.sample(range(1 << made.choice((6, 16, 28))), made.randint(1, 40))) for _ in range(200)] + [[100]]
    counts = [[made.randint(1, 1 << made.choice((1, 9, 30))) for _ in own] for own in places[:-1]] + [[1]]
    n = len(places)
    kinds = context_tree.pa.schema([(name, t) for name, t in zip(context_tree.NAMES, _arrow_types(), strict=True)])
    rows = context_tree.pa.RecordBatch.from_pydict(
        dict(zip(context_tree.NAMES, [[7] * n, [b"w"] * n, [1] * n, places, counts, [None] * n, [None] * n, [None] * n], strict=True)), kinds
    )
    marks = context_tree.pa.RecordBatch.from_pydict(dict(zip(context_tree.NAMES, [[7], [None], [None], [[0, 1, 0]], [None], [[1, 0, 3]], [[True] * 3], [[0.5] * 3]], strict=True)), kinds)
    packed, listed = context_tree._packed(iter([rows, marks]))
    for start in (0, 7):
        lengths, place, times = context_tree._unpacked(packed["postings"].slice(start))
        assert lengths.tolist() == [len(own) for own in places[start:]]
        assert place.tolist() == sum(places[start:], []) and times.tolist() == sum(counts[start:], [])
    assert packed["postings"][-1].as_py() == bytes([100, 1]) and listed["postings"][0].as_py() == bytes([0, 1, 0])


def _arrow_types():
    pa = context_tree.pa
    return [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.float64())]


def test_context_tree_query_tells_the_order_of_words(spark, tmp_path):
    made = random.Random(4)
    rows = [(i, " ".join(["abc def", "ghi jkl"][made.random() < 0.5] for _ in range(40))) for i in range(60)]
    rows += [(100, "abc def " * 20), (101, "abc jkl " * 20), (102, "def abc " * 20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    score = {r.doc_id: r.score for r in registry.QUERIES["op7_context_tree"](spark, str(tmp_path)).collect()}
    # The same words in an order that training has not.
    assert score[100] > score[101] + 5


def test_kneser_ney_marks_halves_without_a_shuffle_of_texts(spark, monkeypatch):
    ids = [0, 1, 63, 64, 65, 127, 128, 10**15, -1, -64, -65, None]
    frame = spark.createDataFrame([(i, "x") for i in ids + ids[:2]], "doc_id long, text string")
    good = spark.createDataFrame([(i,) for i in ids[:-1:2]], "doc_id long")
    want = sorted((r.doc_id, r.half) for r in good.select("doc_id", kneser_ney.fold().alias("half")).collect())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for sent in (kneser_ney.SENT_IDS, 0):
            monkeypatch.setattr(kneser_ney, "SENT_IDS", sent)
            marked = kneser_ney.in_half(frame, good)
            assert ("SortMergeJoin" in marked._jdf.queryExecution().toString()) == (sent == 0)
            rows = marked.collect()
            assert len(rows) == len(ids) + 2
            assert sorted({(r.doc_id, r._fold) for r in rows if r._fold is not None}) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_kneser_ney_sums_each_order_once(spark, monkeypatch):
    grams = spark.createDataFrame([(int(g), int(1 + g % 3)) for g in np.random.default_rng(2).integers(0, 1 << 48, 300)], "gram long, n long")
    plans = []
    plain = kneser_ney.stored
    monkeypatch.setattr(kneser_ney, "stored", lambda df, label: plans.append((label, df._jdf.queryExecution().optimizedPlan().toString())) or plain(df, label))
    made = kneser_ney.probabilities(grams)
    assert [t.count() for t in made][-1] == grams.select("gram").distinct().count()
    assert [label for label, _ in plans] == ["kneser-ney-counts"] * 5 + ["kneser-ney"] * 6
    # No plan sums an order again that is stored: an order's counts are one aggregate, its probabilities one, by context.
    assert max(plan.count("Aggregate [") for _, plan in plans) == 1


def test_kneser_ney_trains_on_every_trusted_document(spark, monkeypatch):
    made = random.Random(3)
    rows = [(i, "".join(made.choices("abcd", k=60)), "en") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    good = spark.createDataFrame([(i, 1, 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int")
    trained = []
    real = kneser_ney.probabilities
    monkeypatch.setattr(kneser_ney, "probabilities", lambda counts: trained.append(counts) or real(counts))
    monkeypatch.setattr(kneser_ney, "TRUSTED_DOCS", 20, raising=False)
    got = {r.doc_id: r for r in kneser_ney.classified(frame, good).collect()}
    assert sum(c.agg({"n": "sum"}).first()[0] for c in trained) == 150 * 61
    # Joined tables give what sent ones give.
    joined = kneser_ney.classified(frame, good, sent=0).collect()
    assert len(joined) == 300 and all(math.isclose(r.perplexity, got[r.doc_id].perplexity, rel_tol=1e-9) for r in joined)
    # The two models' bits for one text, by the models' own tables.
    trained = trained[:2]
    tables = [kneser_ney.seen_costs(real(c)) for c in trained]
    grams, starts, lengths = kneser_ney._grams([rows[1][1]])
    bits = [kneser_ney.gram_bits(grams, own)[starts[0] : starts[0] + lengths[0]].sum() for own in tables]
    scored = kneser_ney.sums(frame.filter("doc_id = 1"), kneser_ney._cut, kneser_ney.gram_costs(kneser_ney.gram_counts(frame), [real(c) for c in trained]), ["b0", "b1"]).first()
    assert np.allclose(bits, [scored.b0, scored.b1], rtol=1e-5)
