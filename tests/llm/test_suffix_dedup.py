"""Repeated 200-byte strings: every step and the whole against brute force, odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from activity_mart.llm import suffix_dedup
from activity_mart.llm.registry import QUERIES


def text(n, seed):
    return "".join(random.Random(seed).choices("abcdefgh éß\n", k=n))


def brute(texts):
    """For each text its removed spans and what is left."""
    seen = Counter(x[i : i + 200] for x in texts for i in range(len(x) - 199))
    out = []
    for x in texts:
        gone = np.zeros(len(x) + 1, dtype=np.int64)
        for i in range(len(x) - 199):
            if seen[x[i : i + 200]] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        inside = np.r_[0, (np.cumsum(gone)[: len(x)] > 0).astype(int), 0]
        spans = list(zip(np.flatnonzero(np.diff(inside) == 1).tolist(), np.flatnonzero(np.diff(inside) == -1).tolist(), strict=True))
        out.append((spans, np.frombuffer(x, dtype=np.uint8)[inside[1:-1] == 0].tobytes()))
    return out


def planted():
    made = random.Random(13)
    shared = [text(n, 90 + n) for n in (199, 200, 201, 260, 272, 273, 400, 1500)]
    rows = [text(made.randint(0, 1500), i) for i in range(30)]
    for i, passage in enumerate(shared):
        for _ in range(3):  # at any shift against the period
            rows.append(text(made.randint(0, 300), made.random()) + passage + text(made.randint(0, 300), made.random()))
        rows.append(passage + passage if i % 2 else passage)
    rows += [rows[3], rows[3], rows[40][:230], "ab" * 300, "x" * 199, "x" * 200, "y" * 201, "z" * 5000, None, "", "short"]
    edited = list(text(3000, 5))
    for at in range(100, 3000, 320):
        edited[at] = "#"
    return [*rows, text(3000, 5), "".join(edited), text(20_000, 6) + shared[7][100:700], text(20_000, 6)[150:900]]


def check(spark, rows, schema="doc_id long, text string, row string, dedup long, key int, place string, open boolean"):
    frame = spark.createDataFrame([(i, t, "clash", None, 1, None, None) for i, t in rows], schema)
    got = suffix_dedup.without_repeats(frame).collect()
    assert not got or got[0].row.asDict().keys() == set(frame.columns)
    texts = [(t or "").encode() for _, t in rows]
    want = [(i, len(x), len(x) - len(kept), spans, kept) for (i, _), x, (spans, kept) in zip(rows, texts, brute(texts), strict=True)]
    found = [(r.row.doc_id, r.dedup.n_bytes, r.dedup.n_removed, [tuple(s) for s in r.dedup.spans], bytes(r.dedup.kept)) for r in got]
    order = lambda r: (r[0] is None, r[0] or 0, r[4], r[1])
    assert sorted(found, key=order) == sorted(want, key=order)


def test_equals_brute_force(spark):
    check(spark, list(enumerate(planted())))


def test_equals_brute_force_in_small_chunks_and_buckets(spark, monkeypatch):
    for name, value in (("CHUNK_BYTES", 6_000), ("BUCKET_KEYS", 300), ("LEAST_KEYS", 10)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = list(enumerate(planted()))
    check(spark, rows + rows[:5] + [(None, t) for _, t in rows[30:36]])


def test_few_rows(spark):
    check(spark, [])
    check(spark, [(1, None), (2, ""), (None, None)])
    check(spark, [(1, text(500, 1)), (2, text(500, 2))])
    check(spark, [(1, text(200, 1)), (1, text(200, 1))])


def test_long_texts_cross_stretches(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 1 << 8)
    suffix_dedup._digests.clear()
    data = np.frombuffer(text(3000, 8).encode(), dtype=np.uint8)
    places = np.sort(np.random.default_rng(1).choice(len(data) - 200, 900, replace=False))
    whole = suffix_dedup.digests(suffix_dedup.FIRST).at(np.r_[data, data], np.r_[places, places + len(data)], 200)
    suffix_dedup._digests.clear()
    assert (whole[:900] == whole[900:]).all() and len(set(whole.tolist())) == len({data[p : p + 200].tobytes() for p in places})


def test_cover_has_every_difference_once():
    cover, period = suffix_dedup.COVER, suffix_dedup.PERIOD
    differences = sorted((a - b) % period for a in cover for b in cover if a != b)
    assert differences == list(range(1, period))


@pytest.mark.parametrize("n", [1, 5, 169])
def test_sliding_least(n):
    x = np.random.default_rng(n).integers(0, 1000, 500).astype(np.uint64)
    assert suffix_dedup.sliding(x, n, np.minimum, 2000).tolist() == [int(x[i : i + n].min()) for i in range(len(x))]


def test_least_grams_count_places():
    data = ("ab" * 150 + text(400, 3)).encode()
    edges = np.array([0, 300, len(data)])
    gram, document, n = suffix_dedup.least_grams(np.frombuffer(data, dtype=np.uint8), edges)
    want = Counter()
    for d, (a, z) in enumerate(((0, 300), (300, len(data)))):
        own = data[a:z]
        digest = [int(g) for g in suffix_dedup.digests(suffix_dedup.FIRST).at(np.frombuffer(own, dtype=np.uint8), np.arange(len(own) - 63), 64)]
        chosen = {i + j for i in range(len(own) - 199) for w in [digest[i : i + 137]] for j, x in enumerate(w) if x == min(w)}
        want.update((digest[p], d) for p in chosen)
    assert dict(zip(zip(gram.tolist(), document.tolist(), strict=True), n.tolist(), strict=True)) == dict(want)


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    texts = [(r.text or "").encode() for r in rows]
    want = [
        (r.doc_id, len(x), len(x) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
        for r, x, (spans, kept) in zip(rows, texts, brute(texts), strict=True)
    ]
    got = QUERIES["op13_cover_suffixes"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
