"""Fill-in-middle: SWAR arithmetic against plain loops, the query against its SQL, odd rows."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from activity_mart.llm import fill_middle
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, row string, fim long, h1 long, n_chars long"
MADE = random.Random(11)
LINES = "".join(MADE.choice(["é", "日本", "a", "\n", "\n", "😀", " x", "\r\n", "<", "P>"]) for _ in range(4000))
TEXTS = [None, "", "\n", "\n\n\n", "one line", "one\ntwo", "one\ntwo\n", LINES.replace("<P>", ""), "holds <P> it\nx", "<S>", "a<M", "x<\n<\n>M>\n", "long " * 200_000 + "\nend", "é\n" * 30]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", None, 5, None if i % 2 else 3) for i, t in enumerate(TEXTS)]
    rows += [rows[7], rows[7], (None, "no\nid\nat all", None, None, None, None), (-4, "ne\ngative", None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def plain(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("seed", "rate", "spm"), [(7, 100, 50), (1, 60, 0), (2, 100, 100), (3, 0, 50)])
def test_equals_plain_code_and_restores(docs, seed, rate, spm):
    made = fill_middle.fill_in_middle(docs, seed, rate, spm)
    got = made.select("row", "fim", fill_middle.restored(F.col("fim.form"), F.col("fim.text")).alias("back")).collect()
    assert len(got) == len(TEXTS) + 4
    assert got[0].row.asDict().keys() == set(docs.columns)
    for r in got:
        assert tuple(r.fim) == plain(r.row.doc_id, r.row.text, seed, rate, spm)
        assert r.back == (r.row.text or "")


def test_marks_are_found_by_number():
    made = np.random.default_rng(4)
    for n in (0, 1, 7, 8, 9, 64, 1000):
        data = made.choice([0x0A, 0x0B, 0x8A, 0x00, 0xFF, 0x41], n).astype(np.uint8)
        marks = fill_middle.Marks(fill_middle.equal_bytes(fill_middle.words_of(data), 0x0A))
        where = np.flatnonzero(data == 0x0A)
        assert marks.select(np.arange(len(where))).tolist() == where.tolist()
        assert marks.rank(np.arange(n + 1)).tolist() == [int((data[:i] == 0x0A).sum()) for i in range(n + 1)]
        inner = fill_middle.Marks(fill_middle.inner_bytes(fill_middle.words_of(data)))
        assert inner.rank(np.array([n])).tolist() == [int(((data & 0xC0) == 0x80).sum())]


def test_empty_table_and_query_columns(spark, docs):
    assert fill_middle.fill_in_middle(docs.filter("doc_id > 1000")).count() == 0


def test_query_equals_its_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = connection.execute(fill_middle.oracle_sql())
    names = [c[0] for c in want.description]
    got = fill_middle.op11_fill_middle(spark, sf_dir)
    assert got.columns == names
    rows = want.fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(rows) and len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
