"""Hard negatives: exact products against big integers, the search against brute force, odd rows."""

import duckdb
import numpy as np
import pytest

from activity_mart.llm import hard_negatives


@pytest.mark.parametrize(("dims", "size"), [(1, 3), (64, 1000), (64, 2**20), (3000, 300), (5, 2**29)])
def test_products_are_exact(dims, size):
    made = np.random.default_rng(dims)
    a, b = (made.integers(-size, size + 1, (n, dims)) for n in (17, 23))
    a[0], b[0] = size, size
    a[1] = -size
    longest = max(int(x @ x) for x in [*a.astype(object), *b.astype(object)])
    residues = hard_negatives.Residues(longest, dims)
    got = residues.product(residues.split(a), residues.split(b))
    assert (got == a.astype(object) @ b.T.astype(object)).all()


def brute(rows, positives, negatives, least, most, step):
    """Rows are ``(id, label, vector)`` in any order; the result as tuples, sorted."""
    dims = max((len(r[2]) for r in rows), default=0)
    q = [np.array([*map(int, r[2]), *[0] * (dims - len(r[2]))], dtype=object) for r in rows]
    want = []
    for a, (own, label, _) in enumerate(rows):
        if own % step:
            continue
        score = [int(x @ q[a]) if dims else 0 for x in q]
        order = sorted(range(len(rows)), key=lambda i: (-score[i], rows[i][0]))
        for p in [i for i in order if i != a and rows[i][1] == label][:positives]:
            fits = [i for i in order if rows[i][1] != label and least * score[p] <= 100 * score[i] <= most * score[p]]
            want += [(own, rows[p][0], k + 1, rows[i][0], score[p], score[i]) for k, i in enumerate(fits[:negatives])]
    return sorted(want)


def embeddings(seed, n, dims, spread):
    made = np.random.default_rng(seed)
    vectors = np.round(made.standard_normal((n, dims)) * spread) / 256
    return [(i, int(made.integers(0, 4)), v.tolist()) for i, v in enumerate(vectors)]


@pytest.mark.parametrize(("spread", "dims"), [(2, 3), (60, 8), (1, 2)])
def test_equals_brute_force_with_ties(spark, monkeypatch, spread, dims):
    # Blocks so small that every anchor block meets several row blocks.
    for name, value in (("BLOCK_ROWS", 150), ("BLOCK_ANCHORS", 20), ("ROWS_AT_ONCE", 32), ("ANCHORS_AT_ONCE", 7)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = embeddings(dims, 500, dims, spread)
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = hard_negatives.mine(hard_negatives.usable(frame), "vec_id % 10 = 0", 3, 4).collect()
    whole = [(i, label, np.floor(256 * np.array(v))) for i, label, v in rows]
    assert sorted(map(tuple, got)) == brute(whole, 3, 4, 30, 90, 10)


def test_odd_rows(spark):
    rows = embeddings(5, 60, 4, 40)
    rows += [rows[0], rows[3], (100, 1, [0.5, 0.25]), (101, 1, []), (-50, 2, [0.5, 0.1, 0.3, 0.2, 0.9])]
    odd = [(200, None, [1.0] * 4), (201, 1, None), (202, 1, [None] * 4), (203, 1, [float("nan")] * 4), (204, 2, [float("inf"), 0.0, 0.0, 0.0]), (None, 1, [1.0] * 4)]
    frame = spark.createDataFrame([(*r, 7, "clash") for r in rows + odd], "vec_id long, label int, embedding array<double>, row long, positives string")
    usable = hard_negatives.usable(frame)
    assert usable.count() == len(rows)
    got = hard_negatives.mine(usable, "vec_id % 10 = 0", 5, 10).collect()
    whole = [(i, label, np.floor(256 * np.array(v))) for i, label, v in rows]
    assert sorted(map(tuple, got)) == brute(whole, 5, 10, 30, 90, 10)
    assert hard_negatives.mine(usable.filter("vec_id % 10 <> 0"), "vec_id % 10 = 0").count() == 0
    assert hard_negatives.mine(usable.filter("vec_id > 1000")).count() == 0
    assert hard_negatives.mine(usable.filter("label = 1"), "vec_id % 10 = 0").count() == 0  # no other label
    with pytest.raises(ValueError, match="too long"):
        hard_negatives.mine(hard_negatives.usable(spark.createDataFrame([(0, 1, [2.0**40])], "vec_id long, label int, embedding array<double>")))


def test_query_equals_its_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = connection.execute(hard_negatives.oracle_sql())
    got = hard_negatives.op12_residue_negatives(spark, sf_dir)
    assert got.columns == [c[0] for c in want.description]
    rows = want.fetchall()
    assert rows and sorted(map(tuple, got.collect())) == sorted(rows)
