import math

import duckdb
import numpy as np
import pytest

from fiscalis.llm import vectors as V
from fiscalis.llm.hardneg import SQL_OP13, BallTree, NegativeParams, hard_negatives, op13_hard_negatives
from fiscalis.llm.topk import SQL_OP11, TopKParams, exact_topk, op11_exact_topk

SCHEMA = "VEC_id string, vec_id long, embedding array<double>, label int, n long, h string"


def table(spark, rows):
    return spark.createDataFrame([("x", i, v, y, 5, "z") for i, v, y in rows], SCHEMA)


def whole(rows, scale, labels):
    out = []
    for i, v, y in rows:
        if v is None or (labels and y is None) or any(x is None or not math.isfinite(x) or not math.isfinite(scale * x) for x in v):
            continue
        out.append((i, [math.floor(scale * x) for x in v], y))
    return out


def product(a, b):
    return max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b, strict=False))))


def order(score, i):
    return (-score, i is None, i or 0)


def brute_topk(rows, every, k, scale):
    use = whole(rows, scale, False)
    out = []
    for a, (i, v, _) in enumerate(use):
        if i is not None and i % every == 0:
            found = sorted([(product(v, w), j) for b, (j, w, _) in enumerate(use) if b != a], key=lambda x: order(*x))[:k]
            out += [(i, r + 1, j, s) for r, (s, j) in enumerate(found)]
    return out


def brute_negatives(rows, every, p):
    use = whole(rows, p.scale, True)
    out = []
    for a, (i, v, y) in enumerate(use):
        if i is None or i % every:
            continue
        scored = sorted([(product(v, w), j, z) for b, (j, w, z) in enumerate(use) if b != a], key=lambda x: order(*x[:2]))
        for s, j, _ in [x for x in scored if x[2] == y][: p.positives]:
            fits = [x for x in scored if x[2] != y and p.low * s <= 100 * x[0] <= p.high * s][: p.negatives]
            out += [(i, j, r + 1, n, s, t) for r, (t, n, _) in enumerate(fits)]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def same(df, want):
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(want, key=key)


def odd_rows(seed, n=260, dim=5, spread=3):
    """Coarse values, so that ties abound; repeated rows, repeated ids, nulls, ragged and useless vectors."""
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) / 2 for x in rng.integers(-spread, spread + 1, dim)], int(rng.integers(0, 4))) for i in range(n)]
    rows += [rows[0]] * 25 + [rows[10]] * 3 + [(20, rows[21][1], 1), (20, rows[22][1], 2), (None, rows[3][1], 1), (None, rows[4][1], 2)]
    rows += [(1000, None, 1), (1010, [None, 1.0], 1), (1020, [float("nan")] * dim, 1), (1030, [float("inf")] + [0.0] * 4, 2), (1040, [], 1), (1050, [1.0, 2.0], None)]
    return rows + [(1060, [2.0, -1.0], 2), (1070, [0.5] * 9, 3), (-30, [1.5] * dim, 3)]


@pytest.mark.parametrize(("seed", "sizes"), [(1, (1 << 21, 1 << 22)), (2, (60, 90))])
def test_topk_equals_brute_force(spark, seed, sizes):
    rows, p = odd_rows(seed), TopKParams(7, 4.0, *sizes)
    use = V.usable_rows(table(spark, rows), p.scale)
    same(exact_topk(use.filter("id % 10 = 0"), use, p), brute_topk(rows, 10, 7, 4.0))


def test_topk_beyond_doubles_and_longs(spark):
    rows = [(i, [x, 1.0], 0) for i, x in enumerate([2.0**30 + 0.25, 2.0**30, -(2.0**30), 1e6, 1e30, -1e30, 3.0])]
    p = TopKParams(4, 1024.0, 8, 8)
    use = V.usable_rows(table(spark, rows), p.scale)
    same(exact_topk(use.filter("id % 2 = 0"), use, p), brute_topk(rows, 2, 4, 1024.0))


def test_topk_sparse_terms_and_empty_tables(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) if rng.random() < 0.1 else 0.0 for x in rng.normal(size=40)], 0) for i in range(120)]
    use = V.usable_rows(table(spark, rows), 64.0)
    same(exact_topk(use.filter("id % 7 = 0"), use, TopKParams(10, 64.0)), brute_topk(rows, 7, 10, 64.0))
    none = V.usable_rows(table(spark, []), 64.0)
    assert exact_topk(none, none).collect() == [] and exact_topk(none, use).collect() == []
    assert exact_topk(use.filter("id = 3"), none, without_self=False).collect() == []


@pytest.mark.parametrize(("seed", "sizes"), [(3, (1 << 20, 1 << 20)), (4, (80, 50))])
def test_negatives_equal_brute_force(spark, seed, sizes):
    rows, p = odd_rows(seed), NegativeParams(4, 3, 50, 95, 4.0, 3, *sizes)
    use = V.usable_rows(table(spark, rows), p.scale, label_col="label")
    same(hard_negatives(use.filter("id % 10 = 0"), use, p), brute_negatives(rows, 10, p))


def test_negatives_beyond_doubles_and_empty_tables(spark):
    rows = [(i, [x, 1.0 + i], i % 2) for i, x in enumerate([2.0**29 + 0.25, 2.0**29, 2.0**28.9, 2.0**28.5, 1e6, 1e25, -1e25, 3.0, 0.0])]
    p = NegativeParams(3, 2, 50, 95, 256.0, 2, 6, 6)
    use = V.usable_rows(table(spark, rows), p.scale, label_col="label")
    same(hard_negatives(use, use, p), brute_negatives(rows, 1, p))
    none = V.usable_rows(table(spark, []), p.scale, label_col="label")
    assert hard_negatives(none, none, p).collect() == [] and hard_negatives(none, use, p).collect() == []


def test_balls_bound_the_products_of_their_rows():
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 8)) * 100
    points = np.floor(centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 8)) * 5)
    tree, q = BallTree(points), np.floor(rng.normal(size=(40, 8)) * 100)
    norms = np.sqrt((q**2).sum(axis=1))
    assert sorted(tree.order.tolist()) == list(range(3000)) and len(tree.leaves) > 16
    pruned = 0
    for node, (a, b) in tree.nodes.items():
        low, high = tree.bounds(node, q, norms)
        scores = q @ tree.points[a:b].T
        assert (low <= scores.min(axis=1)).all() and (scores.max(axis=1) <= high).all()
        if node in tree.leaves:
            pruned += (high < np.sort(q @ points.T, axis=1)[:, -5]).sum()
    assert pruned > 0.5 * len(tree.leaves) * 40


@pytest.mark.parametrize(("query", "sql"), [(op11_exact_topk, SQL_OP11), (op13_hard_negatives, SQL_OP13)])
def test_queries_equal_sql(spark, query, sql):
    sf = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    df = query(spark, sf)
    want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()
    assert want
    same(df, want)
