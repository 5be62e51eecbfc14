"""The token-overlap join against its definition, and what it looks at."""

import random

import pytest
from pyspark.sql import functions as F

from fiscalis.operators import linking


def sets(n, seed, hot):
    rng = random.Random(seed)
    out = [(i, sorted({f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.randrange(0, 14))})) for i in range(n)]
    return [(i, [*s, "hot"] if i % 3 == 0 and hot else s) for i, s in out]


def brute(left, right, least, threshold):
    out = {}
    for i, a in left:
        for j, b in right:
            common = len(set(a) & set(b))
            if common >= max(least, 1) and common / max(min(len(a), len(b)), 1) >= threshold:
                out[i, j] = (common, common / min(len(a), len(b)))
    return out


def frames(spark, left, right):
    return (spark.createDataFrame(x, "id long, tokens array<string>").repartition(3) for x in (left, right))


@pytest.mark.parametrize(("least", "threshold"), [(2, 0.62), (1, 0.55), (1, 1.0), (3, 0.05)])
def test_pairs_equal_the_nested_loop(spark, least, threshold):
    left, right = sets(150, 1, True), sets(400, 2, True) + [(1000, []), (1001, ["hot"]), (1002, ["hot", "w1"])]
    a, b = frames(spark, left, right)
    got = {(r.left_id, r.right_id): (r.common, r.score) for r in linking.token_overlap(a, b, "id", "id", "tokens", least, threshold).collect()}
    assert got == brute(left, right, least, threshold) and got


def test_a_token_of_a_third_of_all_rows_makes_few_candidates(spark):
    rng = random.Random(6)
    rows = lambda n, at: [(at + i, [f"t{rng.randrange(20_000)}" for _ in range(9)] + ["hot"] * (i % 3 == 0) + ["warm"] * (i % 5 == 0)) for i in range(n)]
    left, right = rows(600, 0), rows(3000, 10_000)
    right += [(20_000 + i, [*s[:8], "x"]) for i, s in left[:50]]
    a, b = frames(spark, left, right)
    met = a.select(F.col("id").alias("l"), F.explode("tokens").alias("t")).join(b.select(F.col("id").alias("r"), F.explode("tokens").alias("t")), "t").select("l", "r").distinct().count()
    x, y = linking.ordered_sets(a, b, "id", "id", "tokens")
    candidates = linking.candidate_pairs(x, y, 2, 0.62)
    assert candidates.count() < met / 10 and met > 150_000
    got = {(r.left_id, r.right_id) for r in linking.token_overlap(a, b, "id", "id", "tokens", 2, 0.62).collect()}
    assert got == set(brute(left, right, 2, 0.62)) and len(got) >= 50


def test_null_keys_and_empty_sides(spark):
    a, b = frames(spark, [(1, ["a", "b"]), (None, ["a", "b"]), (2, None)], [(7, ["a", "b"]), (None, ["a"])])
    assert [tuple(r) for r in linking.token_overlap(a, b, "id", "id", "tokens", 1, 0.5).select("left_id", "right_id", "common").collect()] == [(1, 7, 2)]
    assert linking.token_overlap(a.filter("false"), b, "id", "id", "tokens", 1, 0.5).count() == 0
