import random

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from fiscalis.llm import simhash
from fiscalis.llm.common import connected_components
from fiscalis.llm.simhash import neighbour_buckets, op1_simhash_neardup, simhash_components, simhash_fingerprints, wide_fingerprints


def plain_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    parent = {i: i for i in range(len(prints))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                parent[find(a)] = find(b)
    return [find(i) for i in range(len(prints))]


def test_components_equal_brute_force_on_the_table(spark, sf_dir):
    rows = op1_simhash_neardup(spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    ids = sorted(docs)
    prints = [plain_fingerprint(docs[i]) for i in ids]
    roots = plain_components(prints, 3)
    least = {}
    for i, r in zip(ids, roots, strict=True):
        least[r] = min(least.get(r, i), i)
    want = {i: (f"{p:016x}", least[r]) for i, p, r in zip(ids, prints, roots, strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want


def test_components_of_clusters_and_chains(spark):
    rng = random.Random(5)
    prints = []
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(60):
            p = centre
            for _ in range(rng.randrange(5)):
                p ^= 1 << rng.randrange(64)
            prints.append(p)
    chain = rng.getrandbits(64)
    for i in range(0, 60, 3):
        prints.append(chain)
        chain ^= 0b111 << i
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "id long, fp long")
    for radius in (0, 3):
        roots = plain_components(prints, radius)
        least = {}
        for i, r in enumerate(roots):
            least[r] = min(least.get(r, i), i)
        got = {r.id: r.component_id for r in simhash_components(df, radius).collect()}
        assert got == {i: least[r] for i, r in enumerate(roots)}


def test_nulls_empties_ties_and_extra_columns(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n", "c"), (None, "Same text here now", "d"), (5, "same TEXT here now", "e"), (5, "same TEXT here now", "f"), (7, "x", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r.id, r.fp, r.component_id) for r in simhash_components(simhash_fingerprints(df)).collect()), key=str)
    assert len(got) == 7
    zero = [r for r in got if r[1] == 0]
    assert {r[2] for r in zero} == {1} and len(zero) == 3
    assert [r[2] for r in got if r[0] is None] == [5]
    assert [r[2] for r in got if r[0] == 7] == [7]
    empty = simhash_components(simhash_fingerprints(df.filter("false")))
    assert empty.count() == 0


def test_long_text_counts_every_shingle(spark):
    text = " ".join(f"w{i}" for i in range(70_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    fp = simhash_fingerprints(df).first().fp
    assert fp % (1 << 64) == plain_fingerprint(text)


@pytest.mark.parametrize("n", [1, 40])
def test_connected_components_on_paths(spark, n):
    edges = [(i + 1, i) for i in range(n)] + [(100, 101), (101, 100), (200, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {100: 100, 101: 100}


def test_wide_fingerprints_are_majorities_of_weighted_votes():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, n, np.uint64) for n in (0, 1, 5, 300)]
    got = wide_fingerprints(sets, 256, 14)
    assert got.shape == (4, 18) and not got[0].any()
    place = np.random.default_rng(42).permutation(256)
    for hashes, row in zip(sets, got.tolist(), strict=True):
        votes = [0] * 256
        for k, weight in enumerate((1, 2, 2), 1):
            for h in simhash._mixed(simhash._mixed(hashes + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)))).tolist():
                for b in range(256):
                    votes[b] += (weight if h >> 63 else -weight) * (-1) ** (h & 255 & b).bit_count()
        assert row == [sum((votes[place[14 * j + i]] > 0) << i for i in range(14)) for j in range(18)]


def test_neighbour_buckets_hold_every_pair_one_bit_apart(spark, monkeypatch):
    rng = random.Random(8)
    rows = []
    for i in range(500):
        segs = [rng.getrandbits(8) << 4, rng.choice([77, 76, 5, rng.getrandbits(12)])]
        rows.append((i, [v ^ (1 << rng.randrange(12)) if rng.random() < 0.3 else v for v in segs]))
    want = {(a, b) for a, x in rows for b, y in rows if a < b and any((u ^ v).bit_count() <= 1 for u, v in zip(x, y, strict=True))}
    for step in (1 << 16, 3):
        monkeypatch.setattr(simhash, "_STEP", step)
        found = neighbour_buckets(spark.createDataFrame(rows, "id long, segs array<int>"), 12).collect()
        assert len(found) == len(set(found))
        buckets = {}
        for r in found:
            buckets.setdefault(r.bucket, []).append(r.id)
        got = {(min(a, b), max(a, b)) for own in buckets.values() for a in own for b in own if a != b}
        assert want <= got
        for bucket, own in buckets.items():  # a value and its neighbours, nothing else
            assert all((rows[i][1][bucket >> 12] ^ bucket & 4095).bit_count() <= 1 for i in own)


def test_near_dedup_of_the_pipeline_takes_its_candidates_from_simhash(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"so many equal words stand here again {' '.join('abcdefgh')} and {i % 2} {'x' * (i // 2)}") for i in range(4)], "doc_id long, text string")
    asked = []
    monkeypatch.setattr(simhash, "neighbour_buckets", lambda prints, *a: asked.append(prints.columns) or neighbour_buckets(prints, *a))
    kept = corpus_pipeline.near_dedup(spark, docs, None)
    assert asked == [["id", "segs"]] and 1 <= kept.count() <= 4
    monkeypatch.setattr(simhash, "neighbour_buckets", lambda prints, *a: neighbour_buckets(prints, *a).filter("false"))
    assert corpus_pipeline.near_dedup(spark, docs, None).count() == 4  # no other path finds pairs


def test_chance_meetings_of_unrelated_texts_make_no_rows(spark, monkeypatch):
    """At 12 bits a segment, 300 unrelated texts meet by chance some 48,000 times; near copies among them are found."""
    rng = random.Random(21)
    docs = [(i, " ".join(f"w{rng.getrandbits(40)}" for _ in range(40))) for i in range(300)]
    docs += [(1000 + i, f"{docs[i][1]} more") for i in range(20)]
    met = []
    monkeypatch.setattr(simhash, "neighbour_buckets", lambda *a: met.append(neighbour_buckets(*a)) or met[0])
    groups = simhash.near_duplicate_groups(spark.createDataFrame(docs, "doc_id long, text string"), simhash.NearDupParams(width=12)).collect()
    assert {r.dk: r.group_dk for r in groups} == {i: i % 1000 for i, _ in docs}
    together = met[0].groupBy("bucket").agg(simhash.F.collect_list(simhash.F.expr("id")).alias("ids"), simhash.F.count("*").alias("n")).filter("n > 1")
    assert together.agg(simhash.F.sum("n")).first()[0] < 20 * 341 * 3


def test_values_are_left_apart_only_where_no_two_of_their_texts_are_near(spark):
    rng = random.Random(9)
    base = [[rng.getrandbits(12) for _ in range(8)] for _ in range(60)]
    rows = []
    for i in range(400):
        segs = list(rng.choice(base)) if rng.random() < 0.7 else [rng.choice(base)[0], *(rng.getrandbits(12) for _ in range(7))]
        rows.append((i, [v ^ sum(1 << rng.randrange(12) for _ in range(rng.randrange(3))) & 4095 for v in segs]))
    bits = lambda a, b: (a ^ b).bit_count()
    want, every = set(), set()
    for a, x in rows:
        for b, y in rows[:a]:
            for j in range(8):
                if bits(x[j], y[j]) <= 1:
                    every.add((b, a))
                    if sum(bits(x[(j + k) % 8], y[(j + k) % 8]) for k in (1, 2)) <= int(0.29 * 24):
                        want.add((b, a))
    buckets = {}
    for r in neighbour_buckets(spark.createDataFrame(rows, "id long, segs array<int>"), 12, "stars", 0.29).collect():
        buckets.setdefault(r.bucket, set()).add(r.id)
    got = {(a, b) for own in buckets.values() for a in own for b in own if a < b}
    assert want <= got and len(want) > 500 and len(every - got) > 100
