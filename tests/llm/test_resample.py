import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest

from fiscalis.llm.resample import SQL_OP12, ResampleParams, common_prefixes, feature_buckets, op12_importance_resampling, resample, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def buckets(ws, p):
    return [crc32(" ".join(ws[i : i + n]).encode()) % p.buckets for n in range(1, p.max_n + 1) for i in range(len(ws) - n + 1)]


def brute(docs, target, p):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(words(text), p))
    for text in target:
        t.update(buckets(words(text), p))
    big_s, big_t = float(sum(s.values())), float(sum(t.values()))
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + p.buckets) / ((s[b] + 1.0) * (big_t + p.buckets)))) for b in range(p.buckets)]
    out = []
    for i, text in docs:
        ws = words(text)
        own = buckets(ws, p)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{p.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(ws), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= p.min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for r in out:
        r.append(None)
    for k, r in enumerate(able[: p.percent * len(able) // 100]):
        r[5] = k + 1
    return [tuple(r) for r in out]


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("p", [ResampleParams(), ResampleParams(3, 97, 4, 35, 7), ResampleParams(2, 50, 0, 100, 1)])
def test_equals_brute_force(spark, p):
    rng = np.random.default_rng(p.max_n)
    some = ["Alpha", "beta", "GAMMA-delta", "ñandú", "x1y2", "日本語", "İd", "0", "\x7f", "a\x00b", "..."]
    docs = [(i, " ".join(rng.choice(some, rng.integers(0, 60)).tolist())) for i in range(150)]
    docs += [(500, None), (501, ""), (502, "  \n"), (None, "beta " * 30), (None, None), (7, docs[7][1]), (8, docs[8][1]), (503, "alpha beta " * 40000)]
    target = ["beta gamma alpha beta", None, "", "x1y2 日本語 " * 20]
    df = spark.createDataFrame([(1, i, t, "z", 3) for i, t in docs], "score int, doc_id long, text string, TEXT string, rank int").repartition(3)
    goal = spark.createDataFrame([("q", t) for t in target], "n string, text string")
    got = [tuple(r) for r in resample(df, goal, p).collect()]
    want = brute(docs, target, p)
    assert sorted((r[:5] for r in got), key=key) == sorted((r[:5] for r in want), key=key)
    assert sorted(r[4:] for r in got if r[5]) == sorted(r[4:] for r in want if r[5])
    assert sorted((r[:2] + r[5:] for r in got if r[0] not in (7, 8)), key=key) == sorted((r[:2] + r[5:] for r in want if r[0] not in (7, 8)), key=key)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    goal = spark.createDataFrame([], "text string")
    some = spark.createDataFrame([(i, f"w{i % 3} " * 25) for i in range(20)], "doc_id long, text string")
    assert resample(docs, goal).collect() == []
    got = resample(some, goal).collect()
    assert len(got) == 20 and sorted(r.rank for r in got if r.rank) == [1, 2]


def test_suffix_array_and_runs():
    rng = np.random.default_rng(3)
    sizes = np.array([0, 7, 1, 30, 0, 12])
    ids = rng.integers(0, 3, sizes.sum()).astype(np.int32)
    ends = np.repeat(np.cumsum(sizes), sizes)
    depth = 5
    order = suffix_array(ids, ends, depth)
    cut = [tuple(ids[i : min(i + depth, ends[i])].tolist()) for i in range(len(ids))]
    assert [cut[i] for i in order] == sorted(cut)
    lcp = common_prefixes(ids, ends, order, depth)
    for x, y, n in zip(order, order[1:], lcp[1:], strict=False):
        assert n == next((k for k in range(min(len(cut[x]), len(cut[y]))) if cut[x][k] != cut[y][k]), min(len(cut[x]), len(cut[y])))
    ws = [b"w%d" % i for i in ids]
    for n, at in enumerate(feature_buckets(ws, sizes, depth, 1000), 1):
        assert at.tolist() == [crc32(b" ".join(ws[i : i + n])) % 1000 if i + n <= ends[i] else -1 for i in range(len(ws))]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = op12_importance_resampling(spark, sf)
    want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({SQL_OP12})").fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(got, key=key) == sorted(want, key=key) and sum(r[-1] is not None for r in got) > 500
