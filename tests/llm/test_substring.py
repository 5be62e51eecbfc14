import hashlib
import random

import numpy as np
import pytest

from fiscalis.llm.substring import SubstringParams, op6_substring_dedup, pack_sorted, remove_substrings, rolling, unpack_sorted


def plain(docs, span):
    """Words to remove by the definition, judged on the input."""
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in docs]
    key = lambda i: -(1 << 63) if i is None else i
    for i, w in words:
        for p in range(len(w) - span + 1):
            k = tuple(w[p : p + span])
            first[k] = min(first.get(k, (1 << 63, 0)), (key(i), p))
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - span + 1):
            if first[tuple(w[p : p + span])] < (key(i), p):
                gone.update(range(p, p + span))
        kept = [x for n, x in enumerate(w) if n not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_table_equals_brute_force(spark, sf):
    d = f"/root/testdata/{sf}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    want = plain(docs, 20)
    assert sum(r[2] for r in want) > 1000
    assert rows(op6_substring_dedup(spark, d)) == sorted(want, key=str)


@pytest.mark.parametrize("span,chunk,fan", [(20, 3_000_000, 1024), (7, 200, 2), (4, 50, 4), (1, 30, 1024)])
def test_planted_repeats(spark, span, chunk, fan):
    rng = random.Random(span)
    vocab = [f"w{i}" for i in range(300)]
    passages = [rng.choices(vocab, k=rng.randrange(1, 60)) for _ in range(12)]
    docs = []
    for i in range(80):
        words = []
        for _ in range(rng.randrange(6)):
            words += rng.choices(vocab, k=rng.randrange(25)) + rng.choice(passages)[rng.randrange(5) :]
        docs.append((i, " \t\n"[i % 3].join(words)))
    docs += [(100, None), (101, ""), (102, "the " * 90), (103, "the " * 41), (None, docs[5][1]), (None, "x " * 30), (7, docs[7][1]), (7, docs[9][1]), (50, docs[3][1] + "   é")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, spans int").repartition(5)
    got = rows(remove_substrings(df, SubstringParams(span, chunk, fan), digest=True))
    assert got == sorted(plain(docs, span), key=str)


def test_empty_table_and_texts(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id int, text string")
    assert [(r.doc_id, r.kept_text) for r in remove_substrings(df).orderBy("doc_id").collect()] == [(1, "a b c"), (2, "")]
    assert remove_substrings(df.filter("false")).count() == 0


def test_rolling_hash_and_packing():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    for size in range(1, 30):
        want = []
        for i in range(50 - size + 1):
            x = 0
            for v in h[i : i + size].tolist():
                x = (x * 1_000_003 + v) % (1 << 64)
            want.append(x)
        assert rolling(h, size, 1_000_003).tolist() == want
    for a in ([], [0], [5, 5, 9], [1, 1 << 60]):
        assert unpack_sorted(pack_sorted(np.array(a, np.uint64))).tolist() == a
