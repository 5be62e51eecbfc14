import hashlib
import math
import random
import time
from collections import Counter
from decimal import Decimal

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from fiscalis.llm.decontaminate import LeakIndex, LeakParams, find_leaks, myers_search, op3_decontamination, words_of
from fiscalis.llm.fingerprint import fingerprint_classes, find_within, op5_document_fingerprints, weighted_fingerprint


def plain_fp(text):
    w = text.lower().encode().split()
    if not w:
        return 0
    terms = Counter(b" ".join(w[i : i + 2]) for i in range(max(1, len(w) - 1)))
    votes = [0.0] * 64
    for t, n in terms.items():
        h = xxhash.xxh64_intdigest(t, 42)
        for b in range(64):
            votes[b] += (1 + math.log(n)) * (1 if h >> b & 1 else -1)
    return sum(1 << b for b in range(64) if votes[b] > 1e-9), any(abs(v) < 1e-9 for v in votes)


def test_fingerprints_and_neighbours_equal_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in op5_document_fingerprints(spark, sf_dir).collect()}
    assert set(rows) == set(docs)
    ids = sorted(docs)
    for i, j in zip(ids, ids[1:] + ids[:1], strict=True):
        half = len(docs[i]) // 2
        edited = docs[i][: len(docs[i]) - half] + docs[j][:half]
        fps = [weighted_fingerprint(t) for t in (docs[i], edited, docs[j])]
        plain = plain_fp(docs[i])
        assert plain == 0 or plain[1] or plain[0] == fps[0]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(docs[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (f"{fps[0]:016x}", f"{fps[1]:016x}")
        assert r.near_edited == 1 - (fps[0] ^ fps[1]).bit_count() / 64 and r.near_next == 1 - (fps[0] ^ fps[2]).bit_count() / 64
    assert np.mean([r.near_edited > r.near_next for r in rows.values()]) > 0.9


def test_neighbours_with_nulls_ties_and_one_row(spark, tmp_path):
    for n, rows in enumerate(([(1, None)], [(None, "ab cd"), (3, None), (3, "é" * 7), (9, "xyz xyz"), (9, "xyz xyz")], [])):
        path = f"{tmp_path}/{n}"
        spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_chars long").write.parquet(f"{path}/documents.parquet")
        got = op5_document_fingerprints(spark, path).collect()
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        want = []
        for (i, a), (_, b) in zip(order, order[1:] + order[:1], strict=True):
            a, b = a or "", b or ""
            want.append((i, len(a), hashlib.sha256((a[: len(a) - len(a) // 2] + b[: len(a) // 2]).encode()).hexdigest()))
        assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=str) == sorted(want, key=str)


def test_block_tables_find_every_fingerprint_within_the_radius(spark):
    rng = random.Random(9)
    prints = [rng.getrandbits(64) for _ in range(30)]
    for p in prints[:20]:
        for _ in range(12):
            q = p
            for b in rng.sample(range(64), rng.randrange(6)):
                q ^= 1 << b
            prints.append(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "id long, fp long")
    got = {(r.query_fp, r.fp, r.distance) for r in find_within(df.filter("id % 20 = 0"), df).collect()}
    want = {(signed[i], signed[j], (prints[i] ^ prints[j]).bit_count()) for i in range(0, len(prints), 20) for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 3}
    assert got == want
    least = list(range(len(prints)))
    for _ in range(len(prints)):
        new = [min(least[j] for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(prints))]
        if new == least:
            break
        least = new
    assert {r.id: r.class_id for r in fingerprint_classes(df).collect()} == dict(enumerate(least))


def plain_search(item, window):
    rows = [[0] * (len(window) + 1)]
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(window, 1):
            row.append(min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (a != b)))
        rows.append(row)
    return min((d, j) for j, d in enumerate(rows[-1]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=80), st.lists(st.sampled_from("abc"), max_size=60), st.integers(0, 90))
def test_myers_equals_the_edit_matrix(item, window, limit):
    best = plain_search(item, window)
    assert myers_search(item, window, limit) == (best if best[0] <= limit else None)


def plain_leaks(docs, items, rate):
    out = set()
    for d, text in docs:
        w = words_of(text)
        for i, t in items:
            item = words_of(t)
            if len(item) >= 8:
                distance = plain_search(item, w)[0]
                if distance <= int(rate * len(item)):
                    out.add((d, i, distance))
    return out


def test_leaks_equal_brute_force_on_edited_passages(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(5, 45)))) for i in range(25)] + [(30, None), (31, "")]
    items.append((32, items[3][1]))
    docs = [(0, None), (1, ""), (2, "w1")]
    for d in range(3, 90):
        words = words_of(rng.choice(items[:25])[1])
        for _ in range(rng.randrange(7)):
            at = rng.randrange(len(words) + 1)
            words[at : at + rng.randrange(2)] = rng.choices(vocab, k=rng.randrange(2))
        docs.append((d, ", ".join(rng.choices(vocab, k=rng.randrange(30))) + "\n" + " ".join(words).upper() + ". " + " ".join(rng.choices(vocab, k=20))))
    df = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain_leaks(docs, items, 0.1)
    assert len(want) > 20
    for p in (LeakParams(), LeakParams(block_bytes=600)):
        assert {(r.doc_id, r.item_id, r.distance) for r in find_leaks(df, bench, p).collect()} == want
    assert find_leaks(df.filter("false"), bench).count() == find_leaks(df, bench.filter("false")).count() == 0


def test_leaks_on_the_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in op3_decontamination(spark, sf_dir).collect()}
    flat = {d: " ".join(words_of(t)) for d, t in docs}
    assert {(d, i) for d, t in flat.items() for i, x in items if " ".join(words_of(x)) in t} <= got
    assert got == {(d, i) for d, i, _ in plain_leaks([(d, t) for d, t in docs if d in {x for x, _ in got} or d % 9 == 0], items, 0.1)}


def test_short_items_are_found_exactly(spark, tmp_path):
    docs = [(1, "They asked: Who wrote, the Iliad? Nobody knew."), (2, "who wrote the odyssey then"), (3, "ab yes " * 3000), (4, None)]
    items = [(1, "Who wrote the Iliad?"), (2, "yes"), (3, " ?"), (4, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.doc_id, r.item_id, r.distance, r.end_word) for r in op3_decontamination(spark, str(tmp_path)).collect()}
    assert got == {(1, 1, 0, 6), (3, 2, 0, 2)}
    kept = corpus_pipeline.decontamination(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == {2, 4}


def test_hits_of_one_item_without_end_take_one_pass(spark):
    item = [f"q{i}" for i in range(20)]
    index = LeakIndex([(1, item)], 0.1)
    text = " ".join(item[:10] * 20_000)
    began = time.time()
    assert index.leaks(text) == [] and index.leaks(text + " " + " ".join(item[10:])) == [(0, 0, 200_010)]
    assert time.time() - began < 5


def test_item_ids_of_any_type(spark):
    docs = spark.createDataFrame([("d1", "one two three four"), (None, "three")], "doc_id string, text string")
    for kind, ids in (("decimal(10,2)", [Decimal("1.50"), Decimal("2.00")]), ("string", ["x", "y"]), ("binary", [bytearray(b"x"), bytearray(b"y")])):
        bench = spark.createDataFrame([(ids[0], "two three"), (ids[1], "five")], f"item_id {kind}, text string")
        assert [(r.doc_id, r.item_id) for r in find_leaks(docs, bench, LeakParams(short=True)).collect()] == [("d1", ids[0])]


def test_fingerprints_of_an_empty_table_and_a_single_row(spark):
    from fiscalis.llm.fingerprint import edited_neighbours, fingerprints

    docs = spark.createDataFrame([(7, "uno dos tres")], "doc_id long, text string")
    assert fingerprints(docs.filter("false")).count() == 0 and edited_neighbours(docs.filter("false")).count() == 0
    (row,) = edited_neighbours(docs).collect()
    assert row.doc_id == 7 and row.fp == row.next_fp


def test_leaks_without_items_or_documents(spark):
    from fiscalis.llm.decontaminate import drop_leaks

    docs = spark.createDataFrame([(1, "a b c"), (2, None), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([("i", "x y z " * 5), (None, None)], "item_id string, text string")
    assert drop_leaks(docs, items.filter("false")).count() == 3 and drop_leaks(docs, items).count() == 3
    assert drop_leaks(docs.filter("false"), items).count() == 0


def test_toxicity_without_labels_keeps_all(spark):
    from fiscalis.llm.toxicity import drop_toxic

    docs = spark.createDataFrame([(1, "a b c"), (2, None), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert drop_toxic(docs, labels).count() == 3 and drop_toxic(docs.filter("false"), labels).count() == 0
