import time
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fiscalis.llm.packing import (
    _SHORT_RUNS,
    PackingParams,
    encoder,
    op8_bestfit_packing,
    pack_documents,
    packed_sequences,
    plan_packing,
    tokenizer_file,
)

FILE = Tokenizer.from_file(tokenizer_file())  # as loaded, nothing set


def PLAIN(text):
    return FILE.encode(text, add_special_tokens=False).ids


ENCODE = encoder(tokenizer_file())


def check(rows, texts, capacity=1024):
    """Every document once, cut as stated; sequences without gaps or overlaps; returns the number of sequences."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for i, parts in by_doc.items():
        ids = np.array([*PLAIN(texts[i] or ""), 2], "<u4")
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        at = 0
        for r in parts:
            assert r.start == at and r.ids_crc32 == crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids) and all(r.length == capacity for r in parts[1:])
        assert parts[0].length == (len(ids) % capacity or capacity)
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_whole_table(spark, sf_dir):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op8_bestfit_packing(spark, sf).collect()
    assert check(rows, texts) <= 1.01 * sum(r.length for r in rows) / 1024 + 1


def test_nulls_empties_lengths_at_the_border_and_ids(spark):
    texts = {1: None, 2: "", 3: "a b c", 4: " hello" * 1023, 5: " hello" * 1024, 6: " hello" * 5000, 7: "<|endoftext|> ñ 漢字 \n\n  x"}
    docs = spark.createDataFrame([(i, t, "z") for i, t in texts.items()], "doc_id long, text string, piece string")
    packed = pack_documents(docs, with_ids=True)
    assert check(packed.collect(), texts) == 7
    flat = {r.sequence_id: r.ids for r in packed_sequences(packed).collect()}
    for r in packed.collect():
        assert flat[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert pack_documents(docs.filter("false")).count() == 0


def test_repeated_ids_keep_all_rows(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same"), (None, "x")], "doc_id long, text string")
    out = pack_documents(docs)
    assert out.count() == 3 and out.select("sequence_id", "offset").distinct().count() == 3


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=40), st.integers(1, 60))
def test_plan_places_every_rank_once(histogram, groups):
    rows, n = plan_packing(histogram, PackingParams(64, 4, groups))
    fill = {}
    ranks = {s: [] for s in histogram}
    for length, r0, r1, first, offset in rows:
        ranks[length] += range(r0, r1)
        for i in range(r1 - r0):
            fill.setdefault(first + i, []).append((offset, length))
    assert {s: sorted(v) for s, v in ranks.items()} == {s: list(range(k)) for s, k in histogram.items()}
    assert sorted(fill) == list(range(n))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def best_fit_decreasing(draw):
    gaps, n = {}, 0
    for s in sorted(draw.tolist(), reverse=True):
        gap = next((g for g in range(s, 1025) if gaps.get(g)), 1024)
        n += not gaps.get(gap)
        gaps[gap] = max(0, gaps.get(gap, 0) - 1)
        gaps[gap - s] = gaps.get(gap - s, 0) + 1
    return n


def test_plan_is_as_good_as_best_fit_decreasing():
    rng = np.random.default_rng(1)
    for draw in (rng.integers(1, 1024, 20_000), np.minimum(1023, rng.exponential(300, 20_000).astype(int) + 1)):
        sizes, counts = np.unique(draw, return_counts=True)
        _, n = plan_packing(dict(zip(sizes.tolist(), counts.tolist(), strict=True)))
        assert n <= 1.001 * best_fit_decreasing(draw) + 1


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_rank_encoder_equals_the_tokenizer_file(text):
    assert list(ENCODE(text)) == list(PLAIN(text))


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_rank_encoder_on_documents(spark, sf):
    for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select(F.col("text")).collect():
        assert list(ENCODE(r.text)) == list(PLAIN(r.text))


@pytest.mark.parametrize("text", [" " * 5_000_000, "a" * 5_000_000, "x" + "\n" * 1_000_000 + "y", "é" * 400_000])
def test_long_runs_are_tokenised_as_by_the_file(text):
    assert list(ENCODE(text)) == list(PLAIN(text))


def test_long_runs_are_packed(spark):
    texts = {1: " " * 1_500_000, 2: "b" * 1_500_000, 3: "short"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(pack_documents(docs).collect(), texts)


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y ", "<|endoftext|" + "|> <|ENDOFTEXT|>", "é<|endoftext|>" * 2000])
def test_added_tokens_in_a_text_are_their_ids(text):
    assert list(ENCODE(text)) == PLAIN(text)


def test_added_token_of_the_file():
    assert list(ENCODE("a <|endoftext|> b")) == [64, 220, 50256, 275]


def test_runs_are_searched_in_one_pass():
    words = ("w" * 4000 + " ") * 2500  # 10 MB without a long run
    began = time.perf_counter()
    assert _SHORT_RUNS.fullmatch(words)
    assert time.perf_counter() - began < 1
    for n, short in ((4095, True), (4096, False)):
        for run in ("x" * n, " " * n, "a" + "\n" * n + "b", "é" * n + " z"):
            assert bool(_SHORT_RUNS.fullmatch(run)) == short
