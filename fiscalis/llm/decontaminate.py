"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are sequences of words (lower case, ASCII punctuation apart). An item of n words may differ in
k = floor(rate * n) word edits; cut into k + 1 pieces, one piece at least stands unchanged in any match, so exact hits
of pieces, found by one automaton over all of them, are the only places to look at. Each is verified by Myers'
bit-parallel edit distance over the window that an alignment through the hit can reach.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fiscalis.llm.common import fields, place

_APART = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


@dataclass(frozen=True)
class LeakParams:
    """``rate`` of word edits; items under ``min_words`` are matched exactly if ``short`` is set, else left out.

    ``block_bytes`` bounds what of the benchmark is sent to the executors at a time; more blocks, more passes.
    """

    rate: float = 0.1
    min_words: int = 8
    short: bool = False
    block_bytes: int = 32 << 20


def words_of(text: str | None) -> list[str]:
    """Lower-cased words between white space and ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_APART).decode("utf-8", "surrogatepass").split()


def myers_search(item: Sequence[str], window: Sequence[str], limit: int) -> tuple[int, int] | None:
    """Best ``(distance, end)`` of the item against any part of the window that ends before ``end``; None above ``limit``.

    The earliest end among equal distances. Bit i of the vectors is row i of the edit matrix.
    """
    m = len(item)
    peq: dict[str, int] = {}
    for i, w in enumerate(item):
        peq[w] = peq.get(w, 0) | 1 << i
    every, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = every, 0, m
    best: tuple[int, int] | None = (m, 0) if m <= limit else None
    for j, w in enumerate(window, 1):
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & every
        mh = pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = ph << 1 & every, mh << 1 & every
        pv, mv = (mh | ~(xv | ph) & every) & every, ph & xv
        if score <= limit and (best is None or score < best[0]):
            best = (score, j)
    return best


class LeakIndex:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: Sequence[tuple[object, Sequence[str]]], rate: float, min_words: int = 0):
        self.items, self.rate, self.min_words = items, rate, min_words
        self.limits = [int(rate * len(w)) if len(w) >= min_words else 0 for _, w in items]
        self.automaton = ahocorasick.Automaton()
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (_, w) in enumerate(items):
            k = self.limits[i]
            cuts = [len(w) * p // (k + 1) for p in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(f" {' '.join(w[a:b])} ", []).append((i, a))
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def __reduce__(self):
        return LeakIndex, (self.items, self.rate, self.min_words)

    def leaks(self, text: str | None) -> list[tuple[int, int, int]]:
        """``(item, distance, end word)``: for each item that the text holds, its best match, the first of equal ones.

        The windows of an item's hits are merged, so every word of the text is looked at once per item that it may hold.
        """
        if self.empty:
            return []
        words = words_of(text)
        flat = f" {' '.join(words)} "
        found: dict[int, tuple[int, int]] = {}
        spans: dict[int, list[list[int]]] = {}
        at, at_word = 0, 0
        for end, (size, places) in self.automaton.iter(flat):
            begin = end - size + 1
            if begin < at:
                at_word -= flat.count(" ", begin, at)
            else:
                at_word += flat.count(" ", at, begin)
            at = begin
            for i, offset in places:
                k, item = self.limits[i], self.items[i][1]
                if not k:  # the piece is the whole item
                    found.setdefault(i, (0, at_word + len(item)))
                    continue
                lo, hi = max(0, at_word - offset - k), min(len(words), at_word - offset + len(item) + k)
                own = spans.setdefault(i, [])
                if own and lo <= own[-1][1] and own[-1][0] <= hi:
                    own[-1][0], own[-1][1] = min(lo, own[-1][0]), max(hi, own[-1][1])
                else:
                    own.append([lo, hi])
        for i, own in spans.items():
            own.sort()
            lo, hi = own[0]
            for a, b in [*own[1:], (len(words) + 1, 0)]:
                if a <= hi:
                    hi = max(hi, b)
                    continue
                best = myers_search(self.items[i][1], words[lo:hi], self.limits[i])
                if best and (i not in found or best[0] < found[i][0]):
                    found[i] = (best[0], lo + best[1])
                lo, hi = a, b
        return [(i, d, e) for i, (d, e) in sorted(found.items())]


def find_leaks(docs: DataFrame, benchmark: DataFrame, p: LeakParams = LeakParams()) -> DataFrame:
    """``(doc_id, item_id, distance, end_word)`` of every document that holds a test item within its error budget.

    One row per row of ``docs`` and item; equal items are found each; null texts and items without words give none,
    nor do items under ``p.min_words`` words unless ``p.short`` is set. Very long texts are searched whole; an empty
    table on either side gives no rows. The benchmark is read in blocks of bounded size, one pass over the documents
    for each; no shuffle.
    """
    doc_kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = fields(f"doc_id {doc_kind}, item_id {item_kind}, distance int, end_word long")
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    item_type = to_arrow_type(schema["item_id"].dataType)
    out = spark.createDataFrame([], schema)
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).orderBy("item_id", "text").toLocalIterator()
    for items in _blocks(rows, p):
        shared = spark.sparkContext.broadcast(LeakIndex(items, p.rate, p.min_words))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                at, hits = [], []
                for n, text in enumerate(batch.column(1)):
                    for hit in index.leaks(text.as_py()):
                        at.append(n)
                        hits.append(hit)
                ids = pa.array([index.items[i][0] for i, _, _ in hits], item_type)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int32())), ids, pa.array([h[1] for h in hits], pa.int32()), pa.array([h[2] for h in hits], pa.int64())],
                    schema.names,
                )

        out = out.unionByName(texts.mapInArrow(run, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, p: LeakParams = LeakParams()) -> DataFrame:
    """``docs`` without the rows whose text holds a test item within its error budget; all columns are passed on.

    A null or empty text holds none and stays; repeated rows go or stay alike; texts count whole. Items without a word are
    left out; an empty table of items keeps all rows, an empty table of documents stays empty.
    """
    at = place(docs.columns, "text")
    out = docs.withColumn(docs.columns[at], F.col(f"`{docs.columns[at]}`").cast("string"))
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).orderBy("item_id", "text").toLocalIterator()
    for items in _blocks(rows, p):
        shared = docs.sparkSession.sparkContext.broadcast(LeakIndex(items, p.rate, p.min_words))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                yield batch.filter(pa.array([not index.leaks(t.as_py()) for t in batch.column(at)], pa.bool_()))

        out = out.mapInArrow(run, out.schema)
    return out


def _blocks(rows, p: LeakParams) -> Iterator[list[tuple[object, list[str]]]]:
    block: list[tuple[object, list[str]]] = []
    size = 0
    for r in rows:
        w = words_of(r.text)
        if not w or len(w) < p.min_words and not p.short:
            continue
        if block and size + len(r.text) > p.block_bytes:
            yield block
            block, size = [], 0
        block.append((r.item_id, w))
        size += len(r.text)
    if block:
        yield block


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` that holds an item of ``benchmark``, with the item and the distance."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), LeakParams(short=True))
