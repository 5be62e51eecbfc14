"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation.

A vector is a sparse row of (term, weight): the places of its components that are not zero, and their scaled values. A
task holds a block of searches and reads a block of rows in batches. A batch becomes postings by term; each term of the
searches scatters its weighted postings into dense score arrays, one for each search; the best keys are selected by
partition and merged with what the batches before have left. Blocks are merged by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalis.llm import vectors as V
from fiscalis.llm.common import fields, materialize

TILE_SEARCHES, TILE_ROWS = 64, 8192


@dataclass(frozen=True)
class TopKParams:
    """``scale``: components become floor(scale * x). Sizes are in components of a block, a bound on memory and time."""

    k: int = 10
    scale: float = 1024.0
    held_size: int = 1 << 21
    passing_size: int = 1 << 22


def sparse(column: pa.ListArray, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of each component that is not zero, by row."""
    weights = V.scaled(np.asarray(column.flatten(), np.float64), scale)
    sizes = np.asarray(column.value_lengths(), np.int64)
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(len(weights)) - np.repeat(ends - sizes, sizes)
    some = weights != 0
    return row[some], term[some], weights[some]


def by_term(entries: tuple[np.ndarray, np.ndarray, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Postings: term -> rows in ascending order, and their weights."""
    row, term, weight = entries
    order = np.argsort(term, kind="stable")
    row, term, weight = row[order], term[order], weight[order]
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    ends = np.append(starts[1:], len(term))
    return {int(term[a]): (row[a:b], weight[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)}


def accumulate(scores: np.ndarray, searches: dict, postings: dict) -> None:
    """Add weight times posting to the score array of each search that has the term, one term after the other."""
    n = scores.shape[1]
    for term, (which, weights) in searches.items():
        if term not in postings:
            continue
        rows, values = postings[term]
        if 2 * len(rows) > n:  # a posting that most rows have is added as a whole column
            column = np.zeros(n, scores.dtype)
            column[rows] = values
            scores[which] += np.multiply.outer(weights, column)
        else:
            scores[np.ix_(which, rows)] += np.multiply.outer(weights, values)


class Best:
    """The best ``k`` (score, id, copies) of each search so far."""

    def __init__(self, searches: int, k: int):
        self.k = k
        self.score: list[list[int]] = [[] for _ in range(searches)]
        self.row: list[list[tuple]] = [[] for _ in range(searches)]

    def merge(self, at: int, scores: list[int], rows: list[tuple]) -> None:
        both = sorted(
            zip(self.score[at] + scores, self.row[at] + rows, strict=True),
            key=lambda x: (-x[0], x[1][0] is None, x[1][0] or 0),
        )[: self.k]
        self.score[at], self.row[at] = [x[0] for x in both], [x[1] for x in both]


def search_batch(held: list[tuple[pa.ListArray, int]], rows: pa.RecordBatch, best: Best, p: TopKParams, reach: int) -> None:
    """Score a batch of rows for all held searches and keep the best of each."""
    ids, copies = rows.column("id"), rows.column("n").to_pylist()
    names, place, n = ids.to_pylist(), V.id_order(ids), rows.num_rows
    entries = sparse(rows.column("vec"), p.scale)
    terms = int(np.bincount(entries[0]).max(initial=0))
    postings, exact_postings = by_term(entries), None
    for vecs, start in held:
        own = sparse(vecs, p.scale)
        if V.sums_exact(own[2], entries[2], terms, n):
            searches, against, scores = by_term(own), postings, np.zeros((len(vecs), n))
        else:
            exact_postings = exact_postings or by_term((entries[0], entries[1], V.whole(entries[2])))
            searches, against, scores = by_term((own[0], own[1], V.whole(own[2]))), exact_postings, np.full((len(vecs), n), 0, object)
        accumulate(scores, searches, against)
        scores = V.held_to_long(scores)
        keys = scores * n + (n - 1 - place)  # equal scores in order of ids; every key of a search is different
        top = min(reach, n)
        chosen = np.argpartition(keys, n - top, axis=1)[:, n - top :]
        for i, at in enumerate(chosen):
            best.merge(start + i, [int(x) for x in scores[i, at]], [(names[j], copies[j]) for j in at.tolist()])


def exact_topk(searches: DataFrame, rows: DataFrame, p: TopKParams | None = None, without_self: bool = True) -> DataFrame:
    """Highest inner products of each search over all rows: ``query_id, rank, vec_id, score``, all but rank long.

    Both inputs are of ``vectors.usable_rows``. Ties go to the smaller vec_id, an unknown id last. Zeros weigh nothing:
    a shorter vector counts as ending in zeros, a row that shares no term scores 0 and is a candidate. Each row of equal
    rows is a search and a candidate of its own; with ``without_self`` a search loses one row that equals it. Scores
    beyond a long count as its nearest end. No searches or no rows: no result. Fewer than k candidates: all of them.
    """
    p = p or TopKParams()
    reach = p.k + int(without_self)
    one = F.lit(0).alias("part")
    cells = V.grid(searches.select(one, "id", "h", "vec", "n"), rows.select(one, "id", "h", "vec", "n"), "searches", 1, p.held_size, p.passing_size)
    schema = fields("query_id long, h long, own long, score long, vec_id long, n long")

    def flush(block: list[pa.RecordBatch], best: Best) -> Iterator[pa.RecordBatch]:
        own: list = []
        for b in block:
            _, _, weight = entries = sparse(b.column("vec"), p.scale)
            square = np.full(b.num_rows, 0, object)
            np.add.at(square, entries[0], V.whole(weight) ** 2)
            own += zip(b.column("id").to_pylist(), b.column("h").to_pylist(), V.held_to_long(square).tolist(), strict=True)
        for a in range(0, len(own), 2048):
            out = [(*own[i], s, r[0], r[1]) for i in range(a, min(a + 2048, len(own))) for s, r in zip(best.score[i], best.row[i], strict=True)]
            if out:
                arrays = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, block, held, best = None, [], None, None
        for at, side, piece in V.pieces(batches):
            if at != cell:
                if best:
                    yield from flush(block, best)
                cell, block, held, best = at, [], None, None
            if side == 0:
                block.append(piece)
                continue
            if not block:
                continue
            if best is None:
                best, held, start = Best(sum(b.num_rows for b in block), reach), [], 0
                for b in block:
                    for a in range(0, b.num_rows, TILE_SEARCHES):
                        held.append((b.column("vec").slice(a, TILE_SEARCHES), start + a))
                    start += b.num_rows
            for a in range(0, piece.num_rows, TILE_ROWS):
                search_batch(held, piece.slice(a, TILE_ROWS), best, p, reach)
        if best:
            yield from flush(block, best)

    hits = cells.select("part", "qb", "cb", "side", "id", "h", "vec", "n").mapInArrow(search, schema)
    found = V.merged(hits, ["query_id", "h"], p.k, *(("own", "query_id") if without_self else ()))
    repeated = searches.filter("n > 1").select(F.col("id").alias("query_id"), "h", "n")
    found = found.join(repeated, ["query_id", "h"], "left").withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("n", F.lit(1).cast("long")))))
    return found.select("query_id", "rank", "vec_id", "score")


def op11_exact_topk(spark, sf_dir: str) -> DataFrame:
    """For rows of ``embeddings`` with a vec_id divisible by 100, the 10 other rows of the highest integer inner product."""
    p = TopKParams()
    rows = materialize(V.usable_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), p.scale), "vectors")
    return exact_topk(rows.filter("id % 100 = 0"), rows, p)


SQL_OP11 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
