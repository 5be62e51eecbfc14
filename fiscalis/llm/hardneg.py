"""Hard negatives by ball trees: per-partition branch-and-bound over inner products.

A task holds a block of rows as a balanced tree of balls. For a search q a ball of centre c and radius r bounds the inner
products of its rows by q.c - |q| r and q.c + |q| r. A ball is left out if it lies outside the search's score window, or if
its upper bound is strictly beneath the search's current kth score; equal bounds are followed, since ties go by id.
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

LEAF = 128
SLACK = 1e-9


@dataclass(frozen=True)
class NegativeParams:
    """Window of a negative's score in percent of the positive's; sizes in components of a block."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: float = 256.0
    parts: int = 16
    held_size: int = 1 << 20
    passing_size: int = 1 << 20


class BallTree:
    """Rows in the order of a balanced binary tree; node i has the children 2i + 1 and 2i + 2."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.nodes: dict[int, tuple[int, int]] = {}
        self.centre: dict[int, np.ndarray] = {}
        self.radius: dict[int, float] = {}
        self.leaves: set[int] = set()
        todo = [(0, 0, len(points))]
        with np.errstate(all="ignore"):
            while todo:
                node, a, b = todo.pop()
                own = points[self.order[a:b]]
                centre = own.mean(axis=0)
                away = np.sqrt(((own - centre) ** 2).sum(axis=1))
                self.nodes[node], self.centre[node], self.radius[node] = (a, b), centre, float(away.max(initial=0))
                if b - a <= leaf:
                    self.leaves.add(node)
                    continue
                far = own[np.argmax(away)]  # cut along the line to the farthest row, half of the rows on each side
                cut = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition((own - centre) @ (far - centre), cut)]
                todo += [(2 * node + 1, a, a + cut), (2 * node + 2, a + cut, b)]
        self.points = points[self.order]

    def bounds(self, node: int, searches: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each search with the rows of the ball, widened by the rounding of doubles."""
        with np.errstate(all="ignore"):
            middle = searches @ self.centre[node]
            reach = norms * self.radius[node]
            slack = SLACK * (norms * np.sqrt((self.centre[node] ** 2).sum()) + reach) + SLACK
            low, high = middle - reach - slack, middle + reach + slack
        return np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)


class Block:
    """The held rows of a cell: tree, labels, ids, copies."""

    def __init__(self, batch: pa.Table, scale: float):
        self.raw = V.dense(batch.column("vec").combine_chunks(), scale)
        self.tree = BallTree(self.raw)
        at = self.tree.order
        ids = batch.column("id").combine_chunks()
        self.ids = [ids[int(i)].as_py() for i in at]
        self.place = V.id_order(ids)[at]
        self.labels = np.asarray(batch.column("label"), np.int64)[at]
        self.copies = np.asarray(batch.column("n"), np.int64)[at]


class Searches:
    """A batch of searches: owner (row of ``vecs``), score window and the keys found so far."""

    def __init__(self, vecs: np.ndarray, labels: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.vecs, self.labels, self.owner, self.low, self.high, self.k = vecs, labels, owner, low, high, k
        with np.errstate(all="ignore"):
            self.norms = np.sqrt((vecs**2).sum(axis=1))


def search_block(block: Block, s: Searches, same: bool) -> list[list[tuple[int, int]]]:
    """For each search the (score, row) of the best k rows of the block in its window, of its own label or of others."""
    tree, n = block.tree, len(block.ids)
    width = max(tree.points.shape[1], s.vecs.shape[1])
    points, vecs = V.widened(tree.points, width), V.widened(s.vecs, width)
    for node, c in tree.centre.items():
        tree.centre[node] = V.widened(c[None], width)[0]
    exact = V.sums_exact(points, vecs, width, n)
    kind = np.float64 if exact else object
    exact_points, exact_vecs = (points, vecs) if exact else (V.whole(points), V.whole(vecs))
    tie = n - 1 - block.place  # keys are score * n + tie: larger is better, no two are equal
    none = -np.inf
    keys = np.full((len(s.owner), s.k), none, kind)
    rows = np.zeros((len(s.owner), s.k), np.int64)

    def score_leaf(node: int, active: np.ndarray) -> None:
        a, b = tree.nodes[node]
        owners, back = np.unique(s.owner[active], return_inverse=True)
        scores = V.held_to_long(exact_vecs[owners] @ exact_points[a:b].T)[back]
        fits = (block.labels[a:b] == s.labels[s.owner[active]][:, None]) == same
        fits &= (scores >= s.low[active][:, None]) & (scores <= s.high[active][:, None])
        found = np.where(fits, scores * n + tie[a:b], none)
        better = (found > keys[active].min(axis=1)[:, None]).any(axis=1)
        active, found = active[better], found[better]
        if not len(active):
            return
        all_keys = np.concatenate([keys[active], found], axis=1)
        all_rows = np.concatenate([rows[active], np.broadcast_to(np.arange(a, b), found.shape)], axis=1)
        top = np.argpartition(all_keys, all_keys.shape[1] - s.k, axis=1)[:, -s.k :]
        keys[active], rows[active] = np.take_along_axis(all_keys, top, 1), np.take_along_axis(all_rows, top, 1)

    def alive(node: int, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = tree.bounds(node, vecs[s.owner[active]], s.norms[s.owner[active]])
        kth = np.floor(keys[active].min(axis=1).astype(np.float64) / n) * (1 - SLACK * np.sign(keys[active].min(axis=1).astype(np.float64)))
        keep = (high >= s.low[active].astype(np.float64)) & (low <= s.high[active].astype(np.float64) * (1 + SLACK) + 1) & (high >= kth - 1)
        return active[keep], high[keep]

    def descend(node: int, active: np.ndarray) -> None:
        """Branch and bound for all active searches at once, the child of the higher bounds first."""
        if node in tree.leaves:
            score_leaf(node, active)
            return
        sides = [(alive(child, active), child) for child in (2 * node + 1, 2 * node + 2)]
        sides.sort(key=lambda x: -float(x[0][1].sum()) if len(x[0][1]) else np.inf)
        for at, ((kept, _), child) in enumerate(sides):
            if at:
                kept = alive(child, kept)[0] if len(kept) else kept  # the first child may have raised the kth scores
            if len(kept):
                descend(child, kept)

    start, _ = alive(0, np.arange(len(s.owner)))
    if len(start):
        descend(0, start)
    out = []
    for k, r in zip(keys, rows, strict=True):
        out.append([(int((int(x) - int(tie[j])) // n), int(j)) for x, j in zip(k, r, strict=True) if x != none])
    return out


def _search(same: bool, k: int, scale: float, names: list[str]):
    """Arrow task over a grid that holds rows: a tree for each cell, then its searches in batches."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, block = None, [], None
        for at, side, piece in V.pieces(batches):
            if at != cell:
                cell, held, block = at, [], None
            if side == 0:
                held.append(piece)
                continue
            if not held:
                continue
            block = block or Block(pa.Table.from_batches(held), scale)
            for a in range(0, piece.num_rows, 1024):
                part = piece.slice(a, 1024)
                vecs = V.dense(part.column("vec"), scale)
                sizes = np.asarray(part.column("low").value_lengths(), np.int64)
                owner = np.repeat(np.arange(part.num_rows), sizes)
                low, high = (np.asarray(part.column(c).flatten(), np.int64) for c in ("low", "high"))
                ends = part.column("positive").flatten().to_pylist()
                s = Searches(vecs, np.asarray(part.column("label"), np.int64), owner, low, high, k)
                exact = np.full(part.num_rows, 0, object)
                for i, v in enumerate(vecs):
                    exact[i] = sum(int(x) ** 2 for x in v)
                own = V.held_to_long(exact).tolist()
                ids, hs = part.column("id").to_pylist(), part.column("h").to_pylist()
                out = []
                for i, found in enumerate(search_block(block, s, same)):
                    o = int(owner[i])
                    out += [(ids[o], hs[o], own[o], ends[i], score, block.ids[j], int(block.copies[j])) for score, j in found]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    return task


HITS = "anchor_id long, h long, own long, positive_score long, score long, vec_id long, n long"


def _hits(searches: DataFrame, rows: DataFrame, same: bool, k: int, parts: int, p: NegativeParams) -> DataFrame:
    """The best k rows of each block for each search; parts above 1 deal by label, which only searches of one label may."""
    part = (F.pmod(F.xxhash64("label"), F.lit(parts)) if parts > 1 else F.lit(0)).cast("int").alias("part")
    left = searches.select(part, "id", "h", "vec", "label", "low", "high", "positive")
    cells = V.grid(left, rows.select(part, "id", "h", "vec", "label", "n"), "rows", parts, p.held_size, p.passing_size)
    schema = fields(HITS)
    cols = ["part", "qb", "cb", "side", "id", "h", "vec", "label", "n", "low", "high", "positive"]
    return cells.select(*cols).mapInArrow(_search(same, k, p.scale, schema.names), schema)


def hard_negatives(anchors: DataFrame, rows: DataFrame, p: NegativeParams | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: negatives that nearly look positive.

    Both inputs are of ``vectors.usable_rows`` with labels; anchors are rows too. An anchor's positives are its
    ``positives`` best rows of its label, but for itself; a positive's negatives the best ``negatives`` rows of other
    labels whose score lies between ``low`` and ``high`` percent of the positive's, both ends included. Ties go to the
    smaller vec_id, an unknown id last. A positive of a negative score has an empty window, one of zero takes zero
    scores only. Fewer rows than asked for: all of them; none: no result. Each row of equal rows is an anchor, a
    positive and a negative of its own. Scores beyond a long count as its nearest end. No row is left out.
    """
    p = p or NegativeParams()
    every = [F.array(F.lit(x).cast("long")).alias(c) for c, x in (("low", V.LONG_MIN), ("high", V.LONG_MAX), ("positive", 0))]
    hits = _hits(anchors.select("*", *every), rows, True, p.positives + 1, p.parts, p)
    near = V.merged(hits.drop("positive_score"), ["anchor_id", "h"], p.positives, "own", "anchor_id")
    near = materialize(near.select("anchor_id", "h", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    window = near.filter("positive_score >= 0").groupBy("anchor_id", "h").agg(F.sort_array(F.collect_set("positive_score")).alias("positive"))
    scaled = lambda c, percent: c.cast("decimal(27,0)") * F.lit(percent).cast("decimal(9,0)") / F.lit(100).cast("decimal(3,0)")
    window = window.withColumn("low", F.transform("positive", lambda s: F.ceil(scaled(s, p.low)).cast("long")))
    window = window.withColumn("high", F.transform("positive", lambda s: F.floor(scaled(s, p.high)).cast("long")))
    window = window.withColumnsRenamed({"h": "h_", "anchor_id": "id_"})
    same_row = F.col("id").eqNullSafe(F.col("id_")) & (F.col("h") == F.col("h_"))
    searches = anchors.join(window, same_row).select("id", "h", "vec", "label", "low", "high", "positive")
    hits = _hits(searches, rows, False, p.negatives, 1, p).drop("own")
    found = V.merged(hits, ["anchor_id", "h", "positive_score"], p.negatives)
    found = found.select(F.col("anchor_id").alias("a_"), F.col("h").alias("h_"), F.col("positive_score").alias("s_"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    same_search = F.col("anchor_id").eqNullSafe(F.col("a_")) & (F.col("h") == F.col("h_")) & (F.col("positive_score") == F.col("s_"))
    pairs = near.join(found, same_search).drop("a_", "h_", "s_")
    repeated = anchors.filter("n > 1").select(F.col("id").alias("a_"), F.col("h").alias("h_"), "n")
    pairs = pairs.join(repeated, F.col("anchor_id").eqNullSafe(F.col("a_")) & (F.col("h") == F.col("h_")), "left")
    one = F.lit(1).cast("long")
    pairs = pairs.withColumn("n", F.explode(F.sequence(one, F.coalesce("n", one))))
    return pairs.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of the rows of ``embeddings`` with a vec_id divisible by 50, a seventh of the labels moved by one."""
    p = NegativeParams()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = materialize(V.usable_rows(table.withColumn("label", moved), p.scale, label_col="label"), "vectors")
    return hard_negatives(rows.filter("id % 50 = 0"), rows, p)


SQL_OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INT AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
