"""What the vector searches share: usable rows, blocks of searches against blocks of rows, the merge of their hits."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscalis.llm.common import place

LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1
EXACT = float(1 << 53)


def usable_rows(table: DataFrame, scale: float, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = None) -> DataFrame:
    """``(id long, h long, vec array<double>, label int, n long)``: each different row once, with its number of copies.

    Left out are rows whose vector is null or holds a component that is null or not finite (also after scaling), and,
    with a label column, rows without a label; without one ``label`` is 0. ``h`` tells rows of one id apart. The other
    columns of the table, of whatever name, are not read. A copy is told by id, label and vector, so that copies in any
    number meet as one row and a count.
    """
    by = table.toDF(*[f"c{i}" for i in range(len(table.columns))])
    name = lambda c: F.col(f"c{place(table.columns, c)}")
    label = name(label_col).cast("int") if label_col else F.lit(0)
    rows = by.select(name(id_col).cast("long").alias("id"), name(vec_col).cast("array<double>").alias("vec"), label.alias("label"))
    scaled = lambda x: F.abs(x * F.lit(float(scale)))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (scaled(x) < F.lit(float("inf"))))
    kept = rows.filter(F.col("vec").isNotNull() & F.col("label").isNotNull() & sound)
    counted = kept.groupBy("id", "label", "vec").agg(F.count("*").alias("n"))
    return counted.select("id", F.xxhash64("label", "vec").alias("h"), "vec", "label", "n")


def grid(searches: DataFrame, rows: DataFrame, held: str, parts: int, held_size: int, passing_size: int) -> DataFrame:
    """Cells ``(part, qb, cb)`` of one block of searches and one block of rows, the held side before the passing one.

    Both inputs have ``part``, ``id``, ``h`` and ``vec``; a search meets the rows of its part only. A block has at most
    about ``held_size`` or ``passing_size`` components, and a part has at least as many cells as fill the cluster, so
    the memory of a task does not grow with the tables. Every search of a part is copied to each of its blocks of rows,
    and every row to each of its blocks of searches. ``side`` is 0 for the held side (``"rows"`` or ``"searches"``).
    """
    spark = rows.sparkSession
    size = F.greatest(F.size("vec"), F.lit(1)).cast("long")
    sides = searches.select("part", size.alias("q"), F.lit(0).cast("long").alias("c")).unionByName(
        rows.select("part", F.lit(0).cast("long").alias("q"), size.alias("c"))
    )
    q_size, c_size = (passing_size, held_size) if held == "rows" else (held_size, passing_size)
    least = -(-2 * spark.sparkContext.defaultParallelism // parts)
    sums = sides.groupBy("part").agg(F.sum("q").alias("q"), F.sum("c").alias("c"))
    blocks = lambda c, n: F.greatest(F.ceil(F.col(c) / F.lit(n)), F.lit(1)).cast("int")
    cuts = sums.select("part", blocks("q", q_size).alias("nq"), blocks("c", c_size).alias("nc"))
    cuts = cuts.withColumn("nc", F.greatest("nc", F.ceil(F.lit(least) / F.col("nq")).cast("int")))
    cuts = F.broadcast(cuts)  # a row for each part, and the number of parts is a parameter
    own = lambda n, seed: F.pmod(F.xxhash64("id", "h", F.lit(seed)), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = searches.join(cuts, "part").withColumn("qb", own("nq", 1)).withColumn("cb", all_of("nc"))
    c = rows.join(cuts, "part").withColumn("cb", own("nc", 2)).withColumn("qb", all_of("nq"))
    q, c = (x.withColumn("side", F.lit(int(held != side))).drop("nq", "nc") for x, side in ((q, "searches"), (c, "rows")))
    cells = q.unionByName(c, allowMissingColumns=True)
    return cells.repartition("part", "qb", "cb").sortWithinPartitions("part", "qb", "cb", "side")


def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], int, pa.RecordBatch]]:
    """Slices of the batches of a sorted grid, each of one cell and one side."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k)) for k in ("part", "qb", "cb", "side")]
        cut = np.zeros(batch.num_rows, bool)
        for c in cols:
            cut[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(cut).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            yield tuple(int(c[a]) for c in cols[:3]), int(cols[3][a]), batch.slice(a, b - a)


def scaled(values: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)`` in doubles."""
    return np.floor(values * float(scale))


def dense(column: pa.ListArray, scale: float) -> np.ndarray:
    """The scaled vectors as a matrix; a shorter vector has zeros at its end."""
    flat = scaled(np.asarray(column.flatten(), np.float64), scale)
    ends = np.cumsum(np.asarray(column.value_lengths(), np.int64))
    sizes = np.diff(ends, prepend=0)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return out


def widened(matrix: np.ndarray, width: int) -> np.ndarray:
    """The matrix with columns of zeros up to ``width``."""
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1]))) if matrix.shape[1] < width else matrix


def whole(values: np.ndarray) -> np.ndarray:
    """The same whole numbers without a bound: Python's integers."""
    return np.frompyfunc(int, 1, 1)(values)


def sums_exact(left: np.ndarray, right: np.ndarray, terms: int, times: int = 1) -> bool:
    """Whether all sums of products of ``terms`` values, ``times`` over, are exact in doubles."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0))
    return (most * max(terms, 1) + 1) * max(times, 1) < EXACT


def held_to_long(scores: np.ndarray) -> np.ndarray:
    """Scores beyond a long count as its nearest end; in doubles they are exact already."""
    return np.minimum(np.maximum(scores, LONG_MIN), LONG_MAX) if scores.dtype == object else scores


def id_order(ids: pa.Array) -> np.ndarray:
    """The place of each row in ascending order of ids, nulls last."""
    known = np.asarray(ids.fill_null(0), np.int64)
    null = np.asarray(ids.is_null())
    at = np.empty(len(known), np.int64)
    at[np.lexsort((known, null))] = np.arange(len(known))
    return at


def merged(hits: DataFrame, keys: list[str], k: int, self_score: str | None = None, self_id: str | None = None) -> DataFrame:
    """The first ``k`` hits of each search over all blocks, with ``rank``; each copy of a row is a hit of its own.

    ``hits`` has ``score``, ``vec_id`` and ``n`` copies. Where ``self_score`` and ``self_id`` name columns, one hit with
    that id and that score is the searching row itself and goes; it does not matter which of several, as they are equal
    in all that is returned. Blocks must then give ``k + 1`` rows. A search has ``k + 1`` rows of each block at most,
    and Spark cuts them to the first ranks before they move.
    """
    reach = k + 1 if self_score else k
    copies = hits.withColumn("n", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(reach)).cast("int"))))
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    first = copies.drop("n").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= reach)
    if not self_score:
        return first
    own = F.when(F.col("vec_id").eqNullSafe(F.col(self_id)) & (F.col("score") == F.col(self_score)), F.col("rank"))
    first = first.withColumn("own", F.coalesce(F.min(own).over(Window.partitionBy(*keys)), F.lit(reach + 1)))
    first = first.filter(F.col("rank") != F.col("own"))
    first = first.withColumn("rank", F.col("rank") - (F.col("rank") > F.col("own")).cast("int")).drop("own")
    return first.filter(F.col("rank") <= k)
