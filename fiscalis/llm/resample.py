"""Importance resampling towards a target text: hashed n-gram features, counted and scored over suffix arrays of word ids.

Each Arrow batch of a partition becomes one array of word ids. Its suffixes are sorted by their first ``max_n`` words, and
the longest common prefixes of neighbours cut them into runs of equal n-grams, one cut for each n. A run is hashed once,
and its bucket is scattered back to the places of its occurrences. The corpus and the target are counted by bucket; a
document's weight is the mean of the log ratios of its features, and noise of its id turns the highest scores into a draw.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscalis.llm.common import fields, materialize, place


@dataclass(frozen=True)
class ResampleParams:
    """``percent`` of the documents with ``min_words`` or more words are drawn; ``seed`` names the noise."""

    max_n: int = 1
    buckets: int = 10000
    min_words: int = 20
    percent: int = 10
    seed: int = 2024


def _letters() -> bytes:
    """Byte to byte: A-Z to a-z, digits, a-z and all beyond ASCII to themselves, the rest to spaces."""
    table = bytearray(b" " * 256)
    for a, b in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[a : b + 1] = bytes(range(a, b + 1))
    table[0x41:0x5B] = bytes(range(0x61, 0x7B))
    return bytes(table)


LETTERS = _letters()


class WordIds(dict):
    """word -> number in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def suffix_array(ids: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their next ``depth`` words, by prefix doubling; a suffix ends with its document."""
    order, rank, width = np.argsort(ids, kind="stable"), ids.astype(np.int64), 1
    while width < depth:
        after = np.arange(len(ids)) + width
        second = np.full(len(ids), -1, np.int64)
        inside = after < ends
        second[inside] = rank[after[inside]]
        order = np.lexsort((second, rank))
        a, b = order[1:], order[:-1]
        fresh = np.append([0], ((rank[a] != rank[b]) | (second[a] != second[b])).cumsum()) if len(ids) else order
        rank = np.empty(len(ids), np.int64)
        rank[order] = fresh
        width *= 2
    return order


def common_prefixes(ids: np.ndarray, ends: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Words, ``depth`` at most, that each suffix shares with the one before it in ``order``; 0 for the first."""
    lcp = np.zeros(len(order), np.int64)
    a, b = order[1:], order[:-1]
    alive = np.ones(max(len(order) - 1, 0), bool)
    for j in range(depth):
        alive &= (a + j < ends[a]) & (b + j < ends[b])
        at = np.flatnonzero(alive)
        alive[at] = ids[a[at] + j] == ids[b[at] + j]
        lcp[1:] += alive
    return lcp


def feature_buckets(words: list[bytes], sizes: np.ndarray, max_n: int, buckets: int) -> list[np.ndarray]:
    """For each n up to ``max_n`` the bucket of the n-gram that starts at each place, -1 where the document is too short."""
    known = WordIds()
    ids = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
    ends = np.repeat(np.cumsum(sizes), sizes)
    order = suffix_array(ids, ends, max_n)
    lcp = common_prefixes(ids, ends, order, max_n)
    out = []
    for n in range(1, max_n + 1):
        head = lcp < n  # a new run begins where fewer than n words are shared
        firsts = order[head]
        hashes = np.array([crc32(words[i] if n == 1 else b" ".join(words[i : i + n])) for i in firsts.tolist()], np.int64) % buckets
        at = np.empty(len(words), np.int64)
        at[order] = hashes[np.cumsum(head) - 1] if len(words) else 0
        at[np.arange(len(words)) + n > ends] = -1
        out.append(at)
    return out


def _tokenized(texts: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts of a batch, one after the other, and their number in each text."""
    words: list[bytes] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text.is_valid:
            own = text.as_buffer().to_pybytes().translate(LETTERS).split()
            sizes[i] = len(own)
            words += own
    return words, sizes


def _text_of(df: DataFrame, *names: str) -> DataFrame:
    renamed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return renamed.select(*[F.col(f"c{place(df.columns, name)}").alias(name) for name in names])


def bucket_counts(df: DataFrame, p: ResampleParams, text_col: str = "text") -> DataFrame:
    """``(bucket, n)``: features of all texts in each bucket; buckets without one are absent."""
    schema = fields("bucket int, n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(p.buckets, np.int64)
        for batch in batches:
            words, sizes = _tokenized(batch.column(0))
            for at in feature_buckets(words, sizes, p.max_n, p.buckets) if words else ():
                total += np.bincount(at[at >= 0], minlength=p.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], schema.names)

    texts = _text_of(df, text_col).filter(F.col(text_col).isNotNull())
    return texts.mapInArrow(count, schema).groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, p: ResampleParams, text_col: str = "text") -> DataFrame:
    """``(bucket, gain long)`` for every bucket: floor(1000 ln of the smoothed ratio of target to corpus)."""
    zero = F.lit(0).cast("long")
    counts = bucket_counts(docs, p, text_col).select("bucket", F.col("n").alias("corpus"), zero.alias("goal"))
    counts = counts.unionByName(bucket_counts(target, p, text_col).select("bucket", zero.alias("corpus"), F.col("n").alias("goal")))
    every = docs.sparkSession.range(p.buckets).select(F.col("id").cast("int").alias("bucket"), zero.alias("corpus"), zero.alias("goal"))
    counts = counts.unionByName(every).groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("goal").alias("goal"))
    all_rows = Window.partitionBy()  # a row for each bucket
    more = lambda c, by: c.cast("double") + F.lit(float(by))
    above = more(F.col("goal"), 1) * more(F.sum("corpus").over(all_rows), p.buckets)
    below = more(F.col("corpus"), 1) * more(F.sum("goal").over(all_rows), p.buckets)
    return counts.select("bucket", F.floor(1000 * F.ln(above / below)).alias("gain"))


def document_weights(docs: DataFrame, gains: np.ndarray, p: ResampleParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_features, weight)``: the floored mean of the gains of a document's features, 0 without any."""
    own = _text_of(docs, id_col, text_col)
    schema = fields("n_words long, n_features long, weight long")
    schema.fields.insert(0, own.schema[id_col])
    schema.names.insert(0, id_col)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, sizes = _tokenized(batch.column(1))
            ends = np.cumsum(sizes)
            count, total = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for at in feature_buckets(words, sizes, p.max_n, p.buckets) if words else ():
                for into, values in ((count, at >= 0), (total, np.where(at >= 0, gains[at], 0))):
                    sums = np.append(0, np.cumsum(values, dtype=np.int64))
                    into += sums[ends] - sums[ends - sizes]
            weight = total // np.maximum(count, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(count), pa.array(weight)], schema.names)

    return own.mapInArrow(weigh, schema)


def noisy_scores(weights: DataFrame, p: ResampleParams, id_col: str = "doc_id") -> DataFrame:
    """``score``: the weight plus a floored Gumbel number made from the id."""
    text = F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return weights.withColumn("score", F.col("weight") + gumbel)


def draw(scored: DataFrame, p: ResampleParams, id_col: str = "doc_id") -> DataFrame:
    """``rank`` of the drawn documents, null for the others: the highest scores, ties to smaller ids, an unknown id last.

    Scores are whole numbers between bounds that the buckets and the noise set, so the number of documents above each
    score is a small table; only the order within one score needs its rows together, and the noise spreads documents of
    equal weight over thousands of scores. No step orders all documents in one task.
    """
    level = F.when(F.col("n_words") >= p.min_words, F.col("score"))
    scored = scored.withColumn("level", level)
    levels = scored.filter("level is not null").groupBy("level").agg(F.count("*").alias("here"))
    running = Window.orderBy(F.desc("level"))  # a row for each score that occurs
    levels = levels.select("level", (F.sum("here").over(running) - F.col("here")).alias("above"), F.sum("here").over(Window.partitionBy()).alias("all"))
    levels = levels.withColumn("quota", F.expr(f"{p.percent} * all div 100")).filter("above < quota").drop("all")
    near = scored.join(levels, "level", "left")
    order = Window.partitionBy("level").orderBy(F.asc_nulls_last(id_col))
    rank = F.col("above") + F.row_number().over(order)
    drawn = near.filter("above is not null").withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= F.col("quota"), F.col("rank")))
    rest = near.filter("above is null").withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("level", "above", "quota")


def resample(docs: DataFrame, target: DataFrame, p: ResampleParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_features, weight, score, rank)`` of every document of ``docs``, drawn towards the texts of ``target``.

    A null text has no word and an empty text neither: no feature, weight 0. Texts of any length count whole. Repeated
    rows count and are drawn as rows of their own. A null id draws its noise from the empty text. An empty target gives
    every bucket the same smoothed share; an empty table of documents an empty result. Columns of other names are not read.
    """
    p = p or ResampleParams()
    found = bucket_gains(docs, target, p, text_col).collect()  # one number for each bucket, a parameter
    gains = np.zeros(p.buckets, np.int64)
    for row in found:
        gains[row.bucket] = row.gain
    weights = document_weights(docs, gains, p, id_col, text_col)
    return draw(materialize(noisy_scores(weights, p, id_col), "resample"), p, id_col)


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` weighed towards ``benchmark``; a tenth of those with 20 words or more drawn by score."""
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resample(docs, target, ResampleParams()).select("doc_id", "n_features", "weight", "score", "rank")


SQL_OP12 = r"""
WITH RECURSIVE step(b, i, c) AS (
  SELECT b, 0, b::BIGINT FROM range(256) r(b)
  UNION ALL SELECT b, i + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM step WHERE i < 8
), crc AS (SELECT list(c ORDER BY b) AS t FROM step WHERE i = 8
), words AS (
  SELECT doc_id, 0 AS kind, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT NULL, 1, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), counts AS (SELECT kind, doc_id, word, count(*) AS n FROM (SELECT kind, doc_id, unnest(w) AS word FROM words) GROUP BY ALL
), named AS (
  SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM counts)
), hashed AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(x), 2), lambda i: ('0x' || x[i:i+1])::BIGINT)),
         lambda a, v: xor(a // 256, t[(xor(a, v) & 255) + 1]))) % 10000 AS bucket
  FROM named, crc
), totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 0), 0) AS s, coalesce(sum(n) FILTER (kind = 1), 0) AS t FROM counts JOIN hashed USING (word) GROUP BY bucket
), sums AS (SELECT coalesce(sum(s), 0)::DOUBLE AS S_, coalesce(sum(t), 0)::DOUBLE AS T_ FROM totals
), gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (S_ + 10000) / ((s + 1)::DOUBLE * (T_ + 10000))))::BIGINT AS gain FROM totals, sums
), weights AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight FROM counts JOIN hashed USING (word) JOIN gains USING (bucket) WHERE kind = 0 GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || d.doc_id)[1:8])::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM documents d LEFT JOIN weights USING (doc_id)
), able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, 10 * count(*) OVER () // 100 AS quota FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN r <= quota THEN r END AS rank FROM scored s LEFT JOIN able USING (doc_id)
"""
