"""Toxicity scores by a factorization machine over hashed terms.

score = sigmoid(b + sum_i w_i + sum_{i<j} <v_i, v_j>) over the distinct hashed terms of a text: the pairwise part
learns interactions (an insult together with a group mention) that additive weights cannot express. It is fitted on
a bounded sample of labelled rows; texts are scored whole, one pass, without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalis.llm.common import fields, fresh, place

#: A-Z to a-z, other ASCII characters than letters and digits to spaces, bytes of other scripts unchanged.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


@dataclass(frozen=True)
class ToxicityParams:
    """``max_train_rows`` bounds the labelled sample, and that the terms: any that tells alone or in a pair has weights.

    ``prior`` is the score of every text where nothing is labelled.
    """

    bits: int = 20
    factors: int = 8
    max_train_rows: int = 8_000
    min_docs: int = 8
    min_chi2: float = 20.0
    min_pair: float = 40.0
    epochs: int = 40
    spread: float = 0.01
    lead: float = 0.3
    batch: int = 64
    rate: float = 0.1
    l2: float = 1e-4
    seed: int = 17
    threshold: float = 0.3
    prior: float = 0.1


def _hashed(wide: np.ndarray, n: int) -> np.ndarray:
    h = np.zeros(len(wide) - n + 1, np.uint64)
    for k in range(n):
        h *= np.uint64(0x100000001B3)
        h += wide[k : k + len(h)]
    return h


def _slots(h: np.ndarray, bits: int) -> np.ndarray:
    return (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def word_slots(text: bytes | None, bits: int) -> np.ndarray:
    """The distinct hashed words of a text, ascending."""
    words = set((text or b"").translate(_FOLD).split())
    return np.unique(np.array([crc32(w) * 0x9E3779B1 % (1 << 32) >> (32 - bits) for w in words], np.int64))


def term_slots(text: bytes | None, bits: int) -> np.ndarray:
    """The distinct hashed terms of a text, ascending: its words, and the runs of 4 and of 6 bytes inside a word and its
    borders, so that inflected and compounded forms of a word share terms. Runs are hashed for the whole text at once.
    """
    raw = np.frombuffer(b" " + (text or b"").translate(_FOLD) + b" ", np.uint8)
    gap = np.concatenate([[0], np.cumsum(raw == 32)])
    wide = raw.astype(np.uint64)
    found = [word_slots(text, bits)]
    for n in (4, 6):
        m = len(raw) - n + 1
        if m > 0:
            inner = gap[n - 1 : n - 1 + m] == gap[1 : 1 + m]
            found.append(_slots(_hashed(wide, n)[inner], bits).astype(np.int64))
    return np.unique(np.concatenate(found))


def interacting(rows: list[np.ndarray], labels: np.ndarray, p: ToxicityParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every pair of terms that tells about the label together: ``(slot, slot, signed score)``.

    The score test of a product of two centred presences, over all pairs of terms that ``p.min_docs`` rows hold and
    ``p.min_docs`` do not, and that occur together; none is left out. Terms of a sixteenth of the rows or more are met in
    dense blocks, the others through the rows that hold them.
    """
    n = len(rows)
    slots, dense = np.unique(np.concatenate(rows), return_inverse=True) if n else (np.empty(0, np.int64), np.empty(0, np.int64))
    count = np.bincount(dense, minlength=len(slots))
    able = np.flatnonzero((count >= p.min_docs) & (count <= n - p.min_docs))
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    if len(able) < 2 or labels.min() == labels.max():
        return none
    able = able[np.argsort(-count[able], kind="stable")]  # the most frequent first
    at = np.full(len(slots), -1)
    at[able] = np.arange(len(able))
    sizes, cols = np.array([len(r) for r in rows]), at[dense]
    owner = np.repeat(np.arange(n), sizes)[cols >= 0]
    cols = cols[cols >= 0]
    rest, share = labels - labels.mean(), count[able] / n
    pull = np.bincount(cols, rest[owner], len(able))
    lean = 1 - 2 * share
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def keep(i: np.ndarray, j: np.ndarray, moved: np.ndarray, both: np.ndarray) -> None:
        gap = moved - share[j] * pull[i] - share[i] * pull[j]
        own, other = share[i] ** 2, share[j] ** 2
        spread = lean[i] * lean[j] * both + n * (other * lean[i] * share[i] + own * lean[j] * share[j] + own * other)
        z = gap / np.sqrt(np.maximum(spread * labels.var(), 1e-9))
        told = np.flatnonzero((z * z >= p.min_pair) & (both > 0))
        found.append((i[told], j[told], z[told]))

    frequent, step = int((count[able] >= n / 16).sum()), 1024
    starts = range(0, frequent, step)

    def block(a: int) -> np.ndarray:
        x = np.zeros((n, min(step, frequent - a)), np.float32)
        inside = (cols >= a) & (cols < a + x.shape[1])
        x[owner[inside], cols[inside] - a] = 1
        return x

    for a in starts:
        x = block(a)
        signed = x * rest[:, None].astype(np.float32)
        for b in range(a, frequent, step):
            y = x if a == b else block(b)
            moved, both = signed.T @ y, x.T @ y
            i, j = np.nonzero(np.triu(both, 1) if a == b else both)
            keep(i + a, j + b, moved[i, j].astype(float), both[i, j])
    order = np.lexsort((cols, owner))
    owner, cols = owner[order], cols[order]
    first = np.searchsorted(owner, np.arange(n + 1))
    by_term = np.argsort(cols, kind="stable")
    of_term = np.searchsorted(cols[by_term], np.arange(len(able) + 1))
    for i in range(frequent, len(able)):
        held = owner[by_term[of_term[i] : of_term[i + 1]]]
        parts = [cols[first[k] : first[k + 1]] for k in held.tolist()]
        near = np.concatenate([c[: np.searchsorted(c, i)] for c in parts])  # each pair once: the partner is more frequent
        if not len(near):
            continue
        weight = np.repeat(rest[held], [int(np.searchsorted(c, i)) for c in parts])
        both, moved = np.bincount(near, minlength=i), np.bincount(near, weight, i)
        j = np.flatnonzero(both)
        keep(np.full(len(j), i), j, moved[j], both[j])
    if not found:
        return none
    i, j, z = (np.concatenate(c) for c in zip(*found, strict=True))
    return slots[able[i]], slots[able[j]], z


def informative(rows: list[np.ndarray], labels: np.ndarray, p: ToxicityParams, words: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The terms that tell about the label alone or together with another, ascending, and first factors of them.

    Alone: chi-square of the presence. Together: :func:`interacting`, over ``words`` where they are given apart, else
    over all terms. The leading directions of the signed pairs are the first factors, of length ``p.lead`` at most, so
    that the fit does not wait for chance to find an interaction of terms that tell nothing alone.
    """
    size = 1 << p.bits
    with_term, toxic = np.zeros(size), np.zeros(size)
    for row, y in zip(rows, labels, strict=True):
        with_term[row] += 1
        toxic[row] += y
    n, n1 = len(rows), labels.sum()
    gap = toxic * n - with_term * n1
    spread = np.maximum(with_term * (n - with_term) * n1 * (n - n1), 1)
    alone = np.flatnonzero((with_term >= p.min_docs) & (n * gap * gap / spread >= p.min_chi2))
    a, b, z = interacting(rows if words is None else words, labels, p)
    told = np.union1d(a, b)
    slots = np.union1d(alone, told)
    first = np.zeros((len(slots), p.factors))
    if len(told):
        first[np.searchsorted(slots, told)] = _leading(len(told), np.searchsorted(told, a), np.searchsorted(told, b), z, p)
    return slots, first


def _leading(size: int, i: np.ndarray, j: np.ndarray, z: np.ndarray, p: ToxicityParams) -> np.ndarray:
    """Directions of the greatest positive eigenvalues of the symmetric matrix of pairs, by orthogonal iteration."""
    k = min(p.factors, size)
    times = lambda v: np.stack([np.bincount(i, z * v[j, c], size) + np.bincount(j, z * v[i, c], size) for c in range(k)], axis=1)
    shift = float((np.bincount(i, np.abs(z), size) + np.bincount(j, np.abs(z), size)).max())  # makes all eigenvalues positive
    v = np.linalg.qr(np.random.default_rng(p.seed).normal(size=(size, k)))[0]
    for _ in range(50):
        v = np.linalg.qr(times(v) + shift * v)[0]
    values, turn = np.linalg.eigh(v.T @ times(v))
    lead = (v @ turn) * np.sqrt(np.maximum(values, 0))
    out = np.zeros((size, p.factors))
    out[:, :k] = lead * (p.lead / max(1e-9, float(np.sqrt((lead * lead).sum(axis=1)).max())))
    return out


@dataclass
class FactorizationMachine:
    """``slots`` (sorted) are the hashed terms that carry weights; a term outside of them has none."""

    slots: np.ndarray
    bias: float
    w: np.ndarray
    v: np.ndarray

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        """Raw scores of rows of hashed terms; terms without weights are left out."""
        out = np.full(len(rows), self.bias)
        if not len(self.slots):
            return out
        for i, row in enumerate(rows):
            at = np.minimum(np.searchsorted(self.slots, row), len(self.slots) - 1)
            at = at[self.slots[at] == row]
            vs = self.v[at]
            total = vs.sum(axis=0)
            out[i] += self.w[at].sum() + 0.5 * float((total * total).sum() - (vs * vs).sum())
        return out

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rows), -30, 30)))


def fit_fm(rows: list[np.ndarray], labels: np.ndarray, p: ToxicityParams, words: list[np.ndarray] | None = None) -> FactorizationMachine:
    """Adagrad over mini-batches, log loss. Without both labels the machine has a bias only. ``words``: as in :func:`informative`."""
    share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else p.prior
    bias = float(np.log(share / (1 - share)))
    slots, first = informative(rows, labels, p, words) if len(rows) else (np.empty(0, np.int64), np.zeros((0, p.factors)))
    rng = np.random.default_rng(p.seed)
    n = len(slots)
    w, v = np.zeros(n), first + rng.normal(0, p.spread, (n, p.factors))
    if not n or labels.min(initial=0) == labels.max(initial=0):
        return FactorizationMachine(slots, bias, w.astype(np.float32), np.zeros((n, p.factors), np.float32))
    where = [np.searchsorted(slots, r[np.isin(r, slots, assume_unique=True)]) for r in rows]
    gb, gw, gv = 1.0, np.ones(n), np.ones((n, p.factors))
    for _ in range(p.epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), p.batch):
            part = order[at : at + p.batch]
            sizes = np.array([len(where[i]) for i in part])
            idx = np.concatenate([where[i] for i in part])
            doc = np.repeat(np.arange(len(part)), sizes)
            vs = v[idx]
            total = np.stack([np.bincount(doc, vs[:, k], len(part)) for k in range(p.factors)], axis=1)
            squares = np.bincount(doc, (vs * vs).sum(axis=1), len(part))
            margin = bias + np.bincount(doc, w[idx], len(part)) + 0.5 * ((total * total).sum(axis=1) - squares)
            err = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[part]) / len(part)
            e = err[doc]
            used = np.unique(idx)
            pull = np.bincount(idx, e, n)[used] + p.l2 * w[used]
            gw[used] += pull * pull * len(part) ** 2
            w[used] -= p.rate * len(part) ** 0.5 * pull / np.sqrt(gw[used])
            for k in range(p.factors):
                pull = np.bincount(idx, e * (total[doc, k] - vs[:, k]), n)[used] + p.l2 * v[used, k]
                gv[used, k] += pull * pull * len(part) ** 2
                v[used, k] -= p.rate * len(part) ** 0.5 * pull / np.sqrt(gv[used, k])
            g = float(err.sum())
            gb += g * g * len(part) ** 2
            bias -= p.rate * len(part) ** 0.5 * g / gb**0.5
    return FactorizationMachine(slots, bias, w.astype(np.float32), v.astype(np.float32))


def _held_out(doc_id):
    """Rows whose CRC-32 of the id as text leaves 2 on division by 4 are never learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def train_toxicity(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams()) -> FactorizationMachine:
    """Fit on at most ``p.max_train_rows`` labelled rows, the first by a hash of the id; null labels are left out."""
    usable = labels.filter(~_held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    one = usable.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("y"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.max_train_rows)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    bits = p.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1).cast(pa.binary())]
            terms, words = (pa.array([of(t, bits).astype(np.int32) for t in texts], pa.list_(pa.int32())) for of in (term_slots, word_slots))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), terms, words], schema.names)

    schema = fields(f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, y int, terms array<int>, words array<int>")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        found = pa.Table.from_batches(held) if held else None
        if found is None:
            model = fit_fm([], np.empty(0), p)
        else:
            ids, parts = found["doc_id"].to_pylist(), {}
            for c in ("terms", "words"):
                lists = found[c].combine_chunks()
                ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                parts[c] = np.split(lists.flatten().to_numpy(), ends[1:-1])
            at = sorted(range(len(ids)), key=lambda i: (str(ids[i]), len(parts["terms"][i])))
            rows, words = ([parts[c][i] for i in at] for c in ("terms", "words"))
            model = fit_fm(rows, found["y"].to_numpy().astype(float)[at], p, words)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # the sample is bounded, so one task fits the machine; the driver gets the weights only
    sampled = texts.select("doc_id", "text", "y").mapInArrow(run, schema).repartition(1)
    return pickle.loads(sampled.mapInArrow(fit, fields("model binary")).first().model)


def score_toxicity(
    docs: DataFrame, model: FactorizationMachine, p: ToxicityParams = ToxicityParams(), score_col: str = "score"
) -> DataFrame:
    """``docs`` with ``score_col double`` (0 to 1) in place of any column of that name; whole texts, one row per row.

    Null and empty texts get the score of no terms; an empty table gives no rows. The model is broadcast; its size is
    bounded by the labelled rows.
    """
    bits = p.bits
    keep = [c for c in docs.columns if c.lower() != score_col.lower()]
    kept = docs.select(*[F.col(f"`{c}`") for c in keep]).withColumn(score_col, F.lit(0.0))
    at = place(keep, "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm = shared.value
        for batch in batches:
            texts = batch.column(at).cast(pa.string()).cast(pa.binary())
            scores = [float(fm.scores([term_slots(t.as_py(), bits)])[0]) for t in texts]
            cols = [batch.column(i) for i in range(len(keep))] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

    return kept.mapInArrow(run, kept.schema)


def toxicity(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams()) -> DataFrame:
    """Train on the labelled part and score every row of ``docs``."""
    return score_toxicity(docs, train_toxicity(docs, labels, p), p)


def drop_toxic(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``docs`` without the rows that reach the threshold; all columns are passed on.

    Null and empty texts get the score of no terms; repeated rows go or stay alike; texts count whole. Without labels the
    machine has a bias below the threshold only, and all rows stay; an empty table stays empty.
    """
    name = fresh(docs.columns, "toxicity")
    scored = score_toxicity(docs, train_toxicity(docs, labels, p), p, name)
    return scored.filter(F.col(name) < p.threshold).drop(name)


def op9_toxicity_fm(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``."""
    p = ToxicityParams()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), p)
    scored = score_toxicity(docs.select("doc_id", "text"), model, p)
    return scored.select(
        "doc_id",
        _held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= p.threshold).cast("int").alias("predicted"),
    )
