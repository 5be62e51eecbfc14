"""Best-fit packing of tokenised documents into sequences by linear grouping.

Lengths are integers up to the sequence length, so the histogram of lengths, whose size does not depend on the data,
decides everything: large lengths are rounded up within groups of equal cardinality, few-size configurations are
chosen for the groups, the actual lengths take the places of the rounded ones, and small ones go where they fit best.
The plan speaks of ranks within a length; documents meet it by their rank, without any ordering of all documents.
"""

from __future__ import annotations

import base64
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscalis.llm.common import fields, materialize

CAPACITY = 1024
END_ID = 2
LONG_RUN = 4096
#: Matches whole texts without a run of that length; possessive, so each character is looked at once.
_SHORT_RUNS = re.compile(rf"(?:\S{{1,{LONG_RUN - 1}}}+(?!\S)|\s{{1,{LONG_RUN - 1}}}+(?!\s))*+")


@dataclass(frozen=True)
class PackingParams:
    """Lengths above ``capacity / small_part`` are large and form at most ``groups`` groups."""

    capacity: int = CAPACITY
    small_part: int = 4
    groups: int = 2000


def tokenizer_file() -> str:
    """The byte-level BPE vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str):
    """``text -> ids`` of a byte-level BPE tokenizer file, as it encodes a text without adding special tokens.

    If the same vocabulary lies beside it as ranks, the rank encoder serves, which gives equal ids several times
    faster (``tests/llm/test_packing.py`` compares them). Two kinds of texts go to the file's own tokenizer: those that
    hold the literal of one of its added tokens, which it turns into that token's id, and those with a run of
    ``LONG_RUN`` characters or more without a border of white space, since the rank encoder's pattern matching goes as
    deep as such a run is long and ends the process on a million spaces.
    """
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    plain: list = []

    def by_file(text: str) -> list[int]:
        if not plain:
            plain.append(file_encoder(path))
        return plain[0](text)

    try:
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(path, encoding="utf-8") as f:
            added = [x["content"] for x in json.load(f)["added_tokens"]]
    except (ImportError, FileNotFoundError):
        return by_file
    ranked = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(x in text for x in added) or (len(text) >= LONG_RUN and not _SHORT_RUNS.fullmatch(text)):
            return by_file(text)
        return ranked.encode_ordinary(text)

    return encode


def file_encoder(path: str):
    """``text -> ids`` by the tokenizer file itself, as loaded."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    return lambda text: own.encode(text, add_special_tokens=False).ids


def tokenize_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of every row of ``docs (doc_id, text)``: ``doc_id, piece, start, length, ids_crc32, part, local_rank[, ids]``.

    A document is its ids and then id 2; a null text has no ids of its own. Longer documents are cut so that all
    pieces but the first are full. ``local_rank`` counts pieces of one length within the task ``part``; the result
    must be written before its ranks are used.
    """
    path = tokenizer or tokenizer_file()
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, local_rank long"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            rows, piece, start, length, crc, rank, ids_out = [], [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "")
                ids.append(END_ID)
                ids = np.array(ids, "<u4")
                at, k = 0, 0
                size = len(ids) % capacity or capacity
                while at < len(ids):
                    own = ids[at : at + size]
                    rows.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(crc32(own.tobytes()))
                    rank.append(int(seen[size]))
                    if with_ids:
                        ids_out.append(own.astype(np.int32))
                    seen[size] += 1
                    at, k, size = at + size, k + 1, capacity
            cols = [
                batch.column(0).take(pa.array(rows, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(rows), pa.int32()), pa.array(rank, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank"]
            if with_ids:
                cols.append(pa.array(ids_out, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, fields(schema))


class _Shelf:
    """Runs of sequences that are filled alike: ``(first sequence, how many, filled)``; places one item in each of a run."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.used: Counter = Counter()
        self.sequences = 0
        self.rows: list[tuple[int, int, int, int, int]] = []

    def open(self, n: int) -> tuple[int, int, int]:
        self.sequences += n
        return self.sequences - n, n, 0

    def put(self, run: tuple[int, int, int], length: int, n: int) -> tuple[tuple[int, int, int], tuple[int, int, int] | None]:
        """One item of ``length`` in each of the first ``n`` sequences: the run that got them, and the rest."""
        first, many, filled = run
        rank = self.used[length]
        self.used[length] += n
        self.rows.append((length, rank, rank + n, first, filled))
        return (first, n, filled + length), ((first + n, many - n, filled) if many > n else None)


def _configuration(sizes: list[int], left: list[int], capacity: int) -> Counter:
    """A configuration with the largest size that is left and the fullest completion by the sizes that are left.

    Dynamic programming over fill, sizes descending, at most ``left`` of each; among equal fills the one found first,
    with larger sizes, stays.
    """
    head = next(i for i, n in enumerate(left) if n)
    room = capacity - sizes[head]
    via = np.full(room + 1, -1, np.int64)
    via[0] = -2
    for i in range(head, len(sizes)):
        s, most = sizes[i], left[i] - (i == head)
        if s > room or not most:
            continue
        for _ in range(min(most, room // s)):
            new = np.flatnonzero((via[:-s] != -1) & (via[s:] == -1)) + s
            if not len(new):
                break
            via[new] = i
        if via[room] != -1:
            break
    fill = int(np.flatnonzero(via != -1)[-1])
    out = Counter([head])
    while fill:
        i = int(via[fill])
        out[i] += 1
        fill -= sizes[i]
    return out


def plan_packing(histogram: dict[int, int], p: PackingParams = PackingParams()) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """``{length: count}`` -> placements ``(length, rank from, rank to, first sequence, offset)`` and the number of sequences.

    Rank r of a length, in ``[from, to)``, goes to sequence ``first + r - from`` at ``offset``.
    """
    shelf = _Shelf(p.capacity)
    full = histogram.get(p.capacity, 0)
    if full:
        shelf.put(shelf.open(full), p.capacity, full)
    border = p.capacity // p.small_part
    large = [(s, histogram[s]) for s in sorted(histogram, reverse=True) if border < s < p.capacity and histogram[s]]
    total = sum(n for _, n in large)
    step = max(1, -(-total // p.groups))
    groups: list[list[list[int]]] = []
    room = 0
    for s, n in large:
        while n:
            if not room:
                groups.append([])
                room = step
            take = min(n, room)
            groups[-1].append([s, take])
            n, room = n - take, room - take
    sizes = [g[0][0] for g in groups]
    left = [sum(n for _, n in g) for g in groups]
    runs: list[tuple[int, int, int]] = []
    while any(left):
        found = _configuration(sizes, left, p.capacity)
        times = min(left[i] // k for i, k in found.items())
        open_runs = [shelf.open(times)]
        for i, k in sorted(found.items()):
            left[i] -= k * times
            for _ in range(k):
                filled = []
                for run in open_runs:
                    rest: tuple[int, int, int] | None = run
                    while rest is not None:
                        piece = groups[i][0]
                        n = min(piece[1], rest[1])
                        done, rest = shelf.put(rest, piece[0], n)
                        filled.append(done)
                        piece[1] -= n
                        if not piece[1]:
                            groups[i].pop(0)
                open_runs = filled
        runs += open_runs
    gaps: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for run in runs:
        gaps[p.capacity - run[2]].append(run)
    for s in range(border, 0, -1):
        n = histogram.get(s, 0)
        while n:
            gap = next((g for g in range(s, p.capacity + 1) if gaps.get(g)), None)
            if gap is None:
                gaps[p.capacity].append(shelf.open(-(-n // (p.capacity // s))))
                continue
            run = gaps[gap].pop()
            take = min(n, run[1])
            done, rest = shelf.put(run, s, take)
            gaps[gap - s].append(done)
            if rest:
                gaps[gap].append(rest)
            n -= take
    return shelf.rows, shelf.sequences


def pack_pieces(pieces: DataFrame, p: PackingParams = PackingParams()) -> DataFrame:
    """Written ``pieces`` of :func:`tokenize_pieces` with ``sequence_id long, offset long``.

    The driver sees one count per length; the placements, whose number is bounded by the capacity, are broadcast.
    """
    spark = pieces.sparkSession
    counts = {int(r.length): int(r.n) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows, _ = plan_packing(counts, p)
    plan = spark.createDataFrame(rows or [(0, 0, 0, 0, 0)], "length long, r0 long, r1 long, seq0 long, offset long")
    per_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "part"]).withColumn("rank", F.col("base") + F.col("local_rank"))
    fits = (ranked["length"] == plan["length"]) & (ranked["rank"] >= plan["r0"]) & (ranked["rank"] < plan["r1"])
    placed = ranked.join(F.broadcast(plan), fits).withColumn("sequence_id", F.col("seq0") + F.col("rank") - F.col("r0"))
    own = [ranked[c] for c in pieces.columns if c not in ("part", "local_rank")]
    return placed.select(*own, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, p: PackingParams = PackingParams(), with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack every row of ``docs``; one row per piece, with its token ids if asked for.

    Null and empty texts are one piece of the end id; repeated rows are packed each; an empty table gives no rows; a
    very long text is tokenised whole and cut. Other columns are not passed on.
    """
    return pack_pieces(materialize(tokenize_pieces(docs, tokenizer, p.capacity, with_ids), "pieces"), p)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)`` of pieces packed with their ids: the sequences to train on, of bounded length each."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda x: x["ids"])).alias("ids"))


def op8_bestfit_packing(spark, sf_dir: str) -> DataFrame:
    """Pack the whole ``documents`` table into sequences of 1024 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack_documents(docs).select(*cols)
