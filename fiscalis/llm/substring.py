"""Exact substring deduplication by fixed-block anchors.

Each document is cut into non-overlapping blocks of ``block`` words. Any repeated run of ``window >= 2 * block - 1``
words covers a whole block of each document that holds it, and the others meet that block as one of their rolling
windows. So the index of blocks is probed with every rolling window of ``block`` words; blocks that are met elsewhere
are anchors, and hits are extended, window by window, to the maximal exact repeats: a window of ``window`` words is
looked at if all blocks inside are anchors, and is a repeat if the same words start earlier.

Probes travel as sorted distinct hash sets per chunk of text, a few bytes each; a passage that a third of the corpus
holds is one entry per chunk. Hashes that decide about anchors have 48 bits, since a false anchor only costs work;
windows are compared by 96 bits over 64-bit hashes of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalis.llm.common import fields, groups, materialize

_M1, _M2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_WRAP = (1 << 64) - 1


@dataclass(frozen=True)
class SubstringParams:
    """``chunk_words`` bounds what a task holds at a time; ``block`` is the longest that any repeat must cover.

    A chunk sends to ``fan`` destinations at most, whatever the number of buckets; where more are needed, what arrives
    is merged and dealt out again, ``fan`` ways a round.
    """

    window: int = 20
    chunk_words: int = 3_000_000
    fan: int = 1024

    @property
    def block(self) -> int:
        return (self.window + 1) // 2


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def rolling(h: np.ndarray, size: int, mult: int) -> np.ndarray:
    """Polynomial hash of every run of ``size`` values, by doubling; not mixed."""
    if len(h) < size:
        return np.empty(0, np.uint64)
    out, done, span, power, at = None, 0, h, mult, 1
    while at <= size:
        if size & at:
            if out is None:
                out = span
            else:
                m = len(h) - done - at + 1
                out = out[:m] * np.uint64(power) + span[done : done + m]
            done += at
        if at * 2 <= size:
            span = span[:-at] * np.uint64(power) + span[at:]
        power, at = power * power & _WRAP, at * 2
    return out[: len(h) - size + 1]


def _planes(a: np.ndarray) -> bytes:
    """Fixed-width numbers as compressed byte planes."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes()) if len(a) else b""


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    if not data:
        return np.empty(0, kind)
    width = np.dtype(kind).itemsize
    return np.frombuffer(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1).T.tobytes(), kind)


def pack_sorted(a: np.ndarray) -> bytes:
    """Ascending unsigned numbers as compressed differences."""
    if not len(a):
        return b""
    d = np.diff(a.astype(np.uint64), prepend=np.uint64(0))
    wide = int(d.max()) >> 32
    return (b"8" if wide else b"4") + _planes(d.astype("<u8" if wide else "<u4"))


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, np.uint64)
    return np.cumsum(_unplanes(data[1:], "<u8" if data[:1] == b"8" else "<u4").astype(np.uint64), dtype=np.uint64)


def _keyed(docs: DataFrame, carry: tuple[str, str] | None = None) -> DataFrame:
    """``dk`` the id (null: below all others), ``tkey`` a hash of the text, ``text`` bytes (null: empty).

    With ``carry``: all columns of ``docs``, and the first two under the two names given. Ids are integers.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    dk, tkey = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), F.xxhash64(text)
    if carry:
        return docs.select("*", dk.alias(carry[0]), tkey.alias(carry[1]))
    return docs.select(dk.alias("dk"), tkey.alias("tkey"), text.alias("text"))


def _batch(schema, **cols) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    names = [f.name for f in schema.fields]
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], types[{"bigint": "long"}.get(f.dataType.simpleString(), f.dataType.simpleString())]) for f in schema.fields], names)


def filled(to: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(value, indices)`` of each value that occurs, indices ascending."""
    order = np.argsort(to, kind="stable")
    own = to[order]
    cuts = np.flatnonzero(own[1:] != own[:-1]) + 1 if len(own) else []
    for part in np.split(order, cuts) if len(own) else ():
        yield int(to[part[0]]), part


def rounds(buckets: int, fan: int) -> list[int]:
    """How many ways each round deals: powers of two, ``fan`` at most, that make ``buckets`` or more together."""
    bits, step = max(1, (buckets - 1).bit_length()), max(1, fan.bit_length() - 1)
    return [1 << min(step, bits - at) for at in range(0, bits, step)]


def merge_rounds(sent: DataFrame, ways: list[int], refine) -> DataFrame:
    """Rows of the first round dealt on by the further ones.

    ``refine(done, way)`` gives a function over sorted batches that merges the rows of a destination, up to a bounded
    size at a time, and splits them. Rows need not all meet for that, so a destination is spread over as many tasks
    as it will have parts; rows with a negative destination are passed through.
    """
    done = ways[0]
    for way in ways[1:]:
        spread = F.pmod(F.xxhash64("a"), F.lit(way))
        sent = sent.repartition(F.col("dest"), spread).sortWithinPartitions("dest").mapInArrow(refine(done, way), sent.schema)
        done *= way
    return sent


MERGE_ROWS = 4_000_000


def merged_runs(batches: Iterator[pa.RecordBatch], size) -> Iterator[tuple[int, list[dict]]]:
    """Rows of one destination after the other, ``MERGE_ROWS`` numbers at a time; ``size(row)`` bytes stand for numbers."""
    held: list[dict] = []
    total = 0
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["dest"] != held[0]["dest"] or total >= MERGE_ROWS or row["dest"] < 0):
                yield held[0]["dest"], held
                held, total = [], 0
            held.append(row)
            total += size(row)
    if held:
        yield held[0]["dest"], held


_SENT = fields("dest long, chunk long, a binary, b binary, c binary, d binary, e binary")
_FOUND = fields("dest long, chunk long, a binary, b binary, c binary, d binary, e binary, f binary")
_BACK = fields("chunk long, kind int, a binary, b binary, c binary, d binary")


def _blobs(table: pa.Table, *names: str) -> list[list[bytes]]:
    return [[x.as_py() for x in table.column(n)] for n in names]


def anchor_blocks(keyed: DataFrame, p: SubstringParams, buckets: int) -> DataFrame:
    """``(dk, tkey, hits binary)``: numbers of the blocks of a text that are met elsewhere; texts without any are left out."""
    size, ways = p.block, rounds(buckets, p.fan)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple[int, int, np.ndarray]] = []
        words = 0

        def flush() -> Iterator[pa.RecordBatch]:
            chunk = part << 24 | seq
            hashes = [_mixed(rolling(h, size, _M1)) >> np.uint64(16) for _, _, h in held]
            blocks = [h[::size] for h in hashes]
            first = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype(np.uint64)
            every = np.sort(np.concatenate(hashes))
            new = np.concatenate([[True], every[1:] != every[:-1]])
            distinct = every[new]
            multi = distinct[np.diff(np.append(np.flatnonzero(new), len(every))) > 1]
            block = np.concatenate(blocks)
            at = np.minimum(np.searchsorted(multi, block), max(0, len(multi) - 1))
            known = multi[at] == block if len(multi) else np.zeros(len(block), bool)
            local = np.flatnonzero(known)
            yield _batch(
                _SENT, dest=[-1 - chunk], chunk=[chunk], a=[pack_sorted(local)], b=[pack_sorted(first)],
                c=[_planes(np.array([x[0] for x in held], "<i8"))], d=[_planes(np.array([x[1] for x in held], "<i8"))], e=[b""],
            )
            asked = np.flatnonzero(~known)
            rows: dict[str, list] = {k: [] for k in ("dest", "chunk", "a", "b", "c", "d", "e")}
            way = np.uint64(ways[0])
            mine_of = {t: asked[i] for t, i in filled(block[asked] % way)}
            for t, i in filled(distinct % way):  # every block that is asked for is among the distinct ones
                own = mine_of.get(t, asked[:0])
                for k, v in zip(rows, (t, chunk, pack_sorted(distinct[i] // way), pack_sorted(own), _planes((block[own] // way).astype("<u8")), b"", b""), strict=True):
                    rows[k].append(v)
            yield _batch(_SENT, **rows)

        for batch in batches:
            for dk, tkey, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                own = text.as_py().split()
                if len(own) < p.window:
                    continue
                held.append((dk.as_py(), tkey.as_py(), word_hashes(own)))
                words += len(own)
                if words >= p.chunk_words:
                    yield from flush()
                    held, words, seq = [], 0, seq + 1
        if held:
            yield from flush()

    def asked_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunk, number and hash of the blocks that a row asks for; merged rows name the chunk of each."""
        block = _unplanes(row["c"], "<u8")
        if row["d"]:
            return _unplanes(row["d"], "<i8"), _unplanes(row["b"], "<i8"), block
        return np.full(len(block), row["chunk"], np.int64), unpack_sorted(row["b"]).astype(np.int64), block

    def refine(done: int, way: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for dest, held in merged_runs(batches, lambda r: len(r["a"]) // 2):
                if dest < 0:
                    yield _batch(_SENT, **{k: [r[k] for r in held] for k in held[0]})
                    continue
                every = np.sort(np.concatenate([unpack_sorted(r["a"]) for r in held]))
                third = np.zeros(len(every), bool)  # that a hash came more than once is all that counts
                third[2:] = every[2:] == every[:-2]
                every = every[~third]
                chunk, at, block = (np.concatenate(x) for x in zip(*map(asked_of, held), strict=True))
                mine = {t: i for t, i in filled(block % np.uint64(way))}
                none = np.empty(0, np.int64)
                rows: dict[str, list] = {k: [] for k in held[0]}
                for t, i in filled(every % np.uint64(way)):
                    own = mine.get(t, none)
                    for k, v in zip(("dest", "chunk", "a", "b", "c", "d", "e"), (dest + t * done, -1, pack_sorted(every[i] // np.uint64(way)), _planes(at[own]), _planes(block[own] // np.uint64(way)), _planes(chunk[own]), b""), strict=True):
                        rows[k].append(v)
                yield _batch(_SENT, **rows)

        return run

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["dest"]):
            if table.column("dest")[0].as_py() < 0:
                chunks = table.column("chunk").to_pylist()
                a, b, c, d = _blobs(table, "a", "b", "c", "d")
                yield _batch(_BACK, chunk=chunks, kind=[0] * len(chunks), a=a, b=b, c=c, d=d)
                continue
            held = table.to_pylist()
            every = np.sort(np.concatenate([unpack_sorted(r["a"]) for r in held]))
            shared = np.unique(every[1:][every[1:] == every[:-1]])
            if not len(shared):
                continue
            out, ids = [], []
            for row in held:
                chunk, at, block = asked_of(row)
                i = np.minimum(np.searchsorted(shared, block), len(shared) - 1)
                hit = shared[i] == block
                if hit.any():
                    chunk, at = chunk[hit], at[hit]
                    for c, own in filled(chunk):
                        ids.append(c)
                        out.append(pack_sorted(np.sort(at[own])))
            none = [b""] * len(ids)
            yield _batch(_BACK, chunk=ids, kind=[1] * len(ids), a=out, b=none, c=none, d=none)

    result = fields("dk long, tkey long, hits binary")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["chunk"]):
            kind = table.column("kind").to_pylist()
            a, b, c, d = _blobs(table, "a", "b", "c", "d")
            home = kind.index(0)
            first = unpack_sorted(b[home]).astype(np.int64)
            hits = np.unique(np.concatenate([unpack_sorted(x) for x in a])).astype(np.int64)
            cut = np.searchsorted(hits, first)
            some = np.flatnonzero(cut[1:] > cut[:-1])
            if len(some):
                dk, tkey = _unplanes(c[home], "<i8"), _unplanes(d[home], "<i8")
                yield _batch(result, dk=dk[some], tkey=tkey[some], hits=[pack_sorted(hits[cut[i] : cut[i + 1]] - first[i]) for i in some])

    sent = merge_rounds(keyed.mapInArrow(probe, _SENT), ways, refine).repartition("dest").sortWithinPartitions("dest", "chunk")
    back = sent.mapInArrow(meet, _BACK).repartition("chunk").sortWithinPartitions("chunk", "kind")
    return back.mapInArrow(gather, result).dropDuplicates(["dk", "tkey"])  # repeated rows have equal anchors


def repeated_spans(keyed: DataFrame, anchors: DataFrame, p: SubstringParams, buckets: int) -> DataFrame:
    """``(dk, tkey, spans binary)``: word intervals covered by windows that start earlier elsewhere; others left out."""
    size, span, ways = p.block, p.window, rounds(buckets, p.fan)

    def candidates(n: int, hits: np.ndarray) -> np.ndarray:
        """Starts of the windows of n words all of whose whole blocks are anchors."""
        is_hit = np.zeros(n // size + 3, bool)
        is_hit[hits] = True
        start = np.arange(n - span + 1)
        low = -(-start // size)
        high = (start + span) // size - 1
        bad = np.cumsum(np.concatenate([[0], ~is_hit]))
        return start[bad[high + 1] == bad[low]]

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        words = 0

        def flush() -> Iterator[pa.RecordBatch]:
            chunk = part << 24 | seq
            count = [len(x[2]) for x in held]
            dk = np.repeat(np.array([x[0] for x in held], np.int64), count)
            pos = np.concatenate([x[2] for x in held])
            ha, hb = np.concatenate([x[3] for x in held]), np.concatenate([x[4] for x in held])
            order = np.lexsort((pos, dk, hb, ha))
            new = np.ones(len(order), bool)
            new[1:] = (ha[order[1:]] != ha[order[:-1]]) | (hb[order[1:]] != hb[order[:-1]])
            lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
            later = (dk[order] != dk[lead]) | (pos[order] != pos[lead])
            flags = np.sort(order[later])
            yield _batch(
                _FOUND, dest=[-1 - chunk], chunk=[chunk], a=[pack_sorted(flags)], b=[pack_sorted(np.concatenate([[0], np.cumsum(count)]))],
                c=[_planes(np.array([x[0] for x in held], "<i8"))], d=[_planes(np.array([x[1] for x in held], "<i8"))], e=[_planes(np.diff(pos, prepend=0).astype("<i4"))], f=[b""],
            )
            lone = np.sort(order[~later])
            rows: dict[str, list] = {k: [] for k in (*(f.name for f in _SENT.fields), "f")}
            for t, i in filled(ha[lone] % np.uint64(ways[0])):
                own = lone[i]
                for k, v in zip(rows, (t, chunk, pack_sorted(own), _planes(ha[own]), _planes(hb[own]), _planes(np.diff(dk[own], prepend=0)), _planes(pos[own].astype("<i4")), b""), strict=True):
                    rows[k].append(v)
            yield _batch(_FOUND, **rows)

        for batch in batches:
            for dk, tkey, text, hits in zip(*(batch.column(i) for i in range(4)), strict=True):
                h = word_hashes(text.as_py().split())
                at = candidates(len(h), unpack_sorted(hits.as_py()).astype(np.int64))
                if not len(at):
                    continue
                ha, hb = _mixed(rolling(h, span, _M1)), _mixed(rolling(_mixed(h), span, _M2)) >> np.uint64(32)
                held.append((dk.as_py(), tkey.as_py(), at, ha[at], hb[at].astype(np.uint32)))
                words += len(h)
                if words >= p.chunk_words:
                    yield from flush()
                    held, words, seq = [], 0, seq + 1
        if held:
            yield from flush()

    def windows_of(row: dict) -> tuple[np.ndarray, ...]:
        """Chunk, number, both hashes, document and position of a row's windows; merged rows name the chunk of each."""
        ha, hb = _unplanes(row["b"], "<u8"), _unplanes(row["c"], "<u4")
        dk, pos = np.cumsum(_unplanes(row["d"], "<i8")), _unplanes(row["e"], "<i4")
        if row["f"]:
            return _unplanes(row["f"], "<i8"), _unplanes(row["a"], "<i8"), ha, hb, dk, pos
        return np.full(len(ha), row["chunk"], np.int64), unpack_sorted(row["a"]).astype(np.int64), ha, hb, dk, pos

    def refine(done: int, way: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for dest, held in merged_runs(batches, lambda r: len(r["b"]) // 4):
                if dest < 0:
                    yield _batch(_FOUND, **{k: [r[k] for r in held] for k in held[0]})
                    continue
                chunk, at, ha, hb, dk, pos = (np.concatenate(x) for x in zip(*map(windows_of, held), strict=True))
                rows: dict[str, list] = {k: [] for k in held[0]}
                for t, own in filled(ha // np.uint64(done) % np.uint64(way)):
                    for k, v in zip(("dest", "chunk", "a", "b", "c", "d", "e", "f"), (dest + t * done, -1, _planes(at[own]), _planes(ha[own]), _planes(hb[own]), _planes(np.diff(dk[own], prepend=0)), _planes(pos[own]), _planes(chunk[own])), strict=True):
                        rows[k].append(v)
                yield _batch(_FOUND, **rows)

        return run

    back_schema = fields("chunk long, kind int, a binary, b binary, c binary, d binary, e binary")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["dest"]):
            if table.column("dest")[0].as_py() < 0:
                chunks = table.column("chunk").to_pylist()
                a, b, c, d, e = _blobs(table, "a", "b", "c", "d", "e")
                yield _batch(back_schema, chunk=chunks, kind=[0] * len(chunks), a=a, b=b, c=c, d=d, e=e)
                continue
            chunk, index, ha, hb, dk, pos = (np.concatenate(x) for x in zip(*map(windows_of, table.to_pylist()), strict=True))
            order = np.lexsort((pos, dk, hb, ha))
            new = np.ones(len(order), bool)
            new[1:] = (ha[order[1:]] != ha[order[:-1]]) | (hb[order[1:]] != hb[order[:-1]])
            lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
            later = order[(dk[order] != dk[lead]) | (pos[order] != pos[lead])]
            ids, out = [], []
            for c, own in filled(chunk[later]):
                ids.append(c)
                out.append(pack_sorted(np.sort(index[later[own]])))
            none = [b""] * len(ids)
            yield _batch(back_schema, chunk=ids, kind=[1] * len(ids), a=out, b=none, c=none, d=none, e=none)

    result = fields("dk long, tkey long, spans binary")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["chunk"]):
            kind = table.column("kind").to_pylist()
            a, b, c, d, e = _blobs(table, "a", "b", "c", "d", "e")
            home = kind.index(0)
            first = unpack_sorted(b[home]).astype(np.int64)
            pos = np.cumsum(_unplanes(e[home], "<i4").astype(np.int64))
            flags = np.unique(np.concatenate([unpack_sorted(x) for x in a])).astype(np.int64)
            cut = np.searchsorted(flags, first)
            some = np.flatnonzero(cut[1:] > cut[:-1])
            if not len(some):
                continue
            dk, tkey = _unplanes(c[home], "<i8"), _unplanes(d[home], "<i8")
            spans = []
            for i in some:
                starts = pos[flags[cut[i] : cut[i + 1]]]
                fresh = np.concatenate([[True], starts[1:] > starts[:-1] + span])
                ends = np.append(starts[np.flatnonzero(fresh)[1:] - 1], starts[-1]) + span
                spans.append(np.stack([starts[fresh], ends], axis=1).astype("<i4").tobytes())
            yield _batch(result, dk=dk[some], tkey=tkey[some], spans=spans)

    met = keyed.join(anchors, ["dk", "tkey"]).select("dk", "tkey", "text", "hits").sortWithinPartitions("dk", "tkey")
    sent = merge_rounds(met.mapInArrow(extend, _FOUND), ways, refine).repartition("dest").sortWithinPartitions("dest", "chunk")
    back = sent.mapInArrow(meet, back_schema).repartition("chunk").sortWithinPartitions("chunk", "kind")
    return back.mapInArrow(gather, result).dropDuplicates(["dk", "tkey"])


def substring_spans(docs: DataFrame, p: SubstringParams = SubstringParams()) -> DataFrame:
    """Texts of ``docs (doc_id integer, text)`` with the words to remove: ``dk, tkey, text, spans`` (null: none).

    Words lie between the bytes 0x20 and 0x09-0x0D. A window is removed if its words also start at a smaller
    ``(doc_id, position)``, judged on the input. Rows that repeat an id stand at the same place, so neither removes
    the other's windows of equal position; a null id stands before all others.
    """
    keyed = _keyed(docs)
    buckets = max(4, 4 * keyed.rdd.getNumPartitions())
    anchors = materialize(anchor_blocks(keyed, p, buckets), "anchors")
    spans = materialize(repeated_spans(keyed, anchors, p, buckets), "spans")
    return keyed.join(spans, ["dk", "tkey"], "left").select("dk", "tkey", "text", "spans")


def remove_substrings(docs: DataFrame, p: SubstringParams = SubstringParams(), digest: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed`` and ``kept_text``, or its SHA-256 ``kept_sha256`` with ``digest``; a row per row.

    A null or empty text has no words. Repeated rows come in an order of their own, so that the later ones lose what they
    share with the first. Texts of any length count whole; an empty table gives no rows. ``doc_id`` is a whole number.
    """
    last = "kept_sha256" if digest else "kept_text"
    schema = fields(f"doc_id long, n_words long, n_removed long, {last} string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = text.as_py().split()
                n.append(len(words))
                cut = np.frombuffer(spans.as_py() or b"", "<i4").reshape(-1, 2).tolist()
                left, at = [], 0
                for a, b in cut:
                    left += words[at:a]
                    at = b
                left += words[at:]
                gone.append(len(words) - len(left))
                data = b" ".join(left)
                kept.append(hashlib.sha256(data).hexdigest() if digest else data.decode("utf-8", "replace"))
            ids = pa.array([None if x == -(1 << 63) else x for x in batch.column("dk").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], schema.names)

    return substring_spans(docs, p).mapInArrow(run, schema)


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words of all ``documents`` outside of repeated windows of 20 words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_substrings(docs, digest=True)
