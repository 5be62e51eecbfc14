"""Fuzzy line deduplication over the whole corpus.

Lines are compared by the Jaccard similarity of their character shingles. One-permutation MinHash signatures with
random densification are banded; lines that share a band are verified on their exact shingle sets; verified links are
contracted by distributed union-find, and of each component the first line by (document, position) stays.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalis.llm.common import bucket_edges, connected_components, fields, fresh, groups, materialize, place
from fiscalis.llm.substring import _batch, _keyed, _mixed, _planes, _unplanes, filled, merge_rounds, merged_runs, pack_sorted, rolling, rounds, unpack_sorted

_EMPTY = np.uint64((1 << 64) - 1)
#: White space but the space and the line feed.
_SPACES = [chr(x) for x in (9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


@dataclass(frozen=True)
class LineParams:
    """A pair of similarity s is a candidate with probability 1 - (1 - s ** rows) ** bands: 0.998 at 0.8.

    A chunk sends its keys to ``fan`` destinations at most; more are reached in further rounds. A key that ``heavy``
    lines of a chunk carry is sent on for one of them, so that a bucket holds it once for each chunk.
    """

    shingle: int = 6
    similarity: float = 0.8
    bands: int = 16
    rows: int = 5
    chunk_lines: int = 30_000
    chunk_chars: int = 8_000_000
    fan: int = 1024
    heavy: int = 64
    seed: int = 5

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def normal_lines(text: str) -> list[str]:
    """Lines (split at ``\\n``) in the form that is compared: lower case, white space runs as one space, trimmed."""
    text = text.lower()
    if "  " in text or any(x in text for x in _SPACES):
        return [" ".join(x.split()) for x in text.split("\n")]
    return [x.strip(" ") for x in text.split("\n")]


def line_id(line: str) -> int:
    """64-bit identity of a normal line."""
    return xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"), 1) ^ (1 << 63)


def shingle_set(line: str, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` code points, ascending and distinct; of the whole line if it is shorter."""
    return np.unique(_line_shingles(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64), size))


def _line_shingles(points: np.ndarray, size: int) -> np.ndarray:
    return _mixed(rolling(points + np.uint64(1), min(size, len(points)), 0x100000001B3) * np.uint64(0x9E3779B97F4A7C15))


@lru_cache(maxsize=4)
def _probes(p: LineParams) -> np.ndarray:
    """For each bin the sequence of bins that an empty one borrows from."""
    return np.random.default_rng(p.seed).integers(0, p.bins, (4 * p.bins, p.bins))


def _band_shingles(lines: list[str], size: int) -> np.ndarray:
    """A hash for each position of the joined lines, of the ``size`` code points from there; past the end zeros follow.

    The code points are bytes of one number; one beyond a byte counts as a hash of its own, in lines of any kind alike.
    """
    text = "".join(lines)
    try:
        if size > 8:
            raise ValueError("more bytes than a number has")
        raw = text.encode("latin-1")
        h = np.ndarray(len(raw), "<u8", raw + bytes(8), 0, (1,)) << np.uint64(64 - 8 * size)
    except ValueError:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        wide = points > 255
        points[wide] = _mixed(points[wide] * np.uint64(0x9E3779B97F4A7C15))
        if size > 8:
            h = rolling(np.append(points, np.zeros(size - 1, np.uint64)), size, 0x100000001B3)
        else:
            h = rolling(np.append(points, np.zeros(size - 1, np.uint64))[::-1], size, 256)[::-1] << np.uint64(64 - 8 * size)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


_PIECE = 100_000


def band_keys(lines: list[str], p: LineParams) -> np.ndarray:
    """``len(lines) x bands`` keys of 64 bits; equal shingle sets have equal keys."""
    n, k = len(lines), p.bins
    sig = np.full(n * k + 1, _EMPTY, np.uint64)  # the last is for shingles that reach into the next line
    every = np.array([len(x) for x in lines])
    ends, at = np.cumsum(every), 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PIECE, "right")))
        sizes = every[at:end]
        h = _band_shingles(lines[at:end], p.shingle)
        to = (h >> np.uint64(32)) * np.uint64(k)
        to >>= np.uint64(32)
        to = to.view(np.int64)
        to += np.repeat(np.arange(at, end) * k, sizes)
        last = np.cumsum(sizes)
        for back in range(1, p.shingle):
            to[(last - back)[sizes >= back]] = n * k
        short = np.flatnonzero((sizes < p.shingle) & (sizes > 0))
        for i in short.tolist():  # one shingle, the whole line
            own = _band_shingles(lines[at + i : at + i + 1], p.shingle)[0]
            sig[(at + i) * k + (int(own) >> 32) * k // (1 << 32)] = own
        np.minimum.at(sig, to, h)
        at = end
    own = sig[:-1]
    empty = np.flatnonzero(own == _EMPTY)
    col = empty % k
    row = empty - col
    out = own.copy()
    for probe in _probes(p):
        if not len(empty):
            break
        got = own.take(row + probe.take(col))
        full = got != _EMPTY
        out[empty[full]] = got[full]
        left = ~full
        empty, row, col = empty[left], row[left], col[left]
    if len(empty):
        out[empty] = own.reshape(n, k).min(axis=1)[row // k]
    keys = np.full((n, p.bands), np.uint64(p.seed))
    parts = out.reshape(n, p.bands, p.rows)
    for r in range(p.rows):
        keys = _mixed(keys * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, r])
    return _mixed(keys + np.arange(p.bands, dtype=np.uint64))


def jaccard_forest(sets: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """Index pairs spanning the components of "Jaccard at or above the threshold", each link verified on whole sets.

    Sets are sorted and distinct; two empty ones are equal.
    """
    if len(sets) < 2:
        return
    if len(sets) == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        if common >= similarity * (len(sets[0]) + len(sets[1]) - common):
            yield 0, 1
        return
    bare = [i for i, x in enumerate(sets) if not len(x)]
    yield from zip(bare, bare[1:], strict=False)
    kept = [i for i, x in enumerate(sets) if len(x)]
    if len(kept) < 2:
        return
    if bare:
        yield from ((kept[a], kept[b]) for a, b in jaccard_forest([sets[i] for i in kept], similarity))
        return
    sizes = np.array([len(s) for s in sets])
    values, dense = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    rest = np.arange(len(sets))
    member = np.zeros(len(values), bool)
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            at = front.pop()
            own = dense[starts[at] : starts[at] + sizes[at]]
            member[own] = True
            least, most = similarity * sizes[at], sizes[at] / similarity
            able = rest[(sizes[rest] >= least - 1e-9) & (sizes[rest] <= most + 1e-9)]
            found = []
            if len(able) > 64:
                sums = np.add.reduceat(member[dense], starts)[able]
                found = able[sums >= similarity * (sizes[able] + sizes[at] - sums) - 1e-9].tolist()
            else:
                for x in able.tolist():
                    s = int(member[dense[starts[x] : starts[x] + sizes[x]]].sum())
                    if s >= similarity * (sizes[x] + sizes[at] - s) - 1e-9:
                        found.append(x)
            member[own] = False
            if found:
                rest = rest[~np.isin(rest, found)]
                front += found
                yield from zip(repeat(at), found)


def _packed(a: str, b: str, size: int) -> np.ndarray | None:
    """The shingles of ``a`` and then of ``b`` as numbers, the last bit telling the line; None where they do not fit."""
    if size > 7:
        return None
    try:
        raw = (a + b).encode("latin-1")
    except UnicodeEncodeError:
        return None
    every = np.ndarray(len(raw) - size + 1, "<u8", raw + bytes(8), 0, (1,)) << np.uint64(64 - 8 * size)
    every[len(a) :] |= np.uint64(1)
    return np.concatenate([every[: len(a) - size + 1], every[len(a) :]])


def alike(a: str, b: str, p: LineParams) -> bool:
    """Whether the shingle sets of two lines, none shorter than a shingle, reach the similarity."""
    both = _packed(a, b, p.shingle)
    if both is None:
        points = np.frombuffer((a + b).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        both = rolling(points + np.uint64(1), p.shingle, 0x9E3779B97F4A7C15) << np.uint64(1)
        both[len(a) :] |= np.uint64(1)
        both = np.concatenate([both[: len(a) - p.shingle + 1], both[len(a) :]])
    both.sort()
    both = both[np.append(True, both[1:] != both[:-1])]  # each line's shingles once; equal ones differ in the last bit
    common = int(np.count_nonzero((both[1:] ^ both[:-1]) == 1))
    return common >= p.similarity * (len(both) - common)


def _letters(lines: list[str]) -> bytes | None:
    """One byte for each code point of the lines, equal ones for equal ones; None beyond 256 different ones."""
    text = "".join(lines)
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        known = sorted(map(ord, set(text)))
        if len(known) > 256:
            return None
        return np.searchsorted(known, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")).astype(np.uint8).tobytes()


_PRODUCTS = 4_000_000_000


def _common(dense: np.ndarray, line: np.ndarray, values: int, n: int) -> np.ndarray:
    """How many of ``values`` each two of ``n`` lines have in common; ``dense`` ascending, the value of each entry."""
    step = max(1, 4_000_000 // n)
    out = np.zeros((n, n))
    for at in range(0, values, step):
        i, j = np.searchsorted(dense, (at, at + step))
        has = np.zeros((min(step, values - at), n), np.float32)
        has[dense[i:j] - at, line[i:j]] = 1
        out += has.T @ has  # whole numbers below 2 ** 24 each time
    return out


def _spanning(common: np.ndarray, own: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """Index pairs spanning the components of the sets of sizes ``own`` that reach the similarity."""
    near = common >= similarity * (own[:, None] + own - common) - 1e-9
    left = np.ones(len(own), bool)
    while left.any():
        front = [int(left.argmax())]
        left[front] = False
        while front:
            at = front.pop()
            found = np.flatnonzero(near[at] & left).tolist()
            left[found] = False
            front += found
            yield from zip(repeat(at), found)


def line_forest(lines: list[str], p: LineParams) -> Iterable[tuple[int, int]]:
    """:func:`jaccard_forest` of lines: their shingles as numbers that end in the line's, in one sort for all.

    Pairs, the common case, are compared directly.
    """
    n, size = len(lines), p.shingle
    if n == 2 and min(map(len, lines)) >= size:
        if alike(*lines, p):
            yield 0, 1
        return
    sizes = np.array([len(x) for x in lines])
    raw = _letters(lines) if size < 8 and n <= 1 << (64 - 8 * size) and sizes.min() >= size else None
    if raw is None:
        yield from jaccard_forest([shingle_set(x, size) for x in lines], p.similarity)
        return
    room = 64 - 8 * size
    every = np.ndarray(len(raw) - size + 1, "<u8", raw + bytes(8), 0, (1,)) << np.uint64(room)
    every |= np.repeat(np.arange(n, dtype=np.uint64), sizes)[: len(every)]
    inside = np.ones(len(every), bool)
    ends = np.cumsum(sizes)[:-1]
    for back in range(1, size):
        inside[ends - back] = False
    every = every[inside]
    every.sort()
    every = every[np.append(True, every[1:] != every[:-1])]  # each line's shingles once
    line = (every & np.uint64((1 << room) - 1)).astype(np.uint16 if n <= 1 << 16 else np.int64)
    own = np.bincount(line, minlength=n)
    shingle = every >> np.uint64(room)
    new = np.append(True, shingle[1:] != shingle[:-1])
    shared = ~(new & np.append(new[1:], True))  # what a single line has tells nothing more
    line, new = line[shared], new[shared]
    starts = np.flatnonzero(new)
    if n * n * len(starts) <= _PRODUCTS:
        yield from _spanning(_common(np.cumsum(new) - 1, line, len(starts), n), own, p.similarity)
        return
    lengths = np.diff(np.append(starts, len(line)))
    dense = (np.cumsum(new) - 1)[np.argsort(line, kind="stable")]
    mine = np.split(dense, np.cumsum(np.bincount(line, minlength=n))[:-1])
    rest = np.arange(n)
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            at = front.pop()
            runs = lengths[mine[at]]  # the lines that have a shingle with this one, shingle by shingle
            stop = np.cumsum(runs)
            met = line[np.repeat(starts[mine[at]] - stop + runs, runs) + np.arange(stop[-1])] if len(runs) else line[:0]
            common = np.bincount(met, minlength=n)[rest]
            near = common >= p.similarity * (own[rest] + own[at] - common) - 1e-9
            if near.any():
                found = rest[near].tolist()
                rest = rest[~near]
                front += found
                yield from zip(repeat(at), found)


def _steps(a: np.ndarray) -> bytes:
    """Ascending unsigned numbers as differences, each in as many bytes as the largest takes."""
    d = np.diff(a, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(d.max()).bit_length() + 7) // 8)
    return bytes([width]) + d.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unsteps(data: bytes) -> np.ndarray:
    width = data[0]
    d = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    d[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(d.view("<u8").ravel(), dtype=np.uint64)


_LOCAL = -2_000_000
_SENT = fields("dest long, a binary, b binary, c binary, d binary")
_MET = fields("bucket long, lid long, a binary, b binary, c binary, d binary")


def line_bands(keyed: DataFrame, p: LineParams, buckets: int) -> DataFrame:
    """One pass over the texts, written: rows of two kinds.

    ``bucket, lid``: lines that share a band with others. A bucket is named by its least line, so what the bands of a
    line find is one bucket, with each line once but for repeats among the rows; a hot key is a bucket of its own.
    ``a, b, c, d``: packed ids of the lines of a chunk, each with its first document, position and text there. Keys
    travel as one sorted blob per chunk of lines and destination, so a line that is frequent is one entry per chunk.
    """

    ways = rounds(buckets, p.fan)
    bits = [w.bit_length() - 1 for w in ways]  # the highest bits of a key name its destinations, round by round

    def dealt(keys: np.ndarray, who: np.ndarray, hot: np.ndarray, top: int) -> pa.RecordBatch:
        """Rows of ascending keys, one for each value of their ``top`` bits that occurs."""
        shift = np.uint64(64 - top)
        rows: dict[str, list] = {k: [] for k in ("dest", "a", "b", "c", "d")}
        for t, i in filled(keys >> shift):
            for k, v in zip(rows, (t, _steps(keys[i] - (np.uint64(t) << shift)), who[i].astype("<u8").tobytes(), pack_sorted(np.flatnonzero(hot[i])), b""), strict=True):
                rows[k].append(v)
        return _batch(_SENT, **rows)

    def gathered(held: list[dict], top: int, alone: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, lines and hot marks of rows of one destination, by key; without ``alone`` of keys that come twice."""
        parts = [_unsteps(r["a"]) for r in held]
        keys = np.concatenate(parts) + (np.uint64(held[0]["dest"]) << np.uint64(64 - top))
        hot = np.zeros(len(keys), bool)
        at = 0
        for r, part in zip(held, parts, strict=True):
            if r["c"]:
                hot[at + unpack_sorted(r["c"]).astype(np.int64)] = True
            at += len(part)
        order = np.argsort(keys)
        keys = keys[order]
        if not alone:
            twin = np.zeros(len(keys) + 1, bool)
            twin[1:-1] = keys[1:] == keys[:-1]
            shared = twin[1:] | twin[:-1]
            keys, order = keys[shared], order[shared]
        return keys, np.concatenate([np.frombuffer(r["b"], "<u8") for r in held])[order], hot[order]

    def refine(done: int, way: int):
        top = done.bit_length() - 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for dest, held in merged_runs(batches, lambda r: len(r["b"]) // 8):
                if dest < 0:
                    yield _batch(_SENT, **{k: [r[k] for r in held] for k in held[0]})
                else:
                    yield dealt(*gathered(held, top), top + way.bit_length() - 1)

        return run

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, str] = {}
        first: dict[int, tuple[int, int, int]] = {}
        chars = chunk = 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids, lines = np.fromiter(seen.keys(), np.uint64, len(seen)), list(seen.values())
            place = np.array([first[x] for x in seen], np.int64).reshape(-1, 3)
            dest = -1 - (TaskContext.get().partitionId() * 8191 + chunk) % 1_000_003
            yield _batch(_SENT, dest=[dest], a=[_planes(ids)], b=[_planes(place[:, 0])], c=[_planes(place[:, 1].astype("<i4"))], d=[_planes(place[:, 2])])
            parts, at = [], 0
            while at < len(lines):
                end, size = at, 0
                while end < len(lines) and end - at < 4096 and (size < 1_000_000 or end == at):
                    size += len(lines[end])
                    end += 1
                parts.append(band_keys(lines[at:end], p))
                at = end
            keys = np.concatenate(parts).ravel()
            order = np.argsort(keys)
            keys, who = keys[order], np.repeat(ids, p.bands)[order]
            new = np.append(True, keys[1:] != keys[:-1])
            size = np.diff(np.append(np.flatnonzero(new), len(keys)))
            hot = np.repeat(size >= p.heavy, size)
            if hot.any():
                here = _LOCAL - TaskContext.get().partitionId() % 1_000_003
                yield _batch(_SENT, dest=[here], a=[_planes(keys[hot])], b=[_planes(who[hot])], c=[b""], d=[b""])
                keys, who, hot = keys[new | ~hot], who[new | ~hot], hot[new | ~hot]
            yield dealt(keys, who, hot, bits[0])

        for batch in batches:
            for dk, tkey, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                dk, tkey = dk.as_py(), tkey.as_py()
                for i, line in enumerate(normal_lines(text.as_py().decode("utf-8", "replace"))):
                    if line:
                        lid = line_id(line)
                        at = (dk, i, tkey)
                        if lid not in seen:
                            seen[lid] = line
                            first[lid] = at
                            chars += len(line)
                        elif at < first[lid]:
                            first[lid] = at
                if len(seen) >= p.chunk_lines or chars >= p.chunk_chars:
                    yield from flush()
                    seen, first, chars, chunk = {}, {}, 0, chunk + 1
        if seen:
            yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["dest"]):
            t = table.column("dest")[0].as_py()
            if t <= _LOCAL:
                for a, b in zip(table.column("a"), table.column("b"), strict=True):
                    bucket, lid = _unplanes(a.as_py(), "<i8"), _unplanes(b.as_py(), "<i8")
                    none = [None] * len(bucket)
                    yield _batch(_MET, bucket=bucket, lid=lid, a=none, b=none, c=none, d=none)
                continue
            if t < 0:
                none = [None] * table.num_rows
                yield _batch(_MET, bucket=none, lid=none, **{c: table.column(c).to_pylist() for c in "abcd"})
                continue
            keys, who, hot = gathered(table.to_pylist(), sum(bits), alone=False)
            if not len(keys):
                continue
            order = np.lexsort((who, keys))
            keys, who, hot = keys[order], who[order], hot[order]
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            n = np.diff(np.append(starts, len(keys)))
            # the least line stands for a bucket; a hot key's lines are spread, so it stands for itself
            bucket = np.repeat(np.where(np.maximum.reduceat(hot, starts), keys[starts], who[starts]), n)
            many = np.repeat(who[starts] != who[starts + n - 1], n)
            bucket, who = bucket[many], who[many]
            order = np.lexsort((who, bucket))
            bucket, who = bucket[order], who[order]
            fresh = np.ones(len(who), bool)
            fresh[1:] = (bucket[1:] != bucket[:-1]) | (who[1:] != who[:-1])
            bucket, who = bucket[fresh], who[fresh]
            none = [None] * len(who)
            yield _batch(_MET, bucket=bucket.view(np.int64), lid=who.view(np.int64), a=none, b=none, c=none, d=none)

    sent = merge_rounds(keyed.select("dk", "tkey", "text").mapInArrow(sign, _SENT), ways, refine).repartition("dest").sortWithinPartitions("dest")
    return materialize(sent.mapInArrow(meet, _MET), "line-bands")


def chunk_places(met: DataFrame) -> DataFrame:
    """``(lid, dk, pos, tkey)``: the first place of a line in each chunk that has it, from what :func:`line_bands` wrote."""
    schema = fields("lid long, dk long, pos int, tkey long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, c, d in zip(*(batch.column(i) for i in range(4)), strict=True):
                yield _batch(schema, lid=_unplanes(a.as_py(), "<i8"), dk=_unplanes(b.as_py(), "<i8"), pos=_unplanes(c.as_py(), "<i4"), tkey=_unplanes(d.as_py(), "<i8"))

    return met.filter("a is not null").select("a", "b", "c", "d").mapInArrow(run, schema)


def line_texts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(lid, line)`` of the places in ``wanted (dk, pos, tkey)``; the lines come from their first documents only.

    Rows that repeat an id with the same text meet in a task, which reads the first of them; more than one only if the
    join is split for skew.
    """
    schema = fields("lid long, line string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for batch in batches:
            lid, out = [], []
            for dk, tkey, text, places in zip(*(batch.column(i) for i in range(4)), strict=True):
                own = (dk.as_py(), tkey.as_py())
                if own in done:
                    continue
                done.add(own)
                lines = text.as_py().decode("utf-8", "replace").split("\n")
                for i in places.as_py():
                    line = " ".join(lines[i].lower().split())
                    lid.append(line_id(line))
                    out.append(line)
            yield _batch(schema, lid=np.array(lid, np.uint64).view(np.int64), line=out)

    per_text = wanted.groupBy("dk", "tkey").agg(F.collect_list("pos").alias("places"))
    # the short side is hashed, so that texts are not sorted
    return keyed.join(per_text.hint("shuffle_hash"), ["dk", "tkey"]).select("dk", "tkey", "text", "places").mapInArrow(run, schema)


def kept_lines(docs: DataFrame, p: LineParams = LineParams()) -> tuple[DataFrame, DataFrame]:
    """The keyed texts, and ``(dk, tkey, kept array<int>)``: positions of the lines that stay, blank ones apart."""
    keyed = _keyed(docs)
    buckets = max(4, 4 * keyed.rdd.getNumPartitions())
    met = line_bands(keyed, p, buckets)
    places = materialize(chunk_places(met), "line-places")
    pairs = materialize(met.filter("bucket is not null").select("bucket", "lid").distinct(), "line-pairs")
    sizes = materialize(pairs.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "line-sizes")
    members = pairs.join(sizes, "bucket").select("bucket", F.col("lid").alias("id"), "n")
    first = places.join(pairs.select("lid").distinct().hint("shuffle_hash"), "lid", "left_semi").groupBy("lid").agg(F.min(F.struct("dk", "pos", "tkey")).alias("at"))
    texts = materialize(line_texts(keyed, first.select("at.dk", "at.pos", "at.tkey")), "line-texts").withColumnRenamed("lid", "id")

    def linker(payload: list):
        return line_forest(payload, p)

    edges = bucket_edges(members.join(texts, "id"), "line", linker, sizes=sizes)
    roots = connected_components(edges, "line-cc").select(F.col("node").alias("lid"), "root")
    owned = places.join(roots.hint("shuffle_hash"), "lid", "left").groupBy(F.coalesce("root", "lid").alias("root")).agg(F.min(F.struct("dk", "pos", "tkey")).alias("at"))
    kept = owned.groupBy(F.col("at.dk").alias("dk"), F.col("at.tkey").alias("tkey")).agg(F.collect_list("at.pos").alias("kept"))
    return keyed, materialize(kept, "line-kept")


def dedup_lines(docs: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """``docs`` with the lines that stay as ``text``, and ``n_lines, n_kept`` (columns of these names are replaced).

    Of near-equal lines of all texts the first by (doc_id, position) stays; a null id stands before all others. A null
    text stays null. Blank lines stay where they are, unless no other line of a text that had some is left: then the
    text is empty. Rows that repeat an id with the same text keep the same lines. Columns else are passed on. Lines and
    texts of any length count whole; an empty table stays empty.
    """
    _, kept = kept_lines(docs, p)
    keep = [c for c in docs.columns if c.lower() not in ("n_lines", "n_kept")]
    dk, tkey, stays = (fresh([*keep, "n_lines", "n_kept"], c) for c in ("dk", "tkey", "stays"))
    own = _keyed(docs.select(*[F.col(f"`{c}`") for c in keep]), carry=(dk, tkey)).join(kept.toDF(dk, tkey, stays).hint("shuffle_hash"), [dk, tkey], "left")
    at, n_at = place(keep, "text"), len(keep)
    own = own.withColumn(keep[at], F.col(f"`{keep[at]}`").cast("string"))
    out = own.select(*[F.col(f"`{c}`") for c in keep], F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_kept"), stays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, texts = [], [], []
            held = batch.column(n_at + 2)
            ends, places = held.offsets.to_pylist(), held.values.to_pylist()
            for text, start, end in zip(batch.column(at).cast(pa.binary()).to_pylist(), ends, ends[1:], strict=False):
                lines = text.split(b"\n") if text else []
                left = lines
                if end - start < len(lines):
                    stay = set(places[start:end])
                    whole = [i in stay or not x or not x.decode("utf-8", "replace").strip() for i, x in enumerate(lines)]
                    left = [x for x, own in zip(lines, whole, strict=True) if own]
                    if not stay and len(left) < len(lines):
                        left = []
                n.append(len(lines))
                m.append(len(left))
                texts.append(text if left is lines else b"\n".join(left))
            cols = [batch.column(i) for i in range(n_at)] + [pa.array(n, pa.int64()), pa.array(m, pa.int64())]
            cols[at] = pa.array(texts, pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names[: n_at + 2])

    return out.mapInArrow(run, out.drop(stays).schema)


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines of all ``documents``, near-equal ones once: per document the counts and the text that stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), F.col("text").alias("kept_text"))
