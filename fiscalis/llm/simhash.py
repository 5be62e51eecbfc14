"""SimHash fingerprints and near-duplicate components by deletion-variant signatures.

A fingerprint is cut into so few segments that two fingerprints within the radius agree, in one segment at least, up
to a single bit. Each distinct segment value is indexed under its one-wildcard variants (one bit left out): two
values that differ in one bit share exactly one variant, so a variant holds two values at most and no key can be hot.
Equality on the variant finds the neighbouring values, equality on the value finds the agreeing ones, and the
fingerprints below them are verified by their Hamming distance.

Near duplicates by word shingles, a stage of the pipeline, take the same steps on wide fingerprints of many segments,
since texts at a similarity of 0.8 differ in 15 % of their bits; what meets is verified by its shingles. There unrelated
texts meet by chance, in pairs that grow with the square of their number; they are told apart by the bits of the
segments that follow, where two values meet, before a row is made of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalis.llm.common import bucket_edges, connected_components, fields, fresh, hex16, materialize
from fiscalis.llm.lines import jaccard_forest
from fiscalis.llm.substring import _keyed, _mixed

_SEED = 42
_STEP = 1 << 16


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``size`` words joined by one space; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), _SEED)], np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(_SEED)), np.uint64, len(words) - size + 1)


def majority_bits(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes; no hashes give 0."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _STEP):
        part = np.ascontiguousarray(hashes[at : at + _STEP]).view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def ascii_words(text: bytes | None) -> list[bytes]:
    """Words between the bytes 0x20 and 0x09-0x0D, with A-Z lower-cased; none of a null."""
    return (text or b"").lower().split()


def simhash_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp long)`` of every row; whole texts; null and blank texts get 0. Runs without a shuffle.

    Repeated rows and null ids have a fingerprint each; a text of any length counts whole; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()) if pa.types.is_string(batch.column(1).type) else batch.column(1).cast(pa.large_binary())
            fps = np.empty(batch.num_rows, np.uint64)
            for i, text in enumerate(texts):
                fps[i] = majority_bits(shingle_hashes(ascii_words(text.as_py()), shingle))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, fields(f"id {kind}, fp long")
    )


def hamming_forest(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Index pairs spanning the components of "differ in at most ``radius`` bits": one vector step per row."""
    rest = np.arange(len(fps))
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = np.bitwise_count(fps[rest] ^ fps[at]) <= radius
            if near.any():
                found = rest[near].tolist()
                rest = rest[~near]
                front += found
                yield from zip(repeat(at), found)


def segment_buckets(prints: DataFrame, segments: int, width: int) -> DataFrame:
    """Candidate buckets of ``prints (id, seg_values array<long>)``: ``(bucket long, id)``.

    One bucket per segment value that several ids carry, and one per pair of values that differ in a single bit.
    """
    if width + 5 + max(1, (segments - 1).bit_length()) + 1 > 63 or width > 32:
        raise ValueError("segments and width must fit a 64-bit key")
    parts = prints.select("id", F.posexplode("seg_values").alias("seg", "val"))
    parts = parts.withColumn("cell", F.shiftleft(F.col("seg").cast("long"), width + 5) + F.col("val"))
    values = parts.groupBy("cell").agg(F.count("*").alias("n"))
    # the variants are many times the values: spread them over all tasks, whatever the bytes of the values
    spread = values.select("cell").repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cell")
    bits = spread.select("cell", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("bit"))
    one = F.expr("shiftleft(1L, bit)")
    variant = F.col("cell").bitwiseAND(F.bitwise_not(one)) + F.shiftleft(F.col("bit").cast("long"), width)
    pairs = bits.select(variant.alias("variant")).repartition("variant").groupBy("variant").agg(F.count("*").alias("n")).filter("n = 2")
    bit = F.shiftright("variant", width).bitwiseAND(F.lit(31)).cast("int")
    low = F.col("variant") - F.shiftleft(bit.cast("long"), width)
    links = pairs.select(F.col("variant"), low.alias("low"), bit.alias("bit")).select(
        (-F.col("variant") - 1).alias("bucket"),
        F.explode(F.array(F.col("low"), F.col("low") + F.expr("shiftleft(1L, bit)"))).alias("cell"),
    )
    same = values.filter("n > 1").select(F.col("cell").alias("bucket"), "cell")
    return parts.select("cell", "id").join(links.unionByName(same), "cell").select("bucket", "id")


def simhash_components(prints: DataFrame, radius: int = 3, label: str = "simhash") -> DataFrame:
    """``prints (id, fp long)`` -> ``(id, fp, component_id)``: the least id reachable over links of ``radius`` bits.

    Every row is returned. Equal fingerprints are one node, whatever their number; rows without an id take part and
    do not name a component. Radius 1 to 3: two segments of 32 bits.
    """
    if not 0 <= radius <= 3:
        raise ValueError("radius 0 to 3: two segments with one wildcard reach three bits")
    prints = materialize(prints, f"{label}-fp")
    nodes = materialize(prints.groupBy("fp").agg(F.min("id").alias("first_id")), f"{label}-nodes")
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    found = segment_buckets(nodes.select(F.col("fp").alias("id"), F.array(low, high).alias("seg_values")), 2, 32)

    def linker(payload: list):
        return hamming_forest(np.array(payload, np.int64).view(np.uint64), radius)

    edges = bucket_edges(found.withColumn("fp", F.col("id")), "fp", linker)
    roots = connected_components(edges, f"{label}-cc").select(F.col("node").alias("fp"), "root")
    nodes = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = nodes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = nodes.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("id", "fp", "component_id")


@dataclass(frozen=True)
class NearDupParams:
    """Near duplicates by word shingles: Jaccard ``similarity`` of the shingle sets, verified exactly.

    SimHash fingerprints of ``bits`` bits (a power of 4) in segments of ``width``; a pair is a candidate if a segment
    differs in one bit at most, the two segments after it in a share of ``beside`` at most, and the whole in a share of
    ``radius`` at most. Texts at similarity 0.8 differ in 15.3 % of the bits at most, whatever their lengths, so 99.98 %
    of such pairs are candidates directly. Segments of unrelated texts meet by chance ``bits * n / 2 ** width`` times a
    text, and the two after them let one in 1100 of these pass: beyond some hundred million texts ``width`` should grow
    with the logarithm of their number, and ``bits`` with it.
    """

    shingle: int = 5
    similarity: float = 0.8
    bits: int = 4096
    width: int = 28
    radius: float = 0.22
    beside: float = 0.29
    block: int = 256

    @property
    def segments(self) -> int:
        return self.bits // self.width


_WEIGHTS = (1.0, 2.0, 2.0)


def wide_fingerprints(sets: list[np.ndarray], bits: int, width: int) -> np.ndarray:
    """Majority bits of each set of hashes, ``bits // width`` numbers of ``width`` bits a row; an empty set gives 0.

    A hash votes on bit b with the parities of b and three numbers taken from it. The weights 1, 2 and 2 make ties
    rare, by which small sets would differ in more bits than large ones. All votes are summed at once by a
    Walsh-Hadamard transform. ``sets`` hold each hash once.
    """
    side = 1 << (bits.bit_length() - 1) // 2
    if side * side != bits:
        raise ValueError("bits must be a power of 4")
    walsh = np.ones((1, 1))
    while len(walsh) < side:
        walsh = np.block([[walsh, walsh], [walsh, -walsh]])
    count = bits // width
    place = np.random.default_rng(_SEED).permutation(bits)[: count * width]  # neighbouring parities go to different segments
    out = np.empty((len(sets), count), np.int64)
    for at in range(0, len(sets), 64):
        part = sets[at : at + 64]
        owner = np.repeat(np.arange(len(part)), [len(x) for x in part]) * bits
        hashes = np.concatenate(part)
        votes = np.zeros(len(part) * bits)
        for k, weight in enumerate(_WEIGHTS, 1):
            h = _mixed(_mixed(hashes + np.uint64(k * 0x9E3779B97F4A7C15 & ((1 << 64) - 1))))
            sign = (h >> np.uint64(63)).astype(np.float64) * (2 * weight) - weight
            votes += np.bincount(owner + (h & np.uint64(bits - 1)).astype(np.int64), sign, len(votes))
        sums = walsh @ votes.reshape(len(part), side, side) @ walsh
        flat = (sums.reshape(len(part), bits)[:, place] > 0).reshape(len(part), count, width)
        out[at : at + 64] = flat @ (1 << np.arange(width, dtype=np.int64))
    return out


_CLASS = 5


def variant_stars(dealt: np.ndarray, width: int, ones: np.ndarray | None = None, vary: np.ndarray | None = None, most: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Centres and members of the stars in ascending keys of :func:`neighbour_buckets`; both are cells.

    Each value is indexed under its variants with one bit of the half left out that its key does not fix. Equal
    variants are two values that differ in that bit; the one that more texts carry, else the lesser one, is the centre.
    ``ones`` and ``vary`` are the bits beside each value: set in any of its texts, and not the same in all. Two values
    are left apart if more than ``most`` of the bits that neither varies differ, as then no two texts are any nearer.
    """
    half = width // 2
    size, value = dealt & ((1 << _CLASS) - 1), dealt >> _CLASS
    centres, members = [], []

    def cells(keys: np.ndarray) -> np.ndarray:
        part, fixed, other = keys >> width, keys >> half & ((1 << half) - 1), keys & ((1 << half) - 1)
        return (part >> 1 << width) | np.where(part & 1, other << half | fixed, fixed << half | other)

    several = cells(value[(size > 0) & (value >> width & 1 == 0)])
    centres.append(several)
    members.append(several)
    for bit in range(half):
        one = 1 << bit
        variants = ((value & ~one) << (_CLASS + 1)) | ((value >> bit & 1) << _CLASS) | size
        if ones is None:
            variants.sort()
        else:
            order = np.argsort(variants)
            variants = variants[order]
        twin = np.flatnonzero(variants[1:] >> (_CLASS + 1) == variants[:-1] >> (_CLASS + 1))
        if len(twin) and ones is not None:
            a, b = order[twin], order[twin + 1]
            twin = twin[np.bitwise_count((ones[a] ^ ones[b]) & ~(vary[a] | vary[b])) <= most]
        if len(twin):
            low, high = variants[twin], variants[twin + 1]
            bare = low >> (_CLASS + 1)
            up = (high & ((1 << _CLASS) - 1)) > (low & ((1 << _CLASS) - 1))
            low, high = cells(bare), cells(bare | one)
            centre, other = np.where(up, high, low), np.where(up, low, high)
            centres += [centre, centre]
            members += [centre, other]
    return np.concatenate(centres), np.concatenate(members)


def neighbour_buckets(prints: DataFrame, width: int, label: str = "stars", beside: float | None = None) -> DataFrame:
    """Candidate buckets of ``prints (id, segs array<int>)``, many segments of an even ``width``: ``(bucket long, id)``.

    A bucket is a segment value with those that differ from it in one bit. Two such values agree in one half of the
    bits, so each distinct value is sent under either half, and a half holds ``2 ** (width / 2)`` values at most; its
    one-wildcard variants are made and compared where it arrives. Of two neighbours only the one that more texts carry
    has a bucket for both, so copies of a text are not listed with each neighbour of their values.

    With ``beside``, values do not meet if the two segments after them differ in more than that share of bits, for all
    of their texts. So what meets by chance makes no rows, and all that is nearer is found as without it.
    """
    if width % 2 or width > 30:
        raise ValueError("an even width of 30 bits at most")
    half = width // 2
    schema = fields("bucket long, cell long")
    parts = prints.select("id", "segs", F.posexplode("segs").alias("seg", "val"))
    after = [F.get("segs", F.pmod(F.col("seg") + k, F.size("segs"))).cast("long") for k in (1, 2)]
    parts = parts.select(
        "id", "seg", (F.shiftleft(F.col("seg").cast("long"), width) + F.col("val")).alias("cell"), (F.shiftleft(after[0], width) + after[1]).alias("near")
    )
    most = 64 if beside is None else int(beside * 2 * width)
    seg, low = F.shiftright("cell", width), F.col("cell").bitwiseAND(F.lit((1 << half) - 1))
    high = F.shiftright("cell", half).bitwiseAND(F.lit((1 << half) - 1))
    size = F.floor(F.log2("n")).cast("long")
    pack = lambda side, fixed, other: F.shiftleft(F.shiftleft(F.shiftleft(seg * 2 + side, half) + fixed, half) + other, _CLASS) + F.col("size")
    extra = [] if beside is None else ["ones", "vary"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * (1 + len(extra))

        def met(cols: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in variant_stars(cols[0], width, *cols[1:], most=most)], schema.names)

        for batch in batches:
            held = [np.concatenate([x, c.to_numpy()]) for x, c in zip(held, batch.columns, strict=True)]
            key = held[0]
            if len(key) < _STEP:
                continue
            end = int(np.searchsorted(key, key[-1] >> (half + _CLASS) << (half + _CLASS)))  # the last half may go on
            if end:
                yield met([x[:end] for x in held])
                held = [x[end:] for x in held]
        if len(held[0]):
            yield met(held)

    def stars_of(own: DataFrame) -> DataFrame:
        if beside is None:
            values = own.groupBy("cell").agg(F.count("*").alias("n")).withColumn("size", size)
        else:
            values = own.groupBy("cell").agg(F.count("*").alias("n"), F.expr("bit_or(near)").alias("ones"), F.expr("bit_or(near) ^ bit_and(near)").alias("vary"))
            apart = (F.col("n") == 2) & (F.bit_count("vary") > most)  # two texts that meet by chance have no bucket of their own
            values = values.withColumn("size", F.when(apart, F.lit(0).cast("long")).otherwise(size))
        dealt = values.select(F.explode(F.array(pack(0, high, low), pack(1, low, high))).alias("key"), *extra)
        dealt = dealt.repartition(F.shiftright("key", half + _CLASS)).sortWithinPartitions("key")
        return materialize(dealt.mapInArrow(run, schema).distinct(), label)

    # segments in two parts, one after the other, so that their shuffles do not add up on the disks
    stars = stars_of(parts.filter("seg % 2 = 0")).unionByName(stars_of(parts.filter("seg % 2 = 1")))
    return parts.select("id", "cell").join(stars, "cell").select("bucket", "id").distinct()


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    return [np.unique(shingle_hashes(ascii_words(t), size)) for t in texts]


def near_duplicate_groups(docs: DataFrame, p: NearDupParams = NearDupParams(), label: str = "neardup") -> DataFrame:
    """``(dk, tkey, group_dk, group_tkey)`` of every distinct ``(doc_id, text)``; the group is named by its first member.

    Candidates come from deletion-variant signatures of wide SimHash fingerprints, are contracted by Hamming distance,
    and the groups that arise are verified by exact Jaccard similarity of the shingle sets; only members of such groups
    bring their texts. Texts without words are alike. Null ids stand before all others.
    """
    keyed = _keyed(docs)
    places = materialize(keyed.groupBy("tkey", "dk").agg(F.count("*").alias("n")).select("tkey", "dk"), f"{label}-places")
    schema = fields("id long, segs array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (np.unique(shingle_hashes(ascii_words(t.as_py()), p.shingle)) for t in batch.column(1))
            segs = wide_fingerprints(list(sets), p.bits, p.width).astype(np.int32)
            starts = pa.array(np.arange(0, segs.size + 1, p.segments, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(starts, pa.array(segs.ravel()))], schema.names)

    prints = keyed.select(F.col("tkey").alias("id"), "text").mapInArrow(run, schema).groupBy("id").agg(F.first("segs").alias("segs"))
    prints = materialize(prints, f"{label}-fp")
    places_of = materialize(neighbour_buckets(prints, p.width, f"{label}-stars", p.beside), f"{label}-met")
    # buckets with the same members are one: they are told by size and two checksums
    met = places_of.groupBy("bucket").agg(F.count("*").alias("n"), F.expr("bit_xor(id)").alias("x"), F.expr("bit_xor(xxhash64(id))").alias("y"))
    met = met.filter("n > 1").groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    found = places_of.join(met, "bucket").join(prints, "id")
    most = int(p.radius * p.segments * p.width)

    def by_bits(payload: list):
        segs = np.array(payload, np.uint32)
        rest = np.arange(len(segs))
        while len(rest):
            front, rest = [int(rest[0])], rest[1:]
            while front and len(rest):
                at = front.pop()
                near = np.bitwise_count(segs[rest] ^ segs[at]).sum(axis=1, dtype=np.int64) <= most
                if near.any():
                    hits = rest[near].tolist()
                    rest = rest[~near]
                    front += hits
                    yield from zip(repeat(at), hits)

    rough = connected_components(bucket_edges(found, "segs", by_bits), f"{label}-rough")
    texts = keyed.select(F.col("tkey").alias("node"), "text").join(rough, "node")
    members = texts.groupBy(F.col("root").alias("bucket"), F.col("node").alias("id")).agg(F.first("text").alias("text"))

    def by_shingles(payload: list):
        return jaccard_forest(shingle_sets(payload, p.shingle), p.similarity)

    edges = bucket_edges(members, "text", by_shingles, p.block)
    roots = connected_components(edges, f"{label}-cc").select(F.col("node").alias("tkey"), "root")
    rooted = places.join(roots, "tkey", "left").withColumn("root", F.coalesce("root", "tkey"))
    first = rooted.groupBy("root").agg(F.min(F.struct("dk", "tkey")).alias("g"))
    return rooted.join(first, "root").select("dk", "tkey", F.col("g.dk").alias("group_dk"), F.col("g.tkey").alias("group_tkey"))


def drop_near_duplicates(docs: DataFrame, p: NearDupParams = NearDupParams()) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the first by id; all columns are passed on.

    Texts without a word are one group; of repeated rows one stays; a null id stands before all others. Texts count
    whole, and an empty table stays empty.
    """
    groups = near_duplicate_groups(docs, p)
    at = (fresh(docs.columns, "dk"), fresh(docs.columns, "tkey"))
    stay = groups.filter("dk = group_dk and tkey = group_tkey").select(F.col("dk").alias(at[0]), F.col("tkey").alias(at[1]))
    kept = _keyed(docs, carry=at).join(stay, list(at), "left_semi")
    return kept.dropDuplicates(list(at)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_simhash_neardup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of the whole ``documents`` table: 3-word shingles, 64 bits, radius 3."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = simhash_components(simhash_fingerprints(docs, shingle=3), radius=3)
    return out.select(F.col("id").alias("doc_id"), hex16("fp").alias("fingerprint"), "component_id")
