"""Document fingerprints: SimHash with weighted terms, and search by permuted block tables.

Every distinct term (a pair of neighbouring words) votes on 64 signed bits with weight 1 + ln(its count). The bits of
a fingerprint are cut into blocks; for each choice of the blocks that may hold differing bits a table is keyed by the
other blocks, so fingerprints within the radius meet in one table at least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalis.llm.common import bucket_edges, connected_components, fields, hex16, materialize
from fiscalis.llm.simhash import hamming_forest, shingle_hashes

BITS = 64
_STEP = 1 << 12


def weighted_fingerprint(text: str, size: int = 2) -> int:
    """The fingerprint of one text: equal texts have equal ones, a text without words has 0."""
    hashes = shingle_hashes(text.lower().encode("utf-8", "surrogatepass").split(), size)
    if not len(hashes):
        return 0
    terms, counts = np.unique(hashes, return_counts=True)
    votes = np.zeros(BITS)
    for at in range(0, len(terms), _STEP):
        part = np.ascontiguousarray(terms[at : at + _STEP]).view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little").astype(np.float64)
        weight = 1 + np.log(counts[at : at + _STEP])
        votes += 2 * (weight @ bits) - weight.sum()
    return int(np.packbits(votes > 0, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2) -> DataFrame:
    """``(id, fp long)`` of every row; null texts count as empty. No shuffle.

    Texts of any length count whole; repeated rows have a row each; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([weighted_fingerprint(t.as_py() or "", size) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, fields(f"id {kind}, fp long"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits of two fingerprints."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def block_keys(radius: int, blocks: int) -> list[int]:
    """One mask per table: the bits of the blocks that agree, for each choice of ``radius`` blocks that may not."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    return [sum(m for i, m in enumerate(masks) if i not in out) for out in combinations(range(blocks), radius)]


def in_tables(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """``prints`` once per table, with ``bucket``: table number and masked fingerprint, hashed to a long."""
    masks = [m - (1 << 64) if m >> 63 else m for m in block_keys(radius, blocks)]
    table = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.lit(m).alias("mask")) for i, m in enumerate(masks)]))
    return prints.select("*", table.alias("tab")).select(
        *prints.columns, F.xxhash64(F.col("tab.t"), F.col("fp").bitwiseAND(F.col("tab.mask"))).alias("bucket")
    )


def find_within(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """Distinct ``(query_fp, fp, distance)`` of all ``prints (fp)`` within ``radius`` bits of ``queries (fp)``.

    Both sides are reduced to distinct fingerprints; equal ones are found too, at distance 0.
    """
    left = in_tables(queries.select("fp").distinct(), radius, blocks).withColumnRenamed("fp", "query_fp")
    right = in_tables(prints.select("fp").distinct(), radius, blocks)
    distance = F.bit_count(F.col("query_fp").bitwiseXOR(F.col("fp")))
    return left.join(right, "bucket").select("query_fp", "fp", distance.alias("distance")).filter(F.col("distance") <= radius).distinct()


def fingerprint_classes(prints: DataFrame, radius: int = 3, blocks: int = 5, label: str = "fpclass") -> DataFrame:
    """``prints (id, fp)`` with ``class_id``: the least id reachable over fingerprints within ``radius`` bits."""
    nodes = prints.groupBy("fp").agg(F.min("id").alias("first_id"))
    members = in_tables(nodes.select(F.col("fp").alias("id"), "fp"), radius, blocks)

    def linker(payload: list):
        return hamming_forest(np.array(payload, np.int64).view(np.uint64), radius)

    edges = bucket_edges(members, "fp", linker)
    roots = connected_components(edges, label).select(F.col("node").alias("fp"), "root")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"))
    return prints.join(rooted.join(names, "root").select("fp", "class_id"), "fp")


def _edit(own: str, after: str) -> str:
    half = len(own) // 2
    return own[: len(own) - half] + after[:half]


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp`` of ``docs (doc_id, text)``; written.

    The edited text has the last half of the code points replaced by the first as many of the next document by
    ascending doc_id (equal ids by text; null ids first; after the last the first). Rows are dealt by ranges of
    doc_id, so texts move once and all neighbours but those at the borders meet in one task; each task leaves its
    first and last row, two per partition, to be joined. A null text is empty, a single row is its own neighbour, repeated
    rows are neighbours of one another, texts count whole, and an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = fields(
        f"part int, edge int, doc_id {kind}, n_chars long, edited_sha256 string, fp long, edited_fp long, next_fp long, text string"
    )

    def signed(fp: int) -> int:
        return fp - (1 << 64) if fp >> 63 else fp

    def finish(own: str, after: str) -> tuple[str, int]:
        edited = _edit(own, after)
        return hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), signed(weighted_fingerprint(edited))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None
        arrow = pa.schema([(f, t) for f, t in zip(schema.names, [pa.int32(), pa.int32(), None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()], strict=True) if t is not None])

        def table(rows, ids, id_type):
            cols = list(zip(*rows, strict=True))
            arrays = [pa.array(c, arrow.field(n).type) for c, n in zip(cols, arrow.names, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays[:2], pa.array(ids, id_type), *arrays[2:]], schema.names)

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            rows, ids = [], []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                doc, text = doc.as_py(), text.as_py() or ""
                fp = signed(weighted_fingerprint(text))
                if last is None:
                    rows.append((part, 1, None, None, fp, None, None, text))
                    ids.append(doc)
                else:
                    digest, edited = finish(last[1], text)
                    rows.append((part, 0, len(last[1]), digest, last[2], edited, fp, None))
                    ids.append(last[0])
                last = (doc, text, fp)
            if rows:
                yield table(rows, ids, id_type)
        if last is not None:
            yield table([(part, 2, len(last[1]), None, last[2], None, None, last[1])], [last[0]], id_type)

    dealt = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # a stated number of ranges is not merged again, so that each task sorts a small share of the texts
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "text")
    found = materialize(dealt.mapInArrow(run, schema), "edited")
    heads = found.filter("edge = 1").select("part", F.col("text").alias("after"), F.col("fp").alias("after_fp"))
    parts = sorted(r.part for r in heads.select("part").collect())  # one number per partition
    follows = docs.sparkSession.createDataFrame(
        [(a, b) for a, b in zip(parts, parts[1:] + parts[:1], strict=True)] or [(-1, -1)], "part int, next_part int"
    )
    tails = found.filter("edge = 2").join(F.broadcast(follows), "part")
    tails = tails.join(heads.withColumnRenamed("part", "next_part"), "next_part")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [finish(a.as_py(), b.as_py()) for a, b in zip(batch.column("text"), batch.column("after"), strict=True)]
            cols = [batch.column("doc_id"), batch.column("n_chars"), pa.array([e[0] for e in ends], pa.string()), batch.column("fp"), pa.array([e[1] for e in ends], pa.int64()), batch.column("after_fp")]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp"])

    out = fields(f"doc_id {kind}, n_chars long, edited_sha256 string, fp long, edited_fp long, next_fp long")
    closed = tails.select("doc_id", "n_chars", "text", "fp", "after", "after_fp").mapInArrow(close, out)
    return found.filter("edge = 0").select(*out.names).unionByName(closed)


def op5_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edited texts, with the class of each within three bits."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    pairs = edited_neighbours(docs).withColumnRenamed("doc_id", "id")
    classes = fingerprint_classes(pairs)
    return classes.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        hex16("fp").alias("fingerprint"),
        hex16("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "class_id",
    )
