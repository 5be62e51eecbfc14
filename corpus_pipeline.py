"""A pipeline over ``documents``: toxicity, line dedup, near-duplicates, benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalis.llm.common import bounded_batches, materialize
from fiscalis.llm.decontaminate import LeakParams, drop_leaks
from fiscalis.llm.lines import dedup_lines
from fiscalis.llm.packing import pack_documents
from fiscalis.llm.simhash import drop_near_duplicates
from fiscalis.llm.toxicity import drop_toxic


def toxicity(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    bounded_batches(spark)
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, near-equal lines once; ``n_chars`` follows the text. A document may be left with an empty text."""
    out = dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first by id, of each group linked by 5-word shingles at a similarity of 0.8 or more."""
    return drop_near_duplicates(docs)


def decontamination(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its error budget."""
    bounded_batches(spark)
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), LeakParams(short=True))


def packing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack_documents(docs.select("doc_id", "text")).select(*cols)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL expresses neither trained scores nor tokenizers; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; the table between two stages is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
