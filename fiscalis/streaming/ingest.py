"""Streams into keyed tables: each micro-batch is merged as :func:`fiscalis.operators.store.upsert` merges a batch.

A table is laid out by a hash of its key: ``root/<version>/bucket=<n>``. A manifest names, for each bucket, the version that
holds it, so a batch reads and writes the buckets of its own keys only and takes the others over by name. A manifest is
moved into place when all it names is written; readers see the table before or after a batch, nothing between.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fiscalis.operators.store import keep_last, upsert
from fiscalis.sources.publication import POINTER, manifests, next_version, read_text, write_manifest
from fiscalis.sources.tables import TableSpec

BUCKETS = 256


@dataclass
class Manifest:
    """Number of buckets of a table, and the version that holds each bucket that has rows."""

    buckets: int = BUCKETS
    held: dict[int, str] = field(default_factory=dict)

    def paths(self, root: str, only: list[int] | None = None) -> list[str]:
        return [f"{root}/{v}/bucket={b}" for b, v in sorted(self.held.items()) if only is None or b in only]

    def to_json(self) -> str:
        return json.dumps({"buckets": self.buckets, "held": {str(k): v for k, v in sorted(self.held.items())}})

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        doc = json.loads(text)
        return cls(doc["buckets"], {int(k): v for k, v in doc["held"].items()})


def read_manifest(spark: SparkSession, root: str, name: str) -> Manifest:
    return Manifest.from_json(read_text(spark, f"{root}/{POINTER}/{name}"))


def _read(spark: SparkSession, spec: TableSpec, paths: list[str]) -> DataFrame:
    return spark.read.schema(spec.schema).parquet(*paths) if paths else spark.createDataFrame([], spec.schema)


def current_version(spark: SparkSession, root: str, spec: TableSpec, keys: list | None = None) -> DataFrame:
    """The table of the newest manifest; empty before the first. With ``keys`` only their buckets are read."""
    _, _, names = manifests(spark, root)
    if not names:
        return spark.createDataFrame([], spec.schema)
    manifest = read_manifest(spark, root, names[-1])
    if keys is None:
        return _read(spark, spec, manifest.paths(root))
    asked = spark.createDataFrame([(k,) for k in keys], StructType([spec.schema[spec.key]]))
    return _read(spark, spec, manifest.paths(root, _touched(asked, spec.key, manifest.buckets))).filter(F.col(spec.key).isin(keys))


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _touched(rows: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets of the keys of ``rows``: as many numbers as there are buckets at most."""
    return sorted(r.b for r in rows.select(bucket_of(key, buckets).alias("b")).distinct().collect())


def _drop_unnamed(spark: SparkSession, root: str, fs, folder, names: list[str], keep: int) -> None:
    """Delete all manifests but the last ``keep``, and the buckets that none of those names."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    named = {f"{v}/bucket={b}" for n in names[-keep:] for b, v in read_manifest(spark, root, n).held.items()}
    for old in names[:-keep]:
        fs.delete(path(folder, old), False)
    for x in fs.listStatus(path(root)):
        version = x.getPath().getName()
        if not version.startswith("v"):
            continue
        inside = [y.getPath() for y in fs.listStatus(x.getPath()) if y.getPath().getName().startswith("bucket=")]
        if not any(f"{version}/{y.getName()}" in named for y in inside):
            fs.delete(x.getPath(), True)
            continue
        for y in inside:
            if f"{version}/{y.getName()}" not in named:
                fs.delete(y, True)


def merge_batch(root: str, spec: TableSpec, order: str, keep: int = 2, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Writer of one micro-batch: the buckets of its keys are merged and written, then named by a new manifest.

    Versions are counted by the table, not by the stream, so a stream that begins anew goes on from what is there. A
    repeated batch merges the same rows again, which changes nothing. An empty batch writes nothing. All but the last
    ``keep`` versions are deleted. ``buckets`` is settled by the first batch; choose it so that one bucket is a good file.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fs, folder, names = manifests(spark, root)
        manifest = read_manifest(spark, root, names[-1]) if names else Manifest(buckets)
        rows = keep_last(batch.select(*spec.schema.names), spec.key, order)
        touched = _touched(rows, spec.key, manifest.buckets)
        if not touched:
            return
        version = next_version(names)
        merged = upsert(_read(spark, spec, manifest.paths(root, touched)), rows, spec.key).drop("change")
        placed = merged.withColumn("bucket", bucket_of(spec.key, manifest.buckets)).repartition("bucket")
        placed.write.partitionBy("bucket").parquet(f"{root}/{version}")
        held = manifest.held | dict.fromkeys(touched, version)
        write_manifest(spark, fs, folder, version, Manifest(manifest.buckets, held).to_json())
        _drop_unnamed(spark, root, fs, folder, [*names, version], keep)

    return write


def stream_upserts(rows: DataFrame, root: str, spec: TableSpec, order: str, checkpoint: str) -> StreamingQuery:
    """Start merging a stream into the table below ``root``; takes what is there and ends."""
    query = rows.writeStream.foreachBatch(merge_batch(root, spec, order)).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def hourly_counts(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Events by type and hour of a stream with a column ``ts``; rows later than ``late`` are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))
