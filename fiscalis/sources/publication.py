"""Atomic publication: tables are staged below a version of their own, then named by one manifest.

A manifest gives for each table its path, columns, number of rows and digest. It is written aside and moved into place when
all tables are complete, so readers see all tables of one version or all of the one before, whatever happens half way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POINTER = "_current"


def _path(spark: SparkSession, *parts):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(*parts)


def manifests(spark: SparkSession, root: str):
    """File system, folder of the manifests and their names, oldest first: names begin with a counter of the root."""
    folder = _path(spark, f"{root}/{POINTER}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(x.getPath().getName() for x in fs.listStatus(folder)) if fs.exists(folder) else []
    return fs, folder, [n for n in names if n.startswith("v")]


def next_version(names: list[str]) -> str:
    """A name after all of ``names`` that no other writer makes."""
    n = int(names[-1][1:13]) + 1 if names else 0
    return f"v{n:012d}-{uuid.uuid4().hex[:8]}"


def write_manifest(spark: SparkSession, fs, folder, name: str, text: str) -> None:
    """Write aside, then move into place."""
    part = _path(spark, folder, f"_{name}")
    out = fs.create(part, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    fs.rename(part, _path(spark, folder, name))


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first().value


def _digest(columns: list[str]) -> Column:
    """A sum over all rows that does not depend on their order."""
    row = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}))
    return F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def publish(tables: dict[str, DataFrame], root: str, keep: int = 2, text: Callable[[DataFrame, str], None] | None = None) -> dict[str, int]:
    """Stage all tables, then name them; the number of rows of each. All but the last ``keep`` versions are deleted.

    Rows and digests are taken while the tables are written. ``text(df, path)`` writes a table in another form than Parquet.
    """
    spark = next(iter(tables.values())).sparkSession
    fs, folder, names = manifests(spark, root)
    version = next_version(names)
    entries = {}
    for name, df in tables.items():
        seen = Observation(f"publish_{name}")
        own = df.observe(seen, F.count(F.lit(1)).alias("rows"), _digest(df.columns).alias("digest"))
        path = f"{root}/{version}/{name}"
        if text:
            text(own, path)
        else:
            own.write.parquet(path)
        entries[name] = {"path": f"{version}/{name}", "schema": df.schema.jsonValue(), "rows": seen.get["rows"], "digest": str(seen.get["digest"])}
    write_manifest(spark, fs, folder, version, json.dumps(entries))
    for old in names[: len(names) + 1 - keep]:
        fs.delete(_path(spark, folder, old), False)
    kept = {*names[max(0, len(names) + 1 - keep) :], version}
    for x in fs.listStatus(_path(spark, root)):
        if x.getPath().getName().startswith("v") and x.getPath().getName() not in kept:
            fs.delete(x.getPath(), True)
    return {name: e["rows"] for name, e in entries.items()}


def newest(spark: SparkSession, root: str) -> dict[str, dict]:
    """The entries of the newest manifest; none before the first."""
    _, _, names = manifests(spark, root)
    return json.loads(read_text(spark, f"{root}/{POINTER}/{names[-1]}")) if names else {}


def read_published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the newest version of Parquet tables, by name."""
    return {name: spark.read.parquet(f"{root}/{e['path']}") for name, e in newest(spark, root).items()}


def verify(spark: SparkSession, root: str) -> dict[str, bool]:
    """Whether each table of the newest version still has the rows and the digest that its manifest names."""
    out = {}
    for name, e in newest(spark, root).items():
        df = spark.read.parquet(f"{root}/{e['path']}")
        row = df.agg(F.count(F.lit(1)).alias("rows"), _digest(df.columns).alias("digest")).first()
        out[name] = (row.rows, str(row.digest)) == (e["rows"], e["digest"])
    return out
