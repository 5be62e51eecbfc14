"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one under a local master that names none, else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="fiscalis-")
    return _LOCAL[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no table has yet."""
    return f"{shared_folder(spark)}/fiscalis-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table of the shared folder: later uses read it, and what a lost executor held is read again."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def write_once(df: DataFrame, path: str) -> None:
    """Write ``df`` unless a complete table is there; what an earlier run left half written is replaced."""
    if not is_complete(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)
