"""Tables of the engine: declared schemas, JSONL import and export, dated snapshots, Parquet marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_OCCURRENCE = "occurrence_date_from string, occurrence_date_to string, occurrence_date_anchor string, occurrence_date_precision string, occurrence_date_basis string, occurrence_date_confidence double"


@dataclass(frozen=True)
class TableSpec:
    """Name, key and columns of a keyed table."""

    name: str
    key: str
    ddl: str

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


SPECS = {
    s.name: s
    for s in (
        TableSpec("documents", "document_id", "document_id string, source_system string, source_module string, source_url string, title string, document_number string, document_date string, document_type string, region string, unit_cgr string, level string, pdf_url string, content_hash string, retrieved_at string, raw_text string"),
        TableSpec("events", "event_id", "event_id string, document_id string, event_type string, event_date string, title string, entity_name string, region string, source_url string, source_module string, status string, retrieved_at string"),
        TableSpec("findings", "finding_id", f"finding_id string, event_id string, document_id string, finding_order int, description string, finding_type string, risk_family string, severity string, aml_relevance string, aml_score int, amount_clp bigint, enforcement array<string>, source_url string, evidence_id string, {_OCCURRENCE}"),
        TableSpec("evidence", "evidence_id", "evidence_id string, document_id string, finding_id string, source_url string, source_section string, source_text string, page int, paragraph int, content_hash string, retrieved_at string"),
        TableSpec("organizations", "organization_id", "organization_id string, name string, normalized_name string, organization_type string, region string, commune string, rut string, source_document_id string, confidence double"),
        TableSpec("providers", "provider_id", "provider_id string, name string, normalized_name string, provider_type string, rut string, region string, source_document_id string, confidence double"),
        TableSpec("persons", "person_id", "person_id string, name string, normalized_name string, role string, organization_id string, rut string, source_document_id string, confidence double"),
        TableSpec("relationships", "relationship_id", "relationship_id string, source_entity_id string, target_entity_id string, relationship_type string, document_id string, event_id string, finding_id string, evidence_id string, source_url string, confidence double"),
        TableSpec("watch_items", "watch_id", "watch_id string, source_id string, watch_type string, title string, source_url string, stage string, first_seen string, last_seen string, matched_document_id string, match_confidence double, status string"),
        TableSpec("audit_registry", "registry_id", "registry_id string, audit_hash string, audit_url string, status string, attempts int, first_seen string, last_seen string, last_error string, document_id string, discovery_channel string, discovery_source string"),
        TableSpec("source_runs", "run_id", "run_id string, source_id string, source_name string, source_url string, started_at string, finished_at string, status string, http_status int, content_hash string, error string"),
    )
}


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_jsonl(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Rows of JSON lines under the declared schema; an absent file is an empty table, a bad line an error."""
    if not _exists(spark, path):
        return spark.createDataFrame([], spec.schema)
    return spark.read.schema(spec.schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, spec: TableSpec, path: str) -> None:
    """JSON lines ordered by key, columns by name."""
    df.select(*sorted(df.columns)).orderBy(F.col(spec.key).cast("string")).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_snapshots(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """One JSON document per source and day below ``root/source/day/``, with ``source_id`` and ``run_date`` from the path."""
    df = spark.read.schema(schema).option("multiLine", True).json(f"{root}/*/*/snapshot.json")
    path = F.col("_metadata.file_path")
    return df.select("*", F.regexp_extract(path, r"/([^/]+)/([^/]+)/snapshot\.json$", 1).alias("source_id"), F.regexp_extract(path, r"/([^/]+)/([^/]+)/snapshot\.json$", 2).alias("run_date"))


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace the partitions ``(source_id, run_date)`` that ``df`` holds, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_id", "run_date").parquet(path)


def write_marts(marts: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Parquet tables below ``root`` and their numbers of rows, counted while they are written.

    An empty mart replaces what was there as any other does, so no table of an earlier run is read as today's.
    """
    written = {}
    for name, df in marts.items():
        seen = Observation(f"rows_{name}")
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/{name}")
        written[name] = seen.get["n"]
    return written


def enabled_sources(spark: SparkSession, path: str) -> DataFrame:
    """Sources of a configuration file ``{"sources": [...]}`` that are not switched off."""
    doc = spark.read.option("multiLine", True).schema("sources array<struct<id:string,name:string,url:string,collector:string,enabled:boolean>>").json(path)
    return doc.select(F.explode("sources").alias("s")).select("s.*").filter(F.coalesce("enabled", F.lit(True)))
