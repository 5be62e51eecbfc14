"""Entity hub and guarded export to other systems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fiscalis.functions.dates import export_timestamp
from fiscalis.functions.identity import entity_role, global_entity_id, normalize_rut, territory
from fiscalis.functions.text import direct_id, missing, normalize_name, text_or_empty

#: The name under which this engine exports, and fixed values: version, first source, prefix of ids of made evidence.
PRODUCER = "FISCALIS"
VERSION, ULTIMATE, DIRECT = "1.0", "CGR", "EVD-CGR-DOC"


def _or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def adapt_entities(entities: DataFrame) -> DataFrame:
    """Hub rows: resolved by a valid national id, otherwise candidates under their source's id. Other columns stay."""
    rest = [c for c in entities.columns if c not in ("entity_id", "rut", "confidence")]
    rut, source = normalize_rut(F.col("rut")), missing(F.col("entity_id").cast("string"))
    region, kind = _or_null(entities, "region"), F.coalesce(missing(F.col("entity_type")), F.lit("SOURCE_ENTITY"))
    confidence = F.coalesce(_or_null(entities, "confidence").cast("double"), F.lit(0.0))
    out = entities.select(*rest, source.alias("source_entity_id"), rut.alias("rut"), confidence.alias("confidence"), global_entity_id(F.col("rut")).alias("entity_id"))
    ok = F.col("rut").isNotNull()
    return (
        out.withColumn("interop_version", F.lit(VERSION))
        .withColumn("candidate_entity_id", F.when(~ok, F.col("source_entity_id")))
        .withColumn("entity_type", kind)
        .withColumn("entity_role", entity_role(kind))
        .withColumn("rut_valid", ok)
        .withColumn("canonical_name", text_or_empty(F.col("name")))
        .withColumn("normalized_name", F.coalesce(missing(_or_null(entities, "normalized_name")), normalize_name(F.col("name"))))
        .withColumn("identity_status", F.when(ok, "RESOLVED").otherwise("UNRESOLVED"))
        .withColumn("identity_method", F.when(ok, "RUT_EXACT").otherwise("SOURCE_LOCAL_ONLY"))
        .withColumn("identity_confidence", F.when(ok, 1.0).otherwise(0.0))
        .withColumn("candidate_confidence", F.when(~ok, F.col("confidence")))
        .withColumn("territory_mapping_status", F.when(missing(region).isNotNull(), "UNRESOLVED_NAME_ONLY").otherwise("UNKNOWN"))
        .drop("confidence")
    )


def _stamp(c: str) -> Column:
    return export_timestamp(F.col(c))


def _evidence_object(df: DataFrame, source: Column, method: str, published: Column, excerpt: Column) -> DataFrame:
    got = _stamp("retrieved_at")
    return df.select(
        "evidence_id", "document_id", F.lit(PRODUCER).alias("producer_id"), source.alias("source_id"), F.lit(ULTIMATE).alias("ultimate_source_id"),
        missing(F.col("source_url")).alias("source_url"), F.lit("OFFICIAL").alias("source_tier"), F.lit(f"{PRODUCER}_{method}").alias("capture_method"),
        missing(F.trim(_or_null(df, "content_hash"))).alias("content_sha256"), F.lit("VALID").alias("quality_status"), published.alias("source_published_at"),
        got.alias("retrieved_at"), got.alias("ingested_at"), excerpt.alias("excerpt"), F.lit(VERSION).alias("schema_version"),
    )


def export_evidence(evidence: DataFrame, documents: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Evidence objects, and the events that have none and cannot get one.

    Findings' evidence with an id and a time of retrieval; one object made from each document without any, and one
    from each event whose document has none. The last row of an id counts.
    """
    null = F.lit(None).cast("string")
    own = _evidence_object(evidence.filter(missing(F.trim("evidence_id")).isNotNull() & _stamp("retrieved_at").isNotNull()), F.lit("CGR_AUDIT_EVIDENCE"), "FINDING_EXTRACTION", null, missing(F.col("source_text")))
    docs = documents.filter(missing(F.trim("document_id")).isNotNull() & _stamp("retrieved_at").isNotNull())
    bare = docs.join(own.select("document_id").distinct(), "document_id", "left_anti")
    seeded = bare.withColumn("evidence_id", direct_id(DIRECT, F.concat("document_id", F.lit("|"), text_or_empty(F.col("source_url")))))
    made = _evidence_object(seeded, F.coalesce(missing(F.col("source_module")), F.lit("CGR_DOCUMENT")), "DOCUMENT", _stamp("document_date"), null)
    held = own.unionByName(made)
    alone = events.filter(missing(F.trim("event_id")).isNotNull()).join(held.select("document_id").distinct(), "document_id", "left_anti")
    timed = alone.filter(_stamp("retrieved_at").isNotNull()).drop("content_hash")
    from_event = timed.withColumn("evidence_id", direct_id(DIRECT, F.concat("event_id", F.lit("|"), text_or_empty(F.col("source_url"))))).withColumn("document_id", F.concat(F.lit("\u0000"), "event_id"))
    late = _evidence_object(from_event, F.coalesce(missing(F.col("source_module")), F.lit("CGR_EVENT")), "EVENT", _stamp("event_date"), null)
    return held.unionByName(late), alone.filter(_stamp("retrieved_at").isNull())


def evidence_ids(objects: DataFrame) -> DataFrame:
    """``(document_id, evidence_ids)``: sorted distinct ids of each document."""
    return objects.groupBy("document_id").agg(F.array_sort(F.collect_set("evidence_id")).alias("evidence_ids"))


def with_fallback_evidence(documents: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence rows, and one made from each document that has none: ``evidence_id, document_id, source_url, synthetic``."""
    own = evidence.select("evidence_id", "document_id", "source_url", F.lit(False).alias("synthetic"))
    bare = documents.join(evidence.select("document_id").distinct(), "document_id", "left_anti")
    made = bare.select(direct_id("EVD", F.concat(F.lit("DOCUMENT|"), F.col("document_id"))).alias("evidence_id"), "document_id", "source_url", F.lit(True).alias("synthetic"))
    return own.unionByName(made)


def export_entities(hub: DataFrame, objects: DataFrame) -> DataFrame:
    """One object per global id that has evidence: the first row's scalars, roles in order of their first row, evidence united."""
    own = hub.filter(text_or_empty(F.col("entity_id")).startswith("ENT-RUT-")).join(evidence_ids(objects).withColumnRenamed("document_id", "source_document_id"), "source_document_id")
    role = F.coalesce(missing(F.col("entity_role")), F.lit("SOURCE_ENTITY"))
    kind = F.when(F.upper(text_or_empty(F.col("entity_type"))).contains("PERSON"), "PERSON").when(role == "PUBLIC_BODY", "PUBLIC_BODY").otherwise("LEGAL_ENTITY")
    rows = own.select("entity_id", "source_entity_id", role.alias("role"), kind.alias("kind"), missing(F.col("canonical_name")).alias("canonical_name"), missing(F.col("rut")).alias("rut"), "evidence_ids")
    roles = rows.groupBy("entity_id", "role").agg(F.min("source_entity_id").alias("at")).groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct("at", "role"))).alias("r"))
    ids = rows.select("entity_id", F.explode("evidence_ids").alias("e")).groupBy("entity_id").agg(F.array_sort(F.collect_set("e")).alias("evidence_ids"))
    first = rows.groupBy("entity_id").agg(F.min_by(F.struct("kind", "canonical_name", "rut"), "source_entity_id").alias("f"))
    return first.join(roles, "entity_id").join(ids, "entity_id").select(
        "entity_id", F.col("f.kind").alias("entity_type"), "f.canonical_name", F.col("f.rut").alias("rut_normalized"), F.array().cast("array<string>").alias("aliases"),
        F.transform("r", lambda x: x["role"]).alias("roles"), F.array(F.lit(PRODUCER)).alias("producer_ids"), "evidence_ids", F.lit("RUT_EXACT").alias("identity_method"), F.lit(1.0).alias("identity_confidence"),
    )


def export_events(events: DataFrame, objects: DataFrame) -> DataFrame:
    """Event objects with the evidence of their documents, or their own; events without any are left out."""
    ids = evidence_ids(objects)
    rows = events.filter(missing(F.trim("event_id")).isNotNull()).join(ids, "document_id", "left")
    lone = ids.select(F.substring("document_id", 2, 1_000_000).alias("event_id"), F.col("evidence_ids").alias("__own")).filter(F.col("document_id").startswith("\u0000"))
    rows = rows.join(lone, "event_id", "left").withColumn("evidence_ids", F.coalesce("evidence_ids", "__own")).filter("evidence_ids is not null")
    day, got, place = _stamp("event_date"), _stamp("retrieved_at"), territory(F.col("region"))
    null = F.lit(None).cast("string")
    temporal = F.struct(day.alias("valid_from"), null.alias("valid_to"), day.alias("source_published_at"), got.alias("observed_at"), got.alias("retrieved_at"), got.alias("ingested_at"), null.alias("last_seen_at"), F.lit("CURRENT").alias("freshness_state"))
    opt = lambda c: missing(_or_null(events, c))
    attributes = F.struct(opt("document_id").alias("document_id"), opt("title").alias("title"), opt("status").alias("status"), opt("entity_name").alias("entity_name_unresolved"), opt("region").alias("region_name"))
    return rows.select(
        "event_id", F.coalesce(opt("event_type"), F.lit("CGR_OBSERVATION")).alias("event_type"), F.lit(PRODUCER).alias("producer_id"), F.array_compact(F.array(place)).alias("territory_ids"),
        "evidence_ids", temporal.alias("temporal"), attributes.alias("attributes"),
    )


def resolved_ids(hub: DataFrame) -> DataFrame:
    """``(source_entity_id, entity_id)`` of the rows with a global id, one per source id: the last."""
    own = hub.filter(text_or_empty(F.col("entity_id")).startswith("ENT-RUT-") & missing(F.col("source_entity_id")).isNotNull())
    return own.groupBy("source_entity_id").agg(F.max("entity_id").alias("entity_id"))


def promote_relationships(relationships: DataFrame, resolved: DataFrame, evidence: DataFrame) -> DataFrame:
    """Relationships whose two ends are resolved and whose evidence exists, with the global ids.

    ``resolved (source_entity_id, entity_id)`` has one row per source id; the rest of the rows is not exported.
    """
    ids = resolved.filter("entity_id is not null").select("source_entity_id", "entity_id")
    a = ids.toDF("source_entity_id", "source_global_id")
    b = ids.toDF("target_entity_id", "target_global_id")
    out = relationships.join(a, "source_entity_id").join(b, "target_entity_id")
    return out.join(evidence.select("evidence_id").distinct(), "evidence_id", "left_semi")


def export_relationships(relationships: DataFrame, hub: DataFrame, objects: DataFrame, events: DataFrame) -> DataFrame:
    """Relationship objects of :func:`promote_relationships`, with the time of their event if it is exported."""
    rows = promote_relationships(relationships, resolved_ids(hub), objects)
    rows = rows.join(events.select("event_id", "temporal"), "event_id", "left")
    return rows.select(
        "relationship_id", F.col("source_global_id").alias("source_entity_id"), F.col("target_global_id").alias("target_entity_id"),
        F.coalesce(missing(F.col("relationship_type")), F.lit("CGR_RELATION")).alias("relationship_type"), F.lit("DERIVED").alias("assertion_type"),
        F.coalesce(F.col("confidence"), F.lit(0.0)).alias("confidence"), F.array("evidence_id").alias("evidence_ids"), "temporal",
        F.struct(F.col("relationship_id").alias("source_relationship_id"), missing(F.col("finding_id")).alias("finding_id"), missing(F.col("event_id")).alias("event_id"), missing(F.col("document_id")).alias("document_id")).alias("attributes"),
    )


def export_status(hub: DataFrame, relationships: DataFrame, exported: dict[str, DataFrame], skipped_events: DataFrame) -> DataFrame:
    """``(name, n)``: rows of each exported table, and what was not resolved, not promoted, not placed or skipped."""
    one = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
    parts = [one(df, name) for name, df in sorted(exported.items())]
    parts.append(one(hub.filter(~text_or_empty(F.col("entity_id")).startswith("ENT-RUT-")), "unresolved_entity_candidates"))
    kept = exported["relationships"].select("relationship_id")
    parts.append(one(relationships.join(kept, "relationship_id", "left_anti"), "unpromoted_relationship_candidates"))
    parts.append(one(exported["events"].filter(F.size("territory_ids") > 0), "events_with_canonical_region"))
    parts.append(one(skipped_events, "events_skipped_without_evidence"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_export(tables: dict[str, DataFrame], root: str) -> dict[str, int]:
    """JSON lines of each table below ``root`` as ``<name>_fusion_v1``, and how many rows were written."""
    written = {}
    for name, df in tables.items():
        seen = Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{root}/{name}_fusion_v1")
        written[name] = seen.get["n"]
    return written


def require_rows(events: DataFrame, evidence: DataFrame) -> None:
    """Refuse to export nothing: an empty source must not look like a zero."""
    if events.isEmpty() and evidence.isEmpty():
        raise ValueError("neither events nor evidence: nothing to export")
