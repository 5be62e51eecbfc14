"""Audited bodies of documents, their resolution against earlier names, provider arrays, the quality gate, the union of entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalis.functions.text import bound, missing, normalize_name, normalize_ws, stable_id, text_or_empty
from fiscalis.operators.entities import canonical_org, infer_organization
from fiscalis.operators.findings import org_type, region_label
from fiscalis.operators.temporal import objective
from fiscalis.rules import tables as T

#: How sure a name is, by where it comes from; what entities without a confidence get.
FROM_DOCUMENT, FROM_EVENT, RESOLVED = 0.85, 0.75, 0.92
DEFAULTS = {"PUBLIC_ORGANIZATION": 0.9, "PROVIDER": 0.85, "PERSON": 0.5}


def _first_fitting(names: list[Column], clean) -> Column:
    """The first name of 3 to 180 characters once cleaned, else empty; later patterns are tried only if none fits before."""
    fits = [bound(clean(n), lambda x: F.when(F.length(x).between(3, 180), x)) for n in names]
    return F.coalesce(*fits, F.lit(""))


def guess_entity(title: Column, purpose: Column) -> Column:
    """The audited body by the objective's patterns, then the title's."""
    of = lambda col, patterns: [F.regexp_extract(text_or_empty(col), f"(?iuU){p}", 1) for p in patterns]
    return _first_fitting([*of(purpose, T.GUESS_OBJECTIVE), *of(title, T.GUESS_TITLE)], lambda n: F.btrim(normalize_ws(n), F.lit(" -")))


def public_organization(raw_text: Column, event_name: Column) -> Column:
    """The body of a document: its event's, else by patterns in the objective, or in the whole text without one."""

    def search(purpose: Column) -> Column:
        where = F.when(purpose != "", purpose).otherwise(text_or_empty(raw_text))
        found = lambda p: F.regexp_extract(where, f"(?iuU){p}", 1)
        return _first_fitting([found(p) for p in T.PUBLIC_BODIES], canonical_org)

    own = _first_fitting([text_or_empty(event_name)], canonical_org)
    return bound(own, lambda n: F.when(n != "", n).otherwise(bound(objective(raw_text), search)))


def last_event(events: DataFrame) -> DataFrame:
    """The event of each document, the last by id: ``document_id, event_id, event_name, event_region``."""
    usable = events.filter(missing(F.col("document_id")).isNotNull())
    e = usable.groupBy("document_id").agg(F.max_by(F.struct("event_id", "entity_name", "region"), "event_id").alias("e"))
    return e.select("document_id", F.col("e.event_id").alias("event_id"), F.col("e.entity_name").alias("event_name"), F.col("e.region").alias("event_region"))


def document_organizations(documents: DataFrame, events: DataFrame) -> DataFrame:
    """``(document_id, organization_id, name, normalized_name, organization_type, region, confidence)``.

    Every document with a name that can be told, and every event without a document whose own name can, less surely.
    """
    e = last_event(events)
    both = documents.select("document_id", "raw_text", "region", "unit_cgr", "title", F.lit(True).alias("__doc")).join(e, "document_id", "full_outer")
    rows = both.withColumn("name", public_organization(F.col("raw_text"), F.col("event_name"))).filter("name <> ''")
    rows = rows.withColumn("normalized_name", normalize_name(F.col("name")))
    return rows.select(
        "document_id", stable_id("ENT", F.col("normalized_name")).alias("organization_id"), "name", "normalized_name", org_type(F.col("name")).alias("organization_type"),
        region_label(F.col("region"), F.col("event_region"), F.col("unit_cgr"), F.col("title")).alias("region"),
        F.when(F.col("__doc"), F.lit(FROM_DOCUMENT)).otherwise(F.lit(FROM_EVENT)).alias("confidence"),
    )


def organization_rows(by_document: DataFrame) -> DataFrame:
    """One row per organization: that of its last document by id, which is its source."""
    rest = [c for c in by_document.columns if c not in ("organization_id", "document_id")]
    last = by_document.groupBy("organization_id").agg(F.max_by(F.struct("document_id", *rest), "document_id").alias("r"))
    return last.select("organization_id", F.col("r.document_id").alias("source_document_id"), *[F.col(f"r.{c}").alias(c) for c in rest])


def resolve_documents(documents: DataFrame, previous: DataFrame) -> DataFrame:
    """``(document_id, organization_id, name, normalized_name, organization_type, region, confidence)`` by resolved names.

    A document's earlier name is that of the organization whose source it is, the last by id.
    """
    old = previous.filter(missing(F.col("source_document_id")).isNotNull()).groupBy(F.col("source_document_id").alias("document_id")).agg(F.max_by("name", "organization_id").alias("__old"))
    rows = documents.join(old, "document_id", "left").withColumn("name", infer_organization(F.col("title"), objective(F.col("raw_text")), F.col("__old"))).filter("name <> ''")
    rows = rows.withColumn("normalized_name", normalize_name(F.col("name")))
    return rows.select(
        "document_id", stable_id("ENT", F.col("normalized_name")).alias("organization_id"), "name", "normalized_name", org_type(F.col("name")).alias("organization_type"),
        region_label(F.col("region"), F.col("unit_cgr"), F.col("title")).alias("region"), F.lit(RESOLVED).alias("confidence"),
    )


def _collected(rows: DataFrame, each: DataFrame, key: str, ordered: bool) -> DataFrame:
    """``rows`` with ``provider_ids, provider_names`` from ``each (key, pos, id, name)``; rows without any get empty arrays."""
    by = F.struct("pos", "id", "name") if ordered else F.struct("id", "name")
    found = each.groupBy(key).agg(F.array_sort(F.collect_list(by) if ordered else F.collect_set(by)).alias("l"))
    found = found.select(key, F.transform("l", lambda x: x["id"]).alias("provider_ids"), F.transform("l", lambda x: x["name"]).alias("provider_names"))
    empty = F.array().cast("array<string>")
    out = rows.drop("provider_ids", "provider_names").join(found, key, "left")
    return out.withColumn("provider_ids", F.coalesce("provider_ids", empty)).withColumn("provider_names", F.coalesce("provider_names", empty))


def remap_providers(enriched: DataFrame, mapping: DataFrame, providers: DataFrame, key: str = "finding_id") -> DataFrame:
    """Enrichment with the providers that ``mapping (provider_id, targets)`` leads to, distinct and in order, with names.

    An id without a mapping or without targets leaves nothing.
    """
    ids = enriched.select(key, F.explode("provider_ids").alias("provider_id")).join(mapping, "provider_id").select(key, F.explode("targets").alias("id"))
    each = ids.distinct().join(providers.select(F.col("provider_id").alias("id"), "name"), "id").withColumn("pos", F.lit(0))
    return _collected(enriched, each, key, ordered=False)


def keep_providers(enriched: DataFrame, clean: DataFrame, key: str = "finding_id") -> DataFrame:
    """Enrichment with the providers that are in ``clean (provider_id, name)``, in their order, names anew."""
    each = enriched.select(key, F.posexplode("provider_ids").alias("pos", "id")).join(clean.select(F.col("provider_id").alias("id"), "name"), "id")
    return _collected(enriched, each, key, ordered=True)


def drop_targets(relationships: DataFrame, removed: DataFrame) -> DataFrame:
    """Relationships that do not lead to one of ``removed (provider_id)``."""
    return relationships.join(removed.select(F.col("provider_id").alias("target_entity_id")), "target_entity_id", "left_anti").select(*relationships.columns)


def entity_union(organizations: DataFrame, providers: DataFrame, persons: DataFrame) -> DataFrame:
    """All entities under one schema; of equal ids a person stands before a provider, and that before an organization."""

    def side(df: DataFrame, key: str, kind: str, rank: int) -> DataFrame:
        has = lambda c: text_or_empty(F.col(c)) if c in df.columns else F.lit("")
        confidence = F.coalesce(F.nullif(F.col("confidence"), F.lit(0.0)), F.lit(DEFAULTS[kind])) if "confidence" in df.columns else F.lit(DEFAULTS[kind])
        return df.filter(missing(F.col(key)).isNotNull()).select(
            F.col(key).alias("entity_id"), F.lit(rank).alias("rank"), F.lit(kind).alias("entity_type"), has("name").alias("name"), has("normalized_name").alias("normalized_name"),
            has("rut").alias("rut"), (F.lit("") if kind == "PERSON" else has("region")).alias("region"), has("source_document_id").alias("source_document_id"), confidence.alias("confidence"),
        )

    every = side(organizations, "organization_id", "PUBLIC_ORGANIZATION", 1).unionByName(side(providers, "provider_id", "PROVIDER", 2)).unionByName(side(persons, "person_id", "PERSON", 3))
    rest = [c for c in every.columns if c not in ("entity_id",)]
    return every.groupBy("entity_id").agg(F.max(F.struct(*rest)).alias("e")).select("entity_id", *[F.col(f"e.{c}").alias(c) for c in rest if c != "rank"])


def quality_gate(organizations: DataFrame, providers: DataFrame, persons: DataFrame, enriched: DataFrame, relationships: DataFrame) -> dict[str, DataFrame]:
    """Providers that carry a public organization's name go, from all tables that mention them; the entities anew."""
    public = organizations.filter(missing(F.col("name")).isNotNull()).select(normalize_name(F.col("name")).alias("__n")).distinct()
    with_name = providers.filter(missing(F.col("provider_id")).isNotNull()).withColumn("__n", normalize_name(F.col("name")))
    removed = with_name.join(public, "__n", "left_semi").select("provider_id").distinct()
    clean = providers.join(removed, "provider_id", "left_anti").select(*providers.columns)
    return {
        "providers": clean,
        "removed": removed,
        "finding_enrichment": keep_providers(enriched, clean),
        "relationships": drop_targets(relationships, removed),
        "entities": entity_union(organizations, clean, persons),
    }
