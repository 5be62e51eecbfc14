"""The derivation: from documents, events, findings and watch items to entities, enrichment and marts.

Time, rules, bodies, providers and persons, resolution, quality gate, hub, follow-up, alerts, profiles. What several
marts read (the enriched findings, the mentions) is written once below ``work`` and read back, so no rule runs twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalis.functions.dates import document_date
from fiscalis.functions.text import missing, normalize_name, stable_id, text_or_empty
from fiscalis.operators import entities, findings, organizations, publications, temporal
from fiscalis.plans import dashboard, interop, marts

#: Fixed value: the order in which products are rebuilt; each step needs only those before it.
STEPS = ("temporality", "intelligence", "resolution", "quality_gate", "entity_hub", "watch_matches", "enforcement", "tribunal", "alerts", "profiles")
EVENT_COLUMNS = "event_id string, document_id string, entity_name string, region string"


def _written(df: DataFrame, work: str | None, name: str) -> DataFrame:
    """``df`` written below ``work`` and read back; without ``work`` as it is, to be evaluated by each use."""
    if work is None:
        return df
    df.write.mode("overwrite").parquet(f"{work}/{name}")
    return df.sparkSession.read.parquet(f"{work}/{name}")


def finding_inputs(documents: DataFrame, raw_findings: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Findings with what their document lends them: organization, date, objective. All that their rules look at.

    The join brings one row of a document to each of its findings. The organization is the resolved one, else the one
    that the document or its event names.
    """
    spark = documents.sparkSession
    events = events if events is not None else spark.createDataFrame([], EVENT_COLUMNS)
    named = organizations.document_organizations(documents, events)
    resolved = organizations.resolve_documents(documents, organizations.organization_rows(named))
    org = ("organization_id", "name", "organization_type", "region")
    first, second = (df.select("document_id", F.struct(*org).alias(alias)) for df, alias in ((resolved, "__r"), (named, "__n")))
    docs = documents.select("document_id", F.col("document_date").alias("__date"), temporal.objective(F.col("raw_text")).alias("objective"), findings.region_label(F.col("region"), F.col("unit_cgr"), F.col("title")).alias("__region"))
    docs = docs.join(first, "document_id", "left").join(second, "document_id", "full_outer").withColumn("__o", F.coalesce("__r", "__n"))
    pick = lambda c, alias: text_or_empty(F.col(f"__o.{c}")).alias(alias)
    docs = docs.select("document_id", "__date", "objective", pick("organization_id", "organization_id"), pick("name", "organization_name"), pick("organization_type", "organization_type"), F.coalesce(missing(F.col("__o.region")), F.col("__region"), F.lit("")).alias("region"))
    own = raw_findings.drop("organization_id", "organization_name", "organization_type", "region").join(docs, "document_id", "left")
    for c in ("organization_id", "organization_name", "organization_type", "region", "source_url"):
        own = own.withColumn(c, text_or_empty(F.col(c)) if c in own.columns else F.lit(""))
    return own


def apply_rules(own: DataFrame) -> DataFrame:
    """Occurrence, rules and scores of :func:`finding_inputs`: time first, then rules, each finding by itself."""
    own = temporal.with_occurrence(own, audit_objective="objective", doc_date="__date")
    out = findings.classify(own).withColumn("action_date", document_date(F.col("__date"))).drop("__date", "objective")
    for flag, kind in (("disciplinary", "DISCIPLINARY"), ("reparo", "REPARO"), ("criminal_referral", "CRIMINAL_REFERRAL"), ("cde_referral", "CDE_REFERRAL")):
        out = out.withColumn(flag, F.array_contains("enforcement", kind))
    labels = F.transform("irregular", lambda x: x["label"])
    parts = {"from": "from", "to": "to", "anchor": "anchor", "precision": "precision", "basis": "basis", "confidence": "confidence"}
    out = out.withColumn("irregularity_labels", labels).withColumn("roles_detected", findings.roles(F.col("description")))
    return out.withColumns({f"occurrence_date_{k}": F.col(f"occurrence.{v}") for k, v in parts.items()})


def enrich(documents: DataFrame, raw_findings: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Findings with their document's organization and date, occurrence, rules and scores."""
    return apply_rules(finding_inputs(documents, raw_findings, events))


def mentioned_people(enriched: DataFrame) -> DataFrame:
    return entities.person_mentions(enriched, "finding_id", "description").withColumn("person_id", stable_id("ENT", F.col("normalized_name")))


def provider_links(enriched: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """``(finding_id, provider_id, name, relationship_type)`` of providers named in findings, resolved, public names left out.

    ``found`` are the mentions, if they are there already.
    """
    found = found if found is not None else entities.provider_mentions(enriched, "finding_id", "description")
    found = found.withColumn("provider_id", stable_id("ENT", F.col("normalized_name")))
    orgs = enriched.select(normalize_name(F.col("organization_name")).alias("normalized_name")).distinct()
    return entities.without_collisions(found, orgs).select("finding_id", "provider_id", "name", "normalized_name", "relationship_type", "provider_type", "confidence")


def _relationships(enriched: DataFrame, links: DataFrame, persons: DataFrame) -> DataFrame:
    """Edges from the organization of a finding to its providers and persons, for findings that have one."""
    carry = ["finding_id", "document_id", "organization_id", *[c for c in ("evidence_id", "source_url", "event_id") if c in enriched.columns]]
    own = enriched.filter("organization_id <> ''").select(*carry)
    to_provider = links.select("finding_id", F.col("provider_id").alias("target_entity_id"), "relationship_type", "confidence")
    to_person = persons.select("finding_id", F.col("person_id").alias("target_entity_id"), F.lit("MENTIONED_PERSON").alias("relationship_type"), "confidence")
    edges = own.join(to_provider.unionByName(to_person), "finding_id").withColumnRenamed("organization_id", "source_entity_id")
    return edges.withColumn("relationship_id", stable_id("REL", F.col("source_entity_id"), F.col("target_entity_id"), F.col("relationship_type"), F.col("finding_id"))).dropDuplicates(["relationship_id"])


def derive(documents: DataFrame, raw_findings: DataFrame, watch: DataFrame, events: DataFrame | None = None, work: str | None = None) -> dict[str, DataFrame]:
    """All products by name. With ``work``, a folder that all executors share, shared inputs are written there once."""
    keep = lambda df, name: _written(df, work, name)
    enriched = keep(enrich(documents, raw_findings, events), "enriched")
    return products(enriched, None, keep(mentioned_people(enriched), "person_links"), documents, watch, keep)


def products(
    enriched: DataFrame, found: DataFrame | None, people: DataFrame, documents: DataFrame, watch: DataFrame, keep: Callable[[DataFrame, str], DataFrame],
    organization_details=dashboard.organization_details, provider_details=dashboard.provider_details,
) -> dict[str, DataFrame]:
    """All products of enriched findings and their mentions; ``keep(df, name)`` stores what several of them read.

    The two functions give the full profiles of ``(enrichment, organizations, providers)``.
    """
    mentions = keep(provider_links(enriched, found), "provider_links")
    old = mentions.groupBy("provider_id").agg(F.min("name").alias("name"), F.max("provider_type").alias("provider_type"), F.max("confidence").alias("confidence"))
    mapping, resolved = entities.resolve_providers(old)
    targets = mapping.select("provider_id", F.explode("targets").alias("target"))
    kinds = targets.join(old, "provider_id").groupBy(F.col("target").alias("provider_id")).agg(F.max("provider_type").alias("provider_type"), F.greatest(F.max("confidence"), F.lit(0.85)).alias("confidence"))
    providers = keep(resolved.join(kinds, "provider_id"), "providers")
    orgs = enriched.filter("organization_id <> ''").groupBy("organization_id").agg(F.max(F.struct("document_id", "organization_name", "organization_type", "region")).alias("o"))
    orgs = orgs.select("organization_id", F.col("o.organization_name").alias("name"), normalize_name(F.col("o.organization_name")).alias("normalized_name"), F.col("o.organization_type").alias("organization_type"), F.col("o.region").alias("region"), F.col("o.document_id").alias("source_document_id"), F.lit(organizations.RESOLVED).alias("confidence"))
    orgs = keep(orgs, "organizations")
    persons = people.groupBy("person_id").agg(F.max(F.struct("finding_id", "name", "normalized_name", "role", "confidence")).alias("p")).select("person_id", "p.name", "p.normalized_name", "p.role", "p.confidence")

    ids = mentions.groupBy("finding_id").agg(F.array_sort(F.collect_set("provider_id")).alias("provider_ids"))
    arrays = enriched.join(ids, "finding_id", "left").withColumn("provider_ids", F.coalesce("provider_ids", F.array().cast("array<string>")))
    mapped = keep(organizations.remap_providers(arrays, mapping, providers), "with_providers")
    edges = entities.remap(_relationships(enriched, mentions, people).withColumnRenamed("target_entity_id", "provider_id"), mapping, "provider_id").withColumnRenamed("provider_id", "target_entity_id")
    gate = organizations.quality_gate(orgs, providers, persons, mapped, edges)
    with_ids = keep(gate["finding_enrichment"], "finding_enrichment")
    one_each = with_ids.withColumn("provider_id", F.explode_outer("provider_ids"))
    hub = interop.adapt_entities(gate["entities"])
    years, precision = marts.temporal_summary(enriched)
    usable = enriched.filter(missing(F.col("organization_id")).isNotNull())
    org_details = organization_details(with_ids, orgs, gate["providers"])
    provider_rows = provider_details(with_ids, orgs, gate["providers"])
    enforcement = findings.enforcement_events(enriched)
    hypotheses = findings.hypothesis_rows(enriched)
    alerts = findings.alert_matches(enriched)
    return {
        "finding_enrichment": with_ids,
        "organizations": orgs,
        "providers": gate["providers"],
        "persons": persons,
        "relationships": gate["relationships"],
        "entities": gate["entities"],
        "entity_hub": hub,
        "irregularities": findings.irregularity_rows(enriched),
        "penal_hypotheses": hypotheses,
        "enforcement_events": enforcement,
        "fau_matches": alerts,
        "provider_links": mentions,
        "organization_profiles": dashboard.with_bounds(dashboard.organizations_list(org_details), with_ids, "organization_id"),
        "provider_profiles": dashboard.with_bounds(dashboard.providers_list(provider_rows), one_each, "provider_id"),
        "region_profiles": dashboard.region_details(with_ids),
        "penal_cases": dashboard.penal_cases(hypotheses, with_ids, with_ids),
        "enforcement_list": dashboard.enforcement_list(enforcement, with_ids, with_ids),
        "alerts_list": dashboard.alerts_list(alerts, with_ids, with_ids),
        "top_irregularities": marts.top_labels(usable, "organization_id", "irregularity_codes", 6),
        "temporal_years": years,
        "temporal_precision": precision,
        "occurrence_bounds": marts.occurrence_bounds(usable, "organization_id"),
        "watch_items": publications.match_watch(watch, documents),
        "kpis": marts.kpis(one_each.dropDuplicates(["finding_id"])),
    }
