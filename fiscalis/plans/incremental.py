"""The derivation over what has changed: equal to a full one, with the costly steps on new and changed rows only.

The state of the last run is published with its products, under one manifest. A finding's inputs are its own row and what
its document lends it; their digest tells whether rules, dates and mentions of the finding have to run again. What is per
group, an organization's or a provider's profile, has a checksum of all the rows it is made of; only groups whose checksum
is not the stored one are derived again. Bodies, providers and the quality gate depend on all rows, are joins of narrow
tables and run whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalis.operators import entities
from fiscalis.operators.store import semantic_hash
from fiscalis.plans import dashboard
from fiscalis.plans.derive import apply_rules, finding_inputs, mentioned_people, products
from fiscalis.sources.publication import publish, read_published
from fiscalis.sources.scratch import written

STATE = ("finding_inputs", "enriched", "provider_mentions", "person_links", "organization_details", "organization_sums", "provider_details", "provider_sums")


def finding_changes(inputs: DataFrame, old: DataFrame | None) -> DataFrame:
    """``(finding_id, input_hash, change)`` with change in inserted, updated, unchanged, deleted.

    ``inputs`` has one row per finding; the hash is over all its columns, and ``old`` are the rows of the last run.
    """
    new = inputs.select("finding_id", semantic_hash(inputs.columns, ()).alias("input_hash"))
    if old is None:
        return new.withColumn("change", F.lit("inserted"))
    both = new.join(old.select("finding_id", F.col("input_hash").alias("old_hash")), "finding_id", "full_outer")
    change = (
        F.when(F.col("old_hash").isNull(), "inserted").when(F.col("input_hash").isNull(), "deleted")
        .when(F.col("old_hash") != F.col("input_hash"), "updated").otherwise("unchanged")
    )
    return both.select("finding_id", "input_hash", change.alias("change"))


def carried(old: DataFrame | None, unchanged: DataFrame, fresh: DataFrame) -> DataFrame:
    """The rows of unchanged findings as they were, and those that were derived again."""
    if old is None:
        return fresh
    return old.join(unchanged, "finding_id", "left_semi").select(*fresh.columns).unionByName(fresh)


def group_sums(key: str, *parts: DataFrame) -> DataFrame:
    """``(key, rows, total)``: a checksum of all rows that each group is made of, whatever their order."""
    every = None
    for df in parts:
        row = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})).cast("decimal(38,0)")
        own = df.filter(F.col(key).isNotNull()).select(key, row.alias("h"))
        every = own if every is None else every.unionByName(own)
    return every.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.sum("h").alias("total"))


def by_group(key: str, sums: DataFrame, old_sums: DataFrame | None, old: DataFrame | None, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``compute(groups)`` gives for the groups whose checksum is new, and the old rows of those where it is not."""
    if old is None:
        return compute(sums.select(key))
    same = sums.join(old_sums, [key, "rows", "total"], "left_semi").select(key)
    fresh = compute(sums.join(same, key, "left_anti").select(key))
    return old.join(same, key, "left_semi").select(*fresh.columns).unionByName(fresh)


def derive_changes(documents: DataFrame, raw_findings: DataFrame, watch: DataFrame, root: str, events: DataFrame | None = None) -> dict[str, int]:
    """Derive, publish products and state below ``root``, and count: rows of each table, ``findings_derived``, groups.

    Findings have one row per ``finding_id``. The first run derives all; a later one reads the published state. A run that
    stops leaves the published version as it was.
    """
    spark = documents.sparkSession
    old = read_published(spark, root)
    of = lambda name: old.get(f"state_{name}")
    inputs = written(finding_inputs(documents, raw_findings, events), "finding-inputs")
    changes = written(finding_changes(inputs, of("finding_inputs")), "finding-changes")
    unchanged = changes.filter("change = 'unchanged'").select("finding_id")
    todo = inputs.join(changes.filter("change in ('inserted', 'updated')").select("finding_id"), "finding_id", "left_semi")
    fresh = written(apply_rules(todo), "fresh-findings")
    enriched = written(carried(of("enriched"), unchanged, fresh), "enriched")
    mentions = written(carried(of("provider_mentions"), unchanged, entities.provider_mentions(fresh, "finding_id", "description")), "provider-mentions")
    people = written(carried(of("person_links"), unchanged, mentioned_people(fresh)), "person-links")
    state: dict[str, DataFrame] = {}

    def organizations(rows: DataFrame, orgs: DataFrame, providers: DataFrame) -> DataFrame:
        names = rows.select("organization_id", F.explode("provider_ids").alias("provider_id")).distinct().join(providers.select("provider_id", "name"), "provider_id", "left")
        own = rows.filter("organization_id <> ''")
        sums = written(group_sums("organization_id", own, names.filter("organization_id <> ''"), orgs.select("organization_id", "name", "region").join(own.select("organization_id").distinct(), "organization_id", "left_semi")), "organization-sums")
        compute = lambda groups: dashboard.organization_details(own.join(groups, "organization_id", "left_semi"), orgs, providers)
        state["organization_sums"] = sums
        state["organization_details"] = written(by_group("organization_id", sums, of("organization_sums"), of("organization_details"), compute), "organization-details")
        return state["organization_details"]

    def provider_rows(rows: DataFrame, orgs: DataFrame, providers: DataFrame) -> DataFrame:
        each = rows.withColumn("provider_id", F.explode_outer("provider_ids")).filter("provider_id is not null")
        names = each.select("provider_id", "organization_id").distinct().join(orgs.select("organization_id", "name"), "organization_id", "left")
        sums = written(group_sums("provider_id", each, names, providers.select("provider_id", "name").join(each.select("provider_id").distinct(), "provider_id", "left_semi")), "provider-sums")

        def compute(groups: DataFrame) -> DataFrame:
            own = each.join(groups, "provider_id", "left_semi").withColumn("provider_ids", F.array("provider_id")).drop("provider_id")
            return dashboard.provider_details(own, orgs, providers)

        state["provider_sums"] = sums
        state["provider_details"] = written(by_group("provider_id", sums, of("provider_sums"), of("provider_details"), compute), "provider-details")
        return state["provider_details"]

    made = products(enriched, mentions, people, documents, watch, written, organizations, provider_rows)
    state |= {"finding_inputs": changes.filter("change <> 'deleted'").select("finding_id", "input_hash"), "enriched": enriched, "provider_mentions": mentions, "person_links": people}
    counts = publish(made | {f"state_{k}": state[k] for k in STATE}, root)
    kinds = {r.change: r["count"] for r in changes.groupBy("change").count().collect()}
    return counts | {f"findings_{k}": kinds.get(k, 0) for k in ("inserted", "updated", "unchanged", "deleted")} | {"findings_derived": fresh.count()}
