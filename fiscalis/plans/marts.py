"""Profiles, indicators and top lists over classified findings.

Each profile is one aggregation (partial before the shuffle); a top list is a bounded heap per task, never a full sort.
Ties are settled by ids, so results do not depend on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalis.functions.dates import text_max, text_min
from fiscalis.functions.text import missing

#: Published with every mart.
DISCLAIMER = "Scores order human review; they establish neither an offence nor an individual responsibility."
NO_REGION = "Sin región"


def _flag(name: str) -> Column:
    return F.count_if(F.array_contains("enforcement", name))


def _amount() -> Column:
    return F.sum(F.coalesce("amount_clp", F.lit(0)))


def capped(x: Column) -> Column:
    return F.least(F.lit(100), x)


def organization_profiles(classified: DataFrame) -> DataFrame:
    """Rollup by organization with the recurrence and priority scores; rows without an organization are left out."""
    own = classified.filter(missing(F.col("organization_id")).isNotNull())
    out = own.groupBy("organization_id").agg(
        F.count("*").alias("findings"),
        F.countDistinct("document_id").alias("documents"),
        F.countDistinct("provider_id").alias("providers"),
        _amount().alias("amount"),
        F.max("cgr_score").alias("cgr_max"),
        F.max("penal_score").alias("penal_max"),
        F.max("aml_score").alias("aml_max"),
        F.count_if(F.col("penal_relevance") == "HIGH").alias("penal_high"),
        _flag("DISCIPLINARY").alias("disciplinary"),
        _flag("REPARO").alias("reparos"),
        _flag("CRIMINAL_REFERRAL").alias("criminal_referrals"),
        _flag("CDE_REFERRAL").alias("cde_referrals"),
    )
    c = F.col
    recurrence = c("findings") * 3 + c("documents") * 6 + c("penal_high") * 6 + c("criminal_referrals") * 12 + c("reparos") * 8 + c("providers") * 2
    out = out.withColumn("recurrence_score", capped(recurrence))
    priority = F.bround(F.lit(0.55) * c("cgr_max") + F.lit(0.25) * c("penal_max") + F.lit(0.20) * c("recurrence_score"), 0)
    return out.withColumn("priority_score", capped(priority).cast("bigint"))


def top_organizations(classified: DataFrame, n: int = 250) -> DataFrame:
    return organization_profiles(classified).orderBy(F.desc("priority_score"), F.desc("findings"), "organization_id").limit(n)


def provider_profiles(classified: DataFrame) -> DataFrame:
    """Rollup by provider with the exposure score."""
    own = classified.filter(missing(F.col("provider_id")).isNotNull())
    out = own.groupBy("provider_id").agg(
        F.count("*").alias("findings"),
        F.countDistinct("document_id").alias("documents"),
        F.countDistinct("organization_id").alias("organizations"),
        _amount().alias("amount"),
        F.count_if(F.col("penal_relevance") == "HIGH").alias("penal_high"),
    )
    c = F.col
    return out.withColumn("exposure_score", capped(c("organizations") * 15 + c("documents") * 8 + c("findings") * 4 + c("penal_high") * 8))


def top_providers(classified: DataFrame, n: int = 250) -> DataFrame:
    return provider_profiles(classified).orderBy(F.desc("exposure_score"), F.desc("organizations"), F.desc("findings"), "provider_id").limit(n)


def region_profiles(classified: DataFrame) -> DataFrame:
    """Rollup by region; missing regions are one group."""
    named = classified.withColumn("region", F.coalesce(missing(F.col("region")), F.lit(NO_REGION)))
    return named.groupBy("region").agg(
        F.count("*").alias("findings"),
        F.countDistinct("organization_id").alias("organizations"),
        F.countDistinct("document_id").alias("documents"),
        _amount().alias("amount"),
        F.count_if(F.col("penal_relevance") == "HIGH").alias("penal_high"),
    )


def top_labels(df: DataFrame, group: str, labels: str, n: int) -> DataFrame:
    """``(group, code, n, rank)``: the most frequent labels of each group, ties by first encounter in finding order."""
    # outer, then filtered: an inner explode would have its array computed again by an inferred filter
    each = df.select(group, "finding_id", F.posexplode_outer(labels).alias("pos", "code")).filter("code is not null")
    counts = each.groupBy(group, "code").agg(F.count("*").alias("n"), F.min(F.struct("finding_id", "pos")).alias("first"))
    w = Window.partitionBy(group).orderBy(F.desc("n"), "first")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).drop("first")


def kpis(classified: DataFrame) -> DataFrame:
    """One row of global indicators."""
    return classified.agg(
        F.count("*").alias("findings"),
        F.countDistinct("document_id").alias("documents"),
        F.countDistinct("organization_id").alias("organizations"),
        F.countDistinct("provider_id").alias("providers"),
        F.count_if(F.col("aml_relevance") == "HIGH").alias("aml_high"),
        F.count_if(F.col("penal_relevance") == "HIGH").alias("penal_high"),
        _flag("CRIMINAL_REFERRAL").alias("criminal_referrals"),
        _flag("REPARO").alias("reparos"),
        _amount().alias("amount"),
    )


def top_findings(classified: DataFrame, n: int = 250) -> DataFrame:
    return classified.orderBy(F.desc("priority_score"), F.desc("finding_id")).limit(n)


def top_cases(hypotheses: DataFrame, context: DataFrame, n: int = 250) -> DataFrame:
    """The highest hypotheses with columns of their findings; only the chosen rows are joined."""
    top = hypotheses.orderBy(F.desc("score"), "hypothesis_id").limit(n)
    return top.join(context, "finding_id", "left")


def nested_hypotheses(hypotheses: DataFrame) -> DataFrame:
    """Hypotheses of each finding as one array, by score descending and then id."""
    order = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("by"), "hypothesis_id", "code", "score")))
    return hypotheses.groupBy("finding_id").agg(F.transform(order, lambda x: F.struct(x["hypothesis_id"], x["code"], x["score"])).alias("details"))


def temporal_summary(findings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts by year of the anchor and by precision, of findings with a struct ``occurrence``."""
    years = findings.filter(F.col("occurrence.anchor") != "").groupBy(F.substring("occurrence.anchor", 1, 4).alias("year")).agg(F.count("*").alias("n"))
    precision = findings.groupBy(F.col("occurrence.precision").alias("precision")).agg(F.count("*").alias("n"))
    total = Window.partitionBy()
    return years, precision.withColumn("pct", F.bround(F.lit(100.0) * F.col("n") / F.greatest(F.sum("n").over(total), F.lit(1)), 1))


def occurrence_bounds(findings: DataFrame, group: str) -> DataFrame:
    """First and last known day of each group; empty if none is known."""
    return findings.groupBy(group).agg(text_min(F.col("occurrence.from")).alias("first_day"), text_max(F.col("occurrence.to")).alias("last_day"))


def latest_per_group(df: DataFrame, group: str, *order: str) -> DataFrame:
    """The last row of each group by ``order``: an aggregation of structs, without a sort of the group."""
    rest = [c for c in df.columns if c != group and c not in order]
    best = df.groupBy(group).agg(F.max(F.struct(*order, *rest)).alias("row"))
    return best.select(group, "row.*")


def coverage(registry: DataFrame, max_attempts: int = 4) -> DataFrame:
    """One row on the fetch queue: by status, exhausted, and the share that is fetched."""
    c = F.col
    return registry.agg(
        F.count("*").alias("discovered"),
        F.count_if(c("status") == "FETCHED").alias("fetched"),
        F.count_if((c("status") == "ERROR") & (c("attempts") >= max_attempts)).alias("exhausted"),
        F.count_if((c("status") != "FETCHED") & (c("attempts") < max_attempts)).alias("pending"),
        text_min(c("first_seen")).alias("first_seen"),
        text_max(c("last_seen")).alias("last_seen"),
    ).withColumn("fetched_pct", F.bround(F.lit(100.0) * c("fetched") / F.greatest(c("discovered"), F.lit(1)), 1))
